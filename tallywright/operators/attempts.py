"""Attempts: one row per problem and run with its verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.quarantine import read_kept, read_set_aside, write_split

_CHECKED = T.StructType(
    [T.StructField("run_id", T.StringType()), T.StructField("raw_id", T.StringType()),
     T.StructField("problem_id", T.LongType()), T.StructField("passed", T.BooleanType())]
)


def to_attempts(evaluations: DataFrame) -> DataFrame:
    """Evaluations as (run_id, problem_id, passed). No verdict counts as not passed.

    Ids that are no whole numbers raise, as ANSI casts do.
    """
    return evaluations.select(
        F.col("run_id").cast("string").alias("run_id"),
        F.col("problem_id").cast("bigint").alias("problem_id"),
        F.coalesce(F.col("passed").cast("boolean"), F.lit(False)).alias("passed"),
    )


def with_id_check(evaluations: DataFrame) -> DataFrame:
    """The tolerant form: ``problem_id`` where the id is a whole number, else NULL.

    The text it came from stays in ``raw_id``. Rows with a NULL id are the ones to set aside.
    """
    return evaluations.select(
        F.col("run_id").cast("string").alias("run_id"),
        F.col("problem_id").cast("string").alias("raw_id"),
        F.col("problem_id").try_cast("bigint").alias("problem_id"),
        F.coalesce(F.col("passed").try_cast("boolean"), F.lit(False)).alias("passed"),
    )


NO_NUMBER = "id is not a whole number"


def store_attempts(evaluations: DataFrame, path: str) -> dict[str, int]:
    """Store attempts whose id is a whole number, and set the others aside with the reason, in one write.

    Returns how many were ``kept`` and ``set_aside``. ``stored_attempts`` and ``attempts_set_aside`` read them.
    """
    reason = F.when(F.col("problem_id").isNull(), NO_NUMBER)
    return write_split(with_id_check(evaluations), path, reason)


def stored_attempts(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, problem_id, passed) of the attempts that were kept."""
    return read_kept(spark, path, _CHECKED).select("run_id", "problem_id", "passed")


def attempts_set_aside(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, raw_id, passed, reason) of the attempts that were not."""
    return read_set_aside(spark, path, _CHECKED).select("run_id", "raw_id", "passed", "reason")


def by_run_and_problem(attempts: DataFrame) -> DataFrame:
    """Global order by run, then problem, then the row's other columns: a range-partitioned sort.

    The key is a function of the row alone, so a task that is run again sorts it to the same place.
    """
    others = [c for c in attempts.columns if c not in ("run_id", "problem_id")]
    return attempts.orderBy("run_id", "problem_id", *others)


def duplicate_attempts(attempts: DataFrame) -> DataFrame:
    """(problem, run) pairs that occur more than once, with their number of rows."""
    return (
        attempts.groupBy("problem_id", "run_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
    )


def first_attempts(attempts: DataFrame, order: list[str | Column]) -> DataFrame:
    """The first row of each (problem, run) by ``order``.

    Only the smallest row per map task is shuffled, however many rows a pair has. Equal
    positions fall back to the verdict, so the result never depends on the partitioning.
    """
    picked = F.min(F.struct(*order, F.col("passed").alias("_passed")))
    return attempts.groupBy("problem_id", "run_id").agg(picked.alias("_first")).select(
        "problem_id", "run_id", F.col("_first._passed").alias("passed")
    )
