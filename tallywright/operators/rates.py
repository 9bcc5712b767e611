"""Pass rates over attempts, and the problems at either end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.metrics import ratio


def _counts() -> list[Column]:
    return [
        F.count("passed").alias("attempts"),
        F.count_if(F.col("passed")).alias("passes"),
    ]


def overall_rate(attempts: DataFrame) -> DataFrame:
    """One row: attempts, passes, failures and their rate."""
    return attempts.agg(*_counts()).select(
        "attempts",
        "passes",
        (F.col("attempts") - F.col("passes")).alias("failures"),
        ratio(F.col("passes"), F.col("attempts")).alias("pass_rate"),
    )


def rate_by(attempts: DataFrame, key: str) -> DataFrame:
    """Attempts, passes and pass rate per run or per problem."""
    return attempts.groupBy(key).agg(*_counts()).withColumn(
        "pass_rate", ratio(F.col("passes"), F.col("attempts"))
    )


def top_by_count(attempts: DataFrame, n: int = fv.TOP_ROWS) -> DataFrame:
    """The ``n`` problems with most attempts; the smaller id first among equals."""
    return (
        rate_by(attempts, "problem_id").orderBy(F.desc("attempts"), "problem_id").limit(n)
    )


def top_by_rate(attempts: DataFrame, n: int = fv.TOP_ROWS, worst: bool = False) -> DataFrame:
    """The ``n`` problems with the highest (or lowest) pass rate over the runs they have."""
    rate = F.col("pass_rate") if worst else F.desc("pass_rate")
    return (
        rate_by(attempts, "problem_id")
        .select("problem_id", "pass_rate")
        .orderBy(rate, "problem_id")
        .limit(n)
    )


def run_coverage_rate(attempts: DataFrame) -> DataFrame:
    """Passes per run over *all* problems, also those the run has no attempt for."""
    problems = attempts.agg(F.count_distinct("problem_id")).scalar()
    return (
        attempts.groupBy("run_id")
        .agg(F.count_if(F.col("passed")).alias("passes"))
        .withColumn("problems", problems)
        .withColumn("coverage_rate", ratio(F.col("passes"), F.col("problems")))
    )


def first_per_group(rows: DataFrame, by: list[str], order: list[Column], n: int = fv.TOP_ROWS) -> DataFrame:
    """The ``n`` first rows of each group by ``order`` (ascending; negate a number to turn it round).

    Adds ``place`` from 1. Rows equal in ``order`` go by their other columns, so the result never
    depends on the partitioning; rows equal in all are counted and repeated. No group is sorted or gathered: the
    rows of a group are dealt by their hash into some parts, whose first rows are found with a partial step.
    The ``n``-th of these cannot come before the group's ``n``-th row, so all that follow it go;
    what is left is a few times ``n`` different rows, however large the group is. Columns are orderable.
    """
    others = [c for c in rows.columns if c not in by]
    keys = [order_by.alias(f"o{k}") for k, order_by in enumerate(order)]
    keyed = rows.select(*by, F.struct(*keys, F.struct(*others).alias("row")).alias("_key"))
    part = F.pmod(F.xxhash64("_key"), F.lit(8 * n)).alias("_part")
    firsts = keyed.groupBy(*by, part).agg(F.min("_key").alias("_first"))
    cut = firsts.groupBy(*by).agg(F.get(F.sort_array(F.collect_list("_first")), F.lit(n - 1)).alias("_cut"))
    cut = cut.select(*[F.col(c).alias(f"_{c}") for c in by], "_cut")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    # Parts of a group that has fewer than n say that it has few different rows.
    few = keyed.join(cut, same).where(F.col("_cut").isNull() | (F.col("_key") <= F.col("_cut")))
    counted = few.groupBy(*by, "_key").agg(F.least(F.count(F.lit(1)), F.lit(n)).cast("int").alias("_times"))
    listed = F.sort_array(F.flatten(F.collect_list(F.array_repeat("_key", F.col("_times")))))
    return counted.groupBy(*by).agg(F.slice(listed, 1, n).alias("_rows")).select(
        *by, F.posexplode("_rows").alias("_place", "_found")
    ).select(*by, *[F.col(f"_found.row.`{c}`").alias(c) for c in others], (F.col("_place") + 1).alias("place"))


def hardest_by(rates: DataFrame, by: list[str], n: int = fv.TOP_ROWS) -> DataFrame:
    """The ``n`` problems with the lowest pass rate in each group; the smaller id first among equals."""
    return first_per_group(rates, by, [F.col("pass_rate"), F.col("problem_id")], n)


def easiest_by(rates: DataFrame, by: list[str], n: int = fv.TOP_ROWS) -> DataFrame:
    """The ``n`` problems with the highest pass rate in each group."""
    return first_per_group(rates, by, [-F.col("pass_rate"), F.col("problem_id")], n)


def most_attempted_by(rates: DataFrame, by: list[str], n: int = fv.TOP_ROWS) -> DataFrame:
    """The ``n`` problems with most attempts in each group."""
    return first_per_group(rates, by, [-F.col("attempts"), F.col("problem_id")], n)
