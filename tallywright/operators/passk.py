"""pass@k per problem, difficulty classes and their shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.metrics import difficulty, pass_at_k_col, ratio


def pass_at_k(
    attempts: DataFrame, ks: list[int] = fv.PASS_AT, strict: bool = False
) -> DataFrame:
    """``pass@k`` per problem from the long table: two counts, then a formula per problem.

    Missing verdicts are not counted. A problem with none gets NULL.
    """
    counts = attempts.groupBy("problem_id").agg(
        F.count("passed").alias("n"), F.count_if(F.col("passed")).alias("c")
    )
    return counts.select(
        "problem_id", "n", "c",
        *[pass_at_k_col(F.col("n"), F.col("c"), k, strict).alias(f"pass@{k}") for k in ks],
    )


def with_difficulty(rates: DataFrame, rate: str = "pass@1") -> DataFrame:
    return rates.withColumn("difficulty", difficulty(F.col(rate)))


def mean_pass_at_k(
    rates: DataFrame, by: list[str] | None = None, ks: list[int] = fv.PASS_AT
) -> DataFrame:
    """Mean of each pass@k over a set of problems, or over each set named by ``by``."""
    return rates.groupBy(*(by or [])).agg(
        *[F.avg(f"pass@{k}").alias(f"mean_pass@{k}") for k in ks]
    )


def class_distribution(classified: DataFrame) -> DataFrame:
    """Count and share of every class, those without rows included. One pass, no join."""
    counts = classified.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("difficulty") == name).alias(name) for name in fv.CLASSES],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("difficulty"),
                F.col(name).alias("problems"),
                ratio(F.col(name), F.col("total")).alias("share"),
            )
            for name in fv.CLASSES
        ]
    )
    return counts.select(F.inline(rows))
