"""Distinct problems in a form that can be stored per run and merged later, without the ids.

A sketch (HyperLogLog) has at most 2^``lg_k`` counters, whatever it has seen, so tables of sketches
stay small: a coverage over all runs reads one row a run instead of all attempts. Estimates are off
by a relative standard error of ``standard_error(lg_k)``; few ids are counted nearly exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import ratio

LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a merged estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def run_sketches(
    rows: DataFrame, by: list[str] = ["run_id"], id_col: str = "problem_id", lg_k: int = LG_K
) -> DataFrame:
    """(by, rows, passes, sketch) per group: one row to store for each run.

    Groups are sketched in every task and the sketches merged, so a group of any size costs one row a
    task. NULL ids are not counted. Without ``passed`` there are no ``passes``.
    """
    passes = [F.count_if(F.col("passed")).alias("passes")] if "passed" in rows.columns else []
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *passes, F.hll_sketch_agg(id_col, lg_k).alias("sketch")
    )


def merged_distinct(sketches: DataFrame, by: list[str] = []) -> DataFrame:
    """(by, rows, problems): the estimated number of different ids in the merged sketches."""
    merged = sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("sketch", F.lit(True)).alias("sketch")
    )
    return merged.select(*by, F.coalesce("rows", F.lit(0)).alias("rows"),
                         F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("problems"))


def run_coverage(sketches: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, passes, problems, coverage): passes of a run over all problems of all runs, estimated."""
    problems = merged_distinct(sketches).select("problems").scalar()
    return sketches.select(run, "passes", problems.alias("problems"), ratio(F.col("passes"), problems).alias("coverage"))
