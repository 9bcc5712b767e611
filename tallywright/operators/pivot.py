"""The problem-by-run table and its inverse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .attempts import first_attempts


def run_columns(runs: list[str]) -> list[str]:
    return [f"run_{run}_pass" for run in runs]


def pivot_runs(
    attempts: DataFrame,
    runs: list[str] | None = None,
    on_duplicate: str = "error",
    order: list[str] | None = None,
) -> DataFrame:
    """One row per problem, one nullable verdict per run in ``runs``.

    Without ``runs`` the columns are those of all runs there are, in order, for which the ids of
    the runs are read first. An attempt of a run that is not listed raises.
    One aggregation with one shuffle: every run is a conditional column, and the same pass
    counts its rows, so a second row for a (problem, run) raises unless
    ``on_duplicate='first'`` picks the first by ``order``.
    """
    if on_duplicate == "first":
        attempts = first_attempts(attempts, order)
    elif on_duplicate != "error":
        raise ValueError("on_duplicate is 'error' or 'first'")
    if runs is None:
        found = attempts.select("run_id").where("run_id is not null").distinct()
        runs = sorted(r["run_id"] for r in found.collect())
    cells = []
    other = F.count_if(F.coalesce(~F.col("run_id").isin(runs), F.lit(True)))
    unlisted = F.raise_error(
        F.concat(
            F.lit("attempts of runs that are not listed, at problem "),
            F.col("problem_id").cast("string"),
        )
    ).cast("boolean")
    for run, name in zip(runs, run_columns(runs)):
        here = F.col("run_id") == run
        verdict = F.min(F.when(here, F.col("passed")))
        twice = F.raise_error(
            F.concat(
                F.lit(f"run {run} has more than one attempt at problem "),
                F.col("problem_id").cast("string"),
            )
        ).cast("boolean")
        cells.append(F.when(other > 0, unlisted).when(F.count_if(here) > 1, twice).otherwise(verdict).alias(name))
    return attempts.groupBy("problem_id").agg(*cells)


def unpivot_runs(pivot: DataFrame, runs: list[str], keep_missing: bool = False) -> DataFrame:
    """Back to attempts; cells without a verdict are left out unless kept."""
    long = pivot.unpivot("problem_id", run_columns(runs), "_column", "passed").select(
        F.regexp_extract("_column", "^run_(.*)_pass$", 1).alias("run_id"),
        "problem_id",
        "passed",
    )
    return long if keep_missing else long.where(F.col("passed").isNotNull())
