"""Training rows: sampled problems with the text of their best attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.text import instruction_text
from ..functions.verdict import pass_count
from ..sources.scratch import stored

POSITION = ["position"]
MOST_BROADCAST = 200_000  # rows of ids, a run, a position and dataset names


def best_attempt(evaluations: DataFrame, position: list[str] = POSITION) -> DataFrame:
    """The best attempt per problem as (problem_id, run_id, position, score).

    A pass scores 100, anything else the number of outputs that speak of a pass. Among equal
    scores the earliest run wins, then the earliest row. Only the score and the position of
    the best row per map task are shuffled; texts are not touched.
    """
    score = F.when(F.col("passed"), F.lit(fv.PASS_SCORE)).otherwise(
        pass_count(F.col("test_outputs"))
    )
    return (
        evaluations.select("problem_id", "run_id", *position, score.alias("_score"))
        .groupBy("problem_id")
        .agg(F.min(F.struct((-F.col("_score")).alias("_rank"), "run_id", *position)).alias("_best"))
        .select(
            "problem_id",
            *[F.col(f"_best.{c}").alias(c) for c in ["run_id", *position]],
            (-F.col("_best._rank")).alias("score"),
        )
    )


def reference_code(responses: DataFrame, position: list[str] = POSITION) -> DataFrame:
    """The solution per problem, the last one where there are several."""
    return responses.groupBy("problem_id").agg(
        F.max_by(F.col("problem.code"), F.struct(*position)).alias("code")
    ).where(F.col("code").isNotNull())


def train_rows(
    samples: DataFrame,
    evaluations: DataFrame,
    code: DataFrame | None = None,
    position: list[str] = POSITION,
) -> DataFrame:
    """(dataset, problem_id, instruction, output) for every sampled problem with both parts.

    With ``code`` the output is the reference solution and the instruction the full question;
    without it they are the best attempt's own code and the bare problem statement.

    ``samples`` holds (dataset, problem_id), each pair once. The best attempts of the sampled
    problems, without texts, are stored and counted first. Up to ``MOST_BROADCAST`` of them are
    sent to the texts, which then are not shuffled; more are joined by (problem, run, position),
    which spreads a hot problem. Only the texts that the rows are made of are read.
    """
    datasets = samples.groupBy("problem_id").agg(F.collect_set("dataset").alias("_datasets"))
    keys = ["problem_id", "run_id", *position]
    best = best_attempt(evaluations, position).drop("score").join(datasets, "problem_id")
    best = stored(best.select(*[F.col(k).alias(f"_{k}") for k in keys], "_datasets"), "best-attempts")
    if best.count() <= MOST_BROADCAST:
        best = F.broadcast(best)
    parts = ["problem_statement", "generated_code" if code is None else "test_cases"]
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    # One row per problem is kept should a position occur twice; its hash decides, not its texts.
    rows = (
        evaluations.select(*keys, *parts)
        .join(best, same)
        .groupBy("problem_id")
        .agg(F.min_by(F.struct(*parts, "_datasets"), F.xxhash64(*parts)).alias("_first"))
        .select("problem_id", "_first.*")
    )
    if code is None:
        instruction, output = F.col("problem_statement"), F.col("generated_code")
    else:
        rows = rows.join(code, "problem_id")
        instruction = instruction_text(
            F.col("problem_statement"), F.col("problem_id"), F.col("test_cases")
        )
        output = F.col("code")
    return rows.select(
        "problem_id", "_datasets", instruction.alias("instruction"), output.alias("output")
    ).select(F.explode("_datasets").alias("dataset"), "problem_id", "instruction", "output")


def train_rows_missing(
    samples: DataFrame, evaluations: DataFrame, code: DataFrame | None = None
) -> DataFrame:
    """Sampled problems that give no training row, and why."""
    missing = samples.select("problem_id").distinct().join(
        evaluations.select("problem_id").distinct().withColumn("_run", F.lit(True)),
        "problem_id", "left",
    )
    reason = F.when(F.col("_run").isNull(), F.lit("no results"))
    if code is not None:
        missing = missing.join(
            code.select("problem_id").withColumn("_code", F.lit(True)), "problem_id", "left"
        )
        reason = reason.when(F.col("_code").isNull(), F.lit("no reference code"))
    return missing.select("problem_id", reason.alias("reason")).where(F.col("reason").isNotNull())
