"""Model responses: records, statistics, run metadata and the ledger of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.metrics import ratio
from ..functions.text import prompt_text
from .totals import grouped_with_total


def record_id(task_id: Column, position: Column) -> Column:
    """Id of a record as text; ``unknown_<position>`` where the problem has none."""
    return F.coalesce(
        task_id.cast("string"), F.concat(F.lit("unknown_"), position.cast("string"))
    )


def head_problems(
    problems: DataFrame, n: int | None = None, demo: bool = False, order: str = "task_id"
) -> DataFrame:
    """The first ``n`` problems by ``order``; 0 or None takes all, a demo run four."""
    limit = fv.DEMO_PROBLEMS if demo else n
    return problems.orderBy(order).limit(limit) if limit else problems


def with_prompt(problems: DataFrame) -> DataFrame:
    return problems.withColumn(
        "prompt", prompt_text(F.col("text"), F.col("task_id"), F.col("test_list"))
    )


def assemble_responses(prompts: DataFrame, replies: DataFrame) -> DataFrame:
    """Response records from prompts and the replies to them.

    ``prompts`` has the problem fields, ``prompt`` and ``position``; ``replies`` has
    ``position``, ``model_response`` and ``timestamp``.
    """
    fields = [c for c in prompts.columns if c not in ("prompt", "position")]
    return prompts.join(replies, "position").select(
        record_id(F.col("task_id"), F.col("position")).alias("problem_id"),
        F.struct(*fields).alias("problem"),
        "prompt", "model_response", "timestamp",
    )


def response_stats(
    responses: DataFrame, by: list[str] = ["split"], total: bool = True
) -> DataFrame:
    """Responses, errors and tokens per group and overall."""
    tokens = F.col("model_response.usage.total_tokens")
    measures = {
        "total_problems": F.count(F.lit(1)),
        "successful_responses": F.count_if(F.col("model_response.error").isNull()),
        "total_tokens": F.coalesce(F.sum(tokens), F.lit(0)),
        "token_rows": F.count(tokens),
    }
    return grouped_with_total(responses, measures, by, total).select(
        *by, "is_total", "total_problems", "successful_responses",
        (F.col("total_problems") - F.col("successful_responses")).alias("failed_responses"),
        ratio(F.col("successful_responses"), F.col("total_problems")).alias("success_rate"),
        ratio(F.col("total_tokens"), F.col("token_rows")).alias("average_tokens"),
        "total_tokens",
    )


def run_metadata(runs: DataFrame, problems: DataFrame) -> DataFrame:
    """Run settings with the problems loaded for their split and those to process.

    ``runs`` has ``split``, ``demo_mode``, ``max_problems`` (0 or NULL: no limit) and any
    further settings, which are kept. Every split there is counts; the counts are one row a split.
    """
    loaded = problems.groupBy("split").agg(F.count(F.lit(1)).alias("total_problems_loaded"))
    limit = F.nullif(F.col("max_problems"), F.lit(0))
    count = F.coalesce(F.col("total_problems_loaded"), F.lit(0))
    return (
        runs.join(loaded, "split", "left")
        .withColumn("total_problems_loaded", count)
        .withColumn(
            "problems_to_process",
            F.when(F.col("demo_mode"), F.lit(fv.DEMO_PROBLEMS).cast("bigint")).otherwise(
                F.least(F.col("total_problems_loaded"), F.coalesce(limit, F.col("total_problems_loaded")))
            ),
        )
    )


def metadata_records(table: DataFrame) -> DataFrame:
    """``run_metadata`` rows in the nested form they are stored in.

    ``timestamp`` and ``results_directory`` stand beside the settings where they are given.
    """
    counts = ["total_problems_loaded", "problems_to_process"]
    beside = ["timestamp", "results_directory"]
    settings = [c for c in table.columns if c not in counts + beside]
    return table.select(
        *[c for c in beside if c in table.columns],
        F.struct(*settings).alias("run_config"),
        F.struct(*counts).alias("dataset_info"),
    )


def ledger_summary(runs: DataFrame) -> DataFrame:
    """Runs of the ledger that succeeded and failed."""
    return runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("success")).alias("successful_runs"),
    ).select(
        "total_runs", "successful_runs",
        (F.col("total_runs") - F.col("successful_runs")).alias("failed_runs"),
        ratio(F.col("successful_runs"), F.col("total_runs")).alias("success_rate"),
    )
