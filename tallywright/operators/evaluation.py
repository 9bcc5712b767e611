"""From responses and recorded script runs to verdicts, test rows and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.metrics import ratio
from ..functions.text import bind, extract_code, response_content, strip_ws, test_script
from ..functions.verdict import all_passed, final_outputs, outcome_lines, parse_outcome
from .totals import grouped_with_total

RUN_FIELDS = ["returncode", "stdout", "stderr", "timed_out", "runner_error"]
NOT_RUN = "no recorded script run"


def with_generated_code(responses: DataFrame) -> DataFrame:
    """Adds ``generated_code``. Two steps, so that each text is taken apart once per row."""
    return responses.withColumn("_content", response_content(F.col("model_response"))).withColumn(
        "generated_code", extract_code(F.col("_content"))
    ).drop("_content")


def with_script(coded: DataFrame) -> DataFrame:
    """Adds the ``script`` that tests ``generated_code`` against ``test_cases``."""
    return coded.withColumn("script", test_script(F.col("generated_code"), F.col("test_cases")))


def with_verdict(runs: DataFrame, printed_lines_only: bool = False) -> DataFrame:
    """Adds ``test_outputs`` and ``passed`` to rows that tell how a script's run ended.

    Only silent runs need the script's text. Without a ``script`` column it is put together
    for those rows alone, from ``generated_code`` and ``test_cases``.
    ``printed_lines_only`` is the older rule: the exit code and the error text do not count,
    and a run that reports nothing has passed.
    """
    timed_out = F.coalesce(F.col("timed_out"), F.lit(False))
    if printed_lines_only:
        script = F.lit("")
    elif "script" in runs.columns:
        script = F.col("script")
    else:
        script = test_script(F.col("generated_code"), F.col("test_cases"))
    returncode = F.lit(0) if printed_lines_only else F.coalesce(F.col("returncode"), F.lit(0))
    # Bound, so that each text is taken apart once, also in a filter on the verdict.
    texts = F.struct(
        outcome_lines(F.col("stdout")).alias("lines"),
        strip_ws(F.coalesce(F.col("stderr"), F.lit(""))).alias("stderr"),
    )
    outputs = bind(
        texts,
        lambda t: final_outputs(
            t["lines"], t["stderr"], returncode, timed_out, F.col("runner_error"), script
        ),
    )
    passed = all_passed(F.col("test_outputs"), if_none=printed_lines_only)
    return runs.withColumn("test_outputs", outputs).withColumn(
        "passed", ~timed_out & F.col("runner_error").isNull() & passed
    )


def evaluate(
    responses: DataFrame,
    script_runs: DataFrame,
    keys: list[str] = ["problem_id", "run_id"],
    keep: list[str] = [],
) -> DataFrame:
    """Evaluations of responses whose scripts were run elsewhere.

    ``keys`` identify an attempt on both sides; a second recorded run of one raises. ``keep`` names
    further columns of the responses to carry along, such as the split. A response without code is a failed
    evaluation without outputs; a script without a recorded run is a runner error.
    """
    coded = with_generated_code(
        responses.select(
            *keys,
            *keep,
            F.col("problem.text").alias("problem_statement"),
            F.coalesce(
                F.col("problem.test_list"), F.array().cast("array<string>")
            ).alias("test_cases"),
            "model_response",
        )
    ).drop("model_response")
    joined = coded.join(
        _one_run(script_runs.select(*keys, *RUN_FIELDS), keys), keys, "left"
    ).withColumn(
        "runner_error",
        F.when(F.col("_found").isNull(), F.lit(NOT_RUN)).otherwise(F.col("runner_error")),
    ).drop("_found")
    return without_code_failed(with_verdict(joined)).select(
        *keys, *keep, "problem_statement", "passed", "error", "test_outputs", "generated_code",
        "test_cases",
    )


def _one_run(runs: DataFrame, keys: list[str]) -> DataFrame:
    """The recorded run of each key; a window on the join's keys costs no exchange of its own."""
    named = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    twice = F.raise_error(F.concat(F.lit("more than one recorded run of "), named)).cast("boolean")
    several = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    return runs.withColumn("_several", several).withColumn(
        "_found", F.when(F.col("_several"), twice).otherwise(F.lit(True))
    ).drop("_several")


def without_code_failed(judged: DataFrame) -> DataFrame:
    """Rows without code did not pass and have no outputs; adds ``error``."""
    empty = F.col("generated_code") == ""
    return (
        judged.withColumn("error", F.when(empty, F.lit(fv.NO_CODE)))
        .withColumn("passed", ~empty & F.col("passed"))
        .withColumn(
            "test_outputs",
            F.when(empty, F.array().cast("array<string>")).otherwise(F.col("test_outputs")),
        )
    )


def explode_tests(evaluations: DataFrame, keep: list[str] = ["problem_id"]) -> DataFrame:
    """One row per test output with the statement at its place. No shuffle."""
    number = (F.col("_at") + 1).cast("string")
    statement = F.coalesce(
        F.get("test_cases", "_at"),
        F.concat(F.lit("Test case "), number, F.lit(" (no statement)")),
    )
    # The outer form, because the plain one has the optimizer add a filter on the array below
    # the step that computes it, which would compute it again.
    outcome = evaluations.select(
        *keep, "problem_statement", "test_cases",
        F.posexplode_outer("test_outputs").alias("_at", "_output"),
    ).where(F.col("_at").isNotNull()).select(
        *keep, "problem_statement", statement.alias("test_case_statement"),
        parse_outcome(F.col("_output")).alias("_outcome"),
    )
    return outcome.select(
        *keep, "problem_statement", "test_case_statement",
        F.col("_outcome.status").alias("test_output"), F.col("_outcome.reason").alias("reason"),
    )


def _passed() -> Column:
    """No verdict counts as not passed."""
    return F.coalesce(F.col("passed"), F.lit(False))


def evaluation_stats(
    evaluations: DataFrame, by: list[str] = [], total: bool = True
) -> DataFrame:
    """Passed, failed and why, per group and overall."""
    no_code = F.col("error").eqNullSafe(F.lit(fv.NO_CODE))
    measures = {
        "total_problems": F.count(F.lit(1)),
        "passed": F.count_if(_passed()),
        "no_code_generated": F.count_if(no_code),
        "test_failures": F.count_if(~_passed() & ~no_code),
    }
    return grouped_with_total(evaluations, measures, by, total).select(
        *by, "is_total", "total_problems", "passed",
        (F.col("total_problems") - F.col("passed")).alias("failed"),
        ratio(F.col("passed"), F.col("total_problems")).alias("pass_rate"),
        "no_code_generated", "test_failures",
    )


def ids_where(evaluations: DataFrame, passed: bool | None = None, keep: list[str] = []) -> DataFrame:
    """Ids of passed, failed or all evaluations, as rows (a list would grow with the data)."""
    rows = evaluations if passed is None else evaluations.where(_passed() == passed)
    return rows.select(*keep, "problem_id")


def id_arrays(
    evaluations: DataFrame, by: list[str] = ["run_id"], passed: bool | None = None, most: int = 100_000
) -> DataFrame:
    """The ids of ``ids_where`` as one sorted array per group, for runs that are small.

    An array stands in one task, so a group of more than ``most`` ids raises. Groups are counted
    first, with a partial step, and rows meet their count before any array is built.
    """
    rows = ids_where(evaluations, passed, by)
    group = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in by])
    refusal = F.raise_error(F.concat(F.lit(f"more than {most} ids in "), group, F.lit("; use ids_where")))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.when(F.col("_n") > most, refusal.cast("boolean")).otherwise(True).alias("_fits"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return (
        rows.join(sizes, same).where("_fits").groupBy(*by)
        .agg(F.sort_array(F.collect_list("problem_id")).alias("problem_ids"))
    )


def failed_preview(evaluations: DataFrame, n: int = 3, order: list[str] = ["problem_id"]) -> DataFrame:
    """The first ``n`` failed evaluations with their error or outputs."""
    shown = F.coalesce(F.col("error"), F.array_join("test_outputs", "\n"))
    first = evaluations.where(~_passed()).orderBy(*order).limit(n)
    others = [c for c in order if c != "problem_id"]
    return first.select("problem_id", *others, shown.alias("details"))


def test_row_summary(tests: DataFrame) -> DataFrame:
    """Test rows, the problems they belong to, and how many passed and failed."""
    return tests.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("problem_id").alias("unique_problems"),
        F.count_if(F.col("test_output") == fv.PASS_WORD).alias("pass_rows"),
        F.count_if(F.col("test_output") == fv.FAIL_WORD).alias("fail_rows"),
    )


test_row_summary.__test__ = False
