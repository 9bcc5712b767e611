"""The registered queries: each operator over whole tables, shaped for comparison with SQL.

Shaping means: arrays joined to text, no NULL texts, doubles rounded to ten digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from .. import schemas
from ..functions import text as tx
from ..functions.metrics import difficulty
from ..functions.verdict import pass_count
from ..operators import attempts as at
from ..operators import evaluation as ev
from ..operators import filters as fl
from ..operators import passk as pk
from ..operators import presence as pr
from ..operators import pivot as pv
from ..operators import rates as rt
from ..operators import responses as rs
from ..operators import sampling as sm
from ..operators import scripts as sc
from ..operators import sketches as sk
from ..operators import trainset as tr
from ..sources import quarantine as qt
from ..sources import readers as rd
from ..sources import writers as wr
from ..sources.scratch import scratch_path, stored
from ..streaming.progress import read_progress, stream_progress
from . import views as vw

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(spark, sf_dir))

    _QUERIES[build.__name__] = shaped
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), 10).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _lines(texts: str) -> Column:
    return F.array_join(texts, "\n")


def _shown(flag: str) -> Column:
    return F.coalesce(F.col(flag).cast("string"), F.lit("missing")).alias(flag)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.with_difficulty(pk.pass_at_k(vw.attempts(spark, sf_dir)))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.stratified_mix(_classified(spark, sf_dir).drop("n", "c"))


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.evaluate(vw.responses(spark, sf_dir), vw.script_runs(spark, sf_dir))


def _evaluation_columns(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys, "problem_statement", "passed", F.coalesce("error", F.lit("")).alias("error"),
        _lines("test_outputs").alias("test_outputs"), "generated_code",
        _lines("test_cases").alias("test_cases"),
    )


# --- pass@k and classes ----------------------------------------------------------------------


@_query
def pass_at_k_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.class_distribution(_classified(spark, sf_dir))


@_query
def pass_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.pass_at_k(vw.attempts(spark, sf_dir))


@_query
def pass_at_k_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.pass_at_k(vw.attempts(spark, sf_dir), ks=[1, 5, 10, 12], strict=True)


@_query
def pass_at_k_all_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated attempts within a run counted each."""
    return pk.pass_at_k(vw.attempts_raw(spark, sf_dir))


@_query
def difficulty_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = pk.pass_at_k(vw.attempts(spark, sf_dir))
    return rates.select("problem_id", "pass@1", difficulty(F.col("pass@1")).alias("difficulty"))


@_query
def mean_pass_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.mean_pass_at_k(_classified(spark, sf_dir), by=["difficulty"])


# --- attempts --------------------------------------------------------------------------------


@_query
def attempt_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing verdict counts as not passed."""
    known = vw.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("problem_id"),
        (F.col("l_suppkey") % 12 + 1).alias("run_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") > 25).alias("passed"),
    )
    return at.to_attempts(known)


@_query
def attempt_id_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("l_partkey").cast("string")
    texts = vw.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("test_"), part))
        .otherwise(part).alias("problem_id"),
        (F.col("l_suppkey") % 12 + 1).alias("run_id"),
        (F.col("l_quantity") > 25).alias("passed"),
    )
    checked = at.with_id_check(texts)
    return checked.groupBy("run_id").agg(
        F.count("problem_id").alias("kept"),
        F.count_if(F.col("problem_id").isNull()).alias("set_aside"),
        F.max("raw_id").alias("last_raw_id"),
    )


@_query
def attempts_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at.by_run_and_problem(vw.attempts(spark, sf_dir))


@_query
def duplicate_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at.duplicate_attempts(vw.attempts_raw(spark, sf_dir))


@_query
def attempts_of_one_problem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.with_id(vw.attempts_raw(spark, sf_dir), "101").select(
        "problem_id", "run_id", "passed", *vw.ATTEMPT_ORDER
    )


@_query
def pass_at_k_above_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk.pass_at_k(fl.ids_above(vw.attempts(spark, sf_dir), 600))


@_query
def pass_at_k_listed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is itself a table: ids with a good label."""
    listed = vw.table(spark, sf_dir, "labels").where(F.col("quality") == 1).select("doc_id")
    return pk.pass_at_k(fl.ids_in(vw.attempts(spark, sf_dir), listed))


@_query
def attempts_of_short_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.rate_by(fl.ids_in(vw.attempts_raw(spark, sf_dir), [601, 602, 603, 607]), "problem_id")


@_query
def latest_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest day of events stands for the newest run."""
    dated = vw.table(spark, sf_dir, "events").select(
        F.date_format("ts", "'results_'yyyyMMdd").alias("run_ts"), "event_id", "user_id", "value"
    )
    return fl.latest_run(dated)


# --- rates, top lists, pivot -----------------------------------------------------------------


@_query
def overall_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.overall_rate(vw.attempts(spark, sf_dir))


@_query
def rate_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.rate_by(vw.attempts(spark, sf_dir), "run_id").orderBy("run_id")


@_query
def rate_by_problem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.rate_by(vw.attempts(spark, sf_dir), "problem_id")


@_query
def top_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.top_by_count(vw.attempts_raw(spark, sf_dir))


@_query
def top_by_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.top_by_rate(vw.attempts(spark, sf_dir))


@_query
def bottom_by_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.top_by_rate(vw.attempts(spark, sf_dir), worst=True)


@_query
def run_coverage_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.run_coverage_rate(vw.attempts(spark, sf_dir))


@_query
def pivot_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = pv.pivot_runs(
        vw.attempts_raw(spark, sf_dir), vw.RUNS, on_duplicate="first", order=vw.ATTEMPT_ORDER
    )
    return table.select("problem_id", *[_shown(c) for c in pv.run_columns(vw.RUNS)])


@_query
def pivot_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raises if a (problem, run) comes twice; here it does not."""
    table = pv.pivot_runs(vw.attempts(spark, sf_dir), vw.RUNS)
    return table.select("problem_id", *[_shown(c) for c in pv.run_columns(vw.RUNS)])


@_query
def unpivot_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = pv.pivot_runs(vw.attempts(spark, sf_dir), vw.RUNS)
    return pv.unpivot_runs(table, vw.RUNS)


@_query
def pass_at_k_from_pivot_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pivot stored as csv, read back, and pass@k from it."""
    path = scratch_path(spark, "pivot-csv")
    wr.write_table(pv.pivot_runs(vw.attempts(spark, sf_dir), vw.RUNS), path, "csv")
    return pk.pass_at_k(pv.unpivot_runs(rd.read_pivot(spark, path, vw.RUNS), vw.RUNS))


# --- samples ---------------------------------------------------------------------------------


@_query
def stratified_mixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _samples(spark, sf_dir)


@_query
def mix_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.mix_summary(_samples(spark, sf_dir), names=list(fv.MIXES))


@_query
def shuffled_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.shuffle_rows(_samples(spark, sf_dir)).select("dataset", "problem_id", "difficulty", "shuffle_key")


@_query
def sample_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All mixes stored as csv, a folder each, and read back."""
    path = scratch_path(spark, "sample-csv")
    wr.write_table(_samples(spark, sf_dir), path, "csv", ["dataset"])
    return rd.read_sample(spark, path, dataset=True)


# --- best attempts and training rows ---------------------------------------------------------


@_query
def passed_test_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vw.evaluations(spark, sf_dir).select(
        "problem_id", *vw.POSITION, pass_count(F.col("test_outputs")).alias("passed_tests")
    )


@_query
def best_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.best_attempt(vw.evaluations(spark, sf_dir), vw.POSITION)


@_query
def sampled_best_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = tr.best_attempt(vw.evaluations(spark, sf_dir), vw.POSITION)
    return _samples(spark, sf_dir).select("dataset", "problem_id").join(best, "problem_id")


def _solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.reference_code(
        vw.responses(spark, sf_dir).withColumn("position", F.lit(0)), ["position"]
    )


@_query
def reference_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many entries per problem; the last one counts."""
    code = F.concat_ws("-", F.lit("v"), "l_orderkey", "l_linenumber", "l_suppkey")
    entries = vw.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("problem_id"), F.struct(code.alias("code")).alias("problem"),
        *vw.POSITION,
    )
    return tr.reference_code(entries, vw.POSITION)


@_query
def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.train_rows(
        _samples(spark, sf_dir), vw.evaluations(spark, sf_dir), _solutions(spark, sf_dir),
        vw.POSITION,
    )


@_query
def train_rows_own_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier form: problem statement and the best attempt's own code."""
    return tr.train_rows(
        _samples(spark, sf_dir), vw.evaluations(spark, sf_dir), position=vw.POSITION
    )


@_query
def train_rows_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = vw.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("problem_id"))
    return tr.train_rows_missing(
        wanted, vw.evaluations(spark, sf_dir), _solutions(spark, sf_dir)
    )


@_query
def train_rows_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows stored as JSON lines, a folder for each dataset, and read back."""
    path = scratch_path(spark, "train-jsonl")
    rows = train_rows(spark, sf_dir).select("dataset", "instruction", "output")
    wr.write_table(rows, path, "json", ["dataset"])
    return rd.read_train_rows(spark, path, dataset=True)


# --- text ------------------------------------------------------------------------------------


@_query
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.with_prompt(vw.problems(spark, sf_dir)).select("task_id", "prompt")


@_query
def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vw.problems(spark, sf_dir).select(
        "task_id",
        tx.instruction_text(F.col("text"), F.col("task_id"), F.col("test_list")).alias("instruction"),
    )


@_query
def response_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vw.responses(spark, sf_dir).select(
        "problem_id", tx.response_content(F.col("model_response")).alias("content")
    )


@_query
def generated_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = ev.with_generated_code(vw.responses(spark, sf_dir))
    return coded.select("problem_id", "generated_code")


@_query
def tagged_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vw.tagged(spark, sf_dir).select(
        "problem_id", tx.extract_tagged(F.col("answer")).alias("code")
    )


@_query
def tagged_code_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vw.tagged(spark, sf_dir).select(
        "problem_id", tx.extract_tagged(F.col("answer"), corrected=True).alias("code")
    )


@_query
def last_assistant_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vw.transcripts(spark, sf_dir).select(
        "conv_id", "turn", tx.last_assistant(F.col("transcript")).alias("answer")
    )


@_query
def test_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vw.problems(spark, sf_dir).select(
        "task_id", tx.test_script(F.col("code"), F.col("test_list")).alias("script")
    )


# --- verdicts --------------------------------------------------------------------------------


def _judged_orders(spark: SparkSession, sf_dir: str, printed_lines_only: bool) -> DataFrame:
    runs = vw.script_runs(spark, sf_dir).withColumn(
        "script", F.when(F.col("problem_id") % 2 == 0, F.lit("assert x")).otherwise("x")
    )
    return ev.with_verdict(runs, printed_lines_only).select(
        "problem_id", "passed", F.size("test_outputs").alias("outputs"),
        _lines("test_outputs").alias("test_outputs"),
    )


@_query
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged_orders(spark, sf_dir, printed_lines_only=False)


@_query
def verdicts_printed_lines_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged_orders(spark, sf_dir, printed_lines_only=True)


@_query
def evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluation_columns(_evaluated(spark, sf_dir), "problem_id", "run_id")


@_query
def explode_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.explode_tests(vw.evaluations(spark, sf_dir), ["problem_id", *vw.POSITION])


@_query
def test_row_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.test_row_summary(ev.explode_tests(vw.evaluations(spark, sf_dir)))


@_query
def evaluation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.evaluation_stats(vw.evaluations(spark, sf_dir)).drop("is_total")


@_query
def evaluation_stats_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev.evaluate(
        vw.responses(spark, sf_dir), vw.script_runs(spark, sf_dir), keep=["split"]
    )
    return ev.evaluation_stats(rows, by=["split"]).drop("is_total").withColumn(
        "split", F.coalesce("split", F.lit("overall"))
    )


@_query
def passed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.ids_where(vw.evaluations(spark, sf_dir), True, ["run_id"])


@_query
def failed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.ids_where(vw.evaluations(spark, sf_dir), False, ["run_id"])


@_query
def failed_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.failed_preview(vw.evaluations(spark, sf_dir), 3, ["problem_id", *vw.POSITION])


@_query
def script_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scripts really run: code written here from whole numbers only, some of it wrong."""
    key = F.col("task_id")
    code = (
        F.when(key % 5 == 0, F.concat(F.lit("def f_"), key, F.lit("(x):\n    return x - 1")))
        .when(key % 7 == 0, F.concat(F.lit("def f_"), key, F.lit("(x):\n    raise ValueError('boom')")))
        .when(key % 11 == 0, F.lit("def broken(:"))
        .otherwise(F.col("code"))
    )
    scripts = vw.problems(spark, sf_dir).select(
        key.alias("problem_id"), tx.test_script(code, F.col("test_list")).alias("script")
    )
    runner = sc.python_runner(("-I", "-S"))
    ran = sc.run_scripts(scripts, runner, ["problem_id"])
    # Scripts are made on the fly, many times the size of their table, so neither side is small.
    judged = ev.with_verdict(ran.join(scripts.hint("merge"), "problem_id"))
    return judged.select(
        "problem_id", "passed", "returncode", _lines("test_outputs").alias("test_outputs")
    )


# --- responses and runs ----------------------------------------------------------------------


@_query
def response_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.response_stats(vw.responses(spark, sf_dir), by=[]).drop("is_total")


@_query
def response_stats_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.response_stats(vw.responses(spark, sf_dir)).drop("is_total").withColumn(
        "split", F.coalesce("split", F.lit("overall"))
    )


@_query
def response_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts joined to replies; a problem without id gets one from its position."""
    asked = rs.with_prompt(vw.problems(spark, sf_dir)).withColumn("position", F.col("task_id"))
    asked = asked.withColumn("task_id", F.when(F.col("position") % 10 != 7, F.col("task_id")))
    replies = vw.responses(spark, sf_dir).select(
        F.col("problem_id").alias("position"), "model_response", "timestamp"
    )
    return rs.assemble_responses(asked.na.fill("", ["prompt"]), replies).select(
        "problem_id", "prompt", "timestamp", F.col("problem.code").alias("code"),
        tx.response_content(F.col("model_response")).alias("content"),
    )


@_query
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = rs.run_metadata(vw.run_settings(spark, sf_dir), vw.problems(spark, sf_dir))
    return table.na.fill("", ["model_name", "model_path"]).na.fill(0, ["max_problems"])


@_query
def ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.ledger_summary(vw.ledger(spark, sf_dir))


@_query
def first_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.head_problems(vw.problems(spark, sf_dir), 50).select("task_id", "text")


@_query
def demo_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.head_problems(vw.problems(spark, sf_dir), demo=True).select("task_id", "text")


@_query
def problem_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = rs.with_prompt(vw.problems(spark, sf_dir)).select("task_id", "text", "code", "prompt")
    return fl.preview(asked, 3, 100, ["task_id"])


@_query
def response_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = vw.responses(spark, sf_dir).select(
        "problem_id", "prompt",
        F.coalesce(
            F.col("model_response.error"), tx.response_content(F.col("model_response"))
        ).alias("reply"),
    )
    return fl.preview(shown, 3, 200, ["problem_id"], always=True)


@_query
def splits_of_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.splits_for_run(vw.problems(spark, sf_dir)).select("task_id", "split")


@_query
def splits_of_fine_tuned_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.splits_for_run(vw.problems(spark, sf_dir), fine_tuned=True).select("task_id", "split")


# --- stored records --------------------------------------------------------------------------


def _stored_problems(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    path = scratch_path(spark, "problems")
    wr.write_table(vw.problems(spark, sf_dir), path, "parquet", ["split"])
    return rd.read_problems(spark, path, split).select(
        "task_id", "split", "text", "code", _lines("test_list").alias("tests")
    )


@_query
def stored_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_problems(spark, sf_dir, "test")


@_query
def stored_problems_other_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split that does not exist gives the first one that does."""
    return _stored_problems(spark, sf_dir, "extra")


def _store_responses(spark: SparkSession, sf_dir: str, splits: list[str] = fv.RESPONSE_SPLITS) -> str:
    """One folder a split, named as the file of its responses is."""
    base = scratch_path(spark, "results")
    name = F.concat(F.lit("results_final_"), "split", F.lit(".json"))
    rows = vw.responses(spark, sf_dir).where(F.col("split").isin(splits))
    wr.write_json_arrays(
        rows.withColumn("file", name).drop("split", "run_id"), base, partition_by="file"
    )
    return base


def _response_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "problem_id", "split", "prompt", "timestamp", F.col("problem.code").alias("code"),
        tx.response_content(F.col("model_response")).alias("content"),
        F.coalesce("model_response.error", F.lit("")).alias("error"),
    )


@_query
def stored_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files of all splits."""
    return _response_columns(rd.read_responses(spark, _store_responses(spark, sf_dir), prefix="file="))


@_query
def stored_responses_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _store_responses(spark, sf_dir)
    name = fv.RESPONSES_NAME.format(split="validation")
    return _response_columns(rd.read_response_file(spark, f"{base}/file={name}"))


@_query
def missing_response_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits whose file is not in a results folder: one is not written, others may have no response."""
    return rd.missing_splits(spark, _store_responses(spark, sf_dir, ["test", "train"]), prefix="file=")


def _store_runs(spark: SparkSession, sf_dir: str, arrays: bool, compression: str = "none") -> str:
    """One folder per run, all in one job."""
    base = scratch_path(spark, "runs")
    rows = vw.evaluations(spark, sf_dir).drop(*vw.POSITION)
    if arrays:
        wr.write_json_arrays(rows, base, partition_by="run_id", compression=compression)
    else:
        wr.write_table(rows, base, "json", ["run_id"])
    return base


@_query
def stored_run_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run folder, only the fields a pass rate needs."""
    base = _store_runs(spark, sf_dir, arrays=False)
    return at.to_attempts(rd.read_attempts(spark, base, layout="lines", partitioned=True))


@_query
def stored_run_evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records of listed run folders, from array files."""
    base = _store_runs(spark, sf_dir, arrays=True, compression="gzip")
    rows = rd.read_evaluations(spark, base, vw.RUNS, layout="array", partitioned=True)
    return _evaluation_columns(rows, "problem_id", "run_id")


@_query
def stored_lines_well_formed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that do not parse are left out; every seventh is cut in half here."""
    path = scratch_path(spark, "lines")
    whole = F.to_json(F.struct("problem_id", "prompt", "timestamp"))
    half = F.substr(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    vw.responses(spark, sf_dir).select(
        F.when(F.col("problem_id") % 7 == 0, half).otherwise(whole).alias("value")
    ).write.text(path)
    return rd.read_response_file(spark, path, layout="lines").select(
        "problem_id", "prompt", "timestamp"
    )


@_query
def streamed_progress_of_cut_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh arriving line is cut in half; the rest is counted as in a batch."""
    base = scratch_path(spark, "progress-cut")
    rows = vw.responses(spark, sf_dir).drop("split")
    whole = F.to_json(F.struct(*[c for c in rows.columns if c != "run_id"]))
    half = F.substr(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
    rows.select(
        F.when(F.col("problem_id") % 7 == 0, half).otherwise(whole).alias("value"), "run_id"
    ).write.partitionBy("run_id").text(f"{base}/records")
    stream_progress(
        spark, f"{base}/records", f"{base}/stats", f"{base}/checkpoint", max_files=8
    ).awaitTermination()
    return read_progress(spark, f"{base}/stats")


@_query
def stored_array_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run folder's array files, cut at record starts."""
    base = _store_runs(spark, sf_dir, arrays=True)
    return at.to_attempts(rd.read_attempts(spark, base, partitioned=True))


@_query
def pass_at_k_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pass@k stored as csv and read back."""
    path = scratch_path(spark, "pass-at-k-csv")
    rates = pk.pass_at_k(vw.attempts(spark, sf_dir))
    wr.write_table(rates.drop("n", "c"), path, "csv")
    return rd.read_pass_at_k(spark, path)


@_query
def all_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.ids_where(vw.evaluations(spark, sf_dir), keep=["run_id"])


@_query
def evaluation_stats_null_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a verdict have not passed."""
    return ev.evaluation_stats(vw.evaluations_some_null(spark, sf_dir)).drop("is_total")


@_query
def failed_ids_null_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.ids_where(vw.evaluations_some_null(spark, sf_dir), False, ["run_id"])


@_query
def streamed_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records arriving as files, followed to the end."""
    base = scratch_path(spark, "progress")
    wr.append_records(vw.responses(spark, sf_dir).drop("split"), f"{base}/records")
    stream_progress(
        spark, f"{base}/records", f"{base}/stats", f"{base}/checkpoint", max_files=8
    ).awaitTermination()
    return read_progress(spark, f"{base}/stats")


# --- order in files, reports, quarantine -----------------------------------------------------


@_query
def best_attempt_by_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best attempts of stored runs with many records a problem: of equal ones the earlier in its file."""
    base = scratch_path(spark, "ordered-runs")
    # Line items move and are sorted, not the many times larger records made of them.
    lines = vw.lines(spark, sf_dir).repartitionByRange("run_id", *vw.POSITION)
    wr.write_json_arrays(
        lines, base, partition_by="run_id", order=vw.POSITION, records=vw.evaluations_of, compression="gzip"
    )
    found = rd.read_evaluations(spark, base, partitioned=True)
    place = ["file", "position"]
    best = tr.best_attempt(found, place)
    return best.join(
        found.select("problem_id", "run_id", *place, "generated_code"), ["problem_id", "run_id", *place]
    ).select("problem_id", "run_id", "score", "generated_code")


@_query
def reference_code_by_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored lines with many entries a problem: the last in the files counts."""
    path = scratch_path(spark, "ordered-lines")
    code = F.concat_ws("-", F.lit("v"), *vw.POSITION)
    entries = vw.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("problem_id"), F.struct(code.alias("code")).alias("problem"), *vw.POSITION
    )
    ordered = entries.repartitionByRange(*vw.POSITION).sortWithinPartitions(*vw.POSITION)
    wr.write_table(ordered.drop(*vw.POSITION), path, "json")
    return tr.reference_code(rd.read_response_file(spark, path, layout="lines", with_file=True), ["file", "position"])


def _flawed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, value): a record per line item; some are cut short, no object, or of an id that is no number."""
    order = F.col("l_orderkey")
    item = F.when(order % 13 == 2, F.concat(F.lit('"test_'), "l_partkey", F.lit('"'))).otherwise(F.col("l_partkey").cast("string"))
    head = F.concat(F.lit('{"problem_id": '), item, F.lit(', "error": "'), order, F.lit("-"), "l_linenumber", F.lit("-"), "l_suppkey")
    passed = (F.col("l_quantity") > 25).cast("string")
    value = (
        F.when(order % 7 == 3, head)
        .when(order % 11 == 5, F.concat(F.lit("["), order, F.lit("]")))
        .otherwise(F.concat(head, F.lit('", "passed": '), passed, F.lit("}")))
    )
    run = F.lpad((F.col("l_suppkey") % 12 + 1).cast("string"), 2, "0")
    return vw.table(spark, sf_dir, "lineitem").select(run.alias("run_id"), value.alias("value"))


def _split_records(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int], DataFrame]:
    base = scratch_path(spark, "flawed-runs")
    _flawed_lines(spark, sf_dir).write.partitionBy("run_id").text(base)
    records = rd.checked_evaluations(spark, base, layout="lines", partitioned=True)
    path = scratch_path(spark, "split-records")
    return path, qt.write_split(records, path), records


@_query
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record that could not be used, with the reason; written in the pass that parses."""
    path, _, records = _split_records(spark, sf_dir)
    return qt.read_set_aside(spark, path, records.schema).select("run_id", "reason", "rejected")


@_query
def kept_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same pass kept, by run, and its own counts of both kinds."""
    path, counts, records = _split_records(spark, sf_dir)
    rates = rt.rate_by(at.to_attempts(qt.read_kept(spark, path, records.schema)), "run_id")
    return rates.withColumns({f"all_{k}": F.lit(n).cast("bigint") for k, n in counts.items()})


@_query
def skipped_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that gave no record, and why: one has no file, one only broken records, one no folder."""
    base = scratch_path(spark, "some-runs")
    broken = F.when(F.col("run_id") == "07", F.substring("value", 2, 9)).otherwise(F.col("value"))
    lines = _flawed_lines(spark, sf_dir).withColumn("value", broken)
    lines.where(F.col("run_id") != "03").write.partitionBy("run_id").text(base)
    lines.limit(0).select("value").write.text(f"{base}/run_id=03/notes")
    runs = [*vw.RUNS, "13"]
    listed = rd.inventory(spark, base, runs, partitioned=True)
    read = rd.read_attempts(spark, base, runs, layout="lines", numeric_ids=False, partitioned=True)
    return rd.skipped_runs(listed, read)


@_query
def quarantined_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts stored in one write, those with an id that is no number apart; both read back, by run."""
    path = scratch_path(spark, "split-attempts")
    part = F.col("l_partkey").cast("string")
    texts = vw.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("test_"), part)).otherwise(part).alias("problem_id"),
        (F.col("l_suppkey") % 12 + 1).alias("run_id"), (F.col("l_quantity") > 25).alias("passed"),
    )
    counts = at.store_attempts(texts, path)
    kept = at.stored_attempts(spark, path).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("problem_id").alias("id_sum")
    )
    aside = at.attempts_set_aside(spark, path).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("set_aside"), F.max("raw_id").alias("last_raw_id"), F.max("reason").alias("reason")
    )
    return kept.join(aside, "run_id", "left").na.fill(0, ["set_aside"]).na.fill("", ["last_raw_id", "reason"]).withColumns(
        {f"all_{k}": F.lit(n).cast("bigint") for k, n in counts.items()}
    )


# --- by group --------------------------------------------------------------------------------


def _rates_by_split_and_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = vw.attempts(spark, sf_dir)
    classes = pk.with_difficulty(pk.pass_at_k(attempts)).select("problem_id", "difficulty")
    rates = rt.rate_by(attempts, "problem_id").join(classes, "problem_id")
    return rates.withColumn("split", vw.split_of(F.col("problem_id")))


@_query
def hardest_by_split_and_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.hardest_by(_rates_by_split_and_class(spark, sf_dir), ["split", "difficulty"])


@_query
def easiest_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.easiest_by(_rates_by_split_and_class(spark, sf_dir), ["difficulty"], 25)


@_query
def most_attempted_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = rt.rate_by(vw.attempts_raw(spark, sf_dir), "problem_id")
    return rt.most_attempted_by(rates.withColumn("split", vw.split_of(F.col("problem_id"))), ["split"])


@_query
def passed_id_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sorted array of passed ids a run, as text."""
    arrays = ev.id_arrays(vw.evaluations(spark, sf_dir), passed=True, most=10_000_000)
    return arrays.select("run_id", F.array_join(F.col("problem_ids").cast("array<string>"), ",").alias("problem_ids"))


# --- sketches --------------------------------------------------------------------------------


def _stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = ev.explode_tests(vw.evaluations(spark, sf_dir), ["run_id", "problem_id"])
    passed = F.col("test_output") == fv.PASS_WORD
    return stored(sk.run_sketches(tests.withColumn("passed", passed)), "sketches")


def _near(estimate: str, exact: str) -> Column:
    """Within four standard errors."""
    return (F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) * (4 * sk.standard_error())).alias("near")


@_query
def distinct_problems_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems with test rows, per run and in all runs, from stored sketches against the exact count."""
    sketches = _stored_sketches(spark, sf_dir)
    tests = ev.explode_tests(vw.evaluations(spark, sf_dir), ["run_id", "problem_id"])
    exact = tests.groupBy("run_id").agg(F.count_distinct("problem_id").alias("unique_problems"))
    overall = tests.agg(F.count_distinct("problem_id").alias("unique_problems"))
    runs = sk.merged_distinct(sketches, ["run_id"]).join(exact, "run_id")
    total = sk.merged_distinct(sketches).select(
        F.lit("overall").alias("run_id"), "rows", "problems",
        overall.scalar().alias("unique_problems"),
    )
    return runs.unionByName(total).select("run_id", "rows", "unique_problems", _near("problems", "unique_problems"))


@_query
def run_coverage_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passed attempts of a run over all problems there are, from stored sketches."""
    attempts = vw.attempts(spark, sf_dir)
    covered = sk.run_coverage(stored(sk.run_sketches(attempts), "coverage"))
    exact = rt.run_coverage_rate(attempts).select("run_id", F.col("coverage_rate").alias("exact"))
    return covered.join(exact, "run_id").select("run_id", "passes", _near("coverage", "exact"))


# --- key presence, late repeats, ids as text -------------------------------------------------


def _stored_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses read as VARIANT; of every seventeenth the error key is there and null."""
    base = scratch_path(spark, "presence")
    rows = vw.responses(spark, sf_dir)
    response = F.to_json("model_response")
    rest = F.when(response == "{}", F.lit("}")).otherwise(F.concat(F.lit(","), F.substr(response, F.lit(2))))
    response = F.when(F.col("problem_id") % 17 == 1, F.concat(F.lit('{"error":null'), rest)).otherwise(response)
    head = F.concat(F.lit('{"problem_id":'), "problem_id", F.lit(',"model_response":'))
    rows.select(F.concat(head, response, F.lit("}")).alias("value"), "run_id").write.partitionBy("run_id").text(base)
    return rd.read_response_variants(spark, base, layout="lines").withColumn(
        "split", vw.split_of(F.col("problem_id"))
    )


@_query
def response_stats_by_key_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.response_stats_by_presence(_stored_presence(spark, sf_dir)).drop("is_total").withColumn(
        "split", F.coalesce("split", F.lit("overall"))
    )


@_query
def contents_by_key_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_presence(spark, sf_dir).select(
        "problem_id", pr.content_by_presence(F.col("model_response")).alias("content")
    )


@_query
def streamed_progress_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that arrive in four deliveries, each with all of the one before again."""
    base = scratch_path(spark, "progress-repeats")
    rows = vw.responses(spark, sf_dir).drop("split")
    last = rows.agg(F.max("timestamp")).first()[0] or 0.0
    quarter = F.floor(F.col("timestamp") * 4 / F.lit(last + 1)).cast("int")
    for k in range(4):
        wr.append_records(rows.where(quarter.between(k - 1, k)), f"{base}/records")
        stream_progress(
            spark, f"{base}/records", f"{base}/stats", f"{base}/checkpoint", horizon=f"{int(last / 2) + 2} seconds"
        ).awaitTermination()
    return read_progress(spark, f"{base}/stats")


@_query
def response_of_unknown_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of a problem that has no id of its own, by the id it was given."""
    asked = rs.with_prompt(vw.problems(spark, sf_dir)).withColumn("position", F.col("task_id"))
    asked = asked.withColumn("task_id", F.when(F.col("position") % 10 != 7, F.col("task_id")))
    replies = vw.responses(spark, sf_dir).select(
        F.col("problem_id").alias("position"), "model_response", "timestamp"
    )
    records = rs.assemble_responses(asked.na.fill("", ["prompt"]), replies)
    return fl.with_id(records, "unknown_17").unionByName(fl.ids_above(records, 90)).select("problem_id", "timestamp")
