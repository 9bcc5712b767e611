"""The given tables read as problems, responses, script runs and attempts.

Every view keeps all rows of its table. ``oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attempts import first_attempts
from ..operators.evaluation import with_verdict, without_code_failed

RUNS = [f"{r:02d}" for r in range(1, 13)]
ATTEMPT_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey"]
POSITION = ATTEMPT_ORDER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: str | Column) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _run_id(number: Column) -> Column:
    return F.lpad((number % 12 + 1).cast("string"), 2, "0")


def split_of(problem_id: Column) -> Column:
    return (
        F.when(problem_id.between(1, 10), "prompt")
        .when(problem_id.between(11, 510), "test")
        .when(problem_id.between(511, 600), "validation")
        .otherwise("train")
    )


def _tests(problem_id: Column, plus: Column) -> Column:
    """None to three tests, by the id."""
    tests = [
        _text("assert f_", problem_id, f"({k}) == ", plus + k) for k in (1, 2, 3)
    ]
    return F.slice(F.array(*tests), F.lit(1), (problem_id % 4).cast("int"))


# Printed by a script run: tests passed and failed, helper and other lines, nothing.
STDOUTS = [
    "Test 1: PASS - All Clear\nTest 2: PASS - All Clear\nTest 3: PASS - All Clear\n",
    "Test 1: PASS - All Clear\nTest 2: FAIL - Result does not match expected output\n",
    "",
    "Test 1: FAIL - could not PASS value: 7\n",
    "loading\nTest 1: PASS - All Clear\nvalue 3\n",
    "Testing helper\nTest 1: PASS - All Clear\nTest 2: PASS\nTest 3: FAIL\nTest 4: FAIL - k: v - w\n",
    "  Test 1: FAIL - name 'x' is not defined\n Test 2: PASS - indented\n\n",
    "done\n",
    "Test 1: PASS - All Clear\r\nTest 2: PASS - All Clear\r\n",
]
# Its error text, by the way the run ended; the runs of places 1 to 4 exit with 1.
STDERRS = [
    "",
    "Traceback\nAssertionError: bad - value\nend\n",
    "Traceback\nAssertionError\n",
    "Traceback\n  line 1\nNameError: name 'v' is not defined\n",
    " \n",
    "DeprecationWarning: old\n",
    "", "", "", "", "",
]


def _pick(texts: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in texts]), (number % len(texts) + 1).cast("int"))


def _recorded_run(a: Column, b: Column) -> dict[str, Column]:
    """How a script ended: every kind of outcome occurs."""
    ending = a % len(STDERRS)
    return {
        "returncode": F.when(ending.between(1, 4), F.lit(1)).otherwise(F.lit(0)),
        "stdout": _pick(STDOUTS, a + b),
        "stderr": _pick(STDERRS, a),
        "timed_out": ending == 0,
        "runner_error": F.when(ending == 6, F.lit("no space left - PASS on")),
    }


def attempts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt per line item; a problem may have several in a run."""
    part = F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        part.alias("problem_id"),
        _run_id(F.col("l_suppkey")).alias("run_id"),
        (F.col("l_quantity") <= 1 + (part * 7919) % 50).alias("passed"),
        *ATTEMPT_ORDER,
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_attempts(attempts_raw(spark, sf_dir), ATTEMPT_ORDER)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: all that evaluations are made of, and the run."""
    return table(spark, sf_dir, "lineitem").select("l_partkey", *POSITION, _run_id(F.col("l_suppkey")).alias("run_id"))


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole evaluation per line item, with the verdict of its recorded run."""
    return evaluations_of(lines(spark, sf_dir))


def evaluations_of(lines: DataFrame) -> DataFrame:
    """``evaluations`` of some of ``lines``, row by row."""
    problem, supplier = F.col("l_partkey"), F.col("l_suppkey")
    code = F.when(
        (F.col("l_linenumber") == 7) & (supplier % 5 == 0), F.lit("")
    ).otherwise(
        _text(
            "def f_", problem, "(x):\n    return x + ", supplier,
            F.when(F.col("l_linenumber") % 2 == 0, "\n    assert x").otherwise(""),
        )
    )
    run = _recorded_run(F.col("l_orderkey"), supplier + F.col("l_linenumber"))
    rows = lines.select(
        problem.alias("problem_id"),
        "run_id",
        *POSITION,
        _text("Problem ", problem).alias("problem_statement"),
        _tests(problem, problem % 7).alias("test_cases"),
        code.alias("generated_code"),
        *[column.alias(name) for name, column in run.items()],
    )
    return without_code_failed(with_verdict(rows)).select(
        "problem_id", "run_id", *POSITION, "problem_statement", "passed", "error",
        "test_outputs", "generated_code", "test_cases",
    )


def evaluations_some_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``evaluations`` where every eleventh order's verdicts are missing."""
    return evaluations(spark, sf_dir).withColumn(
        "passed", F.when(F.col("l_orderkey") % 11 != 0, F.col("passed"))
    )


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A problem per part."""
    key = F.col("p_partkey")
    size = F.col("p_size").cast("bigint")
    return table(spark, sf_dir, "part").select(
        key.alias("task_id"),
        _text("Add ", size, " to the input, as for a ", F.col("p_name")).alias("text"),
        _text("def f_", key, "(x):\r\n    return x + ", size).alias("code"),
        _tests(key, size).alias("test_list"),
        F.lit("").alias("test_setup_code"),
        F.array().cast("array<string>").alias("challenge_test_list"),
        split_of(key).alias("split"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response per document, wrapped in each of the ways a model answers."""
    doc, text = F.col("doc_id"), F.col("text")
    extra = F.when(
        doc % 4 == 0, _text("\n```python\ndef extra():\n    return ", doc, "\n```")
    ).otherwise("")
    content = (
        F.when(doc % 6 == 0, _text("Here is the code:\n```python\n", text, "\n```\nDone.", extra))
        .when(doc % 6 == 1, _text("Answer:\n```\n", text, "\n```\nBye"))
        .when(doc % 6 == 2, _text("Sure.\n  def solve(x):\n    return ", doc, "\n\n\t", text))
        .when(doc % 12 == 3, _text("```python\n", text))
        .when(doc % 12 == 9, _text("```\n", text))
        .when(doc % 6 == 4, F.lit(""))
        .otherwise(_text(" ", text, "\n"))
    )
    choice = F.struct(
        F.lit(0).cast("bigint").alias("index"),
        F.struct(F.lit("assistant").alias("role"), content.alias("content")).alias("message"),
        F.lit("stop").alias("finish_reason"),
    )
    usage = F.struct(
        F.lit(0).cast("bigint").alias("prompt_tokens"),
        F.col("n_chars").alias("completion_tokens"),
        F.col("n_chars").alias("total_tokens"),
    )
    failed = doc % 17 == 0
    return table(spark, sf_dir, "documents").select(
        doc.alias("problem_id"),
        _run_id(doc).alias("run_id"),
        split_of(doc).alias("split"),
        F.struct(
            doc.alias("task_id"),
            _text("Problem ", doc).alias("text"),
            _text("def ref_", doc, "():\n    return ", doc).alias("code"),
            _tests(doc, doc % 7).alias("test_list"),
            F.lit("").alias("test_setup_code"),
            F.array().cast("array<string>").alias("challenge_test_list"),
        ).alias("problem"),
        _text("Question ", doc).alias("prompt"),
        F.struct(
            F.when(failed, F.lit("timeout")).alias("error"),
            F.when(~failed & (doc % 19 != 0), F.array(choice)).alias("choices"),
            F.when(~failed & (doc % 13 != 0), usage).alias("usage"),
        ).alias("model_response"),
        doc.cast("double").alias("timestamp"),
    )


def script_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recorded script run per order."""
    run = _recorded_run(F.col("o_orderkey"), F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("problem_id"),
        _run_id(F.col("o_orderkey")).alias("run_id"),
        *[column.alias(name) for name, column in run.items()],
    )


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decoded chat per turn; only assistant turns hold an answer."""
    start = F.lit("system\nYou are helpful\nuser\nturn ")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.when(
            F.col("role") == "assistant",
            _text(start, F.col("turn"), "\nassistant\n", "\nassistant\nassistant\n", F.col("text")),
        )
        .when(F.col("role") == "user", _text(start, F.col("turn"), "\nassistant\n", F.col("text")))
        .otherwise(_text(start, F.col("text")))
        .alias("transcript"),
    )


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tagged answer per document: closed, unclosed with and without an end mark, bare."""
    doc, text = F.col("doc_id"), F.col("text")
    return table(spark, sf_dir, "documents").select(
        doc.alias("problem_id"),
        F.when(doc % 5 == 0, _text("Use <TAG>\n  x = 1\n", text, "\nprint(x)\n</TAG> and <TAG>y</TAG>"))
        .when(doc % 5 == 1, _text("Use <TAG> # start\n", text, "\n# Test cases\nprint(1) # Expected output: 1"))
        .when(doc % 5 == 2, _text("Use <TAG>\ndef f(x):\n    return x\n", text))
        .when(doc % 5 == 3, _text("import os\n", text, "\nprint(2)\n  y = 2 # Expected output: 2"))
        .otherwise(_text("Use <TAG>\tz = 3\n", text, "\n  import re\ndef g(y):"))
        .alias("answer"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finished run per event."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_number"),
        (F.col("event_type") != "error").alias("success"),
        F.col("value").alias("duration_seconds"),
        F.col("ts").cast("string").alias("timestamp"),
    )


def run_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of a run per customer."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("run_number"),
        F.element_at(
            F.array(*[F.lit(s) for s in ("prompt", "test", "validation", "train")]),
            (key % 4 + 1).cast("int"),
        ).alias("split"),
        (F.col("c_nationkey") % 5 == 0).alias("demo_mode"),
        F.when(key % 3 > 0, key % 300).alias("max_problems"),
        F.when(key % 2 == 0, F.lit("served")).alias("model_name"),
        F.when(key % 2 == 1, F.lit("local")).alias("model_path"),
    )
