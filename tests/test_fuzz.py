"""Text operators against their SQL on random mixtures of the marks they react to."""

import random

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from tallywright.functions import text as tx
from tallywright.functions.verdict import parse_outcome
from tallywright.operators import evaluation as ev
from tallywright.plans import oracle

ROWS = 4000


def texts(pieces, seed, most=14):
    draw = random.Random(seed)
    return ["".join(draw.choices(pieces, k=draw.randint(0, most))) for _ in range(ROWS)]


def duck(columns, sql):
    con = duckdb.connect()
    con.register("given", pa.table(columns))
    return con.execute(sql).fetchall()


def differing(spark_rows, duck_rows, given):
    left, right = sorted(map(tuple, spark_rows)), sorted(map(tuple, duck_rows))
    assert len(left) == len(right) == ROWS
    return [(given[a[0]], a, b) for a, b in zip(left, right) if a != b][:3]


def test_extract_code(spark):
    pieces = ["```", "```python", "`", "python", "def f(x):", "def ", "def", "\n", "\n", "\n", " ",
              "    return x", "\t", "\r", "\x0b", " ", "\x85", "prose", "class A:", "@d"]
    given = texts(pieces, 1)
    df = spark.createDataFrame(list(enumerate(given)), "id long, content string")
    got = df.select("id", tx.extract_code(F.col("content")).alias("code")).collect()
    steps = oracle._CODED[len(oracle._RESPONSES) + 1:]
    sql = f"with responses as (select * from given), {steps} select id, generated_code from coded"
    assert differing(got, duck({"id": range(ROWS), "content": given}, sql), given) == []


def test_extract_tagged(spark):
    pieces = ["<TAG>", "</TAG>", "def f(x):", "def 1(", "import os", "import ", "print(", "print",
              "# Test cases", "Expected output:", "\n", "\n", "\n", " ", "    y", "\t", "\r", "z = 1"]
    given = texts(pieces, 2)
    df = spark.createDataFrame(list(enumerate(given)), "id long, answer string")
    for corrected in (False, True):
        got = df.select("id", tx.extract_tagged(F.col("answer"), corrected).alias("code")).collect()
        name = "tagged_code_corrected" if corrected else "tagged_code"
        steps = oracle._tag_code(corrected)[len(oracle._TAGGED) + 1:]
        select = oracle.oracle_sql()[name].rsplit("\nselect problem_id", 1)[1]
        sql = (
            "with tagged as (select id as problem_id, answer from given), "
            f"{steps} select problem_id {select}"
        )
        assert differing(got, duck({"id": range(ROWS), "answer": given}, sql), given) == []


def test_verdicts(spark):
    printed = ["Test 1: PASS", "Test 2: FAIL - x", "Testing", "test", "PASS", "\n", "\n", " ", "\r", ": ", " - "]
    wrong = ["AssertionError", "AssertionError: ", "NameError: PASS", "\n", "\n", " ", ": ", "x"]
    draw = random.Random(3)
    columns = {
        "id": list(range(ROWS)),
        "stdout": texts(printed, 4),
        "stderr": texts(wrong, 5, 5),
        "returncode": [draw.choice([0, 0, 1, -9]) for _ in range(ROWS)],
        "timed_out": [draw.random() < 0.05 for _ in range(ROWS)],
        "runner_error": [draw.choice([None] * 15 + ["no PASS"]) for _ in range(ROWS)],
        "script": [draw.choice(["x", "assert x", "assert"]) for _ in range(ROWS)],
    }
    df = spark.createDataFrame(
        list(zip(*columns.values())),
        "id long, stdout string, stderr string, returncode int, timed_out boolean, "
        "runner_error string, script string",
    )
    shown = F.concat_ws("|", "test_outputs").alias("outputs")
    got = ev.with_verdict(df).select("id", "passed", F.size("test_outputs"), shown).collect()
    sql = (
        f"with {oracle._judge('given', 'judged').strip()} select id, passed, len(test_outputs), "
        "array_to_string(test_outputs, '|') from judged"
    )
    assert differing(got, duck(columns, sql), list(zip(*columns.values()))) == []


def test_parse_outcome(spark):
    given = texts(["Test 1", ":", ": ", " - ", "PASS", "FAIL", "-", " ", "x", "　"], 6, 9)
    df = spark.createDataFrame(list(enumerate(given)), "id long, line string")
    got = df.select("id", parse_outcome(F.col("line")).alias("o")).select("id", "o.*").collect()
    rest = oracle._strip("array_to_string(string_split(line, ':')[2:], ':')")
    sql = f"""
      with parsed as (select id, case when contains(line, ':') then {rest} else line end as r from given)
      select id, case when contains(r, 'PASS') then 'PASS' else 'FAIL' end,
        case when contains(r, ' - ') then array_to_string(string_split(r, ' - ')[2:], ' - ')
          when contains(r, 'PASS') then 'Passed' else 'Failed' end from parsed"""
    assert differing(got, duck({"id": range(ROWS), "line": given}, sql), given) == []


def test_last_assistant(spark):
    given = texts(["\nassistant\n", "assistant\n", "\nassistant", "user", "\n", "x"], 7, 9)
    df = spark.createDataFrame(list(enumerate(given)), "id long, transcript string")
    got = df.select("id", tx.last_assistant(F.col("transcript")).alias("a")).collect()
    for r in got:
        pieces = given[r["id"]].split("\nassistant\n")
        assert r["a"] == (pieces[-1] if len(pieces) > 1 else "")
