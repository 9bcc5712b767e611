"""The verdict table, outcome lines and test rows."""

import pytest
from pyspark.sql import functions as F

from tallywright.functions import verdict as vd
from tallywright.operators import evaluation as ev

RUN = "returncode int, stdout string, stderr string, timed_out boolean, runner_error string, script string"
ASSERTS, BARE = "assert x", "x = 1"

TABLE = {
    "timeout": ((0, "Test 1: PASS", "", True, None, ASSERTS), (False, ["TIMEOUT"])),
    "runner error": ((None, None, None, False, "PASS lost", BARE), (False, ["ERROR: PASS lost"])),
    "assertion with message": (
        (1, "Test 1: PASS\n", "Traceback\n AssertionError: a: b \nmore", False, None, BARE),
        (False, ["Test 1: FAIL - Assertion failed: a: b"]),
    ),
    "assertion without message": (
        (1, "", "Traceback\nAssertionError\n", False, None, BARE),
        (False, ["Test 1: FAIL - Assertion failed"]),
    ),
    "assertion after printed lines": (
        (1, "Test 1: PASS\n", "AssertionError", False, None, BARE), (True, ["Test 1: PASS"]),
    ),
    "other error": (
        (1, "Test 1: PASS\n", "Traceback\nNameError: x\n\n", False, None, BARE),
        (False, ["Test 1: FAIL - NameError: x"]),
    ),
    "error naming PASS": (
        (1, "", "KeyError: 'PASS'", False, None, BARE), (True, ["Test 1: FAIL - KeyError: 'PASS'"]),
    ),
    "exit without text": (
        (3, "Test 1: PASS", " \n", False, None, BARE),
        (False, ["Test 1: FAIL - Script failed with return code 1"]),
    ),
    "silent with assertions": (
        (0, "done\n", " \n", False, None, ASSERTS),
        (True, ["Test 1: PASS - All assertions passed silently"]),
    ),
    "silent with warning": ((0, "", "Warning", False, None, ASSERTS), (False, [])),
    "silent without assertions": ((0, "", "", False, None, BARE), (False, [])),
    "all pass": (
        (0, "Test 1: PASS - All Clear\nTest 2: PASS\n", "", False, None, BARE),
        (True, ["Test 1: PASS - All Clear", "Test 2: PASS"]),
    ),
    "one fails": (
        (0, "Test 1: PASS\nTest 2: FAIL - x", "", False, None, BARE),
        (False, ["Test 1: PASS", "Test 2: FAIL - x"]),
    ),
    "failure naming PASS": (
        (0, "Test 1: FAIL - no PASS", "", False, None, BARE), (True, ["Test 1: FAIL - no PASS"]),
    ),
    "line of the code itself": (
        (0, "  Testing\nTest 1: PASS", "", False, None, BARE), (False, ["Testing", "Test 1: PASS"]),
    ),
    "only leading lines are stripped": (
        (0, "x\n Test 1: PASS\nTest 2: PASS\r\n", "", False, None, BARE), (True, ["Test 2: PASS"]),
    ),
}


@pytest.mark.parametrize("case", TABLE)
def test_verdict(spark, case):
    run, wanted = TABLE[case]
    row = ev.with_verdict(spark.createDataFrame([run], RUN)).first()
    assert (row["passed"], row["test_outputs"]) == wanted


def test_older_rule(spark):
    runs = [
        (1, "Test 1: PASS", "NameError", False, None, BARE),
        (1, "", "NameError", False, None, BARE),
        (0, "Test 1: FAIL", "", False, None, BARE),
        (0, "", "", True, None, BARE),
        (0, "", "", False, "PASS", BARE),
    ]
    rows = ev.with_verdict(spark.createDataFrame(runs, RUN), printed_lines_only=True).collect()
    assert [r["passed"] for r in rows] == [True, True, False, False, False]
    assert [r["test_outputs"] for r in rows][3:] == [["TIMEOUT"], ["ERROR: PASS"]]


def test_parse_outcome(spark):
    cases = {
        "TIMEOUT": ("FAIL", "Failed"),
        "ERROR: x - y": ("FAIL", "y"),
        "Test 1: PASS": ("PASS", "Passed"),
        "Test 1: PASS - All Clear": ("PASS", "All Clear"),
        "Test 2: FAIL - a - b": ("FAIL", "a - b"),
        "Test 3: FAIL - k: v": ("FAIL", "k: v"),
        "Testing PASS - fine": ("PASS", "fine"),
        "Test PASS: no": ("FAIL", "Failed"),
    }
    df = spark.createDataFrame([(line,) for line in cases], "line string")
    got = [tuple(r[0]) for r in df.select(vd.parse_outcome(F.col("line"))).collect()]
    assert got == list(cases.values())


EVALUATION = (
    "problem_id long, problem_statement string, passed boolean, error string, "
    "test_outputs array<string>, generated_code string, test_cases array<string>"
)


def test_explode_tests(spark):
    rows = [
        (1, "p", True, None, ["Test 1: PASS"], "c", ["a", "b"]),
        (2, "q", False, None, ["Test 1: PASS", "Test 2: FAIL"], "c", ["a"]),
        (3, "r", False, "No code generated", [], "", ["a"]),
        (4, "s", False, None, ["TIMEOUT"], "c", []),
    ]
    got = ev.explode_tests(spark.createDataFrame(rows, EVALUATION)).orderBy(
        "problem_id", "test_case_statement"
    )
    assert [tuple(r) for r in got.collect()] == [
        (1, "p", "a", "PASS", "Passed"),
        (2, "q", "Test case 2 (no statement)", "FAIL", "Failed"),
        (2, "q", "a", "PASS", "Passed"),
        (4, "s", "Test case 1 (no statement)", "FAIL", "Failed"),
    ]


def response(problem, content, tests):
    return (
        problem, "01", {"text": f"p{problem}", "test_list": tests},
        {"choices": [{"message": {"content": content}}]} if content is not None else {"error": "x"},
    )


def test_evaluate_end_to_end(spark):
    from tallywright import schemas

    schema = schemas.T.StructType(
        [
            schemas.T.StructField("problem_id", schemas.T.LongType()),
            schemas.T.StructField("run_id", schemas.T.StringType()),
            schemas.T.StructField("problem", schemas.PROBLEM),
            schemas.T.StructField("model_response", schemas.MODEL_RESPONSE),
        ]
    )
    fenced = "```python\ndef f(x): return x\n```"
    responses = spark.createDataFrame(
        [
            response(1, fenced, ["assert f(1) == 1"]),
            response(2, fenced, ["assert f(1) == 2"]),
            response(3, None, ["a"]),
            response(4, fenced, None),
            response(5, "```python\n```", ["a"]),
        ],
        schema,
    )
    runs = spark.createDataFrame(
        [
            (1, "01", 0, "Test 1: PASS - All Clear\n", "", False, None),
            (2, "01", 0, "Test 1: FAIL - Result does not match expected output\n", "", False, None),
            (3, "01", 0, "Test 1: PASS", "", False, None),
        ],
        "problem_id long, run_id string, returncode int, stdout string, stderr string, "
        "timed_out boolean, runner_error string",
    )
    done = ev.evaluate(responses, runs)
    got = {r["problem_id"]: r for r in done.collect()}
    assert {k: r["passed"] for k, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert got[3]["error"] == got[5]["error"] == "No code generated" and got[3]["test_outputs"] == []
    assert got[4]["test_outputs"] == ["ERROR: no recorded script run"] and got[4]["test_cases"] == []
    assert got[1]["generated_code"] == "def f(x): return x" and got[1]["error"] is None
    stats = ev.evaluation_stats(done).first()
    assert (stats["total_problems"], stats["passed"], stats["failed"]) == (5, 1, 4)
    assert (stats["no_code_generated"], stats["test_failures"], stats["pass_rate"]) == (2, 2, 0.2)
    assert sorted(r[0] for r in ev.ids_where(done, False).collect()) == [2, 3, 4, 5]


def test_rate_of_mixed_endings(spark):
    """One passes, one fails an assertion, one prints nothing, one was stopped."""
    endings = [
        (0, "Test 1: PASS - All Clear\n", "", False), (1, "", "AssertionError: no\n", False),
        (0, "", "", False), (0, "", "", True),
    ]
    df = spark.createDataFrame(
        [(k, "y = 2", ["assert y == 2"], *e, None) for k, e in enumerate(endings)],
        "problem_id long, generated_code string, test_cases array<string>, returncode int, stdout string, "
        "stderr string, timed_out boolean, runner_error string",
    )
    judged = ev.without_code_failed(ev.with_verdict(ev.with_script(df)))
    stats = ev.evaluation_stats(judged).first()
    assert (stats["total_problems"], stats["passed"], stats["pass_rate"]) == (4, 1, 0.25)


def test_stats_of_nothing(spark):
    stats = ev.evaluation_stats(spark.createDataFrame([], EVALUATION)).first()
    assert (stats["total_problems"], stats["pass_rate"]) == (0, 0.0)
