"""Prompt, extraction and script text, case by case."""

import pytest
from pyspark.sql import functions as F

from tallywright import schemas
from tallywright.functions import text as tx

PROBLEM = (
    "Write a function to find the kth element in the given array.",
    101,
    ["assert kth_element([12,3,5], 3, 2) == 3", "assert kth_element([17,24], 2, 1) == 17"],
)


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_prompt_with_tests(spark):
    text, task, tests = PROBLEM
    got = one(spark, tx.prompt_text(F.col("a"), F.col("b"), F.col("c")), a=text, b=task, c=tests)
    assert got == (
        "Please solve the following Python programming problem:\n\n"
        "Problem: Write a function to find the kth element in the given array.\n\n"
        "Task ID: 101\n\n"
        "Expected behavior (test cases):\n"
        "1. kth_element([12,3,5], 3, 2) should return 3\n"
        "2. kth_element([17,24], 2, 1) should return 17\n"
        "\n\n"
        "Please provide a complete Python function that solves this problem. "
        "Write only the function code without any explanations or comments."
    )


def test_prompt_without_tests(spark):
    df = spark.createDataFrame([("Do it", 7, [])], "a string, b long, c array<string>")
    prompt = tx.prompt_text(F.col("a"), F.col("b"), F.col("c"))
    assert "Expected behavior" not in df.select(prompt).first()[0]
    null = df.withColumn("c", F.lit(None).cast("array<string>"))
    assert null.select(prompt).first()[0] == df.select(prompt).first()[0]


def test_instruction_has_one_newline_less(spark):
    text, task, tests = PROBLEM
    columns = F.col("a"), F.col("b"), F.col("c")
    prompt = one(spark, tx.prompt_text(*columns), a=text, b=task, c=tests)
    instruction = one(spark, tx.instruction_text(*columns), a=text, b=task, c=tests)
    assert instruction == prompt.replace("17\n\n\n", "17\n\n")


F3 = "```"
CODE_CASES = {
    "python fence": (f"Hi\n{F3}python\ndef f():\n    return 1\n{F3}\nbye", "def f():\n    return 1"),
    "two python fences": (f"{F3}python\na\n{F3}\nx\n{F3}python\nb\n{F3}", "a\n\nb"),
    "second python fence open": (f"{F3}python\na\n{F3}\nx\n{F3}python\nb", "a"),
    "open python fence": (f" {F3}python\na = 1\n", f"{F3}python\na = 1"),
    "python fence inside python fence": (f"{F3}python a {F3}python b {F3}", "b"),
    "empty python fence": (f"x {F3}python\n{F3} y", ""),
    "plain fence": (f"x\n{F3}\na\n{F3}\ny", "a"),
    "open plain fence": (f"x\n{F3}\na\n", "a"),
    "other language": (f"{F3}py\na\n{F3}", "py\na"),
    "plain fence starting with python": (f"{F3} python a {F3}", f"{F3} python a {F3}"),
    "two plain fences": (f"{F3}a{F3} b {F3}c{F3}", "a\n\nc"),
    "empty plain fence": (f" {F3}{F3} b ", f"{F3}{F3} b"),
    "four ticks": (f"{F3}`\na\n{F3}`", "`\na"),
    "def then prose": ("Sure\ndef f(x):\n    return x\nThat is all", "def f(x):\n    return x"),
    "def, blank lines": ("def f(x):\n\n    return x\n\n\nEnd", "def f(x):\n\n    return x\n\n"),
    "decorator is lost": ("import os\n@cache\ndef f():\n\treturn 1", "def f():\n\treturn 1"),
    "two defs": ("def f():\n  pass\ndef g():\n  pass\nx", "def f():\n  pass\ndef g():\n  pass"),
    "indented def": ("class A:\n    def f(self):\n        pass\nprint(1)", "    def f(self):\n        pass"),
    "carriage returns": ("def f():\r\n    return 1\r\n\r\nx", "def f():\r\n    return 1\r\n\r"),
    "def without a name": ("def \nx", "def \nx"),
    "unicode space before def": ("\u3000def f():\n\u00a0\n pass\nx", "\u3000def f():\n\u00a0\n pass"),
    "other indentation ends it": ("def f():\n\u3000pass", "def f():"),
    "prose": (" no code here \n", "no code here"),
    "unicode spaces": ("\u2003\x1cno code\u3000\x85", "no code"),
    "empty": ("", ""),
}


@pytest.mark.parametrize("case", CODE_CASES)
def test_extract_code(spark, case):
    content, wanted = CODE_CASES[case]
    assert one(spark, tx.extract_code(F.col("a")), a=content) == wanted


def test_extract_code_of_long_function(spark):
    body = "def f():\n" + "    x = 1\n" * 50_000
    assert one(spark, tx.extract_code(F.col("a")), a=body + "end") == body[:-1]


def test_response_content(spark):
    rows = [
        ("error", {"error": "down", "choices": [{"message": {"content": "x"}}]}, ""),
        ("no choices", {"choices": []}, ""),
        ("null choices", {}, ""),
        ("no content", {"choices": [{"message": {}}]}, ""),
        ("content", {"choices": [{"message": {"content": "a"}}, {"message": {"content": "b"}}]}, "a"),
    ]
    df = spark.createDataFrame(
        [(r,) for _, r, _ in rows],
        schemas.T.StructType([schemas.T.StructField("r", schemas.MODEL_RESPONSE)]),
    )
    got = [r[0] for r in df.select(tx.response_content(F.col("r"))).collect()]
    assert got == [w for *_, w in rows]


TAG_CASES = {
    "closed": ("a <TAG>\n  x = 1\n  return x\n</TAG> b", "x = 1\nreturn x", "x = 1\n  return x"),
    "open, starts with def": ("a <TAG>\ndef f(s):\n    return s\n# Test cases\nprint(f(1))", "", "def f(s):\n    return s"),
    "open, comment first": ("<TAG> # go\ny = 1\nprint(y)", "# go\ny = 1", "# go\ny = 1"),
    "no tag": ("import x\n a = 1 \nprint(a)\nb # Expected output: 1", "a = 1", " a = 1 "),
    "two tags": ("<TAG>a</TAG><TAG>b</TAG>", "a", "a"),
    "close before open": ("</TAG> <TAG> z = 2\nimport y", "z = 2", "z = 2"),
}


@pytest.mark.parametrize("case", TAG_CASES)
def test_extract_tagged(spark, case):
    text, plain, corrected = TAG_CASES[case]
    assert one(spark, tx.extract_tagged(F.col("a")), a=text) == plain
    assert one(spark, tx.extract_tagged(F.col("a"), corrected=True), a=text) == corrected


def test_last_assistant(spark):
    cases = {
        "user\nhi\nassistant\nyes": "yes",
        "a\nassistant\nb\nassistant\nc": "c",
        "a\nassistant\nassistant\nb": "assistant\nb",
        "a\nassistant\n": "",
        "no mark": "",
    }
    for text, wanted in cases.items():
        assert one(spark, tx.last_assistant(F.col("a")), a=text) == wanted


def test_script_text(spark):
    row = spark.createDataFrame([("y = 1", ["assert y == 1"])], "a string, b array<string>").select(
        tx.test_script(F.col("a"), F.col("b")).alias("s")
    ).first()
    assert row["s"] == (
        "# Generated code\ny = 1\n\n# Test cases\n\n# Test case 1\ntry:\n    result = y == 1\n"
        "    if result:\n        print(f\"Test 1: PASS - All Clear\")\n    else:\n"
        "        print(f\"Test 1: FAIL - Result does not match expected output\")\n"
        "except Exception as e:\n    print(f\"Test 1: FAIL - {e}\")\n"
    )


def test_script_runs_as_written(spark):
    code = "def f(x):\n    return x + 1"
    script = one(
        spark, tx.test_script(F.col("a"), F.col("b")), a=code,
        b=["assert f(1) == 2", "assert f(1) == 3", "assert 1 / 0"],
    )
    assert "assert " not in script and script.startswith("# Generated code\ndef f(x):")
    printed = []
    exec(script, {"print": printed.append})  # noqa: S102 - our own three lines of code
    assert printed == [
        "Test 1: PASS - All Clear",
        "Test 2: FAIL - Result does not match expected output",
        "Test 3: FAIL - division by zero",
    ]
