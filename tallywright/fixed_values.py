"""Texts, names and numbers that results must match exactly."""

# --- prompt and instruction text -------------------------------------------------------------
PROMPT_HEAD = "Please solve the following Python programming problem:\n\nProblem: "
PROMPT_TASK = "\n\nTask ID: "
PROMPT_TESTS = "\n\nExpected behavior (test cases):\n"
PROMPT_FOOT = (
    "\n\nPlease provide a complete Python function that solves this problem. "
    "Write only the function code without any explanations or comments."
)
ASSERT_WORD = "assert "
EQUALS_WORD = " == "
EQUALS_PROSE = " should return "

# --- test script text (``{i}`` is the test number, ``{test}`` the cleaned test) --------------
SCRIPT_HEAD = "# Generated code\n"
SCRIPT_TESTS = "\n\n# Test cases\n"
SCRIPT_TEST = """
# Test case {i}
try:
    result = {test}
    if result:
        print(f"Test {i}: PASS - All Clear")
    else:
        print(f"Test {i}: FAIL - Result does not match expected output")
except Exception as e:
    print(f"Test {i}: FAIL - {{e}}")
"""

# --- outcome lines and verdict texts ---------------------------------------------------------
OUTCOME_PREFIX = "Test"
PASS_WORD = "PASS"
FAIL_WORD = "FAIL"
PASS_REASON = "Passed"
FAIL_REASON = "Failed"
REASON_MARK = " - "
ASSERTION_WORD = "AssertionError"
TIMEOUT_LINE = "TIMEOUT"
RUNNER_ERROR_HEAD = "ERROR: "
FAIL_HEAD = "Test 1: FAIL - "
ASSERTION_LINE = "Test 1: FAIL - Assertion failed"
EXIT_LINE = "Test 1: FAIL - Script failed with return code 1"
SILENT_PASS_LINE = "Test 1: PASS - All assertions passed silently"
NO_CODE = "No code generated"
RUN_SECONDS = 30

# --- code extraction -------------------------------------------------------------------------
PYTHON_FENCE = "```python"
FENCE = "```"
OPEN_TAG = "<TAG>"
CLOSE_TAG = "</TAG>"
ASSISTANT_MARK = "\nassistant\n"
# Text that ends the code after an unclosed tag.
TAG_ENDS = ["# Test cases", r"print\(", "import ", r"def [a-zA-Z_][a-zA-Z0-9_]*\(", "<TAG>"]
# Lines dropped from tagged code: by their start, or by a text inside.
TAG_DROPPED_STARTS = ["print(", "import ", "<TAG>", "# Test cases"]
TAG_DROPPED_TEXT = "Expected output:"
# Everything Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set without the newline, as a Java regex class body.
LINE_SPACE = (
    r"\t\x0B\f\r\x1C-\x1F \x85\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
)

# --- scores, classes and mixes ---------------------------------------------------------------
PASS_SCORE = 100
EASY_FROM = 0.75
MEDIUM_FROM = 0.30
CLASSES = ["Easy", "Medium", "Hard"]
MIXES = {
    "Easy-heavy": {"Easy": 0.70, "Medium": 0.20, "Hard": 0.10},
    "Hard-heavy": {"Easy": 0.10, "Medium": 0.20, "Hard": 0.70},
    "Medium-heavy": {"Easy": 0.10, "Medium": 0.70, "Hard": 0.20},
    "Balanced": {"Easy": 0.33, "Medium": 0.33, "Hard": 0.34},
}
SAMPLE_SEED = 42
PASS_AT = [1, 5, 10]
TOP_ROWS = 10
DEMO_PROBLEMS = 4

# --- splits and file names -------------------------------------------------------------------
SPLITS = ["train", "test", "validation", "prompt"]
RESPONSE_SPLITS = ["test", "train", "validation"]
RESPONSES_PREFIX = ""
RESPONSES_NAME = "results_final_{split}.json"
EVALUATIONS_NAME = "evaluations/evaluation_results_all.json"
