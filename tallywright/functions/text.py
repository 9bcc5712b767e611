"""Text functions over columns. All are built-in expressions, so they stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Written out plainly, a value used several times is computed several times as soon as the
    optimizer moves a filter below the projection that made it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_ws(text: Column) -> Column:
    """Remove leading and trailing whitespace, newlines and Unicode spaces included."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def after_first(text: Column, mark: str) -> Column:
    """What follows the first ``mark``; call it only where ``mark`` occurs."""
    return F.substr(text, F.instr(text, mark) + F.lit(len(mark)))


def _without_assert(test: Column) -> Column:
    return F.replace(test, F.lit(fv.ASSERT_WORD), F.lit(""))


def _as_prose(test: Column) -> Column:
    return F.replace(_without_assert(test), F.lit(fv.EQUALS_WORD), F.lit(fv.EQUALS_PROSE))


def _numbered(tests: Column) -> Column:
    return F.transform(
        tests, lambda t, i: F.concat((i + 1).cast("string"), F.lit(". "), _as_prose(t))
    )


def prompt_text(text: Column, task_id: Column, tests: Column) -> Column:
    """The question put to a model. Without tests the test section is left out."""
    lines = F.array_join(_numbered(tests), "\n")
    section = F.when(
        F.size(tests) > 0, F.concat(F.lit(fv.PROMPT_TESTS), lines, F.lit("\n"))
    ).otherwise(F.lit(""))
    return F.concat(
        F.lit(fv.PROMPT_HEAD), text, F.lit(fv.PROMPT_TASK), task_id.cast("string"),
        section, F.lit(fv.PROMPT_FOOT),
    )


def instruction_text(text: Column, task_id: Column, tests: Column) -> Column:
    """The question as it stands in a training row: one newline less, section always there."""
    return F.concat(
        F.lit(fv.PROMPT_HEAD), text, F.lit(fv.PROMPT_TASK), task_id.cast("string"),
        F.lit(fv.PROMPT_TESTS), F.array_join(_numbered(tests), "\n"), F.lit(fv.PROMPT_FOOT),
    )


def response_content(response: Column) -> Column:
    """Text of the first choice; '' for an error, no choices or no content."""
    first = F.get(response["choices"], F.lit(0))["message"]["content"]
    return F.when(response["error"].isNotNull(), F.lit("")).otherwise(
        F.coalesce(first, F.lit(""))
    )


# First "def" line, then every following line that is blank, indented or again a "def" line.
# (?md): line ends are \n only; the possessive loop keeps the matcher's stack flat.
_SPACE = f"[{fv.LINE_SPACE}]*"
_DEF_LINE = rf"{_SPACE}def {_SPACE}[^\n{fv.LINE_SPACE}][^\n]*"
FUNCTION_PATTERN = (
    rf"(?md)^({_DEF_LINE}(?:\n(?:[ \t][^\n]*|{_DEF_LINE}|{_SPACE}$))*+)"
)


def extract_code(content: Column) -> Column:
    """Code inside a response text.

    Three exclusive cases: closed ```python blocks, plain ``` blocks, or the first function
    in a text without fences. Where none yields a block, the stripped text is the code.
    Give this a plain column (not a long expression): the text is looked at several times.
    """
    tail = F.split(content, fv.PYTHON_FENCE)
    closed = F.filter(
        F.slice(tail, F.lit(2), F.size(tail)), lambda p: F.contains(p, F.lit(fv.FENCE))
    )
    python_blocks = F.transform(
        closed, lambda p: strip_ws(F.substring_index(p, fv.FENCE, 1))
    )
    inside = F.filter(F.split(content, fv.FENCE), lambda p, i: i % 2 == 1)
    plain_blocks = F.filter(
        F.transform(inside, strip_ws),
        lambda p: (p != "") & ~F.startswith(p, F.lit("python")),
    )
    function = F.regexp_extract(content, FUNCTION_PATTERN, 1)
    blocks = (
        F.when(F.contains(content, F.lit(fv.PYTHON_FENCE)), python_blocks)
        .when(F.contains(content, F.lit(fv.FENCE)), plain_blocks)
        .otherwise(F.filter(F.array(function), lambda f: f != ""))
    )
    return bind(
        blocks,
        lambda b: F.when(F.size(b) > 0, F.array_join(b, "\n\n")).otherwise(strip_ws(content)),
    )


def extract_tagged(text: Column, corrected: bool = False) -> Column:
    """Code between <TAG> and </TAG>, cut at the first end mark when the tag is not closed.

    Lines are stripped and printing, import and test lines dropped. ``corrected=True`` keeps
    indentation and looks for the end mark only after the code's first line, so that a
    function's own ``def`` line does not end it.
    """
    ends = "|".join(fv.TAG_ENDS)

    def up_to_end(body: Column) -> Column:
        if not corrected:
            return F.get(F.split(body, ends, 2), F.lit(0))
        first = F.substring_index(body, "\n", 1)
        rest = F.substr(body, F.length(first) + 1)
        return F.concat(first, F.get(F.split(rest, ends, 2), F.lit(0)))

    def tagged(after: Column) -> Column:
        closed = F.contains(after, F.lit(fv.CLOSE_TAG))
        cut = F.when(closed, F.substring_index(after, fv.CLOSE_TAG, 1)).otherwise(
            bind(strip_ws(after), up_to_end)
        )
        return F.when(after.isNull(), text).otherwise(strip_ws(cut))

    code = bind(F.get(F.split(text, fv.OPEN_TAG, 2), F.lit(1)), tagged)

    def kept(bare: Column) -> Column:
        wanted = (bare != "") & ~F.contains(bare, F.lit(fv.TAG_DROPPED_TEXT))
        for start in fv.TAG_DROPPED_STARTS:
            wanted = wanted & ~F.startswith(bare, F.lit(start))
        return wanted

    lines = F.split(code, "\n")
    if corrected:
        return F.array_join(F.filter(lines, lambda line: bind(strip_ws(line), kept)), "\n")
    return F.array_join(F.filter(F.transform(lines, strip_ws), kept), "\n")


def last_assistant(transcript: Column) -> Column:
    """Text after the last assistant mark, '' where there is none."""
    parts = F.split(transcript, fv.ASSISTANT_MARK)
    return F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise(F.lit(""))


def test_script(code: Column, tests: Column) -> Column:
    """Runnable script: the code, then one guarded block per test that prints its outcome."""
    # The template's doubled braces stand for single ones, as in str.format.
    template = fv.SCRIPT_TEST.replace("{{", "{").replace("}}", "}")

    def block(test: Column, i: Column) -> Column:
        pieces: list[Column] = []
        for n, before_number in enumerate(template.split("{i}")):
            if n:
                pieces.append((i + 1).cast("string"))
            for m, literal in enumerate(before_number.split("{test}")):
                if m:
                    pieces.append(_without_assert(test))
                pieces.append(F.lit(literal))
        return F.concat(*pieces)

    return F.concat(
        F.lit(fv.SCRIPT_HEAD), code, F.lit(fv.SCRIPT_TESTS),
        F.array_join(F.transform(F.coalesce(tests, F.array().cast("array<string>")), block), ""),
    )


test_script.__test__ = False  # not a pytest case, whatever the name suggests


def cut_text(text: Column, width: int, always: bool = False) -> Column:
    """Text cut to ``width`` characters with dots behind, for previews."""
    cut = F.concat(F.substring(text, 1, width), F.lit("..."))
    return cut if always else F.when(F.length(text) > width, cut).otherwise(text)
