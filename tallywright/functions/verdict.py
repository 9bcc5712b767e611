"""Outcome lines of a test run and what they mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .text import after_first, strip_ws


def outcome_lines(stdout: Column) -> Column:
    """The printed lines that report a test."""
    printed = strip_ws(F.coalesce(stdout, F.lit("")))
    # (?md): line ends are \n only
    return F.regexp_extract_all(printed, F.lit(f"(?md)^{fv.OUTCOME_PREFIX}.*$"), F.lit(0))


def final_outputs(
    lines: Column,
    stderr: Column,
    returncode: Column,
    timed_out: Column,
    runner_error: Column,
    script: Column,
) -> Column:
    """Outputs of a script run; ``stderr`` is its stripped error text.

    A non-zero exit replaces the printed lines by one failure line, except after a bare
    assertion error that printed some. A clean silent run of a script with assertions counts
    as one pass. Give this plain columns: lines and error text are looked at several times.
    """
    none = F.size(lines) == 0
    message = strip_ws(F.regexp_extract(stderr, f"{fv.ASSERTION_WORD}:([^\n]*)", 1))
    failure = (
        F.when(
            F.contains(stderr, F.lit(fv.ASSERTION_WORD + ":")),
            F.array(F.concat(F.lit(fv.ASSERTION_LINE + ": "), message)),
        )
        .when(
            F.contains(stderr, F.lit(fv.ASSERTION_WORD)),
            F.when(none, F.array(F.lit(fv.ASSERTION_LINE))).otherwise(lines),
        )
        .when(
            stderr != "",
            F.array(F.concat(F.lit(fv.FAIL_HEAD), F.substring_index(stderr, "\n", -1))),
        )
        .otherwise(F.array(F.lit(fv.EXIT_LINE)))
    )
    silent = none & (stderr == "") & F.contains(script, F.lit(fv.ASSERT_WORD))
    return (
        F.when(timed_out, F.array(F.lit(fv.TIMEOUT_LINE)))
        .when(
            runner_error.isNotNull(),
            F.array(F.concat(F.lit(fv.RUNNER_ERROR_HEAD), runner_error)),
        )
        .when(returncode != 0, failure)
        .when(silent, F.array(F.lit(fv.SILENT_PASS_LINE)))
        .otherwise(lines)
    )


def pass_count(outputs: Column) -> Column:
    """How many outputs speak of a pass."""
    passes = F.size(F.filter(outputs, lambda o: F.contains(o, F.lit(fv.PASS_WORD))))
    return F.coalesce(passes, F.lit(0))


def all_passed(outputs: Column, if_none: bool = False) -> Column:
    """True where every output speaks of a pass; ``if_none`` where there are no outputs."""
    passes = F.transform(outputs, lambda o: F.contains(o, F.lit(fv.PASS_WORD)))
    return F.coalesce(F.array_min(passes), F.lit(if_none))


def parse_outcome(line: Column) -> Column:
    """Outcome line as ``struct<status, reason>``."""
    rest = F.when(F.contains(line, F.lit(":")), strip_ws(after_first(line, ":"))).otherwise(line)
    passed = F.contains(rest, F.lit(fv.PASS_WORD))
    reason = F.when(
        F.contains(rest, F.lit(fv.REASON_MARK)), after_first(rest, fv.REASON_MARK)
    ).otherwise(F.when(passed, F.lit(fv.PASS_REASON)).otherwise(F.lit(fv.FAIL_REASON)))
    return F.struct(
        F.when(passed, F.lit(fv.PASS_WORD)).otherwise(F.lit(fv.FAIL_WORD)).alias("status"),
        reason.alias("reason"),
    )
