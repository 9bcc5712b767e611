"""Numbers: pass@k, rates and difficulty classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def pass_at_k_col(n: Column, c: Column, k: int, strict: bool = False) -> Column:
    """Unbiased chance that one of ``k`` attempts passes, given ``c`` passes in ``n``.

    1.0 when fewer than ``k`` attempts failed, also for ``n < k``; with ``strict`` the
    latter gives NULL. No attempts at all give NULL.

    A product of ``k`` factors at every size, so a hot problem's attempts cost nothing more.
    """
    n, c = n.cast("bigint"), c.cast("bigint")
    k_factors = F.lit(1.0)
    for j in range(k):
        k_factors = k_factors * ((n - c - j).cast("double") / (n - j))
    value = (
        F.when(n - c < k, F.lit(1.0))
        .when(c == 0, F.lit(0.0))
        .otherwise(1.0 - k_factors)
    )
    return F.when(n >= (k if strict else 1), value)


def difficulty(
    rate: Column, easy: float = fv.EASY_FROM, medium: float = fv.MEDIUM_FROM
) -> Column:
    """Class of a pass rate; NaN and NULL are Hard."""
    return (
        F.when(rate.isNull() | F.isnan(rate), F.lit("Hard"))
        .when(rate >= easy, F.lit("Easy"))
        .when(rate >= medium, F.lit("Medium"))
        .otherwise(F.lit("Hard"))
    )


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
