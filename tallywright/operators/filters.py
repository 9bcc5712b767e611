"""Row filters by split and id, and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import cut_text


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def with_id(df: DataFrame, wanted: str | int, id_col: str = "problem_id") -> DataFrame:
    """Rows of one id. Ids kept as text are compared as text, so ``unknown_3`` is found as well; for
    ids that are numbers a text that is none raises."""
    if _is_text(df, id_col):
        return df.where(F.col(id_col) == str(wanted))
    return df.where(F.col(id_col) == int(wanted))


def ids_above(df: DataFrame, lower: int, id_col: str = "problem_id") -> DataFrame:
    """Rows with a greater id. Ids kept as text count by their number; those that are none are not above."""
    if _is_text(df, id_col):
        return df.where(F.col(id_col).try_cast("bigint") > lower)
    return df.where(F.col(id_col) > lower)


def ids_in(df: DataFrame, ids: list | DataFrame, id_col: str = "problem_id") -> DataFrame:
    """Rows whose id is listed. A list is pushed to the scan; a table, for ids that come from
    data or are very many, is a semi join on its first column. Ids may be numbers or texts."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(id_col)), id_col, "left_semi")
    return df.where(F.col(id_col).isin(ids))


def splits_for_run(df: DataFrame, fine_tuned: bool = False) -> DataFrame:
    """Rows of the splits an all-splits run uses: never the prompt split, and for a
    fine-tuned model not the training split either."""
    return df.where(~F.col("split").isin(["prompt", "train"] if fine_tuned else ["prompt"]))


def latest_run(df: DataFrame, run_col: str = "run_ts") -> DataFrame:
    """Rows of the newest run; on a partition column only that run's files are read."""
    return df.where(F.col(run_col) == df.agg(F.max(run_col)).scalar())


def preview(
    df: DataFrame, n: int = 3, width: int = 100, order: list[str | Column] = [], always: bool = False
) -> DataFrame:
    """The first ``n`` rows with long texts cut."""
    rows = (df.orderBy(*order) if order else df).limit(n)
    return rows.select(
        *[
            cut_text(F.col(f.name), width, always).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
