"""Grouped measures with an overall row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_with_total(
    df: DataFrame, measures: dict[str, Column], by: list[str], total: bool
) -> DataFrame:
    """Additive ``measures`` per ``by``, plus one row over everything (``is_total``).

    The total is added up from the groups, so the input is read and shuffled once; it is there
    also for no input, with zeros.
    """
    named = [column.alias(name) for name, column in measures.items()]
    if not by:
        return df.agg(*named).withColumn("is_total", F.lit(True))
    groups = df.groupBy(*by).agg(*named)
    if not total:
        return groups.withColumn("is_total", F.lit(False))
    # A global aggregate has a row for no groups too; a grouping set has not. Both read one exchange.
    overall = groups.agg(*[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in measures])
    return groups.withColumn("is_total", F.lit(False)).unionByName(
        overall.withColumn("is_total", F.lit(True)), allowMissingColumns=True
    )
