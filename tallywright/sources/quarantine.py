"""Good and bad rows stored in one write, and read back apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIDE = "set_aside"


def write_split(df: DataFrame, path: str, reason: str | Column = "reason", mode: str = "overwrite") -> dict[str, int]:
    """Store rows without a ``reason`` and those with one, each in a folder of its own, in one pass.

    Returns how many rows there were of either kind (``kept`` and ``set_aside``), counted by the tasks
    that write them.
    """
    given = F.col(reason) if isinstance(reason, str) else reason
    marked = df.withColumn("reason", given.cast("string")).withColumn(SIDE, F.col("reason").isNotNull())
    seen = Observation()
    counted = marked.observe(seen, F.count_if(~F.col(SIDE)).alias("kept"), F.count_if(F.col(SIDE)).alias(SIDE))
    counted.write.mode(mode).partitionBy(SIDE).parquet(path)
    return {"kept": seen.get["kept"], SIDE: seen.get[SIDE]}


def _read(spark: SparkSession, path: str, schema: T.StructType, bad: bool) -> DataFrame:
    full = T.StructType([*[f for f in schema.fields if f.name not in ("reason", SIDE)],
                         T.StructField("reason", T.StringType()), T.StructField(SIDE, T.BooleanType())])
    return spark.read.schema(full).parquet(path).where(F.col(SIDE) == bad).drop(SIDE)


def read_kept(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows without a reason; only their folder is read. ``schema`` is that of the rows written."""
    return _read(spark, path, schema, False).drop("reason")


def read_set_aside(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows with a reason, and the reason."""
    return _read(spark, path, schema, True)
