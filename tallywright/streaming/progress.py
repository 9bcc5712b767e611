"""Progress of runs while their records arrive as files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.filters import latest_run
from ..operators.responses import response_stats
from ..sources.readers import parse_records
from ..sources.scratch import remove_path

_TEXTS = T.StructType([T.StructField("value", T.StringType()), T.StructField("run_id", T.StringType())])
_PROGRESS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("is_total", T.BooleanType()),
        T.StructField("total_problems", T.LongType()),
        T.StructField("successful_responses", T.LongType()),
        T.StructField("failed_responses", T.LongType()),
        T.StructField("success_rate", T.DoubleType()),
        T.StructField("average_tokens", T.DoubleType()),
        T.StructField("total_tokens", T.LongType()),
        T.StructField("epoch", T.LongType()),
    ]
)


def stream_progress(
    spark: SparkSession,
    records: str,
    progress: str,
    checkpoint: str,
    once_per_record: bool = False,
    max_files: int | None = None,
    horizon: str | None = None,
) -> StreamingQuery:
    """Follow a folder of response records and keep the statistics per run up to date.

    Takes everything there is and stops; call it again, or on a schedule, to go on from the
    checkpoint. The state is one row of counters per run. Lines that are no records are left out, as
    in a batch. Each epoch is stored under a number above all stored before, whatever the
    checkpoint, in one file; only the last two are kept.

    ``horizon`` (such as "2 hours") drops records delivered twice within that time, by the records' own
    ``timestamp``; ids older than the horizon leave the state, so that it holds the ids of one horizon,
    however long the stream runs. Records that come later than the horizon allows, measured from the
    newest of the batches before, are not counted; those without a timestamp are counted each time.
    ``once_per_record`` drops repeats however late; its state then grows with the number of records.
    """
    reader = spark.readStream.schema(_TEXTS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(records).select(F.col("value").alias("_json"), "run_id")
    stream = parse_records(lines, schemas.response())
    if once_per_record:
        stream = stream.dropDuplicates(["run_id", "problem_id"])
    elif horizon:
        # A watermark begins at 1970; what is not later than that would be late from the start.
        at = F.timestamp_seconds(F.greatest("timestamp", F.lit(0.001)))
        timed = stream.where("timestamp is not null").withColumn("_at", at).withWatermark("_at", horizon)
        timed = timed.dropDuplicatesWithinWatermark(["run_id", "problem_id"]).drop("_at")
        stream = timed.unionByName(stream.where("timestamp is null"))
    stats = response_stats(stream, by=["run_id"], total=False)

    last = _stored(spark, progress).agg(F.max("epoch")).first()[0] or 0

    def store(rows: DataFrame, epoch: int) -> None:
        nonlocal last
        # One small file, which appears whole or not at all.
        rows.coalesce(1).write.mode("overwrite").parquet(f"{progress}/epoch={last + 1}")
        last += 1
        remove_path(spark, f"{progress}/epoch={last - 2}")

    return (
        stats.writeStream.outputMode("complete")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stored(spark: SparkSession, progress: str) -> DataFrame:
    try:
        return spark.read.schema(_PROGRESS).parquet(progress)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _PROGRESS)


def read_progress(spark: SparkSession, progress: str) -> DataFrame:
    """Statistics per run as of the newest stored epoch; an empty table where there is none."""
    return latest_run(_stored(spark, progress), "epoch").drop("epoch", "is_total")
