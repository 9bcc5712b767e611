"""Writers. Every one writes from all tasks; a table becomes a folder of part files."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN_FILES = 100  # of one task, each with a buffer of some KB


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: list[str] = [],
    id_field: str = "problem_id",
    mode: str = "overwrite",
) -> None:
    """Store a table as parquet, orc, json (one record per line) or csv with a header.

    ``id_field`` is the name the problem id gets in the files.
    """
    if id_field != "problem_id":
        df = df.withColumnRenamed("problem_id", id_field)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt in ("json", "csv"):
        with _folders_at_once(df.sparkSession):
            writer.save(path)
    else:
        writer.save(path)


@contextmanager
def _folders_at_once(spark: SparkSession) -> Iterator[None]:
    """Tasks keep the text files of up to ``OPEN_FILES`` folders open, instead of sorting their rows by folder first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(max(OPEN_FILES, int(before or 0))))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def append_records(df: DataFrame, path: str, partition_by: list[str] = ["run_id"]) -> None:
    """Add finished records to a folder that ``streaming.progress`` follows.

    One file per batch and partition rather than one per record: with billions of records
    the file listing would cost more than the records.
    """
    write_table(df, path, "json", partition_by, mode="append")


def write_json_arrays(
    df: DataFrame, path: str, id_field: str = "problem_id", partition_by: str | None = None, order: list[str] = [],
    records: Callable[[DataFrame], DataFrame] | None = None, compression: str = "none",
) -> None:
    """Store records as JSON arrays indented by two, one array per part file.

    ``partition_by`` puts the rows of each value of a column into a folder of its own, in one job. A
    part file is never cut, because a cut array could not be read. No task holds more than one Arrow
    batch. Records stand in the order of the columns ``order`` within a part file; the part files of a table
    that is partitioned by ranges of them follow each other by name.

    ``records`` makes the records of ``df``, row by row, once its rows are in order: what is sorted then is
    as narrow as ``df``, which has the columns ``partition_by`` and ``order`` as the records do.
    ``compression`` is a codec's name for Spark's text files, such as gzip. Uncompressed files are cut at
    record starts when they are read, others are read by a task each.
    """
    folder = F.col(partition_by).cast("string") if partition_by else F.lit("")
    folder = F.coalesce(folder, F.lit("__HIVE_DEFAULT_PARTITION__"))
    if order:
        df = df.sortWithinPartitions(folder, *order)
    if records:
        df = records(df)
    if id_field != "problem_id":
        df = df.withColumnRenamed("problem_id", id_field)
    fields = [c for c in df.columns if c != partition_by]
    record = F.to_json(F.struct(*fields), {"pretty": "true"})
    # Line ends inside of texts are escaped, so every one is followed by a line of the record.
    text = df.select(
        folder.alias("folder"), F.concat(F.lit("\n  "), F.replace(record, F.lit("\n"), F.lit("\n  "))).alias("value")
    )

    def as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, begun = ["folder", "value"], set()
        for batch in batches:
            folders = batch.column(0).dictionary_encode()
            found, at = folders.dictionary, folders.indices
            # The first record of a folder that this task has none of stands behind the bracket.
            heads = [","] * batch.num_rows
            for k, folder in enumerate(found.to_pylist()):
                if folder not in begun:
                    begun.add(folder)
                    heads[pc.index(at, k).as_py()] = "["
            lines = pc.binary_join_element_wise(pa.array(heads, pa.string()), batch.column(1), "")
            yield pa.RecordBatch.from_arrays([batch.column(0), lines], names)
        ends = sorted(begun) or ([] if partition_by else [""])
        if ends:
            texts = ["\n]\n" if begun else "[]\n"] * len(ends)
            yield pa.RecordBatch.from_arrays([pa.array(ends, pa.string()), pa.array(texts, pa.string())], names)

    lines = text.mapInArrow(as_array, "folder string, value string")
    lines = lines.withColumnRenamed("folder", partition_by) if partition_by else lines.select("value")
    # Every piece brings its own line ends.
    writer = lines.write.mode("overwrite").option("maxRecordsPerFile", 0).option("lineSep", " ")
    writer = writer.option("compression", compression)
    with _folders_at_once(df.sparkSession):
        (writer.partitionBy(partition_by) if partition_by else writer).text(path)
