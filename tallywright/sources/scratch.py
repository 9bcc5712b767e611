"""Tables a job stores on its way, in a folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(folder: str, master: str) -> bool:
    """Whether all of a cluster can be taken to see a folder: it is on no local disk, or there is one machine."""
    local = folder.startswith("file:") or ":" not in folder.split("/", 1)[0]
    return master.startswith("local") or not local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder in ``spark.checkpoint.dir``, else below the session's warehouse.

    The same rule holds on a cluster and in a local session. What is written there belongs to the
    application: remove ``tallywright/<application id>`` when it has ended. On a cluster a warehouse on
    the driver's own disk is refused, since executors do not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if not shared(root, spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/tallywright/{app}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back, so that lineage ends there.

    Unlike a local checkpoint the files outlive any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a table that ``stored`` made, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(spark, folder)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system Spark knows; one that is not there is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def matching_paths(spark: SparkSession, pattern: str, folders: bool) -> list[str]:
    """Paths of the folders, or of the files, that match a pattern of any file system Spark knows, sorted."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [] if f.isDirectory() == folders)
