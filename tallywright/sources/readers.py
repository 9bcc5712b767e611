"""Readers. All take a schema from ``schemas``, so no pass over the data is spent on one.

Two layouts of JSON files are read: ``array`` (a file is one JSON array indented by two, the form in
which runs are usually delivered) and ``lines`` (one record per line). Both are cut at record starts,
so that files of any size are read by many tasks, record by record; an array written in another way
is one row.

``position`` is a record's stored field of that name where it has one, else its place: a number that
grows along the file, however the file was cut. Places of different files say nothing about each
other; ``file`` orders the files of one run by name.

Whatever is no JSON object is left out; a field of the wrong type is NULL and costs neither
its record nor its file. ``checked_evaluations`` keeps what is left out, with the reason, and
``inventory`` tells which files were not there. ``id_field`` is the name the problem id has in the
files. Ids are whole numbers unless ``numeric_ids=False`` keeps them as text.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from .. import schemas
from .scratch import matching_paths

_CORRUPT = "_corrupt_record"


# What stands before a record of an array that is indented by two.
_RECORD_START = "\n  {"


def _decoded(content: Column) -> Column:
    """Texts are UTF-8; one that is not is taken as Latin-1."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(content.cast("binary"), "ISO-8859-1"))


def _json_texts(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """(_path, _json, position) of every record."""
    if layout not in ("array", "lines"):
        raise ValueError("layout is 'array' or 'lines'")
    reader = spark.read if layout == "lines" else spark.read.option("lineSep", _RECORD_START)
    pieces = reader.text(path).select(
        F.col("_metadata.file_path").alias("_path"), "value", _place().alias("_place")
    )
    if layout == "lines":
        texts = pieces.select("_path", F.col("value").alias("_json"), "_place")
    else:
        text = _decoded(F.col("value"))
        # The first piece is what stands before the first record: a bracket, or a whole array that
        # is not indented. The others lack their first brace and end with a comma or the bracket.
        opening = F.startswith(F.ltrim(text), F.lit("["))
        others = F.array(F.concat(F.lit("{"), F.rtrim(text, F.lit(" \t\r\n,]"))))
        records = F.when(opening, F.from_json(text, "array<string>")).otherwise(others)
        texts = pieces.select("_path", F.posexplode(records).alias("_at", "_json"), "_place").withColumn(
            "_place", F.col("_place") + F.col("_at")
        ).drop("_at")
    # Only a text that can have the field (its name may be written with escapes) is parsed for it.
    named = F.contains("_json", F.lit("position")) | F.contains("_json", F.lit("\\u"))
    stored = F.when(named, F.get_json_object("_json", "$.position")).try_cast("bigint")
    return texts.withColumn("position", F.coalesce(stored, F.col("_place"))).drop("_place")


def _place() -> Column:
    """A number that grows along a file whatever pieces it was cut into, for use right above the scan.

    Pieces begin at multiples of the largest piece's length. A task reads its pieces in order and no
    more bytes than that length, and every record has a byte or more; so the beginning of the piece
    plus the number of records the task has read before stays below the next piece's beginning. (A
    setting of spark.sql.files.maxPartitionNum lets tasks read more; it must not be set.)
    """
    before = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.col("_metadata.file_block_start") + before


def _read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    layout: str,
    id_field: str,
    numeric_ids: bool,
) -> DataFrame:
    """Records with ``problem_id``, ``position`` and ``_path``.

    No matching file gives an empty table, as a run without results is no error.
    """
    try:
        texts = _json_texts(spark, path, layout)
    except AnalysisException as error:
        if not _no_file(error):
            raise
        texts = spark.createDataFrame([], "_path string, _json string, position bigint")
    return parse_records(texts, schema, id_field, numeric_ids).select(
        "problem_id", *[f.name for f in schema.fields if f.name != id_field], "position", "_path"
    )


def _no_file(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def parse_records(
    texts: DataFrame, schema: T.StructType, id_field: str = "problem_id", numeric_ids: bool = True
) -> DataFrame:
    """``texts`` with the fields of the JSON objects in ``_json``; what is no object is left out.

    Batches and streams read records by this rule alike.
    """
    record, columns, is_object = _record(schema, id_field, numeric_ids)
    return (
        texts.withColumn("_record", record)
        .where(F.col("_record").isNotNull() & is_object)
        .select(*columns, *[c for c in texts.columns if c != "_json"])
    )


def _record(schema: T.StructType, id_field: str, numeric_ids: bool) -> tuple[Column, list[Column], Column]:
    """How ``_record`` is parsed from ``_json``, its fields, and whether it is an object."""
    id_type = "bigint" if numeric_ids else "string"
    typed = [
        T.StructField(f.name, T.StringType() if f.name == id_field else f.dataType)
        for f in schema.fields
    ]
    columns = [
        F.col(f"_record.`{f.name}`").cast(id_type).alias("problem_id")
        if f.name == id_field
        else F.col(f"_record.`{f.name}`")
        for f in schema.fields
    ]
    parsed = T.StructType([*typed, T.StructField(_CORRUPT, T.StringType())])
    record = F.from_json("_json", parsed, {"columnNameOfCorruptRecord": _CORRUPT})
    corrupt = F.col(f"_record.{_CORRUPT}")
    # Only records with a flaw are looked at a second time.
    return record, columns, corrupt.isNull() | F.json_object_keys(corrupt).isNotNull()


NOT_JSON = "not JSON"
NO_OBJECT = "not an object"
NO_NUMBER = "id is not a whole number"


def checked_records(
    texts: DataFrame, schema: T.StructType, id_field: str = "problem_id", numeric_ids: bool = True
) -> DataFrame:
    """``parse_records`` that keeps every record, with ``reason`` where it cannot be used.

    A record with a reason has NULL fields, and its text in ``rejected``. Blank texts are no records. An id
    that is no whole number is a reason instead of an error.
    """
    record, columns, is_object = _record(schema, id_field, False)
    whole = F.col(f"_record.`{id_field}`")
    reason = (
        F.when(F.col("_record").isNull() | ~is_object, F.when(F.try_parse_json("_json").isNull(), NOT_JSON).otherwise(NO_OBJECT))
        .when(F.lit(numeric_ids) & whole.isNotNull() & whole.try_cast("bigint").isNull(), NO_NUMBER)
    )
    others = [c for c in texts.columns if c != "_json"]
    named = texts.where(F.trim("_json") != "").withColumn("_record", record).withColumn("reason", reason)
    fine = F.col("reason").isNull()
    fields = [
        F.when(fine, whole.try_cast("bigint") if numeric_ids else whole).alias("problem_id")
        if f.name == id_field else F.when(fine, F.col(f"_record.`{f.name}`")).alias(f.name)
        for f in schema.fields
    ]
    return named.select(*fields, *others, "reason", F.when(~fine, F.col("_json")).alias("rejected"))


def read_problems(
    spark: SparkSession, path: str, split: str = "test", fmt: str = "parquet"
) -> DataFrame:
    """Problems of one split; an unknown split falls back to the first one there is.

    The fallback is a scalar subquery over the split column, so with the split as partition
    column only that partition's files are read.
    """
    problems = spark.read.schema(schemas.PROBLEM_TABLE).format(fmt).load(path)
    place = F.array_position(F.array(*[F.lit(s) for s in fv.SPLITS]), F.col("split"))
    # Listed splits in their order, then others by name.
    order = F.struct(place == 0, place, "split")
    chosen = problems.agg(
        F.coalesce(
            F.max(F.when(F.col("split") == split, F.col("split"))), F.min_by("split", order)
        )
    ).scalar()
    return problems.where(F.col("split") == chosen)


def read_responses(
    spark: SparkSession,
    base: str,
    split: str | None = None,
    id_field: str = "problem_id",
    layout: str = "array",
    numeric_ids: bool = True,
    prefix: str = fv.RESPONSES_PREFIX,
) -> DataFrame:
    """Response records of one results folder: one split, or all that are there.

    Files are found by their exact name; ``prefix`` is what it begins with.
    """
    splits = [split] if split else fv.RESPONSE_SPLITS
    name = prefix + fv.RESPONSES_NAME.format(split="{" + ",".join(splits) + "}")
    return read_response_file(spark, f"{base}/{name}", id_field, layout, numeric_ids)


def read_response_file(
    spark: SparkSession,
    path: str,
    id_field: str = "problem_id",
    layout: str = "array",
    numeric_ids: bool = True,
    with_file: bool = False,
) -> DataFrame:
    """Response records of one explicit file; a file that cannot be read gives none.

    A file written by this library is a folder of part files: with ``with_file`` the column ``file``
    names a record's, and (``file``, ``position``) is its place.
    """
    schema = schemas.response(id_field)
    pattern = fv.RESPONSES_NAME.replace(".", r"\.").format(split="([a-z]+)")
    records = _read_json(spark, path, schema, layout, id_field, numeric_ids)
    if with_file:
        records = records.withColumn("file", F.substring_index("_path", "/", -1))
    return records.withColumn("split", F.regexp_extract("_path", pattern, 1)).drop("_path")


def read_response_variants(
    spark: SparkSession,
    path: str,
    id_field: str = "problem_id",
    layout: str = "array",
    numeric_ids: bool = True,
) -> DataFrame:
    """(problem_id, prompt, timestamp, model_response, position, split), ``model_response`` as VARIANT.

    Reads what ``read_response_file`` reads, for use where a key's presence counts (``operators.presence``);
    records that are no JSON objects are left out.
    """
    try:
        texts = _json_texts(spark, path, layout)
    except AnalysisException as error:
        if not _no_file(error):
            raise
        texts = spark.createDataFrame([], "_path string, _json string, position bigint")
    pattern = fv.RESPONSES_NAME.replace(".", r"\.").format(split="([a-z]+)")
    record = texts.withColumn("_record", F.try_parse_json("_json")).where(
        F.startswith(F.schema_of_variant("_record"), F.lit("OBJECT"))
    )
    item = F.try_variant_get("_record", f"$['{id_field}']", "string")
    return record.select(
        (item.cast("bigint") if numeric_ids else item).alias("problem_id"),
        F.try_variant_get("_record", "$.prompt", "string").alias("prompt"),
        F.try_variant_get("_record", "$.timestamp", "double").alias("timestamp"),
        F.try_variant_get("_record", "$.model_response", "variant").alias("model_response"),
        "position", F.regexp_extract("_path", pattern, 1).alias("split"),
    )


def _run_files(base: str, runs: list[str] | None, partitioned: bool) -> tuple[str, str]:
    """Where the files of runs are, and a pattern of their paths whose group is the run."""
    folder = "{" + ",".join(runs) + "}" if runs else "*"
    if partitioned:
        return f"{base}/run_id={folder}", "/run_id=([^/]+)/"
    return f"{base}/{folder}/{fv.EVALUATIONS_NAME}", "([^/]+)/" + fv.EVALUATIONS_NAME.replace(".", r"\.")


def _decoded_path() -> Column:
    """Paths in file metadata are URL-encoded; "+" is a plain character there."""
    return F.url_decode(F.replace(F.col("_path"), F.lit("+"), F.lit("%2B")))


def _with_run(records: DataFrame, pattern: str) -> DataFrame:
    """``run_id`` and ``file``, the file's name."""
    return records.withColumn("run_id", F.regexp_extract(_decoded_path(), pattern, 1)).withColumn(
        "file", F.substring_index("_path", "/", -1)
    ).drop("_path")


def _read_runs(
    spark: SparkSession,
    base: str,
    runs: list[str] | None,
    schema: T.StructType,
    layout: str,
    id_field: str,
    numeric_ids: bool,
    partitioned: bool,
) -> DataFrame:
    path, pattern = _run_files(base, runs, partitioned)
    return _with_run(_read_json(spark, path, schema, layout, id_field, numeric_ids), pattern)


def read_attempts(
    spark: SparkSession,
    base: str,
    runs: list[str] | None = None,
    id_field: str = "problem_id",
    layout: str = "array",
    numeric_ids: bool = True,
    partitioned: bool = False,
) -> DataFrame:
    """(run_id, problem_id, passed) of every run folder; only two fields are parsed.

    A run's folder holds ``evaluations/evaluation_results_all.json``, or is ``run_id=<run>`` as this
    library's writers make them (``partitioned``).
    """
    schema = schemas.attempt_fields(id_field)
    return _read_runs(spark, base, runs, schema, layout, id_field, numeric_ids, partitioned)


def read_evaluations(
    spark: SparkSession,
    base: str,
    runs: list[str] | None = None,
    id_field: str = "problem_id",
    layout: str = "array",
    numeric_ids: bool = True,
    partitioned: bool = False,
) -> DataFrame:
    """Whole evaluation records of every run folder, or of the listed ones.

    The run id is the folder's name. Between several records of a problem in one run ``file`` and
    ``position`` tell the earlier one; a run of one file needs ``position`` only.
    """
    schema = schemas.evaluation(id_field)
    return _read_runs(spark, base, runs, schema, layout, id_field, numeric_ids, partitioned)


def checked_evaluations(
    spark: SparkSession,
    base: str,
    runs: list[str] | None = None,
    id_field: str = "problem_id",
    layout: str = "array",
    numeric_ids: bool = True,
    partitioned: bool = False,
) -> DataFrame:
    """``read_evaluations`` that keeps what cannot be used: its text in ``rejected``, why in ``reason``.

    ``quarantine.write_split`` stores both kinds in one pass. No matching file gives an empty table.
    """
    path, pattern = _run_files(base, runs, partitioned)
    try:
        texts = _json_texts(spark, path, layout)
    except AnalysisException as error:
        if not _no_file(error):
            raise
        texts = spark.createDataFrame([], "_path string, _json string, position bigint")
    return _with_run(checked_records(texts, schemas.evaluation(id_field), id_field, numeric_ids), pattern)


NO_FOLDER = "no run folder"
NO_FILE = "no evaluations file"
EMPTY_FILE = "empty file"
NO_RECORD = "no readable record"


def inventory(
    spark: SparkSession, base: str, runs: list[str] | None = None, partitioned: bool = False
) -> DataFrame:
    """(run_id, folder, file, bytes) of every run folder below ``base``, and of every listed run.

    ``folder`` and ``file`` tell whether they are there. Files are listed, not read. The paths of folders and
    files pass the driver, as those of all files that Spark reads do.
    """
    path, pattern = _run_files(base, runs, partitioned)
    head = "run_id=" if partitioned else ""
    folders = [p.rsplit("/", 1)[1][len(head):] for p in matching_paths(spark, f"{base}/{head}*", True)]
    # What this library writes is a folder of part files; those of runs delivered whole are files.
    parts = "/part-*" if partitioned else ""
    files = matching_paths(spark, path + parts, False) + matching_paths(spark, f"{path}/part-*", False)
    known = {m.group(1) for m in (re.search(pattern, f) for f in files) if m}
    table = spark.createDataFrame(
        [(run, run in folders, run in known) for run in (runs or folders)], "run_id string, folder boolean, file boolean"
    )
    try:
        lengths = spark.read.format("binaryFile").load(path).select("path", "length")
    except AnalysisException as error:
        if not _no_file(error):
            raise
        lengths = spark.createDataFrame([], "path string, length bigint")
    sizes = lengths.groupBy(F.regexp_extract("path", pattern, 1).alias("run_id")).agg(F.sum("length").alias("bytes"))
    return table.join(sizes, "run_id", "left").select(
        "run_id", "folder", "file", F.coalesce("bytes", F.lit(0)).alias("bytes")
    )


def skipped_runs(listed: DataFrame, records: DataFrame) -> DataFrame:
    """(run_id, reason) of the runs in ``listed`` (an ``inventory``) that gave none of ``records``."""
    reason = (
        F.when(~F.col("folder"), NO_FOLDER).when(~F.col("file"), NO_FILE)
        .when(F.col("bytes") == 0, EMPTY_FILE).otherwise(NO_RECORD)
    )
    read = records.select("run_id").distinct()
    return listed.join(read, "run_id", "left_anti").select("run_id", reason.alias("reason"))


def missing_splits(spark: SparkSession, base: str, prefix: str = fv.RESPONSES_PREFIX) -> DataFrame:
    """(split) of the response files that are not in a results folder."""
    name = prefix + fv.RESPONSES_NAME
    there = {p.rsplit("/", 1)[1] for kind in (True, False) for p in matching_paths(spark, f"{base}/*", kind)}
    gone = [(s,) for s in fv.RESPONSE_SPLITS if name.format(split=s) not in there]
    return spark.createDataFrame(gone, "split string")


def read_stored(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table this library wrote, partition columns included in ``schema``."""
    return spark.read.schema(schema).format(fmt).load(path)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, id_field: str) -> DataFrame:
    table = spark.read.schema(schema).option("header", True).csv(path)
    return table.withColumnRenamed(id_field, "problem_id")


def read_pivot(
    spark: SparkSession, path: str, runs: list[str], id_field: str = "problem_id"
) -> DataFrame:
    """The problem-by-run table; an empty cell is a missing verdict."""
    return _read_csv(spark, path, schemas.pivot(runs, id_field), id_field)


def read_pass_at_k(
    spark: SparkSession, path: str, ks: list[int] = fv.PASS_AT, id_field: str = "problem_id"
) -> DataFrame:
    return _read_csv(spark, path, schemas.pass_at_k(ks, id_field), id_field)


def read_sample(
    spark: SparkSession, path: str, ks: list[int] = fv.PASS_AT, id_field: str = "problem_id",
    dataset: bool = False,
) -> DataFrame:
    """A sample; with ``dataset``, of a folder that has one folder for each."""
    return _read_csv(spark, path, _of_datasets(schemas.sample(ks, id_field), dataset), id_field)


def read_train_rows(spark: SparkSession, path: str, dataset: bool = False) -> DataFrame:
    """Training rows; with ``dataset``, of a folder that has one folder for each."""
    return spark.read.schema(_of_datasets(schemas.TRAIN_ROW, dataset)).json(path)


def _of_datasets(schema: T.StructType, dataset: bool) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("dataset", T.StringType())] if dataset else schema.fields)
