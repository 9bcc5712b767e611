"""Tables of many folders are written without sorting rows by folder."""

import json

import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from tallywright.plans import catalog, views
from tallywright.sources import readers as rd
from tallywright.sources import writers as wr

CONF = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def rows(spark):
    run = F.when(F.col("id") % 11 != 0, F.concat(F.lit("r"), F.col("id") % 5))
    return spark.range(0, 600, 1, 3).select(
        F.col("id").alias("problem_id"), run.alias("run_id"), F.concat(F.lit("a\n  {"), "id").alias("code")
    )


def arrays(path):
    return {d.name: [json.loads(f.read_text()) for f in sorted(d.glob("part-*"))] for d in path.glob("run_id=*")}


def test_arrays_of_interleaved_folders(spark, rows, tmp_path, monkeypatch):
    want = {}
    for r in rows.collect():
        want.setdefault(f"run_id={r['run_id'] or '__HIVE_DEFAULT_PARTITION__'}", []).append(r["problem_id"])
    before, called = spark.conf.get(CONF), []
    text = DataFrameWriter.text
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "sortWithinPartitions", lambda *a, **b: pytest.fail("sorted"))
        m.setattr(DataFrameWriter, "text", lambda self, path: called.append(spark.conf.get(CONF)) or text(self, path))
        wr.write_json_arrays(rows, str(tmp_path / "a"), partition_by="run_id")
    got = arrays(tmp_path / "a")
    assert {k: [r["problem_id"] for part in parts for r in part] for k, parts in got.items()} == want
    assert called == [str(wr.OPEN_FILES)] and spark.conf.get(CONF) == before
    wr.write_json_arrays(rows.limit(0), str(tmp_path / "b"), partition_by="run_id")
    assert arrays(tmp_path / "b") == {}


def test_arrays_in_order(spark, rows, tmp_path):
    one = rows.withColumn("place", -F.col("problem_id")).coalesce(1)
    wr.write_json_arrays(one, str(tmp_path / "a"), partition_by="run_id", order=["place"])
    for parts in arrays(tmp_path / "a").values():
        ids = [r["problem_id"] for part in parts for r in part]
        assert len(parts) == 1 and ids == sorted(ids, reverse=True)


def test_lines_of_many_folders_are_not_sorted(spark, rows, tmp_path, monkeypatch):
    called, save = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, path: called.append(spark.conf.get(CONF)) or save(self, path))
    wr.write_table(rows, str(tmp_path / "l"), "json", ["run_id"])
    assert called == [str(wr.OPEN_FILES)] and spark.read.json(str(tmp_path / "l")).count() == 600


def test_only_records_that_can_name_a_position_are_parsed_for_it(spark, tmp_path):
    lines = ['{"problem_id": 1, "position": 70}', '{"problem_id": 2, "\\u0070osition": 80}', '{"problem_id": 3}']
    (tmp_path / "l.json").write_text("\n".join(lines))
    texts = rd._json_texts(spark, str(tmp_path / "l.json"), "lines")
    assert [r["position"] for r in texts.collect()] == [70, 80, 2]
    assert "contains" in texts._jdf.queryExecution().optimizedPlan().toString().lower()


def test_compressed_arrays_are_read_like_others(spark, rows, tmp_path):
    found = {}
    for codec in ("none", "gzip"):
        path = str(tmp_path / codec)
        wr.write_json_arrays(rows.repartition(5, "problem_id"), path, partition_by="run_id", compression=codec)
        read = rd.read_evaluations(spark, path, partitioned=True)
        inner = read.selectExpr("problem_id", "run_id", "substring(file, 1, 10) file", "position")
        # Places are compared within a file: numbers themselves say nothing.
        parts = {}
        for r in sorted(inner.collect(), key=lambda r: r["position"]):
            parts.setdefault((r["run_id"], r["file"]), []).append(r["problem_id"])
        found[codec] = parts
    assert found["none"] == found["gzip"] and sum(map(len, parts.values())) == 600
    assert all(f.suffixes[-2:] == [".txt", ".gz"] for f in (tmp_path / "gzip").glob("run_id=*/part-*"))


def test_records_are_made_of_rows_in_order(spark, tmp_path):
    lines = spark.range(50).selectExpr("id place", "concat('r', id % 2) run_id").repartition(1)

    def records(df):
        assert df.columns == ["place", "run_id"]
        return df.selectExpr("place problem_id", "run_id", "-place place", "repeat('x', 9) code")

    wr.write_json_arrays(lines, str(tmp_path / "a"), "item", "run_id", ["place"], records)
    got = arrays(tmp_path / "a")
    assert {k: [r["item"] for r in v[0]] for k, v in got.items()} == {f"run_id=r{k}": list(range(k, 50, 2)) for k in (0, 1)}
    assert got["run_id=r1"][0][0] == {"item": 1, "place": -1, "code": "x" * 9}


@pytest.mark.parametrize("name", ["stored_run_evaluations", "best_attempt_by_file_order"])
def test_stored_evaluations_are_compressed_and_not_sorted_as_records(spark, sf_dir, monkeypatch, name):
    paths, moved = [], []
    table = type(spark.range(1))
    text, ranged, ordered = DataFrameWriter.text, table.repartitionByRange, table.sortWithinPartitions
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path: paths.append(path) or text(self, path))
    monkeypatch.setattr(table, "repartitionByRange", lambda self, *a: moved.append(self.columns) or ranged(self, *a))
    monkeypatch.setattr(table, "sortWithinPartitions", lambda self, *a: moved.append(self.columns) or ordered(self, *a))
    rows = catalog.queries()[name](spark, sf_dir).count()
    files = [f for path in paths for f in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).inputFiles()]
    assert rows and files and all(f.endswith(".txt.gz") for f in files)
    assert all(columns == ["l_partkey", *views.POSITION, "run_id"] for columns in moved)
    assert len(moved) == (2 if name == "best_attempt_by_file_order" else 0)
