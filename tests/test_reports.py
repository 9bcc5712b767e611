"""Order in cut files, reports of what was not read, quarantine, group lists, sketches, key presence."""

import gzip
import json
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywright import fixed_values as fv
from tallywright import schemas
from tallywright.operators import attempts as at
from tallywright.operators import evaluation as ev
from tallywright.operators import filters as fl
from tallywright.operators import presence as pr
from tallywright.operators import rates as rt
from tallywright.operators import responses as rs
from tallywright.operators import sketches as sk
from tallywright.operators import trainset as tr
from tallywright.sources import quarantine as qt
from tallywright.sources import readers as rd
from tallywright.sources import writers as wr
from tallywright.streaming.progress import read_progress, stream_progress


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_splits(spark):
    """Files are cut into pieces of some hundred bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def evaluations(count, seed):
    random.seed(seed)
    return [
        {"item": random.randrange(9), "passed": random.random() < 0.4, "error": None, "test_outputs": ["Test 1: PASS"] * random.randrange(3),
         "generated_code": f"code {k} " + "é" * random.randrange(60), "test_cases": [], "problem_statement": "s"}
        for k in range(count)
    ]


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def written(records, layout):
    if layout == "array":
        return json.dumps(records, indent=2, ensure_ascii=False)
    return "\n".join(json.dumps(r, ensure_ascii=False) for r in records) + "\n"


# --- order ---


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_places_grow_along_cut_files(spark, tmp_path, small_splits, layout):
    runs = {f"{k:02d}": evaluations(n, k) for k, n in ((1, 300), (2, 5), (3, 1), (4, 120))}
    for run, records in runs.items():
        put(tmp_path / run / fv.EVALUATIONS_NAME, written(records, layout))
    rows = rd.read_evaluations(spark, str(tmp_path), id_field="item", layout=layout)
    assert rows.rdd.getNumPartitions() > 50 and "binaryFile" not in plan(rows)
    got = rows.collect()
    for run, records in runs.items():
        mine = sorted((r for r in got if r["run_id"] == run), key=lambda r: r["position"])
        assert [r["generated_code"] for r in mine] == [r["generated_code"] for r in records]
        assert len({r["position"] for r in mine}) == len(records)


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_ties_go_to_the_earliest_record_however_files_are_cut(spark, tmp_path, small_splits, layout):
    runs = {f"{k:02d}": evaluations(200, k) for k in range(1, 4)}
    for run, records in runs.items():
        put(tmp_path / run / fv.EVALUATIONS_NAME, written(records, layout))
    best = {}
    for run, records in runs.items():
        for r in records:
            score = 100 if r["passed"] else sum("PASS" in x for x in r["test_outputs"])
            if score > best.get(r["item"], (-1,))[0]:
                best[r["item"]] = (score, run, r["generated_code"])
    found = rd.read_evaluations(spark, str(tmp_path), id_field="item", layout=layout)
    joined = tr.best_attempt(found).join(found.select("problem_id", "run_id", "position", "generated_code"), ["problem_id", "run_id", "position"])
    assert {r["problem_id"]: (r["score"], r["run_id"], r["generated_code"]) for r in joined.collect()} == best
    samples = spark.createDataFrame([("d", k) for k in best], "dataset string, problem_id long")
    rows = tr.train_rows(samples, found)
    assert {r["problem_id"]: r["output"] for r in rows.collect()} == {k: v[2] for k, v in best.items()}


def test_last_solution_of_a_cut_file(spark, tmp_path, small_splits):
    entries = [{"item": k % 7, "problem": {"code": f"v{k}"}} for k in range(400)]
    put(tmp_path / "results_final_train.json", written(entries, "array"))
    code = tr.reference_code(rd.read_responses(spark, str(tmp_path), "train", "item"))
    assert {r["problem_id"]: r["code"] for r in code.collect()} == {k % 7: f"v{k}" for k in range(400)}


def test_places_in_other_files(spark, tmp_path):
    records = evaluations(30, 7)
    path = tmp_path / "packed.json.gz"
    path.write_bytes(gzip.compress(written(records, "lines").encode()))
    rows = rd._read_json(spark, str(path), schemas.evaluation("item"), "lines", "item", True)
    assert [r["generated_code"] for r in rows.orderBy("position").collect()] == [r["generated_code"] for r in records]
    put(tmp_path / "flat.json", json.dumps(records))
    rows = rd._read_json(spark, str(tmp_path / "flat.json"), schemas.evaluation("item"), "array", "item", True)
    assert [r["generated_code"] for r in rows.orderBy("position").collect()] == [r["generated_code"] for r in records]
    # A stored position counts before the place.
    put(tmp_path / "own.json", '{"item": 1, "position": 9}\n{"item": 2, "position": 3}\n')
    rows = rd._read_json(spark, str(tmp_path / "own.json"), schemas.evaluation("item"), "lines", "item", True)
    assert [r["problem_id"] for r in rows.orderBy("position").collect()] == [2, 1]
    with pytest.raises(ValueError):
        rd.read_evaluations(spark, str(tmp_path), layout="other")


def test_ordered_array_files(spark, tmp_path):
    df = spark.range(500).selectExpr("id problem_id", "id * 7919 % 500 key", "'01' run_id").repartition(5)
    wr.write_json_arrays(df.repartitionByRange(4, "key"), str(tmp_path / "a"), partition_by="run_id", order=["key"])
    rows = rd.read_attempts(spark, str(tmp_path / "a"), partitioned=True).orderBy("file", "position").collect()
    assert [r["problem_id"] * 7919 % 500 for r in rows] == list(range(500))


# --- what was not read ---


def test_checked_evaluations(spark, tmp_path):
    lines = ['{"item": 1, "passed": true}', '{"item": 2, "pas', "5", '"text"', "[1, 2", "null", "", "   ", '{"item": "x_1"}',
             '{"item": null}', '{"item": 3, "passed": "odd"}', "{}", "nope"]
    put(tmp_path / "01" / fv.EVALUATIONS_NAME, "\n".join(lines))
    rows = rd.checked_evaluations(spark, str(tmp_path), id_field="item", layout="lines").orderBy("position").collect()
    assert [(r["problem_id"], r["passed"], r["reason"], r["rejected"]) for r in rows] == [
        (1, True, None, None), (None, None, rd.NOT_JSON, lines[1]), (None, None, rd.NO_OBJECT, "5"), (None, None, rd.NO_OBJECT, '"text"'),
        (None, None, rd.NOT_JSON, "[1, 2"), (None, None, rd.NO_OBJECT, "null"), (None, None, rd.NO_NUMBER, lines[8]),
        (None, None, None, None), (3, None, None, None), (None, None, None, None), (None, None, rd.NOT_JSON, "nope"),
    ]
    assert {(r["run_id"], r["file"]) for r in rows} == {("01", "evaluation_results_all.json")}
    usable = rd.read_attempts(spark, str(tmp_path), id_field="item", layout="lines", numeric_ids=False)
    assert usable.count() == sum(r["reason"] in (None, rd.NO_NUMBER) for r in rows)
    texts = rd.checked_evaluations(spark, str(tmp_path), id_field="item", layout="lines", numeric_ids=False)
    assert texts.where(F.col("problem_id") == "x_1").count() == 1
    assert rd.checked_evaluations(spark, str(tmp_path / "none")).count() == 0


def test_skipped_runs(spark, tmp_path):
    base = tmp_path / "all runs+"
    put(base / "01" / fv.EVALUATIONS_NAME, '[\n  {"item": 1}\n]')
    put(base / "02" / fv.EVALUATIONS_NAME, "")
    put(base / "03" / fv.EVALUATIONS_NAME, '[\n  {"item": 1, "passed": tr')
    put(base / "04" / "notes.json", "{}")
    put(base / "a file", "x")
    records = rd.read_attempts(spark, str(base), id_field="item")
    skipped = rd.skipped_runs(rd.inventory(spark, str(base)), records)
    assert {r["run_id"]: r["reason"] for r in skipped.collect()} == {"02": rd.EMPTY_FILE, "03": rd.NO_RECORD, "04": rd.NO_FILE}
    listed = rd.inventory(spark, str(base), ["01", "09"])
    assert {r["run_id"]: (r["folder"], r["file"], r["bytes"] > 0) for r in listed.collect()} == {"01": (True, True, True), "09": (False, False, False)}
    assert [tuple(r) for r in rd.skipped_runs(listed, records).collect()] == [("09", rd.NO_FOLDER)]
    assert rd.inventory(spark, str(base / "nothing")).count() == 0
    assert "content" not in plan(rd.inventory(spark, str(base)))


def test_missing_splits(spark, tmp_path):
    put(tmp_path / "results_final_test.json", "[]")
    assert {r["split"] for r in rd.missing_splits(spark, str(tmp_path)).collect()} == {"train", "validation"}
    assert rd.missing_splits(spark, str(tmp_path / "none")).count() == 3


def test_both_kinds_are_stored_in_one_pass(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "if(id % 9 = 0, 'ninth', null) why")
    path = str(tmp_path / "split")
    assert qt.write_split(df, path, "why") == {"kept": 88, "set_aside": 12}
    good, bad = qt.read_kept(spark, path, df.schema), qt.read_set_aside(spark, path, df.schema)
    assert sorted(r["id"] for r in good.collect()) == [k for k in range(100) if k % 9]
    assert {(r["id"], r["reason"]) for r in bad.collect()} == {(k, "ninth") for k in range(0, 100, 9)}
    assert "PartitionFilters: [isnotnull(set_aside" in plan(good)
    assert qt.write_split(df.limit(0), str(tmp_path / "none"), "why") == {"kept": 0, "set_aside": 0}
    assert qt.write_split(df.where("id % 9 > 0"), str(tmp_path / "good"), "why") == {"kept": 88, "set_aside": 0}
    assert qt.read_set_aside(spark, str(tmp_path / "good"), df.schema).count() == 0


def test_attempts_are_quarantined(spark, tmp_path):
    rows = [("01", "1", True), ("01", "test_1", True), ("02", None, None), ("02", " 2 ", False)]
    df = spark.createDataFrame(rows, "run_id string, problem_id string, passed boolean")
    assert at.store_attempts(df, str(tmp_path / "s")) == {"kept": 2, "set_aside": 2}
    assert sorted(map(tuple, at.stored_attempts(spark, str(tmp_path / "s")).collect())) == [("01", 1, True), ("02", 2, False)]
    aside = at.attempts_set_aside(spark, str(tmp_path / "s")).collect()
    assert {(r["run_id"], r["raw_id"], r["reason"]) for r in aside} == {("01", "test_1", at.NO_NUMBER), ("02", None, at.NO_NUMBER)}


def test_ids_kept_as_text(spark):
    df = spark.createDataFrame([("unknown_3",), ("7",), ("602",), (None,)], "problem_id string")
    assert [r[0] for r in fl.with_id(df, "unknown_3").collect()] == ["unknown_3"]
    assert [r[0] for r in fl.with_id(df, 7).collect()] == ["7"]
    assert [r[0] for r in fl.ids_above(df, 600).collect()] == ["602"]


# --- by group ---


@pytest.mark.parametrize("seed, n, groups", [(1, 1, 3), (2, 5, 4), (3, 40, 2)])
def test_first_per_group(spark, seed, n, groups):
    random.seed(seed)
    # One group holds a third of all rows, half of them the same row; one has a NULL key.
    rows = [(random.choice([None, *range(groups)]), random.randrange(30) / 8, random.randrange(400), random.choice("ab")) for _ in range(3000)]
    rows += [(0, 0.5, 7, "a")] * 1500 + [(9, None, 1, "a")]
    df = spark.createDataFrame(rows, "g int, rate double, item long, t string").repartition(7)
    want = Counter()
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, -(r[1] or 0), r[2], r[3]))
        want.update((*r, place) for place, r in enumerate(mine[:n], 1))
    found = rt.first_per_group(df, ["g"], [-F.col("rate"), F.col("item")], n)
    assert Counter((r["g"], r["rate"], r["item"], r["t"], r["place"]) for r in found.collect()) == want
    assert "Window" not in plan(found) and "partial_min" in plan(found)
    assert rt.first_per_group(df.limit(0), ["g"], [F.col("item")], n).count() == 0


def test_top_lists_by_group_equal_the_global_ones(spark):
    df = spark.range(3000).selectExpr("id % 97 problem_id", "cast(id % 5 as string) run_id", "id % 7 < id % 3 passed")
    rates = rt.rate_by(df, "problem_id").withColumn("g", F.lit(1))
    for by_group, overall in (
        (rt.hardest_by(rates, ["g"]), rt.top_by_rate(df, worst=True)), (rt.easiest_by(rates, ["g"]), rt.top_by_rate(df)),
        (rt.most_attempted_by(rates, ["g"]), rt.top_by_count(df)),
    ):
        assert [r["problem_id"] for r in by_group.orderBy("place").collect()] == [r["problem_id"] for r in overall.collect()]


def test_id_arrays(spark):
    df = spark.createDataFrame([("01", 3, True), ("01", 1, True), ("02", 5, None), (None, 2, True), ("01", 1, False)],
                               "run_id string, problem_id long, passed boolean")
    arrays = {r["run_id"]: r["problem_ids"] for r in ev.id_arrays(df, passed=True).collect()}
    assert arrays == {"01": [1, 3], None: [2]}
    assert {r["run_id"]: r["problem_ids"] for r in ev.id_arrays(df, most=3).collect()}["01"] == [1, 1, 3]
    with pytest.raises(PySparkException, match="more than 2 ids in 01"):
        ev.id_arrays(df, most=2).collect()
    assert ev.id_arrays(df.limit(0)).count() == 0


# --- sketches ---


def test_sketches_merge(spark, tmp_path):
    rows = spark.range(300_000).selectExpr("id % 60000 problem_id", "cast(id % 3 as string) run_id", "id % 2 = 0 passed")
    wr.write_table(sk.run_sketches(rows), str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 3
    total = sk.merged_distinct(stored).first()
    assert total["rows"] == 300_000 and abs(total["problems"] - 60_000) <= 4 * sk.standard_error() * 60_000
    exact = {r["run_id"]: r["n"] for r in rows.groupBy("run_id").agg(F.count_distinct("problem_id").alias("n")).collect()}
    for r in sk.merged_distinct(stored, ["run_id"]).collect():
        assert abs(r["problems"] - exact[r["run_id"]]) <= 4 * sk.standard_error() * exact[r["run_id"]]
    coarse = sk.merged_distinct(sk.run_sketches(rows, lg_k=6)).first()["problems"]
    assert abs(coarse - 60_000) <= 4 * sk.standard_error(6) * 60_000
    covered = sk.run_coverage(stored).collect()
    assert {(r["run_id"], r["passes"]) for r in covered} == {("0", 50_000), ("1", 50_000), ("2", 50_000)}
    assert all(abs(r["coverage"] - 50_000 / 60_000) < 0.05 for r in covered)
    assert tuple(sk.merged_distinct(stored.limit(0)).first()) == (0, 0)


# --- key presence ---


def test_statistics_by_key_presence(spark, tmp_path):
    lines = ['{"item": 1, "model_response": {"error": null, "choices": [{"message": {"content": "a"}}]}}',
             '{"item": 2, "model_response": {"choices": [{"message": {"content": "b"}}], "usage": {"total_tokens": 4}}}',
             '{"item": 3, "model_response": {"error": "down"}}', '{"item": 4}', '{"item": 5, "model_response": null}', "[1]", "5", '{"item": 6, "mod',
             '{"item": 7, "model_response": {"choices": [], "usage": {"total_tokens": 2}}}']
    put(tmp_path / "results_final_test.json", "\n".join(lines))
    rows = rd.read_response_variants(spark, str(tmp_path / "results_final_test.json"), "item", "lines")
    stats = pr.response_stats_by_presence(rows).where("is_total").first()
    assert (stats["total_problems"], stats["failed_responses"], stats["null_errors"], stats["successful_responses"]) == (6, 2, 1, 4)
    assert (stats["average_tokens"], stats["total_tokens"]) == (3.0, 6)
    # The typed form takes the null for no error.
    typed = rd.read_response_file(spark, str(tmp_path / "results_final_test.json"), "item", "lines")
    assert rs.response_stats(typed).where("is_total").first()["failed_responses"] == 1
    texts = {r["problem_id"]: r["c"] for r in rows.select("problem_id", pr.content_by_presence(F.col("model_response")).alias("c")).collect()}
    assert texts == {1: "", 2: "b", 3: "", 4: "", 5: "", 7: ""}
    wr.write_table(rows, str(tmp_path / "stored"))
    again = spark.read.parquet(str(tmp_path / "stored"))
    assert tuple(pr.response_stats_by_presence(again).where("is_total").first()) == tuple(stats)
    assert rd.read_response_variants(spark, str(tmp_path / "none.json")).count() == 0


# --- repeats within a horizon ---


def delivery(spark, start, end):
    return spark.range(start, end).selectExpr(
        "id problem_id", "'01' run_id", "cast(id as double) timestamp",
        "named_struct('error', if(id % 10 = 0, 'down', null)) model_response",
    )


def test_repeats_within_the_horizon_are_counted_once(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("records", "stats", "checkpoint")]
    held = []
    for k in range(8):
        # Each delivery brings all of the one before again.
        wr.append_records(delivery(spark, max(0, 100 * (k - 1)), 100 * (k + 1)), paths[0])
        query = stream_progress(spark, *paths, horizon="220 seconds")
        query.awaitTermination()
        operators = query.lastProgress["stateOperators"]
        held.append(max(o["numRowsTotal"] for o in operators))
    got = read_progress(spark, paths[1]).first()
    assert (got["total_problems"], got["failed_responses"]) == (800, 80)
    # The state holds the ids of a horizon and two deliveries at most, not all 800.
    assert held[-1] <= 540 and held[-1] <= max(held[:6]) + 1


def test_records_without_timestamp_are_counted(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("records", "stats", "checkpoint")]
    rows = delivery(spark, 0, 10)
    wr.append_records(rows.withColumn("timestamp", F.when(F.col("problem_id") > 4, F.col("timestamp"))), paths[0])
    wr.append_records(rows.where("problem_id > 6"), paths[0])
    stream_progress(spark, *paths, horizon="1 hour").awaitTermination()
    assert read_progress(spark, paths[1]).first()["total_problems"] == 10
