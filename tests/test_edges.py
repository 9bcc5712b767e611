"""Rows the given tables do not have: missing verdicts and ids, repeats, unlisted names, bad lines."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywright import fixed_values as fv
from tallywright.functions.metrics import difficulty, pass_at_k_col
from tallywright.operators import evaluation as ev
from tallywright.operators import filters as fl
from tallywright.operators import pivot as pv
from tallywright.operators import responses as rs
from tallywright.operators import sampling as sm
from tallywright.operators import scripts as sc
from tallywright.operators import trainset as tr
from tallywright.sources import readers as rd
from tallywright.sources import writers as wr
from tallywright.streaming.progress import read_progress, stream_progress

HALF = {"half": {"Hard": 0.5}}


def test_class_at_a_boundary_does_not_depend_on_size(spark):
    df = spark.createDataFrame([(4, 3), (1336, 1002), (13360, 10020)], "n long, c long")
    classes = df.select(difficulty(pass_at_k_col(F.col("n"), F.col("c"), 1)).alias("k")).collect()
    assert {r["k"] for r in classes} == {"Easy"}


def test_every_split_counts(spark):
    runs = spark.createDataFrame([("dev", False, None)], "split string, demo_mode boolean, max_problems long")
    row = rs.run_metadata(runs, spark.range(5).select(F.lit("dev").alias("split"))).first()
    assert (row["total_problems_loaded"], row["problems_to_process"]) == (5, 5)


@pytest.mark.parametrize("count", [10, 1001])
def test_listed_text_ids(spark, count):
    df = spark.range(2000).select(F.concat(F.lit("t"), "id").alias("problem_id"))
    ids = [f"t{k}" for k in range(count)]
    assert fl.ids_in(df, ids).count() == count
    assert fl.ids_in(df, spark.createDataFrame([(i,) for i in ids], "i string")).count() == count


def test_samples_count_missing_and_repeated_ids(spark):
    hard = F.lit("Hard").alias("difficulty")
    missing = spark.range(100).select(F.when(F.col("id") >= 10, F.col("id")).alias("problem_id"), "id", hard)
    assert sm.stratified_mix(missing, HALF, ties=["id"]).count() == 50
    repeated = spark.range(100).select((F.col("id") % 10).alias("problem_id"), "id", hard)
    shares = {"some": {"Hard": 0.55}}
    assert sm.stratified_mix(repeated, shares, ties=["id"]).count() == 55
    with pytest.raises(PySparkException, match="name columns in ties"):
        sm.stratified_mix(repeated.drop("id"), shares).collect()
    assert sm.stratified_mix(repeated.drop("id"), HALF).count() == 50


def test_pivot_of_the_runs_there_are(spark):
    df = spark.createDataFrame([("b", 1, True), ("a", 1, False), ("a", 2, True)], "run_id string, problem_id long, passed boolean")
    table = pv.pivot_runs(df)
    assert table.columns == ["problem_id", "run_a_pass", "run_b_pass"]
    assert sorted(map(tuple, table.collect())) == [(1, False, True), (2, True, None)]
    with pytest.raises(PySparkException, match="not listed"):
        pv.pivot_runs(df, ["a"]).collect()


def test_missing_verdicts_have_not_passed(spark):
    df = spark.createDataFrame(
        [(k, None, None, ["Test 1: FAIL"]) for k in range(4)],
        "problem_id long, passed boolean, error string, test_outputs array<string>",
    )
    row = ev.evaluation_stats(df).first()
    assert (row["total_problems"], row["passed"], row["failed"], row["test_failures"]) == (4, 0, 4, 4)
    assert ev.ids_where(df, False).count() == 4 and ev.ids_where(df, True).count() == 0
    assert ev.failed_preview(df).count() == 3


def test_overall_row_of_nothing(spark):
    none = spark.createDataFrame([], "split string, passed boolean, error string")
    assert [tuple(r) for r in ev.evaluation_stats(none, ["split"]).collect()] == [(None, True, 0, 0, 0, 0.0, 0, 0)]


def test_a_second_recorded_run_raises(spark):
    responses = spark.createDataFrame(
        [(1, "a")], "problem_id long, run_id string"
    ).selectExpr(
        "*", "named_struct('text', 't', 'test_list', array('assert 1')) problem",
        "named_struct('error', cast(null as string), 'choices', array(named_struct('message', named_struct('content', 'def f(): pass')))) model_response",
    )
    runs = spark.createDataFrame(
        [(1, "a", 0, "", "", False, None)] * 2,
        "problem_id long, run_id string, returncode int, stdout string, stderr string, timed_out boolean, runner_error string",
    )
    assert ev.evaluate(responses, runs.limit(1)).count() == 1
    with pytest.raises(PySparkException, match="more than one recorded run of 1, a"):
        ev.evaluate(responses, runs).collect()


def evaluations(spark):
    rows = [(k % 3, k, k % 2 == 0) for k in range(12)]
    return spark.createDataFrame(rows, "problem_id long, position long, passed boolean").selectExpr(
        "problem_id", "'s' problem_statement", "passed", "cast(null as string) error",
        "array('Test 1: PASS') test_outputs", "concat('x = ', position) generated_code",
        "array('assert 1') test_cases", "position",
    )


@pytest.mark.parametrize("stored_position", [True, False])
def test_training_rows_of_lines(spark, tmp_path, stored_position):
    rows = evaluations(spark)
    samples = spark.createDataFrame([("d", 0), ("d", 1), ("e", 1)], "dataset string, problem_id long")
    plain = rows if stored_position else rows.drop("position")
    wr.write_table(plain.repartition(3), str(tmp_path / "l" / "01" / fv.EVALUATIONS_NAME), "json")
    wr.write_json_arrays(rows.drop("position").coalesce(1), str(tmp_path / "a" / "01" / fv.EVALUATIONS_NAME))
    lines = tr.train_rows(samples, rd.read_evaluations(spark, str(tmp_path / "l"), layout="lines"))
    arrays = tr.train_rows(samples, rd.read_evaluations(spark, str(tmp_path / "a")))
    keys = [sorted((r["dataset"], r["problem_id"]) for r in t.collect()) for t in (lines, arrays)]
    assert keys[0] == keys[1] == [("d", 0), ("d", 1), ("e", 1)]
    if stored_position:
        assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, arrays.collect()))


def test_large_arrays_are_cut_at_records(spark, tmp_path):
    records = [{"problem_id": k, "passed": k % 2 == 0, "more": [{"a": "x\n  {"}, {}]} for k in range(500)]
    path = tmp_path / "01" / fv.EVALUATIONS_NAME
    path.parent.mkdir(parents=True)
    path.write_text(json.dumps(records, indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = rd.read_attempts(spark, str(tmp_path))
        assert "binaryFile" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.rdd.getNumPartitions() > 3
        assert sorted((r["problem_id"], r["passed"]) for r in rows.collect()) == [(k, k % 2 == 0) for k in range(500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    path.write_text(json.dumps(records))
    assert rd.read_attempts(spark, str(tmp_path)).count() == 500
    path.write_text(json.dumps(records, indent=4))
    assert rd.read_attempts(spark, str(tmp_path)).count() == 500
    path.write_text("[]")
    assert rd.read_attempts(spark, str(tmp_path)).count() == 0


def test_array_files_are_never_cut(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        wr.write_json_arrays(spark.range(6).withColumnRenamed("id", "problem_id"), str(tmp_path / "01" / fv.EVALUATIONS_NAME))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert rd.read_attempts(spark, str(tmp_path)).count() == 6


def test_only_the_exact_name_is_read(spark, tmp_path):
    for name in ("results_final_test.json", "old_results_final_test.json"):
        (tmp_path / name).write_text(json.dumps([{"problem_id": 1}], indent=2))
    assert rd.read_responses(spark, str(tmp_path)).count() == 1
    assert rd.read_responses(spark, str(tmp_path), prefix="old_").count() == 1


@pytest.mark.parametrize("there, chosen", [(["train", "zeta", "alpha"], "train"), (["zeta", "alpha"], "alpha")])
def test_unlisted_splits_come_last(spark, tmp_path, there, chosen):
    df = spark.createDataFrame([(k, s) for k, s in enumerate(there)], "task_id long, split string")
    wr.write_table(df, str(tmp_path / "p"), "parquet", ["split"])
    assert {r["split"] for r in rd.read_problems(spark, str(tmp_path / "p"), "none").collect()} == {chosen}


def test_stream_leaves_bad_lines_out_and_starts_anew(spark, tmp_path):
    assert read_progress(spark, str(tmp_path / "none")).count() == 0
    records = tmp_path / "records" / "run_id=01"
    records.mkdir(parents=True)
    good = json.dumps({"problem_id": 1, "model_response": {"usage": {"total_tokens": 3}}})
    (records / "a.json").write_text(f'{good}\n{good[:20]}\n"text"\n')
    for checkpoint in ("c1", "c2"):  # a new checkpoint counts from the start, and its numbers win
        paths = [str(tmp_path / p) for p in ("records", "stats", checkpoint)]
        stream_progress(spark, *paths).awaitTermination()
        row = read_progress(spark, paths[1]).first()
        assert (row["total_problems"], row["successful_responses"], row["total_tokens"]) == ((1, 1, 3) if checkpoint == "c1" else (2, 2, 6))
        (records / "b.json").write_text(good + "\n")


def test_scripts_of_one_problem_reach_all_tasks(spark):
    df = spark.range(40).select(F.lit(7).cast("long").alias("problem_id"), F.concat(F.lit("x = "), "id").alias("script"))
    ran = sc.run_scripts(df, lambda script, seconds: (0, "", ""), ["problem_id"], partitions=4)
    assert ran.select(F.spark_partition_id().alias("p")).distinct().count() == 4
