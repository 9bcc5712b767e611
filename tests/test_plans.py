"""What the physical plans must and must not contain."""

import re

import pytest
from tallywright.operators import filters as fl
from tallywright.operators import passk as pk
from tallywright.operators import pivot as pv
from tallywright.operators import rates as rt
from tallywright.operators import sampling as sm
from tallywright.operators import trainset as tr
from tallywright.plans import catalog, views
from tallywright.sources import readers as rd
from tallywright.sources import writers as wr

# These store files or start streams when they are built.
STORING = {
    "pass_at_k_from_pivot_csv", "sample_csv", "train_rows_jsonl", "stored_problems",
    "stored_problems_other_split", "stored_responses", "stored_responses_one_file",
    "stored_run_attempts", "stored_run_evaluations", "stored_lines_well_formed", "streamed_progress",
    "streamed_progress_of_cut_lines", "stored_array_attempts", "pass_at_k_csv",
    "best_attempt_by_file_order", "reference_code_by_file_order", "rejected_records", "kept_records", "skipped_runs",
    "quarantined_attempts", "distinct_problems_from_sketches", "run_coverage_from_sketches",
    "response_stats_by_key_presence", "contents_by_key_presence", "streamed_progress_with_repeats", "missing_response_splits",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - STORING))
def test_no_products_and_no_python(spark, sf_dir, name):
    text = plan(catalog.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name != "script_execution":
        for node in ("BatchEvalPython", "ArrowEvalPython", "InPandas", "InArrow"):
            assert node not in text


def test_pass_at_k_shuffles_counts_once(spark):
    df = spark.range(100).selectExpr("id % 7 problem_id", "'01' run_id", "id % 2 = 0 passed")
    text = plan(pk.pass_at_k(df))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_pivot_shuffles_once(spark):
    df = spark.range(100).selectExpr("id % 7 problem_id", "'01' run_id", "true passed")
    text = plan(pv.pivot_runs(df, ["01", "02"]))
    assert text.count("Exchange") == 1 and "SortAggregate" not in text


def test_best_attempt_moves_no_texts(spark, tmp_path):
    path = str(tmp_path / "e")
    df = spark.range(10).selectExpr(
        "id problem_id", "'01' run_id", "1 position", "'t' problem_statement", "true passed",
        "array('Test') test_outputs", "'c' generated_code", "array('a') test_cases",
    )
    wr.write_table(df, path)
    text = plan(tr.best_attempt(spark.read.parquet(path)))
    columns = re.search(r"ReadSchema: struct<([^\n]*)>", text).group(1)
    assert "generated_code" not in columns and "test_cases" not in columns
    assert "partial_min" in text and text.count("Exchange") == 1


def test_top_lists_are_not_sorted_globally(spark):
    df = spark.range(100).selectExpr("id problem_id", "'01' run_id", "true passed")
    for top in (rt.top_by_count(df), rt.top_by_rate(df), rt.top_by_rate(df, worst=True)):
        assert "TakeOrderedAndProject" in plan(top)


def test_id_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "a")
    wr.write_table(spark.range(10).selectExpr("id problem_id", "true passed"), path)
    df = spark.read.parquet(path)
    assert "EqualTo(problem_id,3)" in plan(fl.with_id(df, "3"))
    assert "GreaterThan(problem_id,600)" in plan(fl.ids_above(df, 600))
    assert "In(problem_id, [1,2])" in plan(fl.ids_in(df, [1, 2]))


def test_split_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "test"), (2, "prompt")], "task_id long, split string")
    wr.write_table(df, path, partition_by=["split"])
    text = plan(fl.splits_for_run(spark.read.parquet(path)))
    assert re.search(r"PartitionFilters: \[[^\]]*split", text)


def test_samples_share_one_scan(spark, sf_dir):
    sample = sm.stratified_mix(pk.with_difficulty(pk.pass_at_k(views.attempts(spark, sf_dir))))
    sample.collect()
    final = plan(sample).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") >= 2


def test_attempt_reader_parses_two_fields(spark, tmp_path):
    path = tmp_path / "01" / "evaluations" / "evaluation_results_all.json"
    table = spark.range(3).selectExpr("id problem_id", "true passed", "'c' generated_code")
    wr.write_table(table, str(path), "json")
    text = plan(rd.read_attempts(spark, str(tmp_path), layout="lines"))
    assert "passed" in text and "generated_code" not in text


def test_response_stats_add_totals_up_from_groups(spark, sf_dir):
    df = catalog.queries()["response_stats_by_split"](spark, sf_dir)
    df.collect()
    assert "ReusedExchange" in plan(df)


@pytest.mark.parametrize("name, steps", [("passed_ids", 1), ("failed_preview", 2)])
def test_lines_are_taken_apart_once_a_step(spark, sf_dir, name, steps):
    # The preview looks at them in its filter and, for three rows, in what it shows.
    assert plan(catalog.queries()[name](spark, sf_dir)).count("(?md)^Test") == steps


@pytest.mark.parametrize("name", ["train_rows", "train_rows_own_code"])
def test_training_texts_are_not_shuffled_before_the_join(spark, sf_dir, name):
    text = plan(catalog.queries()[name](spark, sf_dir))
    assert any("BroadcastHashJoin" in line and "_run_id" in line for line in text.splitlines())


def test_scripts_that_ran_are_joined_without_a_broadcast(spark, sf_dir):
    # The table is small, but each row of it becomes a script of some hundred bytes.
    text = plan(catalog.queries()["script_execution"](spark, sf_dir))
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
