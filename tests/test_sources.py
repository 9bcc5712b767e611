"""Readers and writers on files as they come, streaming, and the script runner."""

import json
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywright import fixed_values as fv
from tallywright.operators import evaluation as ev
from tallywright.operators import responses as rs
from tallywright.operators.attempts import with_id_check
from tallywright.operators import scripts as sc
from tallywright.sources import readers as rd
from tallywright.sources import writers as wr
from tallywright.sources.scratch import scratch_path
from tallywright.streaming.progress import read_progress, stream_progress


def put(path, value, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = value if isinstance(value, str) else json.dumps(value, indent=2, ensure_ascii=False)
    path.write_bytes(text.encode(encoding))


def record(item, content="x = 1", **extra):
    return {
        "item": item,
        "problem": {"task_id": item, "text": "t", "code": "c", "test_list": ["assert 1"]},
        "prompt": "p",
        "model_response": {"choices": [{"message": {"content": content}}], "usage": {"total_tokens": 5}},
        "timestamp": 1.5,
        **extra,
    }


def verdict(item, passed=True, **extra):
    return {"item": item, "problem_statement": "é", "passed": passed, "error": None,
            "test_outputs": ["Test 1: PASS"], "generated_code": "x", "test_cases": ["assert 1"], **extra}


def test_read_responses(spark, tmp_path):
    put(tmp_path / "results_final_test.json", [record(11), record(12)])
    put(tmp_path / "results_final_train.json", [record(601), {"model_response": {"error": "down"}}])
    put(tmp_path / "other.json", [record(1)])
    rows = rd.read_responses(spark, str(tmp_path), id_field="item")
    got = sorted((r["split"], r["problem_id"]) for r in rows.where("problem_id is not null").collect())
    assert got == [("test", 11), ("test", 12), ("train", 601)]
    assert rows.where(F.col("model_response.error") == "down").count() == 1
    assert rd.read_responses(spark, str(tmp_path), "train", "item").count() == 2
    assert rd.read_responses(spark, str(tmp_path), "validation", "item").count() == 0
    one = rd.read_response_file(spark, str(tmp_path / "results_final_test.json"), "item")
    assert one.count() == 2
    assert rd.read_response_file(spark, str(tmp_path / "none.json"), "item").count() == 0


def test_read_runs(spark, tmp_path):
    base = tmp_path / "model runs+"
    put(base / "01" / fv.EVALUATIONS_NAME, [verdict(1), {"item": 2}, verdict(3, "odd"), 5, "x", None, []])
    put(base / "02" / fv.EVALUATIONS_NAME, [verdict(1, False)])
    put(base / "broken" / fv.EVALUATIONS_NAME, '[{"item": 1, "passed": tr')
    put(base / "03" / "notes.json", "{}")
    rows = rd.read_attempts(spark, str(base), id_field="item").collect()
    assert sorted((r["run_id"], r["problem_id"], r["passed"]) for r in rows if r["passed"] is not None) == [
        ("01", 1, True), ("02", 1, False),
    ]
    assert len(rows) == 4
    assert rd.read_evaluations(spark, str(base), ["02", "07"], "item").count() == 1
    assert rd.read_evaluations(spark, str(base), ["07"], "item").count() == 0


def test_any_encoding(spark, tmp_path):
    put(tmp_path / "01" / fv.EVALUATIONS_NAME, [verdict(1), verdict(2)])
    put(tmp_path / "02" / fv.EVALUATIONS_NAME, [verdict(3)], "latin-1")
    put(tmp_path / "03" / fv.EVALUATIONS_NAME, "not json")
    rows = rd.read_evaluations(spark, str(tmp_path), id_field="item").collect()
    # Places grow along a file; they are no row numbers.
    rows.sort(key=lambda r: (r["run_id"], r["position"]))
    assert [(r["run_id"], r["problem_id"], r["problem_statement"]) for r in rows] == [
        ("01", 1, "é"), ("01", 2, "é"), ("02", 3, "é"),
    ]
    assert rows[0]["position"] < rows[1]["position"]


def test_ids_that_are_text(spark, tmp_path):
    put(tmp_path / "01" / fv.EVALUATIONS_NAME, [verdict(1), verdict("test_1")])
    with pytest.raises(PySparkException):
        rd.read_attempts(spark, str(tmp_path), id_field="item").collect()
    texts = rd.read_attempts(spark, str(tmp_path), id_field="item", numeric_ids=False)
    assert sorted(r["problem_id"] for r in texts.collect()) == ["1", "test_1"]
    checked = with_id_check(texts).where("problem_id is null").collect()
    assert [r["raw_id"] for r in checked] == ["test_1"]


def test_malformed_lines(spark, tmp_path):
    put(tmp_path / "a.json", json.dumps(record(1)) + '\n"text"\n[1, 2\n\n{"item": 3, "prom\n' + json.dumps(record(2)))
    rows = rd.read_response_file(spark, str(tmp_path / "a.json"), "item", "lines")
    assert sorted(r["problem_id"] for r in rows.collect()) == [1, 2]


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_response_files_round_trip(spark, tmp_path, layout):
    put(tmp_path / "in" / "results_final_test.json", [record(i, f'say "é"\n{i}') for i in range(50)])
    rows = rd.read_responses(spark, str(tmp_path / "in"), id_field="item").drop("position")
    out = str(tmp_path / "out" / "results_final_test.json")
    spread = rows.drop("split").repartition(4)
    if layout == "array":
        wr.write_json_arrays(spread, out, "item")
    else:
        wr.write_table(spread, out, "json", id_field="item")
    again = rd.read_responses(spark, str(tmp_path / "out"), id_field="item", layout=layout).drop("position")
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))
    if layout == "array":
        files = list((tmp_path / "out").glob("*/part-*"))
        assert sum(len(json.loads(f.read_text())) for f in files) == 50


def test_array_file_of_nothing(spark, tmp_path):
    wr.write_json_arrays(spark.createDataFrame([], "problem_id long"), str(tmp_path / "01" / fv.EVALUATIONS_NAME))
    assert rd.read_attempts(spark, str(tmp_path)).count() == 0


def test_csv_keeps_missing_verdicts(spark, tmp_path):
    df = spark.createDataFrame([(1, True, None), (2, False, True)], "problem_id long, run_01_pass boolean, run_02_pass boolean")
    wr.write_table(df, str(tmp_path / "p"), "csv", id_field="item")
    header = next((tmp_path / "p").glob("part-*")).read_text().splitlines()[0]
    assert header == "item,run_01_pass,run_02_pass"
    again = rd.read_pivot(spark, str(tmp_path / "p"), ["01", "02"], "item")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))


def test_csv_of_other_writers(spark, tmp_path):
    put(tmp_path / "pivot.csv", "item,run_01_pass,run_02_pass\n601,True,\n602,False,True\n")
    rows = rd.read_pivot(spark, str(tmp_path / "pivot.csv"), ["01", "02"], "item").collect()
    assert sorted(map(tuple, rows)) == [(601, True, None), (602, False, True)]
    put(tmp_path / "rates.csv", "item,pass@1,pass@5,pass@10\n601,0.08333333333333337,0.41666666666666663,1.0\n")
    assert tuple(rd.read_pass_at_k(spark, str(tmp_path / "rates.csv"), id_field="item").first()) == (
        601, 0.08333333333333337, 0.41666666666666663, 1.0,
    )


def test_train_rows_jsonl_with_escapes(spark, tmp_path):
    put(tmp_path / "t.jsonl", json.dumps({"instruction": "é\n1", "output": 'x = "y"'}) + "\n")
    assert [tuple(r) for r in rd.read_train_rows(spark, str(tmp_path / "t.jsonl")).collect()] == [("é\n1", 'x = "y"')]


def test_problems_fall_back_to_a_split_there_is(spark, tmp_path):
    rows = [(1, "test"), (2, "validation"), (3, "validation")]
    df = spark.createDataFrame(rows, "task_id long, split string").selectExpr(
        "task_id", "'t' text", "'c' code", "array('a') test_list", "'' test_setup_code",
        "cast(array() as array<string>) challenge_test_list", "split",
    )
    wr.write_table(df, str(tmp_path / "p"), "parquet", ["split"])
    ids = {s: sorted(r["task_id"] for r in rd.read_problems(spark, str(tmp_path / "p"), s).collect())
           for s in ("validation", "test", "train")}
    assert ids == {"validation": [2, 3], "test": [1], "train": [1]}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"{i % 3:02d}", None if i % 5 else "down", i) for i in range(60)]
    df = spark.createDataFrame(rows, "problem_id long, run_id string, e string, t long").select(
        "problem_id", "run_id",
        F.struct(F.col("e").alias("error"), F.struct(F.col("t").alias("total_tokens")).alias("usage")).alias("model_response"),
    )
    paths = [str(tmp_path / p) for p in ("records", "stats", "checkpoint")]
    wr.append_records(df.where("problem_id < 30"), paths[0])
    stream_progress(spark, *paths, max_files=2).awaitTermination()
    first = {r["run_id"]: r["total_problems"] for r in read_progress(spark, paths[1]).collect()}
    assert first == {"00": 10, "01": 10, "02": 10}
    wr.append_records(df.where("problem_id >= 30"), paths[0])
    stream_progress(spark, *paths).awaitTermination()
    batch = rs.response_stats(df, ["run_id"], total=False).drop("is_total")
    assert sorted(map(tuple, read_progress(spark, paths[1]).select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_stream_drops_repeats_when_asked(spark, tmp_path):
    df = spark.createDataFrame([(1, "01"), (2, "01")], "problem_id long, run_id string")
    paths = [str(tmp_path / p) for p in ("records", "stats", "checkpoint")]
    for _ in range(2):
        wr.append_records(df, paths[0])
    stream_progress(spark, *paths, once_per_record=True).awaitTermination()
    assert read_progress(spark, paths[1]).first()["total_problems"] == 2


def test_response_stats(spark):
    rows = [("test", None, 10), ("test", "down", None), ("train", None, None)]
    df = spark.createDataFrame(rows, "split string, e string, t long").select(
        "split", F.struct(F.col("e").alias("error"), F.struct(F.col("t").alias("total_tokens")).alias("usage")).alias("model_response")
    )
    got = {r["split"]: tuple(r)[1:] for r in rs.response_stats(df).collect()}
    assert got["test"] == (False, 2, 1, 1, 0.5, 10.0, 10)
    assert got["train"] == (False, 1, 1, 0, 1.0, 0.0, 0)
    assert got[None] == (True, 3, 2, 1, 2 / 3, 10.0, 10)
    assert tuple(rs.response_stats(df.limit(0), by=[]).first()) == (True, 0, 0, 0, 0.0, 0.0, 0)


def test_run_metadata(spark):
    problems = spark.range(90).select(F.lit("validation").alias("split"))
    runs = spark.createDataFrame(
        [(1, "validation", False, None), (2, "validation", False, 0), (3, "validation", False, 20),
         (4, "validation", False, 200), (5, "validation", True, 20), (6, "none", False, 5)],
        "run int, split string, demo_mode boolean, max_problems long",
    )
    got = {r["run"]: (r["total_problems_loaded"], r["problems_to_process"]) for r in rs.run_metadata(runs, problems).collect()}
    assert got == {1: (90, 90), 2: (90, 90), 3: (90, 20), 4: (90, 90), 5: (90, 4), 6: (0, 0)}


def test_metadata_records(spark, tmp_path):
    runs = spark.createDataFrame(
        [("20250101", "test", True, 7, "m", "results_20250101")],
        "timestamp string, split string, demo_mode boolean, max_problems long, model_path string, results_directory string",
    )
    table = rs.run_metadata(runs, spark.range(9).select(F.lit("test").alias("split")))
    wr.write_table(rs.metadata_records(table).coalesce(1), str(tmp_path / "m"), "json")
    stored = json.loads(next((tmp_path / "m").glob("part-*")).read_text())
    assert stored == {
        "timestamp": "20250101", "results_directory": "results_20250101",
        "run_config": {"split": "test", "demo_mode": True, "max_problems": 7, "model_path": "m"},
        "dataset_info": {"total_problems_loaded": 9, "problems_to_process": 4},
    }


def test_head_problems(spark):
    df = spark.range(10).withColumnRenamed("id", "task_id").orderBy(F.desc("task_id"))
    assert [r["task_id"] for r in rs.head_problems(df, 3).collect()] == [0, 1, 2]
    assert rs.head_problems(df, 0).count() == rs.head_problems(df).count() == 10
    assert rs.head_problems(df, 9, demo=True).count() == 4


def test_records_without_task_id(spark):
    prompts = spark.createDataFrame([(0, 5, "a"), (1, None, "b"), (2, 6, "c")], "position int, task_id long, prompt string")
    replies = spark.createDataFrame([(0, 1.0), (1, 2.0)], "position int, timestamp double").withColumn("model_response", F.lit("r"))
    got = sorted((r["problem_id"], r["prompt"], r["problem"]["task_id"]) for r in rs.assemble_responses(prompts, replies).collect())
    assert got == [("5", "a", 5), ("unknown_1", "b", None)]


def test_ledger(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, True), (4, True)], "run_number int, success boolean")
    assert tuple(rs.ledger_summary(df).first()) == (4, 3, 1, 0.75)


def test_run_scripts(spark):
    scripts = {
        1: "print('Test 1: PASS - All Clear')",
        2: "raise NameError('gone')",
        3: "import time; time.sleep(30)",
        4: "def broken(:",
        5: "assert True",
        6: "print('Test 1: FAIL - é')",
    }
    df = spark.createDataFrame(list(scripts.items()), "problem_id long, script string")
    ran = sc.run_scripts(df, sc.python_runner(), ["problem_id"], seconds=4, partitions=6)
    rows = {r["problem_id"]: r for r in ev.with_verdict(ran.join(df, "problem_id")).collect()}
    assert {k: r["passed"] for k, r in rows.items()} == {1: True, 2: False, 3: False, 4: False, 5: True, 6: False}
    assert rows[3]["timed_out"] and rows[3]["test_outputs"] == ["TIMEOUT"]
    assert rows[2]["test_outputs"] == ["Test 1: FAIL - NameError: gone"]
    assert rows[5]["test_outputs"] == ["Test 1: PASS - All assertions passed silently"]


def test_a_runner_starts_one_interpreter_and_scripts_do_not_meet():
    run = sc.python_runner(("-I", "-S"))
    parent = "import os; print(os.getppid())"
    assert run(parent, 5) == run(parent, 5)
    assert run("import builtins; builtins.left = x = 1", 5) == (0, "", "")
    code, out, err = run("print('é')\nprint(left)", 5)
    assert (code, out) == (1, "é\n") and err.startswith("Traceback") and err.count("File") == 1 and err.endswith("'left' is not defined\n")
    assert run("def f(:", 5)[2].endswith("SyntaxError: invalid syntax\n")
    assert run("import atexit; atexit.register(print, 2); print(1); raise SystemExit(3)", 5) == (3, "1\n2\n", "")
    assert run("print(input())", 5)[2].endswith("EOFError: EOF when reading a line\n")
    assert run("import os; os.kill(os.getpid(), 9)", 5)[0] == -9
    assert run("print('x' * 300_000)", 5)[1] == "x" * 300_000 + "\n"
    with pytest.raises(TimeoutError):
        run("while True: pass", 0.3)
    with pytest.raises(OSError):
        run("import os; os.kill(os.getppid(), 9); os.wait()", 5)
    assert run("print(2)", 5) == run(None, 5)[:1] + ("2\n", "")


def test_what_shows_an_error_is_loaded_before_scripts_run():
    run = sc.python_runner(("-I", "-S"))
    assert run("import sys; print('traceback' in sys.modules)", 5)[1] == "True\n"
    kept = "import linecache, sys; print(linecache.cache, sys.stdout.fileno(), sys.stderr.fileno())"
    assert run(kept, 5)[1] == "{} 1 2\n"
    # Shown as by an interpreter that is started for the script.
    for text in ("def f(x):\n    return x + y\nf(1)", "def f(:", "raise ValueError('a\\nb')", "1 / 0"):
        alone = subprocess.run([sys.executable, "-I", "-S", "-"], input=text, capture_output=True, text=True)
        assert run(text, 5) == (alone.returncode, alone.stdout, alone.stderr)


def test_runner_that_fails(spark):
    def runner(script, seconds):
        raise OSError("no interpreter")

    df = spark.createDataFrame([(1, "x")], "problem_id long, script string")
    ran = sc.run_scripts(df, runner, ["problem_id"], partitions=1)
    row = ev.with_verdict(ran.join(df, "problem_id")).first()
    assert (row["passed"], row["test_outputs"]) == (False, ["ERROR: no interpreter"])


def test_scratch_path_is_new_each_time(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
