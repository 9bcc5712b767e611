"""pass@k, classes, rates and the pivot."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywright.functions.metrics import difficulty, pass_at_k_col
from tallywright.operators import attempts as at
from tallywright.operators import filters as fl
from tallywright.operators import passk as pk
from tallywright.operators import pivot as pv
from tallywright.operators import rates as rt

ATTEMPT = "problem_id long, run_id string, passed boolean"

# n = 12: pass@1, pass@5, pass@10 and class for c = 0..8
GOLDEN = [
    (0.0, 0.0, 0.0, "Hard"),
    (0.0833333333, 0.4166666667, 0.8333333333, "Hard"),
    (0.1666666667, 0.6818181818, 0.9848484848, "Hard"),
    (0.2500000000, 0.8409090909, 1.0, "Hard"),
    (0.3333333333, 0.9292929293, 1.0, "Medium"),
    (0.4166666667, 0.9734848485, 1.0, "Medium"),
    (0.5, 0.9924242424, 1.0, "Medium"),
    (0.5833333333, 0.9987373737, 1.0, "Medium"),
    (0.6666666667, 1.0, 1.0, "Medium"),
]


def attempts(spark, counts):
    """Attempts with ``c`` passes in ``n`` for each problem."""
    rows = [
        (problem, f"{i:02d}", i < c) for problem, (n, c) in counts.items() for i in range(n)
    ]
    return spark.createDataFrame(rows, ATTEMPT)


def test_golden_values(spark):
    df = pk.with_difficulty(pk.pass_at_k(attempts(spark, {c: (12, c) for c in range(9)})))
    for row in df.collect():
        *values, name = GOLDEN[row["problem_id"]]
        got = [row["pass@1"], row["pass@5"], row["pass@10"]]
        assert all(math.isclose(g, v, abs_tol=1e-9) for g, v in zip(got, values))
        assert row["difficulty"] == name


def test_edges(spark):
    counts = {1: (12, 12), 2: (4, 0), 3: (4, 2), 4: (9, 0), 5: (10, 0), 6: (12, 9), 7: (8, 6), 8: (10, 3)}
    rows = {r["problem_id"]: r for r in pk.with_difficulty(pk.pass_at_k(attempts(spark, counts))).collect()}
    assert rows[1]["pass@1"] == rows[1]["pass@10"] == 1.0
    assert (rows[2]["pass@1"], rows[2]["pass@5"], rows[2]["pass@10"]) == (0.0, 1.0, 1.0)
    assert rows[4]["pass@10"] == 1.0 and rows[5]["pass@10"] == 0.0
    assert [rows[i]["difficulty"] for i in (6, 7, 8)] == ["Easy", "Easy", "Medium"]
    assert rows[8]["pass@1"] == 0.30000000000000004
    strict = {r["problem_id"]: r for r in pk.pass_at_k(attempts(spark, counts), strict=True).collect()}
    assert strict[2]["pass@5"] is None and strict[2]["pass@1"] == 0.0
    assert strict[5]["pass@10"] == 0.0 and strict[4]["pass@10"] is None


def test_missing_verdicts_are_not_counted(spark):
    df = spark.createDataFrame(
        [(1, "01", True), (1, "02", None), (1, "03", False), (2, "01", None)], ATTEMPT
    )
    rows = {r["problem_id"]: r for r in pk.pass_at_k(df, ks=[1]).collect()}
    assert (rows[1]["n"], rows[1]["c"], rows[1]["pass@1"]) == (2, 1, 0.5)
    assert rows[2]["n"] == 0 and rows[2]["pass@1"] is None


def test_very_many_attempts_need_no_long_arrays(spark):
    df = spark.createDataFrame([(10**12, 10**11), (5000, 1500)], "n long, c long")
    got = [r[0] for r in df.select(pass_at_k_col(F.col("n"), F.col("c"), 5)).collect()]
    assert math.isclose(got[0], 1 - 0.9**5, rel_tol=1e-9)
    wanted = 1 - math.comb(3500, 5) / math.comb(5000, 5)
    assert math.isclose(got[1], wanted, rel_tol=1e-12)


def test_pass_at_k_properties(spark):
    counts = {100 * n + c: (n, c) for n in range(1, 14) for c in range(n + 1)}
    for r in pk.pass_at_k(attempts(spark, counts), ks=[1, 2, 3, 5]).collect():
        n, c = r["n"], r["c"]
        values = [r["pass@1"], r["pass@2"], r["pass@3"], r["pass@5"]]
        assert math.isclose(values[0], c / n, abs_tol=1e-12)
        assert values == sorted(values)
        for k, v in zip((1, 2, 3, 5), values):
            if n >= k:
                assert math.isclose(v, 1 - math.comb(n - c, k) / math.comb(n, k), abs_tol=1e-12)


def test_difficulty(spark):
    cases = [(float("nan"), "Hard"), (None, "Hard"), (0.75, "Easy"), (0.7499, "Medium"), (0.30, "Medium"), (0.2999999999, "Hard")]
    df = spark.createDataFrame(cases, "x double, wanted string")
    assert df.where(difficulty(F.col("x")) != F.col("wanted")).count() == 0


def test_class_distribution_lists_all_classes(spark):
    df = pk.with_difficulty(pk.pass_at_k(attempts(spark, {1: (4, 4), 2: (4, 0), 3: (4, 0)})))
    got = {r["difficulty"]: (r["problems"], r["share"]) for r in pk.class_distribution(df).collect()}
    assert got == {"Easy": (1, 1 / 3), "Medium": (0, 0.0), "Hard": (2, 2 / 3)}
    assert [r["share"] for r in pk.class_distribution(df.limit(0)).collect()] == [0.0, 0.0, 0.0]


def test_attempt_types(spark):
    raw = spark.createDataFrame([("1", 1, None), ("2", 1, True)], "problem_id string, run_id int, passed boolean")
    assert [tuple(r) for r in at.to_attempts(raw).collect()] == [("1", 1, False), ("1", 2, True)]
    bad = raw.union(spark.createDataFrame([("test_1", 1, True)], raw.schema))
    with pytest.raises(PySparkException):
        at.to_attempts(bad).collect()
    checked = at.with_id_check(bad).where(F.col("problem_id").isNull()).collect()
    assert [r["raw_id"] for r in checked] == ["test_1"]


def test_first_attempt(spark):
    df = spark.createDataFrame(
        [(1, "01", False, 2), (1, "01", True, 1), (1, "02", False, 1), (2, "01", None, 1)],
        ATTEMPT + ", position int",
    )
    got = {(r["problem_id"], r["run_id"]): r["passed"] for r in at.first_attempts(df, ["position"]).collect()}
    assert got == {(1, "01"): True, (1, "02"): False, (2, "01"): None}
    assert [tuple(r) for r in at.duplicate_attempts(df).collect()] == [(1, "01", 2)]


def test_pivot(spark):
    df = spark.createDataFrame([(1, "01", True), (1, "02", False), (2, "01", False)], ATTEMPT)
    runs = ["01", "02", "03"]
    table = pv.pivot_runs(df, runs)
    assert table.columns == ["problem_id", "run_01_pass", "run_02_pass", "run_03_pass"]
    assert sorted(tuple(r) for r in table.collect()) == [(1, True, False, None), (2, False, None, None)]
    assert sorted(map(tuple, pv.unpivot_runs(table, runs).collect())) == sorted(
        (r["run_id"], r["problem_id"], r["passed"]) for r in df.collect()
    )
    assert pv.unpivot_runs(table, runs, keep_missing=True).count() == 6
    twice = df.union(spark.createDataFrame([(1, "01", False)], ATTEMPT))
    with pytest.raises(PySparkException, match="more than one attempt"):
        pv.pivot_runs(twice, runs).collect()
    first = pv.pivot_runs(twice.withColumn("position", F.col("passed").cast("int")), runs, "first", ["position"])
    assert first.where("problem_id = 1").first()["run_01_pass"] is False


def test_two_pass_rates(spark):
    df = spark.createDataFrame([(1, "01", True), (2, "01", False), (1, "02", True)], ATTEMPT)
    by_run = {r["run_id"]: r["pass_rate"] for r in rt.rate_by(df, "run_id").collect()}
    coverage = {r["run_id"]: r["coverage_rate"] for r in rt.run_coverage_rate(df).collect()}
    assert by_run == {"01": 0.5, "02": 1.0} and coverage == {"01": 0.5, "02": 0.5}
    total = rt.overall_rate(df).first()
    assert (total["attempts"], total["passes"], total["failures"]) == (3, 2, 1)
    empty = rt.overall_rate(df.limit(0)).first()
    assert (empty["attempts"], empty["pass_rate"]) == (0, 0.0)


def test_top_lists_break_ties_by_id(spark):
    df = attempts(spark, {i: (4, i % 3) for i in range(30, 0, -1)})
    best = [r["problem_id"] for r in rt.top_by_rate(df).collect()]
    worst = [r["problem_id"] for r in rt.top_by_rate(df, worst=True).collect()]
    assert best == [i for i in range(1, 31) if i % 3 == 2]
    assert worst == [i for i in range(1, 31) if i % 3 == 0]
    assert [r["problem_id"] for r in rt.top_by_count(df, 3).collect()] == [1, 2, 3]


def test_id_filters(spark):
    df = spark.range(3000).withColumnRenamed("id", "problem_id")
    assert fl.with_id(df, "602").count() == 1
    with pytest.raises(ValueError):
        fl.with_id(df, "test_1")
    assert fl.ids_above(df, 2990).count() == 9
    assert fl.ids_in(df, [1, 2, 5000]).count() == 2
    assert fl.ids_in(df, list(range(2000))).count() == 2000
    assert fl.ids_in(df, spark.range(10)).count() == 10


def test_preview(spark):
    df = spark.createDataFrame([(2, "x" * 101), (1, "y" * 100)], "id long, text string")
    got = [tuple(r) for r in fl.preview(df, 2, 100, ["id"]).collect()]
    assert got == [(1, "y" * 100), (2, "x" * 100 + "...")]
    assert fl.preview(df, 1, 5, ["id"], always=True).first()["text"] == "yyyyy..."


def test_latest_run(spark):
    df = spark.createDataFrame([("results_20250101", 1), ("results_20250203", 2)], "run_ts string, x int")
    assert [r["x"] for r in fl.latest_run(df).collect()] == [2]
