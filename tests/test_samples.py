"""Stratified samples, their summary, best attempts and training rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tallywright import fixed_values as fv
from tallywright.operators import sampling as sm
from tallywright.operators import trainset as tr

# N, rows per class, and the size each mix must have
SIZES = [
    ((133, 80, 161), {"Easy-heavy": (133, 74, 37), "Hard-heavy": (37, 74, 161), "Medium-heavy": (37, 80, 74), "Balanced": (123, 80, 127)}),
    ((6, 42, 149), {"Easy-heavy": (6, 39, 19), "Hard-heavy": (6, 39, 137), "Medium-heavy": (6, 42, 39), "Balanced": (6, 42, 66)}),
    ((0, 13, 127), {"Easy-heavy": (0, 13, 14), "Hard-heavy": (0, 13, 98), "Medium-heavy": (0, 13, 28), "Balanced": (0, 13, 47)}),
]


def classified(spark, easy, medium, hard):
    classes = ["Easy"] * easy + ["Medium"] * medium + ["Hard"] * hard
    rows = [(601 + i, i / 1000, i / 900, i / 800, c) for i, c in enumerate(classes)]
    return spark.createDataFrame(
        rows, "problem_id long, `pass@1` double, `pass@5` double, `pass@10` double, difficulty string"
    )


def ids_by_mix(sample):
    found = {}
    for r in sample.collect():
        found.setdefault(r["dataset"], []).append(r["problem_id"])
    assert all(len(v) == len(set(v)) for v in found.values())
    return {k: set(v) for k, v in found.items()}


@pytest.mark.parametrize("available, sizes", SIZES)
def test_published_sizes(spark, available, sizes):
    sample = sm.stratified_mix(classified(spark, *available))
    got = {
        r["Dataset"]: (r["Easy_Count"], r["Medium_Count"], r["Hard_Count"])
        for r in sm.mix_summary(sample).collect()
    }
    assert got == sizes


def test_sample_is_the_smallest_keys_of_each_class(spark):
    df = classified(spark, 133, 80, 161)
    got = ids_by_mix(sm.stratified_mix(df))
    rows = df.collect()

    def key(i):
        return hashlib.md5(f"{i}:42".encode()).hexdigest()

    for mix, shares in fv.MIXES.items():
        wanted = set()
        for name, share in shares.items():
            ids = sorted((r["problem_id"] for r in rows if r["difficulty"] == name), key=key)
            wanted |= set(ids[: int(len(rows) * share)])
        assert got[mix] == wanted


def test_sample_does_not_depend_on_partitions_and_nests(spark):
    df = classified(spark, 0, 13, 127)
    one, other = (ids_by_mix(sm.stratified_mix(df.repartition(n))) for n in (1, 7))
    assert one == other
    assert one["Easy-heavy"] <= one["Medium-heavy"] <= one["Balanced"]
    assert ids_by_mix(sm.stratified_mix(df, seed=7)) != one


def test_many_rows_share_a_prefix(spark, monkeypatch):
    """With one prefix for all rows the cut is found by ranking alone; with many, never."""
    df = classified(spark, 300, 300, 300)
    usual = ids_by_mix(sm.stratified_mix(df))
    for digits in (0, 1, 8):
        monkeypatch.setattr(sm, "PREFIX_DIGITS", digits)
        assert ids_by_mix(sm.stratified_mix(df)) == usual


def test_empty_and_unknown_classes(spark):
    df = classified(spark, 0, 0, 0)
    assert sm.stratified_mix(df).count() == 0
    summary = sm.mix_summary(sm.stratified_mix(df), names=list(fv.MIXES)).collect()
    assert {r["Total_Samples"] for r in summary} == {0} and {r["Easy_Pct"] for r in summary} == {None}
    odd = classified(spark, 5, 5, 5).withColumn(
        "difficulty", F.when(F.col("problem_id") < 603, "Odd").otherwise(F.col("difficulty"))
    )
    # Odd rows count towards the size of the whole but belong to no mix.
    assert sm.stratified_mix(odd, {"m": {"Hard": 0.2}}).count() == 3


def test_one_class_holds_nearly_everything(spark):
    df = spark.range(200_000).select(
        F.col("id").alias("problem_id"),
        F.when(F.col("id") % 1000 == 0, "Easy").otherwise("Hard").alias("difficulty"),
    )
    sizes = {
        (r["dataset"], r["difficulty"]): r["count"]
        for r in sm.stratified_mix(df).groupBy("dataset", "difficulty").count().collect()
    }
    assert sizes["Hard-heavy", "Hard"] == 140_000 and sizes["Hard-heavy", "Easy"] == 200
    assert sizes["Balanced", "Hard"] == 68_000


def test_shuffle_keeps_rows(spark):
    df = classified(spark, 20, 20, 20)
    shuffled = [r["problem_id"] for r in sm.shuffle_rows(df).collect()]
    assert sorted(shuffled) == sorted(r["problem_id"] for r in df.collect()) != shuffled
    assert shuffled == [r["problem_id"] for r in sm.shuffle_rows(df.repartition(5)).collect()]


EVALUATION = (
    "problem_id long, run_id string, position int, problem_statement string, passed boolean, "
    "test_outputs array<string>, generated_code string, test_cases array<string>"
)


def evaluation(problem, run, position, passed, outputs):
    return (problem, run, position, f"p{problem}", passed, outputs, f"c{run}{position}", ["assert f(1) == 2"])


def evaluations(spark):
    ok = "Test 1: PASS"
    return spark.createDataFrame(
        [
            evaluation(1, "02", 0, True, [ok]), evaluation(1, "01", 1, True, [ok]), evaluation(1, "01", 0, True, [ok]),
            evaluation(2, "01", 0, False, [ok, "FAIL"]), evaluation(2, "02", 0, False, [ok, ok, "FAIL"]),
            evaluation(2, "03", 0, False, [ok, ok, "FAIL"]),
            evaluation(3, "01", 0, True, [ok]), evaluation(3, "02", 0, False, [ok] * 101 + ["FAIL"]),
            evaluation(4, "02", 0, False, []), evaluation(4, "01", 0, False, None),
            # the same position twice
            evaluation(5, "01", 0, True, [ok]), evaluation(5, "01", 0, True, [ok]),
        ],
        EVALUATION,
    )


def test_best_attempt(spark):
    got = {r["problem_id"]: tuple(r)[1:] for r in tr.best_attempt(evaluations(spark)).collect()}
    assert got == {
        1: ("01", 0, 100), 2: ("02", 0, 2), 3: ("02", 0, 101), 4: ("01", 0, 0), 5: ("01", 0, 100),
    }


def test_train_rows(spark):
    samples = spark.createDataFrame(
        [("a", 1), ("b", 1), ("a", 5), ("a", 2), ("b", 9)], "dataset string, problem_id long"
    )
    code = spark.createDataFrame([(1, "r1"), (5, "r5"), (7, "r7")], "problem_id long, code string")
    rows = tr.train_rows(samples, evaluations(spark), code).collect()
    assert sorted((r["dataset"], r["problem_id"], r["output"]) for r in rows) == [
        ("a", 1, "r1"), ("a", 5, "r5"), ("b", 1, "r1"),
    ]
    assert "Problem: p1\n\nTask ID: 1\n\nExpected behavior (test cases):\n1. f(1) should return 2\n\nPlease" in rows[0]["instruction"] or rows[0]["problem_id"] != 1
    own = {r["problem_id"]: (r["instruction"], r["output"]) for r in tr.train_rows(samples, evaluations(spark)).collect()}
    assert own == {1: ("p1", "c010"), 2: ("p2", "c020"), 5: ("p5", "c010")}
    missing = tr.train_rows_missing(samples, evaluations(spark), code).collect()
    assert sorted(map(tuple, missing)) == [(2, "no reference code"), (9, "no results")]
    assert [tuple(r) for r in tr.train_rows_missing(samples, evaluations(spark)).collect()] == [(9, "no results")]


def test_reference_code_takes_the_last(spark):
    df = spark.createDataFrame(
        [(1, 0, "a"), (1, 2, "c"), (1, 1, "b"), (2, 0, None)], "problem_id long, position int, code string"
    ).select("problem_id", "position", F.struct("code").alias("problem"))
    assert [tuple(r) for r in tr.reference_code(df).collect()] == [(1, "c")]


def test_hot_problem(spark):
    """A third of all rows on one problem: counts, best attempt and texts stay whole."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("long").alias("problem_id"),
        F.format_string("%02d", F.col("id") % 12).alias("run_id"),
        F.col("id").alias("position"),
        F.lit("p").alias("problem_statement"),
        (F.col("id") == 29_997).alias("passed"),
        F.array(F.lit("FAIL")).alias("test_outputs"),
        F.col("id").cast("string").alias("generated_code"),
        F.array(F.lit("assert x")).alias("test_cases"),
    )
    best = tr.best_attempt(rows)
    assert best.count() == 20_001
    assert tuple(best.where("problem_id = 0").first())[2:] == (29_997, 100)
    samples = rows.select(F.lit("all").alias("dataset"), "problem_id").distinct()
    trained = tr.train_rows(samples, rows)
    assert trained.count() == 20_001
    assert trained.where("problem_id = 0").first()["output"] == "29997"
