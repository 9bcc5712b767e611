"""The pipeline's stages, one after the other, and SQL for the queries that have some."""

from collections import Counter

import pytest

import corpus_pipeline
from compare import compare, connect
from tallywright.llm import decontaminate, queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf_dir), queries.queries()[name], queries.oracle_sql()[name], sf_dir) == []


def test_stages(spark, sf_dir):
    first = docs = queries.table(spark, sf_dir, "documents")
    rows = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "stage")
        assert docs.dtypes == first.dtypes
        rows.append(docs.collect())
    groups = {r["doc_id"]: r["component_id"] for r in queries.op2_simhash(spark, sf_dir).collect()}
    before, after = ({r["doc_id"] for r in part} for part in rows[:2])
    assert after == {min(i for i in before if groups[i] == g) for g in {groups[i] for i in before}}
    items = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    lines = [decontaminate.normal(t) for _, t in items]
    for r in rows[1]:
        held = any(t in decontaminate.normal(r["text"]) for t in lines)
        assert not (held and r in rows[2])
    assert len(rows[2]) > 0.9 * len(rows[1]) * 0.9 and set(rows[3]) <= set(rows[2])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    counts = Counter(r["shard"] for r in last)
    assert len(last) == len(rows[3]) and max(counts.values()) - min(counts.values()) <= 1


def test_stages_on_odd_rows(spark, odd, sf_dir):
    for df in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, df, sf_dir).collect()


def test_the_mix_goes_by_the_identified_language(spark, docs, sf_dir):
    given = queries.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    shown = {lang: given.where(f"lang = '{lang}'").first()["text"] for lang in ("en", "fr", "de")}
    added = docs((-1, shown["fr"], None, "a"), (-2, shown["de"], "en", "a"), (-3, shown["en"], "en", "a"), (-4, "1 2 3", "en", "a"))
    kept = corpus_pipeline.stored(corpus_pipeline.languages(spark, given.unionByName(added), sf_dir), "identified")
    got = {r["doc_id"]: r["lang"] for r in kept.where("doc_id < 0").collect()}
    assert got == {-1: "fr", -2: "de", -3: "en"}
    few = kept.where("doc_id < 0").select(*given.columns)
    taken = queries.mixed(few.unionByName(few.withColumn("doc_id", few.doc_id - 10)))
    assert {r["lang"] for r in taken.collect()} <= {"fr", "de", "en"}
