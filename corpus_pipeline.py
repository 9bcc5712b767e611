"""A training corpus from ``documents``: language, near-duplicates, benchmark leaks, mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywright.llm import decontaminate, langid, simhash
from tallywright.llm.queries import mixed, sharded, table
from tallywright.sources.scratch import stored


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letters, or fewer than half in labelled spans of a learned language's script.

    The others go on under the language most of their letters are labelled with, by which they are mixed.
    """
    return langid.identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return simhash.deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a benchmark item, also one with few edits."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of domains, languages and sources takes them."""
    return mixed(docs).drop("__epoch")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document that is left."""
    return sharded(docs)


STAGES = [
    ("language ID", languages),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources to target weights", mix),
    ("sharding", shards),
]
# Fingerprints, language scores and ring positions have no SQL form; tests hold every stage against
# a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
