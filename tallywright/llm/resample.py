"""Importance resampling toward a target distribution, with counts of distinct lines.

Features are runs of one to ``order`` words, hashed into buckets. A newline separates words like any
other sign, so it cuts texts into lines whose inner features do not depend on what stands around: each
distinct line's features are counted once and multiplied by how often the line occurs. Features that
cross lines are counted per document and added.

A bucket's gain compares its share in the target texts with that in all documents; a document's weight
is the mean gain of its features. Adding Gumbel noise drawn from the id and taking the highest
scores draws documents without replacement, with probabilities that follow the weights.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.sources.scratch import stored

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
MOST_CACHED = 1_000_000  # words whose bucket a task remembers

# A-Z to a-z; signs and blanks to a blank; digits, a-z and all beyond ASCII stay.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Words of a text, lower-cased in A-Z only, as UTF-8."""
    return text.encode().translate(_PLAIN).split()


class Buckets(dict):
    """Bucket of a feature, remembered for a bounded number of features."""

    def __init__(self, count: int):
        super().__init__()
        self.count = count

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MOST_CACHED:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.count
        return bucket


def _inside(words: list[bytes], order: int, buckets: Buckets) -> list[int]:
    """Buckets of all runs of one to ``order`` of ``words``."""
    found = [buckets[w] for w in words]
    for size in range(2, order + 1):
        found += [buckets[b" ".join(words[i : i + size])] for i in range(len(words) - size + 1)]
    return found


def _across(lines: list[list[bytes]], order: int, buckets: Buckets) -> list[int]:
    """Buckets of the runs of at most ``order`` words that begin in one line and end in another."""
    words = [w for line in lines for w in line]
    found, edge, done = [], 0, dict.fromkeys(range(2, order + 1), 0)
    for line in lines[:-1]:
        edge += len(line)
        for size in done:
            # Runs over this line's end; those over an earlier end too have been counted there.
            for i in range(max(done[size], edge - size + 1), min(edge, len(words) - size + 1)):
                found.append(buckets[b" ".join(words[i : i + size])])
            done[size] = max(done[size], edge)
    return found


def _summed(counts: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["bucket", "n"])


def _line_counts(order: int, count: int):
    """(bucket, n): features of distinct lines (line, times), added up in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = Buckets(count), np.zeros(count, np.int64)
        for batch in batches:
            times = batch.column(1).to_numpy(zero_copy_only=False)
            found, sizes = [], []
            for line in batch.column(0).to_pylist():
                inside = _inside(words_of(line), order, buckets)
                sizes.append(len(inside))
                found += inside
            np.add.at(total, np.array(found, np.int64), np.repeat(times, sizes))
        yield _summed(total)

    return run


def _cross_counts(order: int, count: int):
    """(bucket, n): features across lines of whole texts, added up in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = Buckets(count), np.zeros(count, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                lines = [words_of(line) for line in text.split("\n")]
                total += np.bincount(np.array(_across(lines, order, buckets), np.int64), minlength=count)
        yield _summed(total)

    return run


def feature_counts(texts: DataFrame, text: str = "text", order: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket: ``buckets`` sums reach the driver, whatever the input's size."""
    given = texts.select(F.col(text).alias("text")).where("text is not null")
    lines = (
        given.select(F.explode(F.split("text", "\n")).alias("line")).where("line != ''")
        .groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    )
    parts = lines.mapInArrow(_line_counts(order, buckets), "bucket int, n bigint")
    if order > 1:
        parts = parts.unionByName(given.mapInArrow(_cross_counts(order, buckets), "bucket int, n bigint"))
    counts = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in the target and in the source."""
    n, total, wanted = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * float(total + n) / (float(s + 1) * float(wanted + n))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc: int | None, seed: int) -> int:
    """Thousandths of Gumbel noise; a NULL id counts as ''."""
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def _scored(gain: np.ndarray, order: int, seed: int):
    """(doc, n_words, n_features, weight, score) of (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(len(gain))
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc, text in zip(ids, batch.column(1).to_pylist()):
                words = words_of(text or "")
                found = _inside(words, order, buckets)
                weight = int(gain[found].sum()) // len(found) if found else 0
                rows.append((len(words), len(found), weight, weight + noise(doc, seed)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc", "n_words", "n_features", "weight", "score"]
            )

    return run


def _cut(scored: DataFrame, share: int, least_words: int) -> tuple[int, int]:
    """How many are drawn, and a score that all of them reach.

    Gains and noise are logarithms, so there are at most some 100,000 different scores, whatever the
    input's size; their counts reach the driver.
    """
    enough = scored.where(F.col("n_words") >= least_words)
    counts = sorted(((r["score"], r["n"]) for r in enough.groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    wanted = sum(n for _, n in counts) * share // 100
    taken, score = 0, 0
    for score, n in counts:
        taken += n
        if taken >= wanted:
            break
    return wanted, score


def _numbered(rows: DataFrame) -> DataFrame:
    """``rank`` from 1 by score, then id. Sorted by ranges of these, which may part equal rows too;
    a row's rank is its place in its range and the sizes of the ranges before it."""
    order = [F.desc("score"), F.asc_nulls_last("doc"), F.asc("n_features"), F.asc("weight"), F.asc("row")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, at = [], 0
    for r in sizes:
        before.append((r["part"], at))
        at += r["n"]
    offsets = rows.sparkSession.createDataFrame(before, "part bigint, before bigint")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(
        "rank", F.col("before") + inside + 1
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: int = 10,
    order: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; the drawn ones have a rank, from 1.

    Of the rows with at least ``least_words`` words, ``share`` percent are drawn (rounded down), the
    highest scores first; ties go to the smaller id, a NULL id last, then to fewer features and the
    lower weight. NULL and empty texts have no feature and weight 0. Repeated rows are scored alike and ranked
    each. An empty table gives an empty one; an empty target makes rare buckets the better ones. Other
    columns are left out. Ids are integers.

    Lines are counted with a partial step and then shuffled once, so a line that very many documents
    hold is one row a task. The driver holds a number for each bucket and each different score.
    """
    gain = gains(feature_counts(docs, text, order, buckets), feature_counts(target, target_text, order, buckets))
    chosen = docs.select(F.col(id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    scored = chosen.mapInArrow(
        _scored(gain, order, seed), "doc bigint, n_words bigint, n_features bigint, weight bigint, score bigint"
    )
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    wanted, score = _cut(scored, share, least_words)
    may = (F.col("n_words") >= least_words) & (F.col("score") >= score) & F.lit(wanted > 0)
    ranked = _numbered(scored.where(may))
    columns = [F.col("doc").alias(id), "n_features", "weight", "score"]
    drawn = ranked.select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    return drawn.unionByName(scored.where(~may).select(*columns, F.lit(None).cast("bigint").alias("rank")))
