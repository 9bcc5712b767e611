"""Near-duplicates by 64-bit SimHash fingerprints and deletion-variant signatures.

Fingerprints that differ in at most 3 bits agree, in one of two 32-bit segments, in all bits but
one: were both to differ in two or more, four bits would. So each segment is indexed as it is and
with each single bit blanked out. Two fingerprints are compared where they share an entry: the
unblanked one, or a blanked one in which the blanked bits differ. Each candidate is verified by the
number of differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.graph import components
from tallywright.sources.scratch import stored

SEED = 42
RADIUS = 3
SEGMENT = 32
CHUNK = 1 << 16  # shingles of one text that are hashed at a time
MOST_BROADCAST = 500_000  # keys of 16 bytes
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)
PLACES = (np.arange(8) * 256).astype(np.intp)


def fingerprint(text: str | None, width: int) -> int:
    """The signed 64-bit fingerprint: bits that are 1 in over half of the shingles' hashes.

    Words are runs without white space, A-Z in lower case; shingles count as often as they occur.
    Fewer words than ``width`` make one shingle; no word (NULL, empty, blank) makes zero.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    width = min(width, len(words))
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    total = len(words) - width + 1
    ones = np.zeros(64)
    digest = xxhash.xxh64_digest
    for at in range(0, total, CHUNK):
        to = min(at + CHUNK, total)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())
        hashes = np.frombuffer(b"".join([digest(line[i:j], SEED) for i, j in spans]), np.uint8)
        seen = np.bincount((hashes.reshape(-1, 8) + PLACES).ravel(), minlength=2048)
        ones += (seen.reshape(8, 256).astype(np.float64) @ BITS).ravel()
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big", signed=True)


def with_fingerprint(df: DataFrame, text: str, width: int, name: str = "fp") -> DataFrame:
    """All columns and the fingerprint; one pass, no shuffle."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(x.as_py(), width) for x in batch], pa.int64())

    return df.withColumn(name, F.arrow_udf(run, "bigint")(F.col(text)))


def _segment(fp: Column, number: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT * number).bitwiseAND(F.lit((1 << SEGMENT) - 1))


def _key(number: int, variant: Column, value: Column) -> Column:
    """One BIGINT for segment, blanked bit (0: none) and the bits left."""
    return F.shiftleft(variant.cast("bigint"), SEGMENT).bitwiseOR(value).bitwiseOR(
        F.lit(number << (SEGMENT + 6)).cast("bigint")
    )


def _variants(fps: DataFrame, number: int, bit: int) -> DataFrame:
    """(key, fp) with each single bit of a segment blanked that has the value ``bit``."""
    value, place = _segment(F.col("fp"), number), F.col("place")
    mask = F.expr("shiftleft(1L, place)")
    return (
        fps.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SEGMENT - 1))))
        .where((value.bitwiseAND(mask) != 0) if bit else (value.bitwiseAND(mask) == 0))
        .select(_key(number, place + 1, value.bitwiseAND(F.bitwise_not(mask))).alias("key"), "fp")
    )


def close_pairs(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): pairs of the distinct fingerprints ``fp`` that differ in 1 to ``radius`` <= 3 bits.

    33 index rows for each segment of a fingerprint, whatever the size of the table, and an equality
    join; the bit count is part of the join condition. A pair may occur once a segment. Spark takes
    the index for as small as the fingerprints it is made of, so no join is left to choose a broadcast.
    """
    if not 0 < radius <= RADIUS:
        raise ValueError(f"two segments with one blanked bit find up to {RADIUS} differing bits")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    found = None
    for number in (0, 1):
        same = fps.select(_key(number, F.lit(0), _segment(F.col("fp"), number)).alias("key"), "fp")
        left = same.select("key", F.col("fp").alias("a"))
        right = same.select("key", F.col("fp").alias("b"))
        exact = left.join(right.hint("merge"), "key").where((F.col("a") < F.col("b")) & close)
        off, on = _variants(fps, number, 0), _variants(fps, number, 1)
        blanked = (
            off.select("key", F.col("fp").alias("a"))
            .join(on.select("key", F.col("fp").alias("b")).hint("merge"), "key")
            .where(close)
        )
        for part in (exact, blanked):
            part = part.select("a", "b")
            found = part if found is None else found.unionByName(part)
    return found


def fingerprint_groups(fps: DataFrame) -> DataFrame:
    """(fp, root): every distinct fingerprint and the smallest one it reaches by links."""
    distinct = stored(fps.select("fp").distinct(), "fingerprints")
    roots = components(close_pairs(distinct))
    return distinct.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(id, fingerprint, component_id): each row's fingerprint in hex and its group's smallest id.

    One row for each row of ``docs``, repeated rows and ids included; NULL, empty and blank texts
    have fingerprint zero and link like any other. A NULL id is no group's smallest unless the
    group has no other. An empty table gives an empty one; other columns are left out.
    Equal fingerprints are merged before anything is compared, so copies cost no candidates. All
    joins are by sorting: hashed, these tables take many times the bytes of their files, by which
    Spark would send them to the driver.
    """
    marked = stored(with_fingerprint(docs.select(id, text), text, width).select(id, "fp"), "simhash")
    least = marked.groupBy("fp").agg(F.min(id).alias("least"))
    grouped = fingerprint_groups(marked).join(least.hint("merge"), "fp")
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = grouped.select("fp", "root").join(smallest.hint("merge"), "root").select("fp", "component_id")
    return marked.join(groups.hint("merge"), "fp").select(
        id, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """One row of each group: that with the smallest id; all columns are kept.

    Repeats of that very row (same id and fingerprint) leave one, the first by its columns as JSON.
    A group whose ids are all NULL keeps one row in the same way. Names beginning with two
    underscores are taken.

    What goes is found from ids and fingerprints alone; texts are written once with their
    fingerprint and meet only the keys of the rows that go, which are sent to them where they are
    at most ``MOST_BROADCAST``.
    """
    marked = stored(with_fingerprint(docs, text, width, "__fp"), "marked")
    narrow = marked.select(F.col(id).alias("__id"), F.col("__fp").alias("fp"))
    roots = fingerprint_groups(narrow)
    keys = narrow.groupBy("__id", "fp").agg(F.count(F.lit(1)).alias("times"))
    grouped = stored(keys.join(roots.hint("merge"), "fp"), "grouped")
    # NULL ids come last.
    first = grouped.groupBy("root").agg(
        F.min(F.struct(F.col("__id").isNull().alias("no"), "__id", "fp")).alias("first")
    )
    placed = grouped.join(first.hint("merge"), "root")
    stays = F.col("__id").eqNullSafe(F.col("first.__id")) & (F.col("fp") == F.col("first.fp"))
    gone = placed.where(~stays).select(F.col("__id").alias("__gone"), F.col("fp").alias("__gone_fp"))
    repeated = placed.where(stays & (F.col("times") > 1)).select(
        F.col("__id").alias("__gone"), F.col("fp").alias("__gone_fp")
    )
    leaving = stored(gone.unionByName(repeated), "leaving")
    if leaving.count() <= MOST_BROADCAST:
        leaving = F.broadcast(leaving)
    same = F.col(id).eqNullSafe(F.col("__gone")) & (F.col("__fp") == F.col("__gone_fp"))
    kept = marked.join(leaving, same, "left_anti")
    names = docs.columns
    one = (
        marked.join(repeated, same, "left_semi")
        .groupBy(F.col(id).alias("__id"), "__fp")
        .agg(F.min_by(F.struct(*names), F.to_json(F.struct(*names))).alias("row"))
    )
    return kept.select(*names).unionByName(one.select(*(F.col("row")[n].alias(n) for n in names)))
