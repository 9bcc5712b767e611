"""Substring dedup by level-wise doubling.

Only windows that repeat at one length are looked at when the length is doubled. The first level has
half the wanted length and needs not all windows: in every window of the wanted length the half-length
one with the smallest hash is marked, wherever the window stands, so two equal windows mark the same
one. Marks that occur in one document only go; the windows around those that are left are the
candidates of the second level, whose key is the pair of their halves' hashes. Windows that repeat at
that level settle which words go; ``longest_repeats`` doubles them further until none survives.

Texts equal to that of a smaller id go as a whole and are not cut into windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.sources.scratch import remove, stored

WORDS = 20  # words of a window
SLICE = 1 << 20  # bytes of text whose words are hashed at a time
HELD = 1 << 21  # bytes of whole texts whose windows are held at a time
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.default_rng(11)
_BYTE = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE, _STEP = (_RANDOM.integers(0, 2**64, 2, np.uint64) | np.uint64(1)).tolist()
_POWERS = np.concatenate((np.ones(1, np.uint64), np.full(SLICE - 1, _BASE, np.uint64))).cumprod(dtype=np.uint64)
_INVERSE = np.concatenate(
    (np.ones(1, np.uint64), np.full(SLICE - 1, pow(_BASE, -1, 1 << 64), np.uint64))
).cumprod(dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a hash depends on all of its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes_of(part: np.ndarray) -> np.ndarray:
    """Hashes of the words of at most ``SLICE`` bytes."""
    blank = _SPACE[part]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True]))))
    first, after = edges[::2], edges[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _POWERS[: len(part)], dtype=np.uint64)))
    return _mixed((sums[after] - sums[first]) * _INVERSE[first] + (after - first).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word."""
    found, at, size = [], 0, len(text)
    data = np.frombuffer(text, np.uint8)
    while at < size:
        end = min(at + SLICE, size)
        blanks = np.flatnonzero(_SPACE[data[at:end]])
        if len(blanks) == 0 and end - at == SLICE:
            # A word as long as a slice or longer.
            more = np.flatnonzero(_SPACE[data[end:]])
            end = end + int(more[0]) if len(more) else size
            found.append(np.frombuffer(hashlib.blake2b(text[at:end], digest_size=8).digest(), np.uint64))
        else:
            end = at + int(blanks[-1]) + 1 if end < size else end
            found.append(_hashes_of(data[at:end]))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _runs(values: np.ndarray, count: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of each value and the ``count`` - 1 after it; what is cut off at the end says nothing."""
    out, size = values.copy(), 1
    while size < count:
        step = min(size, count - size)
        if step >= len(out):
            break
        out[: len(out) - step] = least(out[: len(out) - step], out[step:])
        size += step
    return out


class Windows:
    """The windows of several texts, one after the other."""

    def __init__(self, texts: list[bytes], words: int):
        hashed = [word_hashes(t) for t in texts]
        self.words, self.half = words, words // 2
        self.counts = np.array([len(h) for h in hashed], np.int64)
        ends = np.cumsum(self.counts)
        self.starts = ends - self.counts
        w = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        n = len(w)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.whole = np.arange(n) + words <= np.repeat(ends, self.counts)
        # Hash of the half window at every word, its length doubled where the binary digits say so.
        half, covered = np.zeros(n, np.uint64), 0
        piece, length, factor = w, 1, _STEP
        while True:
            if self.half & length:
                late = np.zeros(n, np.uint64)
                late[: max(0, n - covered)] = piece[covered:]
                half, covered = half * np.uint64(factor) + late, covered + length
            if length * 2 > self.half:
                break
            late = np.zeros(n, np.uint64)
            late[: max(0, n - length)] = piece[length:]
            piece = piece * np.uint64(factor) + late
            factor, length = factor * factor % (1 << 64), length * 2
        # The lowest bit is left free.
        self.keys = np.maximum(_mixed(half) & np.uint64(2**64 - 2), np.uint64(2))
        least = _runs(self.keys, words - self.half + 1, np.minimum)
        self.least = np.where(self.whole, least, np.uint64(0))
        # A half window is marked if it is the smallest of some whole window around it.
        span = words - self.half
        most = _runs(np.concatenate((np.zeros(span, np.uint64), self.least)), span + 1, np.maximum)[:n]
        self.marked = np.flatnonzero((most > 0) & (most == self.keys))

    def _pairs(self, docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return _mixed(keys + docs.astype(np.uint64) * np.uint64(_STEP))

    def marks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, key, how often) of the marked half windows, each key once a document."""
        docs, keys = self.doc[self.marked], self.keys[self.marked]
        order = np.lexsort((keys, docs))
        docs, keys = docs[order], keys[order]
        new = np.ones(len(order), bool)
        new[1:] = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])
        first = np.flatnonzero(new)
        return docs[first], keys[first], np.diff(np.append(first, len(order)))

    def around(self, docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Starts of the whole windows whose smallest half window is one of (doc, key)."""
        known = np.isin(self._pairs(self.doc[self.marked], self.keys[self.marked]), self._pairs(docs, keys))
        held = np.full(len(self.keys), np.uint64(2**64 - 1))
        held[self.marked[known]] = self.keys[self.marked[known]]
        least = _runs(held, self.words - self.half + 1, np.minimum)
        return np.flatnonzero(self.whole & (least == self.least))

    def distinct(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, later): of the windows at ``at``, the first of each key in its document, and the others."""
        a, b, docs = self.keys[at], self.keys[at + self.half], self.doc[at]
        order = np.lexsort((at, b, a, docs))
        new = np.ones(len(order), bool)
        for x in (docs[order], a[order], b[order]):
            new[1:] &= x[1:] == x[:-1]
        new[1:] = ~new[1:]
        new[:1] = True
        return at[order[new]], at[order[~new]]

    def repeated_inside(self) -> np.ndarray:
        """Starts of windows that stand earlier in the same document."""
        docs, keys, times = self.marks()
        return self.distinct(self.around(docs[times > 1], keys[times > 1]))[1]


def _held(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches cut so that their texts stay below ``HELD`` bytes, or are one text; and the texts, unpacked."""
    whole = zstandard.ZstdDecompressor()
    for batch in batches:
        texts, at, size = [], 0, 0
        for k, packed in enumerate(batch.column(text)):
            x = whole.decompress(packed.as_py()) if packed.is_valid else b""
            if texts and size + len(x) > HELD:
                yield batch.slice(at, k - at), texts
                texts, at, size = [], k, 0
            texts.append(x)
            size += len(x)
        if texts:
            yield batch.slice(at), texts


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, digest, text): texts compressed one by one, which makes them a third shorter on the way than blocks of rows do."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [pack.compress(x.as_buffer()) if x.is_valid else None for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["doc", "digest", "text"])


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _marked(words: int):
    """(h, doc, ref): the marked half windows of (doc, ref, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _held(batches, 2):
            docs, keys, _ = Windows(texts, words).marks()
            at = pa.array(docs)
            yield pa.RecordBatch.from_arrays(
                [_longs(keys), batch.column(0).take(at), batch.column(1).take(at)], names=["h", "doc", "ref"]
            )

    return run


def _listed(batch: pa.RecordBatch, late: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the lists in the fourth column; with ``late`` only of keys that stand in a smaller id."""
    lists = batch.column(3)
    keys = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    chosen = (keys & np.uint64(1) == 1) | (not late)
    return rows[chosen], keys[chosen] & np.uint64(2**64 - 2)


def _located(batch: pa.RecordBatch, windows: Windows, at: np.ndarray) -> pa.RecordBatch:
    """Key, document and place of the windows that start at ``at``."""
    doc = windows.doc[at]
    keys = [_longs(windows.keys[at]), _longs(windows.keys[at + windows.half])]
    named = [batch.column(c).take(pa.array(doc)) for c in (0, 1)]
    return pa.RecordBatch.from_arrays(
        [*keys, *named, pa.array(at - windows.starts[doc])], names=["k1", "k2", "doc", "ref", "at"]
    )


def _candidates(words: int, late: bool):
    """(k1, k2, doc, ref, at): the windows around the marks of (doc, ref, text, marks), each once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _held(batches, 2):
            windows = Windows(texts, words)
            yield _located(batch, windows, windows.distinct(windows.around(*_listed(batch, late)))[0])

    return run


def _kept(words: int):
    """(doc, n_words, n_removed, kept) of (doc, text, later, gone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _held(batches, 1):
            later = batch.column(2).to_pylist()
            # The windows of a later copy are all gone; it is not cut.
            windows = Windows([b"" if c else t for c, t in zip(later, texts)], words)
            inside = windows.repeated_inside()
            change = np.zeros(len(windows.doc) + words + 1, np.int64)
            change[inside] += 1
            change[inside + words] -= 1
            for k, starts in enumerate(batch.column(3).to_pylist()):
                if starts:
                    at = np.array(starts, np.int64) + windows.starts[k]
                    change[at] += 1
                    change[at + words] -= 1
            left = np.cumsum(change) == 0
            counts, removed, kept = [], [], []
            for k, text in enumerate(texts):
                found = text.split()
                if later[k]:
                    stay = [] if len(found) >= words else found
                else:
                    first = windows.starts[k]
                    mask = left[first : first + len(found)]
                    stay = found if mask.all() else list(compress(found, mask))
                counts.append(len(found))
                removed.append(len(found) - len(stay))
                kept.append(b" ".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc", "n_words", "n_removed", "kept"],
            )

    return run


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc, ref, text, first): every row once, texts packed; ``first`` says that no smaller id has the same text.

    It is NULL where one has, or the row has no id. ``ref`` names a row by id and text. All further
    joins are by it and none looks at the id, so texts are shuffled once.
    """
    rows = docs.select(
        F.col(id).cast("bigint").alias("doc"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
        F.col(text).alias("text"),
    )
    ref = F.xxhash64("doc", "digest")
    # One row a text: the name of the row that has the smallest id.
    firsts = (
        rows.where("doc is not null").groupBy("digest").agg(F.min("doc").alias("doc"))
        .select(ref.alias("ref"), F.lit(True).alias("first"))
    )
    # The name is made after the packing, where it is known not to be NULL: no filter on it keeps the
    # uses of the texts from sharing their shuffle.
    packed = rows.mapInArrow(_packed, "doc bigint, digest string, text binary")
    named = packed.select("doc", ref.alias("ref"), "text")
    return named.join(firsts.hint("shuffle_hash"), "ref", "left").select("doc", "ref", "text", "first")


def _in_several(rows: DataFrame, keys: list[str], asked: DataFrame | None = None) -> DataFrame:
    """``asked`` (or ``rows``) whose keys stand in documents of several ids in ``rows``, and the ``least`` of these.

    Keys are counted with a partial step. For the join they are negated on both sides, so that it does not
    build on the counts' own partitions, where Spark could not split those of a hot key.
    """
    turned = [F.bitwise_not(k).alias(k) for k in keys]
    found = (
        rows.groupBy(*keys).agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
        .where("least < most").select(*turned, "least")
    )
    asked = rows if asked is None else asked
    others = [c for c in asked.columns if c not in keys]
    return asked.select(*turned, *others).join(found, keys)


def _marked_texts(texts: DataFrame, words: int) -> DataFrame:
    """(doc, ref, text, marks): texts with halves that stand in several documents.

    The lowest bit of a mark is set where a smaller id has it.
    """
    single = texts.where("first is not null").select("doc", "ref", "text")
    marked = single.mapInArrow(_marked(words), "h bigint, doc bigint, ref bigint")
    mark = F.bitwise_not("h").bitwiseOR((F.col("doc") > F.col("least")).cast("bigint"))
    marks = _in_several(marked, ["h"]).groupBy("ref").agg(F.collect_set(mark).alias("marks"))
    return single.join(marks.hint("shuffle_hash"), "ref").select("doc", "ref", "text", "marks")


_WINDOW = "k1 bigint, k2 bigint, doc bigint, ref bigint, at bigint"


def remove_repeats(
    docs: DataFrame, words: int = WORDS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_words, n_removed, kept) of every row: its text without words that stood somewhere before.

    A word goes if a window of ``words`` consecutive words covers it whose words also stand, in that
    order, earlier in the same text or in a text of a smaller id. Windows are judged on the texts as
    they came. ``kept`` holds the words that stay, joined by one blank, as UTF-8. ``words`` is even.

    NULL texts have no words; texts of fewer than ``words`` words lose none. Rows with a NULL id, and
    rows of one id among each other, are neither earlier nor later: they lose what repeats inside
    them, and a row of a repeated id also what stands in smaller ids. An empty table gives an empty
    one; other columns are left out. Ids are integers. Windows count as equal by 128 bits of hash.
    An odd or smaller ``words`` than 2 raises.

    Texts are shuffled once, then marks and windows: a key that very many documents share is counted
    with a partial step, and the join that tells them is split by Spark where it is skewed. A task
    holds the windows of two megabytes of text, or of one longer text.
    """
    if words < 2 or words % 2:
        raise ValueError("words is even and at least 2")
    texts = _texts(docs, id, text)
    marked = _marked_texts(texts, words)
    # A window can stand earlier elsewhere only if its mark does.
    asked = marked.mapInArrow(_candidates(words, True), _WINDOW)
    again = (
        _in_several(marked.mapInArrow(_candidates(words, False), _WINDOW), ["k1", "k2"], asked)
        .where("doc > least").groupBy("ref").agg(F.collect_set("at").alias("gone"))
    )
    later = (F.col("doc").isNotNull() & F.col("first").isNull()).alias("later")
    joined = texts.join(again.hint("shuffle_hash"), "ref", "left").select("doc", "text", later, "gone")
    kept = joined.mapInArrow(_kept(words), "doc bigint, n_words bigint, n_removed bigint, kept binary")
    return kept.withColumnRenamed("doc", id)


def _every(words: int):
    """(k1, k2, doc, ref, at): every window around the repeated marks of (doc, ref, text, marks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _held(batches, 2):
            windows = Windows(texts, words)
            yield _located(batch, windows, windows.around(*_listed(batch, False)))

    return run


def longest_repeats(docs: DataFrame, words: int = WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, at, length): where the windows of the last level begin that still stand in another document.

    From ``words`` on the length doubles: a window goes on to twice the length if it and the one after
    it both repeat, and its new key is the pair of their keys. Each level is counted, written to the
    shared folder and the one before deleted; the loop ends when nothing survives, after a number
    of levels logarithmic in the longest shared passage. Every window is reported at the last
    level it survived. Texts equal to that of a smaller id are left out, as are NULL ids.
    """
    spark = docs.sparkSession
    place = [F.col("doc").alias(id), F.col("at")]
    rows = _marked_texts(_texts(docs, id, text), words).mapInArrow(_every(words), _WINDOW)
    level, found, length = None, None, words
    while True:
        survivors = stored(_in_several(rows, ["k1", "k2"]).drop("least"), "survivors")
        if level is not None:
            ended = level.join(survivors.select("ref", "at").distinct(), ["ref", "at"], "left_anti")
            ended = stored(ended.select(*place, F.lit(length // 2).cast("bigint").alias("length")), "ended")
            found = ended if found is None else found.unionByName(ended)
            remove(spark, level)
        if survivors.isEmpty():
            empty = survivors.select(*place, F.lit(length).cast("bigint").alias("length"))
            return empty if found is None else found
        level = survivors
        key = F.xxhash64("k1", "k2")
        after = level.select("ref", (F.col("at") - length).alias("at"), key.alias("k2")).distinct()
        rows = level.select("ref", "doc", "at", key.alias("k1")).join(after, ["ref", "at"])
        length *= 2
