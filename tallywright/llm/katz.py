"""Katz backoff bigram model of a corpus, and the log-probability of texts under it.

P(w | h) = d(c) c(h w) / c(h) for bigrams seen, with Good-Turing discounts d; else a(h) P(w), where
a(h) hands out exactly the mass the discounts left, and P(w) is the add-one unigram. A context never
seen backs off with weight one.

Documents are turned once into blocks: arrays of word numbers, with the block's distinct words and
bigrams. What has to be known about a word or a bigram is asked for, once a block, from the bucket
its hash belongs to; buckets add up all blocks' counts, keep the count tables, and answer each block
in the order it asked. So shuffled rows are compressed arrays, one for each block and bucket. Bigrams of a
context that makes up more than ``HOT`` of the corpus are dealt by both words; such contexts are at
most 1 / ``HOT``, and only their sums meet on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm import letters
from tallywright.sources.scratch import remove, scratch_path

END = b"\n"  # no word can be this
BLOCK_CHARS = 1 << 24
WORDS_A_BUCKET = 500_000  # questions about words, about
BIGRAMS_A_BUCKET = 1_000_000  # tokens whose bigrams one bucket keeps, about
HOT = 0.002
DISCOUNTED = 5  # counts up to this are discounted
KINDS = ("<u1", "<u2", "<u4", "<i8", "<f4")


def pack(a: np.ndarray) -> bytes:
    """A non-negative integer array, or one of floats, in the narrowest of ``KINDS``, compressed."""
    if a.dtype.kind == "f":
        kind = 4
    else:
        top = int(a.max()) if len(a) else 0
        kind = 0 if top < 1 << 8 else 1 if top < 1 << 16 else 2 if top < 1 << 32 else 3
    # Bytes of equal weight stand together, so that the zeros of small numbers do.
    width = np.dtype(KINDS[kind]).itemsize
    plain = a.astype(KINDS[kind]).view(np.uint8).reshape(len(a), width).T.tobytes()
    return bytes([kind]) + len(a).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True)


def narrow(data: bytes) -> np.ndarray:
    """The array in the kind it was packed in, for long ones."""
    size, width = int.from_bytes(data[1:9], "little"), np.dtype(KINDS[data[0]]).itemsize
    plain = pa.decompress(memoryview(data)[9:], size * width, codec="zstd")
    return np.frombuffer(plain, np.uint8).reshape(width, size).T.copy().view(KINDS[data[0]]).ravel()


def unpack(data: bytes) -> np.ndarray:
    return narrow(data).astype(np.float64 if data[0] == 4 else np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _batch(names: list[str], kinds: list, *rows: tuple) -> pa.RecordBatch:
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, ids, held, sizes, tokens, place, hashes, counts): words numbered as they come, which
    gives frequent ones small numbers; place is each one's rank by hash."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
        for a, b in letters.ranges(lengths, BLOCK_CHARS):
            texts = batch.column(1).slice(a, b - a).to_pylist()
            held = batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
            local: dict[bytes, int] = {END: 0}
            tokens, sizes = [], []
            for text in texts:
                words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
                sizes.append(len(words) + 1)
                tokens.append(np.fromiter((local.setdefault(w, len(local)) for w in words), np.int32, len(words)))
                tokens.append(np.zeros(1, np.int32))
            sizes, tokens = np.array(sizes), np.concatenate(tokens)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in local), np.uint64, len(local))
            counts = np.bincount(tokens[np.repeat(held, sizes) == 0], minlength=len(local))
            order = np.argsort(hashes)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            ids = batch.column(0).slice(a, b - a)
            columns = [
                pa.array([number], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                *(pa.array([x], pa.binary()) for x in (
                    pack(held), pack(sizes), pack(tokens), pack(place), hashes[order].tobytes(), pack(counts[order])
                )),
            ]
            number += 1
            yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "held", "sizes", "tokens", "place", "hashes", "counts"])


def _slices(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of a sorted array."""
    if len(bucket):
        at = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *at], [*at, len(bucket)]):
            yield int(bucket[a]), int(a), int(b)


def _word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _ask_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes, counts = np.frombuffer(row["hashes"], np.uint64), unpack(row["counts"])
            asked = [
                (k, row["block"], hashes[a:b].tobytes(), pack(counts[a:b]))
                for k, a, b in _slices(_word_bucket(hashes, buckets))
            ]
            yield _batch(["bucket", "block", "hashes", "counts"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()], *asked)

    return run


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one bucket after the other, of input sorted by bucket."""
    held: list[dict] = []
    for row in _rows(batches):
        if held and held[0]["bucket"] != row["bucket"]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _answer_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, bucket, ranks, counts, size, known, total): each word's number in its bucket and its
    count in the corpus; the bucket's own figures stand in its first answer."""
    names = ["block", "bucket", "ranks", "counts", "size", "known", "total"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    for rows in _grouped(batches):
        asked = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        every, rank = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(rank, np.concatenate([unpack(r["counts"]) for r in rows]), len(every)).astype(np.int64)
        at = 0
        for r, a in zip(rows, asked):
            mine = rank[at : at + len(a)]
            first = at == 0
            at += len(a)
            yield _batch(names, kinds, (
                r["block"], r["bucket"], pack(mine), pack(counts[mine]), len(every) if first else 0,
                int(np.count_nonzero(counts)) if first else 0, int(counts.sum()) if first else 0,
            ))


class Block:
    """A block with its words' numbers in the corpus and its distinct bigrams; with ``inverse`` which each token's is."""

    def __init__(self, row: dict, bases: dict[int, int], inverse: bool = False):
        answers = sorted(row["answers"], key=lambda x: x["bucket"])
        # 0 is the start of a text; words count from 1.
        self.words = np.concatenate([unpack(x["ranks"]) + bases[x["bucket"]] + 1 for x in answers] + [[0]])
        self.counts = np.concatenate([unpack(x["counts"]) for x in answers] + [[0]])
        self.sizes, held = unpack(row["sizes"]), unpack(row["held"])
        # A block has some million tokens: what is as long is in 32 bits where it can be, and soon let go.
        self.tokens = unpack(row["place"]).astype(np.int32)[narrow(row["tokens"])]
        start = len(self.words) - 1
        keys = np.empty(len(self.tokens), np.int64)
        keys[0], keys[1:] = start, self.tokens[:-1]
        keys[np.cumsum(self.sizes)[:-1]] = start
        keys *= start + 1
        keys += self.tokens
        order = np.argsort(keys)
        keys = keys[order]
        new = np.ones(len(keys), bool)
        np.not_equal(keys[1:], keys[:-1], out=new[1:])
        first = np.flatnonzero(new)
        self.times = np.add.reduceat(np.repeat(held == 0, self.sizes)[order], first, dtype=np.int64)
        keys = keys[first]
        if inverse:
            self.inverse = np.empty(len(order), np.int32)
            self.inverse[order] = np.cumsum(new, dtype=np.int32) - 1
        del order, new, first
        self.before, self.word = ((keys // (start + 1)).astype(np.int32), (keys % (start + 1)).astype(np.int32))

    def dealt(self, buckets: int, hot_from: float) -> tuple[np.ndarray, np.ndarray]:
        """(order, bucket in that order) of the distinct bigrams."""
        context = self.words[self.before]
        # Texts all begin alike, so their start is hot where there are many.
        hot = (self.counts[self.before] > hot_from) | (context == 0)
        mixed = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = np.where(hot, mixed ^ self.words[self.word].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), mixed)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        bucket = ((mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order]


ASKED = ["bucket", "block", "runs", "lengths", "words", "counts", "times"]


def _ask_bigrams(bases: dict[int, int], buckets: int, hot_from: float):
    """What a block adds to the counts of its bigrams, which is also what it asks about."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row, bases)
            del block.tokens
            order, bucket = block.dealt(buckets, hot_from)
            asked = []
            for k, a, b in _slices(bucket):
                mine = order[a:b]
                context, word = block.words[block.before[mine]], block.word[mine]
                edges = np.concatenate(([0], np.flatnonzero(np.diff(context)) + 1))
                asked.append((
                    k, row["block"], pack(context[edges]), pack(np.diff(np.append(edges, b - a))),
                    pack(block.words[word]), pack(block.counts[word]), pack(block.times[mine]),
                ))
            yield _batch(ASKED, [pa.int64(), pa.int64(), *[pa.binary()] * 5], *asked)

    return run


def _contexts(row: dict) -> np.ndarray:
    return np.repeat(unpack(row["runs"]), unpack(row["lengths"]))


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a bucket: its count table (contexts, words, counts of the words, times), n1 to n6, and
    for each block where in the table its bigrams stand."""
    names = ["bucket", "runs", "lengths", "words", "counts", "times", "seen", "asked"]
    asked_kind = pa.list_(pa.struct([("block", pa.int64()), ("places", pa.binary())]))
    for rows in _grouped(batches):
        context = np.concatenate([_contexts(r) for r in rows])
        word, count, times = (np.concatenate([unpack(r[n]) for r in rows]) for n in ("words", "counts", "times"))
        order = np.lexsort((word, context))
        new = np.concatenate(([True], (np.diff(context[order]) != 0) | (np.diff(word[order]) != 0)))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        at = order[new]
        times = np.add.reduceat(times[order], np.flatnonzero(new))
        ends = np.cumsum([int(unpack(r["lengths"]).sum()) for r in rows])
        asked = [{"block": r["block"], "places": pack(p)} for r, p in zip(rows, np.split(place, ends[:-1]))]
        context = context[at]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(context)) + 1))
        seen = np.bincount(np.minimum(times, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
        yield _batch(names, [pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64()), asked_kind], (
            rows[0]["bucket"], pack(context[edges]), pack(np.diff(np.append(edges, len(context)))),
            pack(word[at]), pack(count[at]), pack(times), seen.tolist(), asked,
        ))


def discounts(seen: list[int]) -> np.ndarray:
    """d(0..5) by Good and Turing from n1..n6; (r - 1/2) / r for all where the corpus is too small
    for these to fall between 0 and 1."""
    k = DISCOUNTED
    d = np.ones(k + 1)
    common = (k + 1) * seen[k] / seen[0] if seen[0] else 1.0
    if common < 1 and all(seen[:k]):
        for r in range(1, k + 1):
            d[r] = ((r + 1) * seen[r] / (r * seen[r - 1]) - common) / (1 - common)
    if not (np.all(d[1:] > 0) and np.all(d[1:] < 1)):
        d[1:] = (np.arange(1, k + 1) - 0.5) / np.arange(1, k + 1)
    return d


class Sums:
    """What backoff weights are made of, by context of a bucket's table."""

    def __init__(self, row: dict, d: np.ndarray, floor: float):
        self.lengths, self.times = unpack(row["lengths"]), unpack(row["times"])
        self.context = unpack(row["runs"])
        self.p_word = (unpack(row["counts"]) + 1) / floor
        self.mass = self.times * d[np.where(self.times > DISCOUNTED, 0, self.times)]
        starts = np.cumsum(self.lengths) - self.lengths
        self.all, self.kept, self.p_seen = (
            np.add.reduceat(x, starts)
            for x in (self.times.astype(np.float64), self.mass, np.where(self.times > 0, self.p_word, 0.0))
        )


def backoff(every: np.ndarray, kept: np.ndarray, p_seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(divisor, weight) of contexts: all of a context's probabilities add up to one.

    Where no count was discounted, one novel word is counted in, so that others keep a chance. A
    context never seen has weight one.
    """
    divisor = np.where(kept >= every, every + 1, every)
    return divisor, np.where(every > 0, (1 - kept / divisor) / (1 - p_seen), 1.0)


def _hot_words(bases: dict[int, int], hot_from: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = unpack(row["ranks"])[unpack(row["counts"]) > hot_from] + bases[row["bucket"]] + 1
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["word"])

    return run


def _context_sums(d: np.ndarray, floor: float, hot: list[int]):
    """What each bucket has of the hot contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sums = Sums(row, d, floor)
            some = (sums.all > 0) & np.isin(sums.context, hot)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[some]) for x in (sums.context, sums.all, sums.kept, sums.p_seen)],
                names=["context", "all", "kept", "p_seen"],
            )

    return run


def _answer_bigrams(d: np.ndarray, floor: float, hot: dict[int, tuple[float, float, float]]):
    """(block, bucket, scores): log10 P(word | context) in the order each block asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sums = Sums(row, d, floor)
            for k in np.flatnonzero(np.isin(sums.context, list(hot))):
                sums.all[k], sums.kept[k], sums.p_seen[k] = hot[int(sums.context[k])]
            divisor, weight = (np.repeat(x, sums.lengths) for x in backoff(sums.all, sums.kept, sums.p_seen))
            logs = np.log10(np.where(sums.times > 0, sums.mass / divisor, weight * sums.p_word))
            for one in row["asked"]:
                yield _batch(
                    ["block", "bucket", "scores"], [pa.int64(), pa.int64(), pa.binary()],
                    (one["block"], row["bucket"], pack(logs[unpack(one["places"])])),
                )

    return run


def _finish(bases: dict[int, int], buckets: int, hot_from: float, floor: float, id: str, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names if n != "ids"}
                block = Block(row, bases, inverse=True)
                order, _ = block.dealt(buckets, hot_from)
                scores = np.empty(len(order))
                scores[order] = np.concatenate(
                    [unpack(x["scores"]) for x in sorted(row["scored"], key=lambda x: x["bucket"])]
                )
                starts = np.concatenate(([0], np.cumsum(block.sizes)[:-1]))
                count = block.counts[block.tokens]
                columns = [
                    batch.column("ids")[k].values,
                    pa.array(unpack(row["held"]) > 0), pa.array(block.sizes),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(np.log10((count + 1) / floor), starts)),
                    pa.array(np.add.reduceat(scores[block.inverse], starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[id, "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, held_out: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    Rows whose column ``held_out`` is false train the model; all are scored. Tokens are runs without
    white space, A-Z in lower case, and one end. base_score is the add-one unigram's, score the
    model's log10 probability of the text. NULL and empty texts have the end alone. Repeated rows
    are rows like any other; without training rows every token is unknown; an empty table gives an
    empty one. Words and bigrams are known by 64-bit hashes of the words; single bigram
    probabilities travel in single precision, sums are in double. A text is one row of a block
    whatever its length.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(id).alias("id"), F.col(text).alias("t"), F.coalesce(F.col(held_out), F.lit(False)).alias("h"))
    kind = chosen.schema["id"].dataType
    blocks = _stored(
        chosen.mapInArrow(
            _to_blocks,
            f"block bigint, ids array<{kind.simpleString()}>, held binary, sizes binary, tokens binary, "
            "place binary, hashes binary, counts binary",
        ),
        "blocks",
    )
    result = (
        f"`{id}` {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
        "base_score double, score double"
    )
    asked = blocks.agg(
        F.coalesce(F.sum(F.octet_length("hashes") / 8), F.lit(0)).cast("bigint").alias("words")
    ).first()["words"]
    buckets = 1 + asked // WORDS_A_BUCKET
    answers = _stored(
        blocks.select("block", "hashes", "counts")
        .mapInArrow(_ask_words(buckets), "bucket bigint, block bigint, hashes binary, counts binary")
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(
            _answer_words,
            "block bigint, bucket bigint, ranks binary, counts binary, size bigint, known bigint, total bigint",
        ),
        "word_answers",
    )
    # One number a bucket reaches the driver; a bucket holds half a million words.
    bases, at, known, total = {}, 0, 0, 0
    for r in answers.where("size > 0").select("bucket", "size", "known", "total").orderBy("bucket").collect():
        bases[r["bucket"]] = at
        at, known, total = at + r["size"], known + r["known"], total + r["total"]
    floor = float(total + known + 1)
    by_block = answers.groupBy("block").agg(
        F.collect_list(F.struct("bucket", "ranks", "counts")).alias("answers")
    )
    hot_from = HOT * total
    hot_words = answers.select("bucket", "ranks", "counts").mapInArrow(_hot_words(bases, hot_from), "word bigint")
    hot_contexts = [0, *(r["word"] for r in hot_words.distinct().collect())]
    indexed = _stored(blocks.drop("hashes", "counts").join(by_block, "block"), "indexed")
    remove(spark, blocks)
    remove(spark, answers)

    buckets = 1 + total // BIGRAMS_A_BUCKET
    schema = "bucket bigint, block bigint, runs binary, lengths binary, words binary, counts binary, times binary"
    table = _stored(
        indexed.drop("ids").mapInArrow(_ask_bigrams(bases, buckets, hot_from), schema)
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(
            _add_up,
            "bucket bigint, runs binary, lengths binary, words binary, counts binary, times binary, "
            "seen array<bigint>, asked array<struct<block: bigint, places: binary>>",
        ),
        "bigrams",
    )
    seen = table.agg(*(F.coalesce(F.sum(F.col("seen")[r]), F.lit(0)) for r in range(DISCOUNTED + 1))).first()
    d = discounts(list(seen))
    # Hot contexts lie in several buckets: their sums are added up, at most 1 / HOT rows and the start.
    sums = table.drop("seen", "asked").mapInArrow(
        _context_sums(d, floor, hot_contexts), "context bigint, `all` double, kept double, p_seen double"
    )
    hot = {
        r["context"]: (r["all"], r["kept"], r["p_seen"])
        for r in sums.groupBy("context").agg(*(F.sum(c).alias(c) for c in ("all", "kept", "p_seen"))).collect()
    }
    scored = (
        table.drop("seen").mapInArrow(_answer_bigrams(d, floor, hot), "block bigint, bucket bigint, scores binary")
        .groupBy("block").agg(F.collect_list(F.struct("bucket", "scores")).alias("scored"))
    )
    found = indexed.join(scored, "block").mapInArrow(_finish(bases, buckets, hot_from, floor, id, kind), result)
    return found.select(
        id, "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )
