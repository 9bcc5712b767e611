"""What a block of Katz's model holds at a time, and that its bigrams are those of its texts."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from tallywright.llm import katz


def block_row(monkeypatch, texts, held):
    monkeypatch.setattr(katz, "TaskContext", type("T", (), {"get": lambda: type("P", (), {"partitionId": lambda self: 0})()}))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()), pa.array(held)], names=["id", "t", "h"]
    )
    (made,) = katz._to_blocks(iter([batch]))
    row = {n: made.column(n)[0].as_py() for n in made.schema.names if n != "ids"}
    hashes = np.frombuffer(row["hashes"], np.uint64)
    row["answers"] = [{"bucket": 0, "ranks": katz.pack(np.arange(len(hashes))), "counts": row["counts"]}]
    return row


def test_bigrams_of_a_block(monkeypatch):
    texts, held = ["a b a b", None, "b", "a a a", ""], [False, False, True, False, True]
    row = block_row(monkeypatch, texts, held)
    block = katz.Block(row, {0: 0}, inverse=True)
    rank = {int(x): k for k, x in enumerate(np.frombuffer(row["hashes"], np.uint64))}
    number = {w: rank[katz.xxhash.xxh64_intdigest(w, 7)] for w in (b"a", b"b", katz.END)}
    start, seen, every = len(number), Counter(), []
    for text, out in zip(texts, held):
        words = [start, *(number[w] for w in (text or "").encode().split()), number[katz.END]]
        every += zip(words, words[1:])
        seen.update({} if out else zip(words, words[1:]))
    got = list(zip(block.before.tolist(), block.word.tolist()))
    assert sorted(got) == sorted(set(every)) and dict(zip(got, block.times.tolist())) == {g: seen[g] for g in got}
    assert [got[k] for k in block.inverse] == every


def test_a_block_is_asked_about_in_few_bytes_a_token(monkeypatch):
    random.seed(1)
    texts = [" ".join(str(int(random.paretovariate(0.6))) for _ in range(1000)) for _ in range(300)]
    row = block_row(monkeypatch, texts, [k % 7 == 2 for k in range(300)])
    batch = pa.RecordBatch.from_pylist([row])
    tracemalloc.start()
    for _ in katz._ask_bigrams({0: 0}, 20, 1e9)(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50 * 301_000
