"""Benchmark items found in documents, whole or with few edits.

Texts are compared as lower-case letters and digits with single spaces, and one space at either end of
an item and of a text, so that an item stands between word edges or pays for it. An item of n
characters may be off by ``rate`` * n edits, those spaces' included. Cut into one piece more than that, at least one piece must stand
unchanged in any such copy; an automaton over all pieces reads each whole document once, and every
hit's surroundings are verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallywright.sources.scratch import stored

RATE = 0.08
BLOCK_CHARS = 4_000_000  # benchmark characters one pass over the documents looks for
WHOLE_WORDS = 3  # items of fewer words must be a whole line or text
OTHER = re.compile(r"[\W_]+")


def normal(text: str) -> str:
    return OTHER.sub(" ", text.lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): ``budget`` + 1 pieces whose lengths differ by at most one."""
    count = min(budget + 1, len(item))
    cuts = [len(item) * k // count for k in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' automaton of one text; Python's integers are its bit vectors, of any length."""

    def __init__(self, item: str):
        self.item, self.size = item, len(item)
        self.masks: dict[str, int] = {}
        for k, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << k

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the substring of ``text`` nearest to the item, the first of equals."""
        full = (1 << self.size) - 1
        top = 1 << self.size - 1
        plus, minus, score = full, 0, self.size
        best, end = self.size, 0
        get = self.masks.get
        for at, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            hp = minus | (full & ~(xh | plus))
            hm = plus & xh
            if hp & top:
                score += 1
            elif hm & top:
                score -= 1
                if score < best:
                    best, end = score, at
            hp = hp << 1 & full
            hm = hm << 1 & full
            plus = hm | (full & ~(xv | hp))
            minus = hp & xv
        return best, end


class Matcher:
    """All items of a block, ready to be looked for."""

    def __init__(self, items: list[tuple[object, str]], rate: float, whole_words: int = WHOLE_WORDS):
        self.items: list[tuple[object, Pattern, int]] = []
        self.whole: dict[str, list[object]] = {}
        owners: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            item = normal(text or "")
            if not item:
                continue
            if item.count(" ") + 1 < whole_words:
                self.whole.setdefault(item, []).append(key)
                continue
            budget = int(len(item) * rate)
            number = len(self.items)
            self.items.append((key, Pattern(f" {item} "), budget))
            for offset, piece in pieces(f" {item} ", budget):
                owners.setdefault(piece, []).append((number, offset))
        self.find = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.find.add_word(piece, (len(piece), where))
        self.any = bool(owners)
        if self.any:
            self.find.make_automaton()

    def matches(self, text: str | None) -> list[tuple[object, int, int]]:
        """(key, edits, end in the normal text) of each item within its budget, at its best place."""
        if not text:
            return []
        line = normal(text)
        found = self._lines(text, line) if self.whole else []
        if not self.any:
            return found
        padded = f" {line} "
        starts: dict[int, set[int]] = {}
        for last, (size, where) in self.find.iter(padded):
            for number, offset in where:
                starts.setdefault(number, set()).add(last + 1 - size - offset)
        for number, places in starts.items():
            key, pattern, budget = self.items[number]
            ordered = sorted(places)
            # Exact copies need no alignment.
            exact = next((p for p in ordered if p >= 0 and padded.startswith(pattern.item, p)), None)
            best = (budget + 1, 0) if exact is None else (0, exact + pattern.size)
            begin = ordered[0]
            for k, place in enumerate(ordered):
                # Windows that overlap are one; all places of the item are looked at.
                if exact is not None or k + 1 < len(ordered) and ordered[k + 1] - place <= pattern.size:
                    continue
                low = max(0, begin - budget)
                distance, end = pattern.best(padded[low : place + pattern.size + budget])
                best = min(best, (distance, low + end))
                begin = ordered[k + 1] if k + 1 < len(ordered) else 0
            if best[0] <= budget:
                # The text's first space and the match's last one are not in the normal text.
                found.append((key, best[0], max(0, min(len(line), best[1] - 2))))
        return found

    def _lines(self, text: str, line: str) -> list[tuple[object, int, int]]:
        """Items of few words that are the whole text or a line of it, at the first such line's end."""
        found, end = {}, 0
        for one in text.splitlines():
            one = normal(one)
            if one:
                end += len(one) + (end > 0)
                found.setdefault(one, end)
        found[line] = found.get(line, len(line))
        return [(key, 0, found[item]) for item, keys in self.whole.items() if item in found for key in keys]


def _blocks(benchmark: DataFrame, item: str, text: str) -> list[DataFrame]:
    """(item, text, times) in blocks of about ``BLOCK_CHARS``, cut by a hash; repeats are one item."""
    benchmark = benchmark.groupBy(item, text).agg(F.count(F.lit(1)).alias("__times"))
    total = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    count = max(1, -(-2 * total // BLOCK_CHARS)) if total > BLOCK_CHARS else 1
    block = F.pmod(F.xxhash64(item, text), F.lit(count))
    return [benchmark.where(block == k) for k in range(count)]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", rate: float = RATE, whole_words: int = WHOLE_WORDS,
) -> DataFrame:
    """(id, item, edits, end): every document row and every benchmark item it holds.

    An item begins and ends at word edges; each edge inside a word counts as an edit. One of fewer than
    ``whole_words`` words must be a whole line or text without edits. Item ids are of any type.

    ``end`` is where the best match ends in the document's normal text. NULL and empty texts on
    either side hold nothing and match nothing, and so do items without a letter or digit. Repeated
    documents give repeated rows, repeated items one row each; empty tables give an empty one. Other
    columns are left out. Very long texts are read whole, in time linear in their length.

    One pass over the documents for each block of the benchmark and no shuffle of documents; a block
    is what the driver holds and sends, so its size is bounded whatever the benchmark's. With more
    than one block, the result of each is stored before the next is collected.
    """
    chosen = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    kinds = chosen.schema["__id"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"`{id}` {kinds[0]}, `{item}` {kinds[1]}, edits int, `end` bigint"
    found = None
    blocks = _blocks(benchmark, item, item_text)
    for block in blocks:
        items = [((r[0], r[2]), r[1]) for r in block.select(item, item_text, "__times").collect()]
        part = chosen.mapInArrow(_search(items, rate, whole_words, id, item, to_arrow_type(benchmark.schema[item].dataType)), schema)
        if len(blocks) > 1:
            part = stored(part, "found")
        found = part if found is None else found.unionByName(part)
    return found


def _search(
    items: list[tuple[tuple[object, int], str]], rate: float, whole_words: int, id: str, item: str, kind: pa.DataType
):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, rate, whole_words)
        for batch in batches:
            rows, keys, edits, ends = [], [], [], []
            for k, value in enumerate(batch.column(1)):
                for (key, times), distance, end in matcher.matches(value.as_py()):
                    rows += [k] * times
                    keys += [key] * times
                    edits += [distance] * times
                    ends += [end] * times
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(keys, kind), pa.array(edits, pa.int32()), pa.array(ends, pa.int64())],
                names=[id, item, "edits", "end"],
            )

    return run


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    rate: float = RATE, whole_words: int = WHOLE_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns and repeats kept."""
    kept = docs
    blocks = _blocks(benchmark.select(F.lit(0).alias(item), item_text), item, item_text)
    for block in blocks:
        items = [tuple(r) for r in block.select(item, item_text).collect()]
        kept = kept.where(~F.arrow_udf(_holds(items, rate, whole_words), "boolean")(F.col(text)))
        if len(blocks) > 1:
            kept = stored(kept, "kept")
    return kept


def _holds(items: list[tuple[object, str]], rate: float, whole_words: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(items, rate, whole_words)
        for batch in batches:
            yield pa.array([bool(matcher.matches(x.as_py())) for x in batch], pa.bool_())

    return run
