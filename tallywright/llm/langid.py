"""Language of texts and of the spans inside them.

Words end where the script changes, too. A word's script narrows the languages it can belong to; among
these it is scored by its letter trigrams, word ends included, and the others are out of the question.
A word in a script of no learned language says nothing. Viterbi over the words, with a penalty for
each change of language, labels spans; a text's language is the one most of its letters are labelled
with, and its score their share of all letters, those that say nothing included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import letters

BITS = 16  # trigrams are counted in 2**16 cells: the model has that many numbers a language
MOST_LANGS = 1024
SWITCH = 12.0  # log-probability a change of language costs
SMOOTH = 0.5
OWN_SHARE = 0.5  # of a text's letters that stand in a learned language's own script, for ``accepted``
SCRIPT_SHARE = 0.002  # of a language's letters, for a script to count as its own
AT_ONCE = 1 << 20  # characters scored at a time
UNKNOWN = "und"


def _cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cell, end-of-word flag, script-change flag, script, is-letter, text starts) for every character position.

    A position's trigram is the character and the two before it, all lower-case, where anything that
    is no letter counts as a word's edge, as does a letter of another script; it belongs to the word that
    it is in or has just ended. A word that ends at a letter of another script has no trigram for its end.
    """
    codes, starts = letters.points(texts)
    lower, script = letters.tables()
    small, kind = lower[codes], script[codes]
    a = np.concatenate(([0], small[:-1]))
    b = np.concatenate(([0, 0], small[:-2]))[: len(small)]
    # Marks of script changes: a letter after a letter of another script.
    before = np.concatenate(([letters.NONE], kind[:-1]))
    parted = (small != 0) & (a != 0) & (kind != before)
    second = np.concatenate(([False], parted[:-1]))
    a[parted] = 0
    b[(a == 0) | second] = 0
    mixed = (small.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (
        a.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    ) ^ (b.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    cell = (mixed >> np.uint64(64 - BITS)).astype(np.int32)
    letter = small != 0
    ended = (np.concatenate(([0], small[:-1])) != 0) & ~letter
    return cell, ended, parted, kind, letter, starts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's cells: (lang, kind, cell, count); kind 0 a trigram, 1 a script's letters."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in set(langs):
            mine = [t for t, x in zip(texts, langs) if x == lang and t]
            cells, scripts = sums.setdefault(lang, (np.zeros(1 << BITS, np.int64), np.zeros(256, np.int64)))
            for a, b in letters.groups(mine, AT_ONCE):
                cell, ended, _, script, letter, _ = _cells(mine[a:b])
                cells += np.bincount(cell[letter | ended], minlength=1 << BITS)
                scripts += np.bincount(script, minlength=256)
    for lang, kinds in sums.items():
        for kind, counts in enumerate(kinds):
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), kind, np.int32)),
                 pa.array(at.astype(np.int32)), pa.array(counts[at])],
                names=["lang", "kind", "cell", "count"],
            )


class Model:
    """Log-probabilities of trigram cells and the languages each script may belong to."""

    def __init__(self, rows: list):
        self.langs = sorted({r["lang"] for r in rows})
        place = {x: k for k, x in enumerate(self.langs)}
        counts = np.zeros((1 << BITS, len(self.langs)))
        scripts = np.zeros((256, len(self.langs)))
        for r in rows:
            (scripts if r["kind"] else counts)[r["cell"], place[r["lang"]]] = r["count"]
        used = np.count_nonzero(counts.sum(axis=1)) + 1
        self.scores = np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * used)).astype(np.float32)
        scripts[letters.NONE] = 0
        shares = scripts / np.maximum(scripts.sum(axis=0), 1)
        allowed = shares >= SCRIPT_SHARE
        self.own = allowed.any(axis=1)
        allowed[~self.own] = True  # nobody's script narrows nothing
        self.barred = np.where(allowed, 0, -np.inf).astype(np.float32)
        self.first = int(np.argmax(counts.sum(axis=0))) if self.langs else 0


def _words(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(scores by word and language, letters by word, whether its script is learned, end of each word, words before each text)."""
    cell, ended, parted, script, letter, starts = _cells(texts)
    kept = np.flatnonzero(letter | ended)
    ends = np.flatnonzero(ended | parted)
    # The position after a word belongs to it as its edge, but for a letter of another script.
    whole = ended[ends]
    bounds = np.searchsorted(kept, ends, "left") + whole
    scored = model.scores[cell[kept]]
    first = np.concatenate(([0], bounds[:-1])).astype(np.int64) if len(bounds) else bounds
    scores = np.add.reduceat(scored, first, axis=0) if len(first) else np.zeros((0, len(model.langs)), np.float32)
    kind = script[ends - 1]
    own = model.own[kind]
    scores[~own] = 0
    scores += model.barred[kind]
    return scores, bounds - first - whole, own, ends, np.searchsorted(ends, starts)


def viterbi(scores: np.ndarray, firsts: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word; words of text k are rows firsts[k] to firsts[k + 1].

    All texts go step by step together, longest first, so the work is that of the words there are.
    """
    total, langs = scores.shape
    labels = np.zeros(total, np.int32)
    if langs < 2 or not total:
        return labels
    sizes = np.diff(firsts)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    begin, length = firsts[order], sizes[order]
    active = np.searchsorted(-length, -np.arange(length[0]), "left")  # texts longer than k words
    back = np.full((total, langs), -1, np.int16)
    value = scores[begin].astype(np.float64)
    for k in range(1, length[0]):
        n = active[k]
        rows, here = begin[:n] + k, value[:n]
        top = here.argmax(axis=1)
        change = (here.max(axis=1) - penalty)[:, None]
        moved = change > here
        if moved.any():
            back[rows] = np.where(moved, top[:, None], -1)
            here = np.where(moved, change, here)
        value[:n] = here + scores[rows]
    label = value.argmax(axis=1).astype(np.int32)
    for k in range(length[0] - 1, -1, -1):
        n = active[k]
        rows = begin[:n] + k
        labels[rows] = label[:n]
        came = back[rows, label[:n]]
        label[:n] = np.where(came >= 0, came, label[:n])
    return labels


def label_words(model: Model, texts: list[str], penalty: float):
    """(label, letters, end in characters of its text, text, whether its script is learned) of every word of ``texts``, in order."""
    parts, firsts, sizes, ends, known = [], [np.zeros(1, np.int64)], [], [], []
    total = 0
    for a, b in letters.groups(texts, AT_ONCE):
        starts = letters.points(texts[a:b])[1]
        scores, size, own, end, first = _words(model, texts[a:b])
        known.append(own)
        parts.append(scores)
        sizes.append(size)
        ends.append(end - np.repeat(starts[:-1], np.diff(first)))
        firsts.append(first[1:] + total)
        total += len(size)
    first = np.concatenate(firsts)
    if not parts:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, np.zeros(0, bool)
    labels = viterbi(np.concatenate(parts), first, penalty)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    return labels, np.concatenate(sizes), np.concatenate(ends), owner, np.concatenate(known)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all rows of ``docs`` that have a text and a language.

    At most 2**16 cells and 256 scripts for each of up to ``MOST_LANGS`` languages reach the driver,
    whatever the size of the table; every task sums its own rows first. No rows give a model without
    languages.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text is not null and lang is not null"
    )
    parts = known.mapInArrow(_count, "lang string, kind int, cell int, count bigint")
    summed = parts.groupBy("lang", "kind", "cell").agg(F.sum("count").alias("count"))
    names = [r["lang"] for r in summed.select("lang").distinct().limit(MOST_LANGS + 1).collect()]
    if len(names) > MOST_LANGS:
        raise ValueError(f"over {MOST_LANGS} languages: is the column a language?")
    return Model(summed.collect())


def _apply(docs: DataFrame, model: Model, id: str, text: str, make, schema: str) -> DataFrame:
    chosen = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    most = max(AT_ONCE, (1 << 25) // max(4, len(model.langs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in letters.groups(texts, most):
                yield make(shared.value, batch.column(0).slice(a, b - a), [t or "" for t in texts[a:b]])

    kind = chosen.schema["__id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"`{id}` {kind}, {schema}")


def decide(model: Model, texts: list[str], penalty: float) -> tuple[list[str], np.ndarray]:
    """The language and its share of the letters, text by text; letters in no learned script are none of its."""
    count = len(model.langs)
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if count:
        labels, sizes, _, owner, own = label_words(model, texts, penalty)
        sums = np.bincount(owner * count + labels, sizes * own, len(texts) * count).reshape(-1, count)
        totals, best = np.bincount(owner, sizes, len(texts)), sums.argmax(axis=1)
        some = totals > 0
        scores[some] = sums[some, best[some]] / totals[some]
        names = [model.langs[k] if ok else UNKNOWN for k, ok in zip(best, some)]
    return names, scores


def own_share(model: Model, texts: list[str], penalty: float) -> tuple[np.ndarray, list[str]]:
    """Share of a text's letters in spans whose language is learned in their script, and the language most of these are labelled with.

    Texts without such letters have 0 and ``und``.
    """
    count = len(model.langs)
    if not count:
        return np.zeros(len(texts)), [UNKNOWN] * len(texts)
    labels, sizes, _, owner, own = label_words(model, texts, penalty)
    totals = np.bincount(owner, sizes, len(texts))
    sums = np.bincount(owner * count + labels, sizes * own, len(texts) * count).reshape(-1, count)
    mine = sums.sum(axis=1)
    names = [model.langs[k] if some else UNKNOWN for k, some in zip(sums.argmax(axis=1), mine > 0)]
    return mine / np.maximum(totals, 1), names


def _judged(model: Model, text: Column, share: float, penalty: float, spark: SparkSession) -> Column:
    """The language of a text that is accepted, NULL of others."""
    shared = spark.sparkContext.broadcast(model)
    most = max(AT_ONCE, (1 << 25) // max(4, len(model.langs)))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            kept: list[str | None] = []
            for a, b in letters.groups(texts, most):
                shares, names = own_share(shared.value, texts[a:b], penalty)
                kept += [x if y >= share and y > 0 else None for x, y in zip(names, shares)]
            yield pa.array(kept, pa.string())

    # Not deterministic to Spark, which else runs it twice: for the rows that stay and for their language.
    return F.arrow_udf(run, "string").asNondeterministic()(text)


def accepted(
    docs: DataFrame, model: Model, text: str = "text", share: float = OWN_SHARE, penalty: float = SWITCH
) -> DataFrame:
    """The rows with at least ``share`` of their letters in spans of learned languages, all columns kept.

    Spans are those of ``language_spans``; a span in a script that its language is not written in
    belongs to none. Rejected are NULL, empty and letter-free texts and those mostly in other
    scripts. A text may spread over any number of learned languages. A model without languages
    accepts nothing.
    """
    return docs.where(_judged(model, F.col(text), share, penalty, docs.sparkSession).isNotNull())


def identified(
    docs: DataFrame, model: Model, text: str = "text", lang: str = "lang", share: float = OWN_SHARE, penalty: float = SWITCH
) -> DataFrame:
    """The rows that ``accepted`` keeps, ``lang`` being the language that most of a text's letters are labelled with.

    What ``lang`` said before is replaced, also NULL. Equal parts go to the first name.
    """
    found = docs.withColumn("__lang", _judged(model, F.col(text), share, penalty, docs.sparkSession))
    names = [F.col("__lang").alias(lang) if c == lang else F.col(f"`{c}`") for c in docs.columns]
    return found.where("__lang is not null").select(*names)


def predict(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", penalty: float = SWITCH) -> DataFrame:
    """(id, lang_pred, score): the language most letters are labelled with, and its share of them.

    ``und`` and 0 for NULL, empty and letter-free texts, and for a model without languages; equal
    shares go to the first name. A text wholly in scripts of no learned language gets a learned name
    with score 0. One row for each row, repeats included; an empty table gives an
    empty one; other columns are left out. Texts are read whole, in one pass without a shuffle.
    """

    def make(model: Model, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        names, scores = decide(model, texts, penalty)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(names, pa.string()), pa.array(scores)], names=[id, "lang_pred", "score"]
        )

    return _apply(docs, model, id, text, make, "lang_pred string, score double")


def language_spans(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", penalty: float = SWITCH) -> DataFrame:
    """(id, start, end, lang): stretches of words with one label, in code points, end exclusive.

    A text without letters has none.
    """

    def make(model: Model, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        labels, sizes, ends, owner = label_words(model, texts, penalty)[:4] if model.langs else (np.zeros(0, np.int64),) * 4
        new = np.ones(len(labels), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (labels[1:] != labels[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(labels)) - 1 if len(first) else first
        columns = [
            ids.take(pa.array(owner[first])), pa.array((ends - sizes)[first]), pa.array(ends[last]),
            pa.array([model.langs[k] for k in labels[first]], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[id, "start", "end", "lang"])

    return _apply(docs, model, id, text, make, "start bigint, `end` bigint, lang string")
