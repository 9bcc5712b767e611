"""Toxicity of texts whose insults may be disguised.

A noisy channel explains a disguised token: letters were replaced by look-alikes, drawn out, or set
apart by blanks and signs. Its possible readings form a lattice of characters; Viterbi under a
letter trigram model picks the likeliest readings. The restored words, next to the plain ones, are scored by
words and word beginnings that mark toxic documents, and the sum is turned into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm import letters
from tallywright.sources.scratch import stored

CELLS = 1 << 16
# What a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l",
    "*": "aeiou", "#": "aeiou",
}
READ_COST = 1.0  # a look-alike read as a letter
WILD_COST = 3.0  # a masking sign read as one of its letters
DROP_COST = 1.5  # a sign that stands for nothing
DROP_READABLE_COST = 6.0  # the same, if it could stand for a letter
KEEP_COST = 6.0  # a sign that is no disguise: the word ends there
SHORTEN_COST = 0.5  # a drawn-out letter written once or twice
BREAK_COST = 0.5  # a gap between short pieces read as a word's end, or as none if others are narrower
WIDE_COST = 3.0
READINGS = 6  # of a window, the best ones, within this of the best
WITHIN = 8.0
EDGES = " \t.,;:?!\"'()[]{}<>"
LETTER = r"[^\W\d_]"
WORD = re.compile(rf"{LETTER}+")
SIGN = re.compile(r"[@$!|+(€£*#]")  # look-alikes that are no digits
# A short piece is one character, also drawn out, or two of which one is a digit.
PIECES = [rf"(?:([^\W_])\{k}*+|[^\W_][0-9]|[0-9][^\W_])(?![^\W_])" for k in (1, 2)]
SPELLED = re.compile(rf"(?<![^\W_]){PIECES[0]}(?:[\W_]++{PIECES[1]})*")
SIGNS = re.compile(rf"[0-9@$!|+(€£*#_.\-](?:(?={LETTER})|(?<={LETTER}[0-9@$]))")
DRAWN_OUT = re.compile(rf"({LETTER})\1\1")
BLANK = re.compile(r"\s")
GAP = re.compile(r"[\W_]+")
STEMS = (4, 5)
WINDOW = 128  # steps of the lattice decoded at a time; longer stretches in windows, each half new
KNOWN = 1024  # characters: readings of longer windows are not kept
PART = re.compile(r"[a-z\u00df-\u024f0-9@$!|+(\u20ac\u00a3*#]+")  # what look-alikes may be part of
SAME = re.compile(r"(.)\1*", re.DOTALL)
PIECE_OR_GAP = re.compile(r"[^\W_]+|[\W_]+")
LABELLED_ROWS = 200_000  # labelled ids the marks are learnt from: 16 bytes each are broadcast
CALIBRATE_ROWS = 20_000  # labelled rows the probability's two numbers are fitted on
MOST_FEATURES = 100_000  # of the highest evidence: the model's size
CACHE = 200_000


def _cell(c: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = (c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (
        a.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    ) ^ (b.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(48)).astype(np.int64)


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task: trigrams (cells from 0) and their contexts (cells from 2**16)."""
    sums = np.zeros(2 * CELLS, np.int64)
    lower, _ = letters.tables()
    none = np.zeros(1, np.uint32)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for x, y in letters.groups(texts, 1 << 20):
            small = lower[letters.points([t or "" for t in texts[x:y]])[0]]
            a = np.concatenate((none, small[:-1]))
            b = np.concatenate((none, none, small[:-2]))[: len(small)]
            b = np.where(a == 0, 0, b)
            kept = (small != 0) | (a != 0)
            sums[:CELLS] += np.bincount(_cell(small, a, b)[kept], minlength=CELLS)
            sums[CELLS:] += np.bincount(_cell(np.zeros_like(a), a, b)[kept], minlength=CELLS)
    at = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["cell", "count"])


class Letters:
    """Log-probability of a letter (0: the word's end) after the two before it."""

    def __init__(self, sums: np.ndarray):
        self.sums = sums
        self.known: dict[tuple[int, int, int], float] = {}

    def score(self, b: int, a: int, c: int) -> float:
        key = (b, a, c)
        found = self.known.get(key)
        if found is None:
            one = [np.array([x], np.uint64) for x in (c, a, b if a else 0)]
            count = self.sums[_cell(*one)[0]]
            context = self.sums[CELLS + _cell(np.zeros(1, np.uint64), one[1], one[2])[0]]
            found = self.known[key] = math.log((count + 0.05) / (context + 5.0))
        return found


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of one character its readings and their costs; a blank ends a word."""
    steps, at = [], 0
    while at < len(token):
        c = token[at]
        end = at + 1
        while end < len(token) and token[end] == c:
            end += 1
        count = end - at
        if c.isalpha():
            options = [(c * count, 0.0)]
            if count > 2:
                options += [(c, SHORTEN_COST), (c * 2, SHORTEN_COST)]
        else:
            options = [("", DROP_READABLE_COST if c in LOOKALIKES else DROP_COST), (" ", KEEP_COST)]
            cost = WILD_COST if c in "*#" else READ_COST
            for x in LOOKALIKES.get(c, ""):
                options += [(x * k, cost * k) for k in {1, min(count, 2)}]
        steps.append(options)
        at = end
    return steps


def _piece_lattice(pieces: list[str], k: int) -> list[list[tuple[str, float]]]:
    steps = _lattice(pieces[k])
    same = [set(x) == set(pieces[k]) for x in pieces[max(0, k - 2) : k + 3]]
    here = min(k, 2)
    if here and len(steps) == 1 and same[here - 1] and (any(same[: here - 1]) or any(same[here + 1 : here + 2])):
        steps[0].append(("", SHORTEN_COST))
    return steps


def _spelled_lattice(run: str) -> list[list[tuple[str, float]]]:
    """The same for short pieces with gaps between: each gap is read as none or as a word's end.

    Where gaps differ in width the narrow ones rather join and the wider ones rather part. A sign in
    a gap may also be a look-alike. Pieces of one letter drawn out over three or more may be fewer.
    """
    gaps = list(GAP.finditer(run))
    narrow = min((len(m[0]) for m in gaps), default=0)
    pieces = GAP.split(run)
    steps = []
    for k, m in enumerate(gaps):
        steps += _piece_lattice(pieces, k)
        wide = len(m[0]) > narrow and not SIGN.search(m[0])
        gap = [("", WIDE_COST), (" ", 0.0)] if wide else [("", 0.0), (" ", BREAK_COST)]
        apart = True
        for c in dict.fromkeys(m[0]):
            if SIGN.match(c):
                options = _lattice(c)[0]
                steps.append([("", DROP_COST), *options[2:]])
                apart = True
            elif apart:
                steps.append(gap)
                apart = False
    return steps + _piece_lattice(pieces, len(gaps))


def readings(token: str, model: Letters, spelled: bool = False) -> list[str]:
    """The likeliest readings of a lower-case token, best first; blanks set words in it apart.

    A ``spelled`` token is a run of short pieces with blanks or signs between. The best ``READINGS`` are
    exact: for each pair of last letters, which is all that the letter model looks back on, as many are kept.
    """
    beam: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
    for options in [*(_spelled_lattice if spelled else _lattice)(token), [(" ", 0.0)]]:
        reached: dict[tuple[int, int], dict[str, float]] = {}
        for (b, a), paths in beam.items():
            for reading, cost in options:
                y, x, gain = b, a, -cost
                for c in reading:
                    code = 0 if c == " " else ord(c)
                    if code or x:
                        gain += model.score(y, x, code)
                    y, x = (x, code) if code else (0, 0)
                ends = reached.setdefault((y, x), {})
                for value, text in paths:
                    text += reading
                    if ends.get(text, -math.inf) < value + gain:
                        ends[text] = value + gain
        beam = {
            state: sorted(((v, t) for t, v in ends.items()), reverse=True)[:READINGS]
            for state, ends in reached.items()
        }
    # The last reading is a blank, after which there is one state.
    (paths,) = beam.values()
    return [t.strip() for v, t in paths if v > paths[0][0] - WITHIN]


def spelled_runs(small: str) -> Iterator[str]:
    """Runs of two or more short pieces, with the look-alike signs that stand apart beside them.

    A run of digits alone is a number and no word in disguise.
    """
    for m in SPELLED.finditer(small):
        a, b = m.span()
        while a and not small[a - 1].isalnum():
            a -= 1
        while b < len(small) and not small[b].isalnum():
            b += 1
        # Signs without a blank to a longer word beside the run belong to that word.
        before, after = small[a : m.start()], small[m.end() : b]
        if a:
            blank = BLANK.search(before)
            before = before[blank.end() :] if blank else ""
        if b < len(small):
            after = after[: max([0, *(x.start() for x in BLANK.finditer(after))])]
        run = (before + m[0] + after).strip()
        if SIGN.search(run) or (GAP.search(run.strip(EDGES)) and WORD.search(run)):
            yield run


class Reader:
    """The distinct words of a text, plain and restored."""

    def __init__(self, model: Letters):
        self.model = model
        self.cache: dict[tuple[str, bool, tuple[bool, bool]], tuple[str, ...]] = {}

    def _read(self, token: str, spelled: bool = False, cut: tuple[bool, bool] = (False, False)) -> tuple[str, ...]:
        """Words of a window's readings; at a cut only a long word's beginning, no end, is a word."""
        key = token, spelled, cut
        found = self.cache.get(key)
        if found is None:
            words = set()
            for t in readings(token, self.model, spelled):
                for m in WORD.finditer(t):
                    torn = cut[1] and m.end() == len(t) and m.end() - m.start() < WINDOW // 4
                    if not (torn or cut[0] and m.start() == 0):
                        words.add(m[0])
            found = tuple(words)
            if len(token) <= KNOWN:
                if len(self.cache) > CACHE:
                    self.cache.clear()
                self.cache[key] = found
        return found

    def _read_all(self, token: str, spelled: bool = False) -> Iterator[str]:
        """Words of the whole token: a word of less than ``WINDOW`` / 2 steps is inside some window."""
        if len(token) <= WINDOW:
            yield from self._read(token, spelled)
            return
        starts = [m.start() for m in (PIECE_OR_GAP if spelled else SAME).finditer(token)] + [len(token)]
        count = len(starts) - 1
        for at in range(0, max(1, count - WINDOW // 2), WINDOW // 2):
            end = min(count, at + WINDOW)
            piece = token[starts[at] : starts[end]]
            if spelled or SIGNS.search(piece) or DRAWN_OUT.search(piece):
                yield from self._read(piece, spelled, (at > 0, end < count))

    def words(self, text: str | None) -> set[str]:
        if not text:
            return set()
        small = text.lower()
        found = set(WORD.findall(small))
        for run in spelled_runs(small):
            found.update(self._read_all(run, True))
        for trigger in (SIGNS, DRAWN_OUT):
            done = 0
            for m in trigger.finditer(small):
                if m.start() < done:
                    continue
                begin = m.start()
                while begin > done and not small[begin - 1].isspace():
                    begin -= 1
                end = BLANK.search(small, m.end())
                done = end.start() if end else len(small)
                token = small[begin:done].strip(EDGES)
                found.update(self._read_all(token))
                # Signs and letters that no look-alike stands for also part words.
                for part in PART.findall(token):
                    part = part.strip(EDGES)
                    if len(part) < len(token) and (SIGNS.search(part) or DRAWN_OUT.search(part)):
                        found.update(self._read_all(part))
        return found


def features(words: set[str]) -> set[str]:
    """Words, and beginnings marked by a dash."""
    return words | {w[:n] + "-" for w in words for n in STEMS if len(w) > n}


class Model:
    def __init__(self, lm: Letters, weights: dict[str, float], scale: tuple[float, float, float]):
        self.letters, self.weights, self.scale = lm, weights, scale

    def evidence(self, words: set[str], cache: dict[str, float]) -> float:
        """The sum over distinct words of each one's strongest mark."""
        total, get = 0.0, self.weights.get
        for w in words:
            value = cache.get(w)
            if value is None:
                if len(cache) > CACHE:
                    cache.clear()
                value = cache[w] = max(get(w, 0.0), *(get(w[:n] + "-", 0.0) for n in STEMS))
            total += value
        return total

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        a, b, c = self.scale
        return 1 / (1 + np.exp(-(a + b * (evidence > 0) + c * np.log1p(evidence))))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge-regularised logistic regression by Newton's method."""
    rows = np.stack([np.ones(len(x)), x > 0, np.log1p(x)], axis=1)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-rows @ w))
        grad = rows.T @ (y - p) - 0.1 * w
        hess = (rows * (p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _count_features(lm: Letters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lm)
        for batch in batches:
            sums: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                sums[label].update(features(reader.words(text.as_py())))
            names = list(sums[0] | sums[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([s[n] for n in names], pa.int64()) for s in sums)],
                names=["feature", "clean", "toxic"],
            )

    return run


def labelled_texts(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    rows: int = LABELLED_ROWS,
) -> DataFrame:
    """(text, label) of the documents among about ``rows`` labelled ids, chosen by a hash of the id.

    So many ids and labels at most are sent to the documents, whose texts are not shuffled. An id
    labelled twice has the larger label.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(id).agg(F.max(label).alias(label))
    share = min(1.0, rows / max(1, known.count()))
    picked = known.where(F.pmod(F.xxhash64(id), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.select(id, text).join(F.broadcast(picked), id).select(text, label)


def fit(
    texts: DataFrame, labelled: DataFrame, text: str = "text", label: str = "toxic",
    most_features: int = MOST_FEATURES, calibrate_rows: int = CALIBRATE_ROWS,
) -> Model:
    """A letter model of all ``texts`` and marks from all ``labelled`` rows (text, 0 or 1).

    A feature's evidence is the log-likelihood its rate of toxic documents gains over the rate of
    all; it must exceed the log of the number of features, so that chance makes no marks. 2 * 2**16
    counts and at most ``most_features`` marks, those with the highest evidence, reach the driver; the
    probability's two numbers are fitted on about ``calibrate_rows`` rows, chosen by a hash of the text. Rows with a NULL label say nothing;
    NULL texts hold no words. Without labels of both kinds every text scores the same.
    """
    sums = np.zeros(2 * CELLS, np.int64)
    parts = texts.select(F.col(text).alias("t")).mapInArrow(_count_letters, "cell int, count bigint")
    for r in parts.groupBy("cell").agg(F.sum("count").alias("count")).collect():
        sums[r["cell"]] = r["count"]
    lm = Letters(sums)
    known = labelled.select(F.col(text).alias("t"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not clean or not toxic:
        return Model(lm, {}, (math.log((toxic + 0.5) / (clean + 0.5)), 0.0, 0.0))
    counted = (
        known.mapInArrow(_count_features(lm), "feature string, clean bigint, toxic bigint")
        .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    base = toxic / (clean + toxic)
    rate = (F.col("toxic") + base) / (F.col("toxic") + F.col("clean") + 1)
    gain = F.col("toxic") * F.log(rate / base) + F.col("clean") * F.log((1 - rate) / (1 - base))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    seen = stored(counted.where("toxic > 0").select("feature", gain.alias("gain"), weight.alias("weight")), "marks")
    total = seen.count()
    marks = (
        seen.where((F.col("gain") > math.log(total + 1)) & (F.col("weight") > 1))
        .orderBy(F.desc("gain"), "feature").limit(most_features).collect()
    )
    model = Model(lm, {r["feature"]: r["weight"] for r in marks}, (0.0, 0.0, 0.0))
    share = min(1.0, calibrate_rows / (clean + toxic))
    picked = known.where(F.pmod(F.xxhash64("t", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    pairs = picked.select(_evidence(picked, model, "t").alias("x"), "y").collect()
    x, y = np.array([r["x"] for r in pairs]), np.array([r["y"] for r in pairs], np.float64)
    model.scale = _logistic(x, y) if len(x) else (math.log(base), 0.0, 0.0)
    return model


def _evidence(df: DataFrame, model: Model, text: str):
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, cache = shared.value, {}
        reader = Reader(model.letters)
        for batch in batches:
            yield pa.array([model.evidence(reader.words(x.as_py()), cache) for x in batch], pa.float64())

    return F.arrow_udf(run, "double")(F.col(text))


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, predicted) of every row: the probability of being toxic, and whether it is 0.5.

    NULL and empty texts score as texts without any mark. Rows are kept one for one, repeats
    included; an empty table gives an empty one; other columns are left out. Texts are read whole,
    in one pass without a shuffle.
    """
    a, b, c = (F.lit(v) for v in model.scale)
    x = F.col("x")
    value = 1 / (1 + F.exp(-(a + b * (x > 0).cast("double") + c * F.log1p(x))))
    return (
        docs.select(F.col(id), _evidence(docs, model, text).alias("x"))
        .select(id, value.alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )
