"""Personal data in texts: fixed patterns, and a character BiLSTM-CRF that finds what they miss.

The tagger is trained on windows of the corpus whose spans the patterns label, and on windows from
anywhere in it into which varied spans are written in other ways, between varied neighbours, beside
numbers that are no personal data. Every stretch of text around a digit or an at-sign is
read in overlapping windows; a character's scores from the windows it is in are averaged, most
weight to the window in whose middle it stands, and one Viterbi pass over the whole stretch decides.
What it finds is added if it does not touch a pattern's span and is well-formed for its kind. Every
form that passes holds a digit or an at-sign, so text far from both cannot hold a span.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.tagger import PAD, Tagger, encode

# The kinds in their order and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Not inside a number: there the pattern fails as it does at the number's first digit.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EMAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
TRIGGER = re.compile(r"[0-9@]+")
BLANK = re.compile(r"\s")
# Forms a span the tagger found must have.
FORMS = {
    "email": re.compile(r"[^\s@]+ ?@ ?[^\s@]+\.[^\s@]*[^\W\d_]"),
    "ip": re.compile(r"[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}"),
    "card": re.compile(r"[0-9](?:[ ./\-]{0,2}[0-9]){12,18}"),
    "phone": re.compile(r"\(?[0-9]{1,4}\)?(?:[ ./()\-]{1,3}[0-9]{2,}){1,6}"),
}
WINDOW = 96  # characters
STRIDE = 48
AT_ONCE = 2048  # windows read together
SAMPLE = 3200  # windows the tagger is trained on
EPOCHS = 11
PLANTED = 2  # windows of each text into which a span is written

Span = tuple[str, int, int, bool]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _email_runs(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of the pattern's characters around each at-sign; no match leaves them."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and EMAIL_RUN.match(text[start - 1]):
            start -= 1
        done = EMAIL_RUN.match(text, at).end()
        yield start, done
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The patterns' spans by kind and start, leftmost and not overlapping within a kind."""
    found: list[Span] = []
    if "@" in text:
        for a, b in _email_runs(text):
            found += [("email", m.start(), m.end(), True) for m in EMAIL.finditer(text, a, b)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end(), True))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end(), True))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", m.start(), m.end(), True))
    return found


def well_formed(kind: str, text: str) -> bool:
    if not FORMS[kind].fullmatch(text):
        return False
    digits = _digits(text)
    if kind == "card":
        return luhn(digits)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    return bool(digits) or kind == "email"


def _labels() -> tuple[int, np.ndarray]:
    """Labels 0 outside, 2k + 1 a span's first character, 2k + 2 its others; what may follow what."""
    count = 2 * len(KINDS) + 1
    allowed = np.ones((count, count), bool)
    for inside in range(2, count, 2):
        allowed[:, inside] = False
        allowed[inside - 1, inside] = allowed[inside, inside] = True
    return count, allowed


def _digits_like(count: int, rng: np.random.Generator) -> str:
    return "".join(map(str, rng.integers(0, 10, count)))


def _card(rng: np.random.Generator) -> str:
    """Digits that pass the check, as many as cards have."""
    body = str(int(rng.integers(1, 10))) + _digits_like(int(rng.choice([11, 13, 14, 14, 14, 17])), rng)
    return next(body + c for c in "0123456789" if luhn(body + c))


def _name(words: list[str], rng: np.random.Generator) -> tuple[str, str]:
    """The two sides of an address, of words of a text or of letters alone."""

    def word() -> str:
        if words and rng.random() < 0.7:
            return words[int(rng.integers(len(words)))].lower()
        return "".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(2, 10))))

    name = word()
    if rng.random() < 0.5:
        name += str(rng.choice([".", "_", "-"])) + word()
    if rng.random() < 0.3:
        name += _digits_like(int(rng.integers(1, 4)), rng)
    host = word() + ("." + word() if rng.random() < 0.3 else "")
    return name, host + "." + str(rng.choice(["com", "org", "net", "io", "de", "fr", "es", "co", "info", word()[:3] + "x"]))


def _accented(word: str, at: int, rng: np.random.Generator) -> str:
    return word[:at] + str(rng.choice(list("éèüöñáçß"))) + word[at + 1 :]


# How many ways a span of each kind is written; the last one is kept out of the training, to measure by.
WAYS = {"email": 5, "ip": 4, "card": 7, "phone": 8}


def reformed(kind: str, way: int, words: list[str], rng: np.random.Generator) -> str:
    """A new span of a kind, written in a way that the patterns miss."""
    if kind == "email":
        name, host = _name(words, rng)
        return [f"{name} @ {host}", f"{name} @{host}", f"{_accented(name, len(name) - 1, rng)}@{host}",
                f"{name}@{_accented(host, int(rng.integers(0, host.index('.'))), rng)}", f"{name}@ {host}"][way]
    if kind == "ip":
        groups = [f"{int(x):x}" for x in rng.integers(0, 65536, 8)]
        if way == 0:
            return ":".join(groups)
        if way == 1:
            return ":".join(g.zfill(4) for g in groups).upper()
        if way == 2:
            return ":".join(groups[: int(rng.integers(2, 5))]) + "::" + ":".join(groups[5 : int(rng.integers(6, 8))])
        return ":".join(groups[: int(rng.integers(5, 8))])
    if kind == "card":
        digits = _card(rng)
        parts = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        if len(digits) == 15 and rng.random() < 0.5:
            parts = [digits[:4], digits[4:10], digits[10:]]
        return [".", "/", "  ", "--", "- ", "..", " -"][way].join(parts)
    d = _digits_like(11, rng)
    if way == 0:
        # Any groups, with one separator.
        cuts, at = [], 0
        while len(d) - at > 4:
            cuts.append(d[at : (at := at + int(rng.integers(2, 5)))])
        first = f"({cuts[0]})" if rng.random() < 0.4 else cuts[0]
        return str(rng.choice([" ", "-", ".", "/"])).join([first, *cuts[1:], d[at:] if len(d) - at > 1 else d[at:] + "0"])
    return ["", f"({d[:3]}) {d[3:6]}-{d[6:10]}", f"{d[:3]}-{d[3:6]}-{d[6:10]}", f"{d[:4]} {d[4:7]} {d[7:10]}", f"0{d[:2]}/{d[2:9]}",
            f"({d[:2]}) {d[2:4]} {d[4:6]} {d[6:8]}", f"{d[:3]} {d[3:6]} {d[6:10]}", f"({d[:3]}){d[3:6]}-{d[6:10]}"][way]


def _other_number(rng: np.random.Generator) -> str:
    """A number that is no personal data: a date, a time, an amount, a version, a range, a code."""
    a, b, c = (int(x) for x in rng.integers(1, 29, 3))
    return [f"{1900 + a * b % 130}-{c:02d}-{b:02d}", f"{a:02d}.{b:02d}.{1990 + c}", f"{a}:{b:02d}:{c:02d}", f"{a} {b:03d} {c * 31:03d}",
            f"{a},{b:03d}.{c:02d}", f"{a}.{b}.{c}", f"{a * 9}-{a * 9 + b}", f"#{a}{b}{c}", f"{a}/{b}/{2000 + c}", f"@{'abcdefgh'[a % 8] * 2}x"][int(rng.integers(10))]


def _written_into(text: str, spans: list[Span], new: str, rng: np.random.Generator) -> tuple[str, int, list[Span]] | None:
    """A window of a text with ``new`` between two of its words, where it begins, and the spans around it."""
    gap = BLANK.search(text, int(rng.integers(len(text) + 1)))
    at = gap.start() if gap else len(text)
    room = max(0, WINDOW - len(new) - 4)
    before = int(rng.integers(0, room + 1))
    a, b = max(0, at - before), min(len(text), at + room - before)
    if any(s < x < e for _, s, e, _ in spans for x in (a, at, b)):
        return None
    head = str(rng.choice([" ", " ", ": ", " (", "\n", ", ", ""] if at > a else [""]))
    tail = str(rng.choice(["", "", ".", ",", ")", ";", " -"]))
    line = text[a:at] + head + new + tail + text[at:b]
    start = at - a + len(head)
    if head == "" and start and line[start - 1].isalnum() or len(line) > WINDOW:
        return None
    more = len(head) + len(new) + len(tail)
    return line, start, [(k, s - a + (more if s >= at else 0), e - a + (more if s >= at else 0), base) for k, s, e, base in spans if a <= s and e <= b]


def planted(text: str, spans: list[Span], rng: np.random.Generator, held_out: bool = False) -> tuple[str, list[Span]] | None:
    """A window of ``text`` with a new span, sometimes beside or instead of it another number.

    With ``held_out`` the span is written in the way of its kind that training leaves out.
    """
    words = [w for w in re.findall(r"[A-Za-z]{2,12}", text[:2000])]
    kind = KINDS[int(rng.integers(len(KINDS)))]
    way = WAYS[kind] - 1 if held_out else int(rng.integers(WAYS[kind] - 1))
    new = reformed(kind, way, words, rng)
    if not held_out and rng.random() < 0.25:
        found = _written_into(text, spans, _other_number(rng), rng)
        return found and (found[0], found[2])
    found = _written_into(text, spans, new, rng)
    if found is None or not well_formed(kind, new):
        return None
    line, start, marks = found
    return line, [*marks, (kind, start, start + len(new), False)]


def _windows(text: str, spans: list[Span], rng: np.random.Generator) -> Iterator[tuple[str, list[Span]]]:
    """Training windows of a text: around each stretch with a digit or an at-sign."""
    done = 0
    for m in TRIGGER.finditer(text):
        if m.start() < done:
            continue
        a = max(0, m.start() - int(rng.integers(8, WINDOW - 32)))
        b = done = a + WINDOW
        if not any(s[1] < b < s[2] or s[1] < a < s[2] for s in spans):
            yield text[a:b], [(k, s - a, e - a, base) for k, s, e, base in spans if a <= s and e <= b]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, marks, planted): windows as they are, and ``PLANTED`` of each text with a new span."""
    for batch in batches:
        rows = []
        for value in batch.column(0):
            text = value.as_py()
            if not text:
                continue
            rng = np.random.default_rng(zlib.crc32(text[:256].encode("utf-8", "replace"), len(text) & 0xFFFFFFFF))
            spans = base_spans(text) if TRIGGER.search(text) else []
            rows += [(*w, False) for w in _windows(text, spans, rng)]
            rows += [(*w, True) for w in (planted(text, spans, rng) for _ in range(PLANTED)) if w]
        marks = [";".join(f"{k}:{s}:{e}" for k, s, e, _ in r[1]) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array(marks, pa.string()), pa.array([r[2] for r in rows], pa.bool_())],
            names=["line", "marks", "planted"],
        )


def _train(epochs: int):
    """One row, the trained weights, of the windows of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted({(r["line"], r["marks"]) for batch in batches for r in batch.to_pylist()})
        tagger = Tagger(*_labels())
        chars, gold = np.zeros((len(rows), WINDOW), np.int32), np.zeros((len(rows), WINDOW), np.int64)
        for k, (line, marks) in enumerate(rows):
            chars[k, : len(line)] = encode(np.array([ord(c) for c in line]))
            for mark in filter(None, marks.split(";")):
                kind, s, e = mark.split(":")
                gold[k, int(s) : int(e)] = 2 * KINDS.index(kind) + 2
                gold[k, int(s)] -= 1
        if rows:
            tagger.train(chars, gold, epochs)
        names = list(tagger.w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([tagger.w[n].tobytes() for n in names], pa.binary())], names=["name", "weights"]
        )

    return run


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, epochs: int = EPOCHS) -> Tagger:
    """A tagger trained on ``sample`` distinct windows: those first by a hash of their text.

    Half of the sample has new spans or numbers written into it; of the rest half has spans, where
    there are so many. Training is one task over this bounded sample, on one core. A corpus without windows gives a tagger that is not trained; what it finds
    must be well-formed all the same.
    """
    windows = docs.select(F.col(text).alias("t")).mapInArrow(_sampled, "line string, marks string, planted boolean")
    windows = windows.groupBy("line").agg(F.min(F.struct("marks", "planted")).alias("w")).select("line", "w.*")
    near = windows.withColumn("hash", F.xxhash64("line"))
    new, spans = F.col("planted"), F.col("marks") != ""
    parts = [
        near.where(some).orderBy("hash", "line").limit(most).select("line", "marks")
        for some, most in ((new, sample // 2), (~new & spans, sample // 4), (~new & ~spans, sample - sample // 2 - sample // 4))
    ]
    trained = parts[0].unionByName(parts[1]).unionByName(parts[2]).coalesce(1).mapInArrow(_train(epochs), "name string, weights binary")
    tagger = Tagger(*_labels())
    for r in trained.collect():
        tagger.w[r["name"]] = np.frombuffer(r["weights"], np.float64).reshape(tagger.w[r["name"]].shape)
    return tagger


WEIGHTS = (1 - np.abs(np.arange(WINDOW) - (WINDOW - 1) / 2) / (WINDOW / 2)).astype(np.float32)[:, None]


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text within half a window of a digit or an at-sign, and the blank-free runs they cut."""
    found: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        done = found[-1][1] if found else 0
        if found and m.end() + STRIDE <= done:
            continue
        a, b = max(0, m.start() - STRIDE), min(len(text), m.end() + STRIDE)
        while a > done and not text[a - 1].isspace():
            a -= 1
        if b < len(text) and not text[b - 1].isspace():
            blank = BLANK.search(text, b)
            b = blank.start() if blank else len(text)
        if found and a <= found[-1][1]:
            found[-1] = (found[-1][0], b)
        else:
            found.append((a, b))
    return found


def _spans_of(path: np.ndarray, offset: int) -> Iterator[tuple[str, int, int]]:
    edges = np.flatnonzero(path % 2 == 1)
    for a in edges.tolist():
        b, inside = a + 1, path[a] + 1
        while b < len(path) and path[b] == inside:
            b += 1
        yield KINDS[(path[a] - 1) // 2], offset + a, offset + b


def added_spans(tagger: Tagger, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """What the tagger finds in each text besides its pattern spans."""
    found: list[list[Span]] = [[] for _ in texts]
    where = [(k, a, b) for k, text in enumerate(texts) for a, b in stretches(text)]
    at = 0
    while at < len(where):
        # A few stretches at a time, about AT_ONCE windows; a long stretch is cut into windows alike.
        windows, owners, part = [], [], []
        while at < len(where) and len(windows) < AT_ONCE:
            k, a, b = where[at]
            codes = encode(np.frombuffer(texts[k][a:b].encode("utf-32-le", "surrogatepass"), np.uint32))
            for start in range(0, max(1, b - a - STRIDE), STRIDE):
                piece = codes[start : start + WINDOW]
                windows.append(np.pad(piece, (0, WINDOW - len(piece)), constant_values=PAD))
                owners.append((len(part), start, len(piece)))
            part.append((k, a, b))
            at += 1
        labels = tagger.w["bias"].shape[0]
        sums = [np.zeros((b - a, labels), np.float32) for _, a, b in part]
        weights = [np.zeros((b - a, 1), np.float32) for _, a, b in part]
        stacked = np.stack(windows)
        for first in range(0, len(stacked), AT_ONCE):
            emitted = tagger.emissions(stacked[first : first + AT_ONCE])
            for (owner, start, size), emission in zip(owners[first : first + AT_ONCE], emitted):
                sums[owner][start : start + size] += emission[:size] * WEIGHTS[:size]
                weights[owner][start : start + size] += WEIGHTS[:size]
        for (k, a, _), path in zip(part, tagger.decode([s / w for s, w in zip(sums, weights)])):
            for kind, s, e in _spans_of(path, a):
                free = all(e <= x[1] or x[2] <= s for x in base[k])
                beside = texts[k][max(0, s - 1) : s] + texts[k][e : e + 1]
                whole = not any(c.isalnum() or c in ":@" for c in beside)
                if free and whole and well_formed(kind, texts[k][s:e]):
                    found[k].append((kind, s, e, False))
    return found


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])


def find(docs: DataFrame, tagger: Tagger, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans): every row's spans (kind, start, end, base) by kind and start.

    Offsets count code points, end exclusive; ``base`` spans are the patterns'. NULL and empty texts
    have an empty list. Rows are kept one for one, repeats included; an empty table gives an empty
    one; other columns are left out. Texts are read whole, in one pass without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [x or "" for x in batch.to_pylist()]
            base = [base_spans(t) if TRIGGER.search(t) else [] for t in texts]
            more = added_spans(shared.value, texts, base)
            spans = [sorted(a + b, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) for a, b in zip(base, more)]
            yield pa.array([[dict(zip(("kind", "start", "end", "base"), s)) for s in x] for x in spans], pa.list_(SPAN))

    kind = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    return docs.select(F.col(id), F.arrow_udf(run, kind)(F.col(text)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text column replaced by its kind in brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            given = [x or "" for x in texts]
            base = [base_spans(t) for t in given]
            out = []
            for original, t, a, b in zip(texts, given, base, added_spans(shared.value, given, base)):
                for kind, s, e, _ in sorted(a + b, key=lambda x: -x[1]):
                    t = f"{t[:s]}[{kind}]{t[e:]}"
                out.append(None if original is None else t)
            yield pa.array(out, pa.string())

    return docs.withColumn(text, F.arrow_udf(run, "string")(F.col(text)))
