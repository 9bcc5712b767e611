"""What the tagger finds besides the patterns, in texts it was not trained on and written in ways left out of its training."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import pii, queries


@pytest.fixture(scope="module")
def tagged(spark):
    """A tagger of three quarters of the documents, and the texts of the others."""
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    texts = [r["text"] for r in docs.where(held & F.col("text").isNotNull()).orderBy("doc_id").collect()]
    return pii.fit(docs.where(~held)), texts


@pytest.mark.parametrize("held_out", [False, True])
def test_recall_and_precision(tagged, held_out):
    tagger, texts = tagged
    rng = np.random.default_rng(7)
    lines, wanted = [], []
    for text in texts * 2:
        found = pii.planted(text, pii.base_spans(text), rng, held_out)
        if found:
            lines.append(found[0])
            wanted.append({s[:3] for s in found[1] if not s[3]})
    base = [pii.base_spans(line) for line in lines]
    hits, there, extra = Counter(), Counter(), 0
    for want, mine, seen in zip(wanted, pii.added_spans(tagger, lines, base), base):
        want = {w for w in want if all(w[2] <= b[1] or b[2] <= w[1] for b in seen)}
        got = {g[:3] for g in mine}
        there.update(k for k, _, _ in want)
        hits.update(k for k, _, _ in want & got)
        extra += len(got - want)
    assert set(there) == set(pii.KINDS) and min(there.values()) > 40
    assert sum(hits.values()) >= 0.9 * sum(there.values())
    assert all(hits[k] >= 0.75 * there[k] for k in pii.KINDS), (hits, there)
    assert extra <= 0.1 * sum(hits.values())


def test_nothing_is_added_to_the_texts_as_they_are(tagged):
    tagger, texts = tagged
    added = pii.added_spans(tagger, texts, [pii.base_spans(t) for t in texts])
    assert sum(map(len, added)) <= 0.01 * len(texts)


def test_planted_spans_are_marked_where_they_stand():
    rng = np.random.default_rng(1)
    text = "Write to a.b@c.org, or call +1 202 555 0100 now.\n" + "words and words " * 30
    spans = pii.base_spans(text)
    kinds = Counter()
    for _ in range(600):
        for held_out in (False, True):
            found = pii.planted(text, spans, rng, held_out)
            if not found:
                continue
            line, marks = found
            assert len(line) <= pii.WINDOW
            for kind, a, b, base in marks:
                if base:
                    assert line[a:b] in ("a.b@c.org", "+1 202 555 0100")
                else:
                    kinds[kind] += 1
                    assert pii.well_formed(kind, line[a:b])
    assert set(kinds) == set(pii.KINDS)
