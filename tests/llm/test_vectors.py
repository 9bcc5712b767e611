"""Embedding links at the threshold itself."""

from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tallywright.llm import vectors


def linked(rows, cosine):
    """Index pairs whose cosine is at least that, in fractions."""
    limit = Fraction(cosine).limit_denominator(100) ** 2
    rows = [[int(x) for x in v] for v in rows]
    squares = [sum(x * x for x in v) for v in rows]
    out = set()
    for i, v in enumerate(rows):
        for j in range(i):
            dot = sum(x * y for x, y in zip(v, rows[j]))
            if dot > 0 and Fraction(dot * dot, squares[i] * squares[j]) >= limit:
                out |= {(i, j), (j, i)}
    return out


def at_the_threshold(count, seed):
    """Whole vectors in 16 dimensions, many pairs of which have a cosine of exactly 0.9."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(count):
        v = np.zeros(16)
        x = rng.permutation(16)
        if k % 2:
            v[x[0]] = 10
        else:
            v[x[:6]] = (9, 4, 1, 1, 1, 0)
            v[x[0]] *= rng.choice([1, 1, -1])
        rows.append(v * rng.choice([1, 2, 3, 7]))
    return np.array(rows)


@pytest.mark.parametrize("seed, spread", [(1, 16), (2, 5), (3, 2)])
@pytest.mark.parametrize("lead", [3, 12, 16])
def test_compare_is_exact_at_the_threshold(seed, spread, lead):
    # The fewer coordinates take part, the denser the links are: both ways of multiplying are met.
    rows = at_the_threshold(160, seed)
    rows = rows[:, :spread] if spread > 6 else np.concatenate((rows[:, :spread], np.ones((160, 1))), axis=1)
    rows = rows[(rows != 0).any(axis=1)]
    axes = np.linalg.qr(np.random.default_rng(seed).normal(size=(rows.shape[1],) * 2))[0][:, :lead]
    want = linked(rows, 0.9) | {(k, k) for k in range(len(rows))}
    for stripe in (7, 1024):
        vectors.STRIPE, before = stripe, vectors.STRIPE
        try:
            got = [(int(i), int(j)) for x, y in vectors.compare(rows, rows, 0.9, axes) for i, j in zip(x, y)]
        finally:
            vectors.STRIPE = before
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("tile_rows", [4096, 40])
def test_groups_at_the_threshold(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile_rows)
    rows = at_the_threshold(300, 5)
    pairs = linked(rows, 0.9)
    data = [(k, [float(x) for x in v]) for k, v in enumerate(rows)]
    # Scaling by powers of two, however far, changes no cosine.
    data += [(1000 + k, [float(x) * 2.0**900 for x in rows[k]]) for k in range(5)]
    pairs |= {(300 + k, j) for k in range(5) for j in range(300) if (k, j) in pairs or k == j}
    pairs |= {(300 + k, 300 + j) for k in range(5) for j in range(5) if (k, j) in pairs}
    links = Counter(i for i, _ in pairs) + Counter(j for i, j in pairs if i >= 300 and j < 300)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in vectors.cosine_groups(df, 0.9, lead=6).collect()}
    assert got == {i: links[k] for k, (i, _) in enumerate(data)}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
