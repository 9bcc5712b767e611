"""The likeliest readings of disguised words against all readings there are."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from tallywright.llm import toxicity


def all_readings(token, model, spelled):
    """Every way through the lattice, scored letter by letter; the best value of each text."""
    steps = (toxicity._spelled_lattice if spelled else toxicity._lattice)(token)
    values = {}
    for way in itertools.product(*steps):
        text, value = "".join(r for r, _ in way) + " ", -sum(c for _, c in way)
        b = a = 0
        for c in text:
            code = 0 if c == " " else ord(c)
            if code or a:
                value += model.score(b, a, code)
            b, a = (a, code) if code else (0, 0)
        values[text] = max(values.get(text, -math.inf), value)
    best = sorted(((v, t) for t, v in values.items()), reverse=True)[: toxicity.READINGS]
    return [(v, t.strip()) for v, t in best if v > best[0][0] - toxicity.WITHIN]


@pytest.mark.parametrize("spelled", [False, True])
def test_readings_equal_enumeration(spelled):
    rng = np.random.default_rng(1)
    # A letter model of chance counts: every trigram is as good as any.
    model = toxicity.Letters(rng.integers(0, 50, 2 * toxicity.CELLS))
    random.seed(2)
    tokens = []
    while len(tokens) < 120:
        signs = "ab1o0$!4*xx" if not spelled else "a b1.o 0 -$ x"
        token = "".join(random.choice(signs) * random.choice([1, 1, 1, 3]) for _ in range(random.randrange(1, 7))).strip()
        steps = (toxicity._spelled_lattice if spelled else toxicity._lattice)(token) if token else []
        if token and math.prod(map(len, steps)) <= 60_000 and not (spelled and not toxicity.WORD.search(token)):
            tokens.append(token)
    for token in tokens:
        want = all_readings(token, model, spelled)
        got = toxicity.readings(token, model, spelled)
        # Readings that differ in the blanks at their ends are told apart until these are cut off.
        assert Counter(got) == Counter(t for _, t in want), token


def test_masks_are_read_under_any_number_of_states():
    model = toxicity.Letters(np.random.default_rng(3).integers(0, 9, 2 * toxicity.CELLS))
    for token in ("*#*#*", "1*!#6", "****", "#1|!*"):
        want = all_readings(token, model, False)
        assert toxicity.readings(token, model)[0] == want[0][1]
