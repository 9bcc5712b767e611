"""Language ID: words, scripts, scores and the pipeline's stage against a plain version."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
from tallywright.llm import langid, letters, queries

TRAIN = [("the cat sat on that mat and went there with them", "en"), ("le chat est sur le tapis avec une souris et des oiseaux", "fr"),
         ("кошка сидит на ковре и смотрит", "ru"), ("γάτα κάθεται στο χαλί", "el")]


@pytest.fixture
def model(docs):
    return langid.fit(docs(*[(k, t, lang) for k, (t, lang) in enumerate(TRAIN * 20)]))


def plain_words(text):
    """(word, start): runs of letters of one script."""
    lower, script = letters.tables()
    found, start = [], None
    for k, c in enumerate(text + " "):
        kind = script[ord(c)] if lower[ord(c)] else None
        if start is not None and (kind is None or kind != script[ord(text[start])]):
            found.append((text[start:k], start))
            start = None
        if start is None and kind is not None:
            start = k
    return found


def plain_scores(model, text):
    """Scores of every word: its trigrams one by one; -inf for languages that its script bars."""
    lower, script = letters.tables()
    out = []
    for word, start in plain_words(text):
        kind = script[ord(word[0])]
        after = text[start + len(word) : start + len(word) + 1] or " "
        codes = [0, 0, *[int(lower[ord(c)]) for c in word]] + ([] if lower[ord(after)] else [0])
        total = np.zeros(len(model.langs))
        if model.own[kind]:
            for k in range(2, len(codes)):
                c, a, b = codes[k], codes[k - 1], codes[k - 2] if codes[k - 1] else 0
                mixed = (c * 0x9E3779B97F4A7C15 ^ a * 0xC2B2AE3D27D4EB4F ^ b * 0x165667B19E3779F9) % 2**64
                mixed ^= mixed >> 29
                mixed = mixed * 0xBF58476D1CE4E5B9 % 2**64
                total += model.scores[mixed >> 64 - langid.BITS]
        out.append((word, total + model.barred[kind]))
    return out


def plain_labels(scores, penalty):
    value, back = scores[0].copy(), []
    for s in scores[1:]:
        top = int(np.argmax(value))
        moved = value[top] - penalty > value
        back.append(np.where(moved, top, np.arange(len(value))))
        value = np.where(moved, value[top] - penalty, value) + s
    label = [int(np.argmax(value))]
    for came in reversed(back):
        label.append(int(came[label[-1]]))
    return label[::-1]


ODD = ["", "a", "Ж", "the cat", "кошкаa кот", "catкошка", "猫が好き the", "x1y2 z", "γάτα-cat/кот", "mañana; straße", "the " * 9 + "кот " * 9,
       "가나다 abc", "\U0001f600 the", "a" * 30 + "б" * 30]


def test_word_scores_equal_the_plain_version(model):
    lower, script = letters.tables()
    random.seed(4)
    texts = ODD + ["".join(random.choice("ab кж γσ1猫.") for _ in range(60)) for _ in range(30)]
    scores, sizes, own, ends, firsts = langid._words(model, texts)
    starts = letters.points(texts)[1]
    for k, text in enumerate(texts):
        want = plain_scores(model, text)
        part = slice(firsts[k], firsts[k + 1])
        assert [len(w) for w, _ in want] == sizes[part].tolist()
        assert [s + len(w) for w, s in plain_words(text)] == (ends[part] - starts[k]).tolist()
        assert [bool(model.own[script[ord(w[0])]]) for w, _ in want] == own[part].tolist()
        for (word, plain), fast in zip(want, scores[part]):
            assert np.allclose(plain, fast, atol=1e-2), word


def test_a_script_bars_languages_outright(model):
    # Evidence, however long, does not outweigh a script.
    for text, lang in (("кошка" * 200 + "a", "ru"), ("a" + "кошка" * 200, "ru"), ("γάτα" * 99 + " le", "el")):
        assert langid.decide(model, [text], langid.SWITCH)[0] == [lang]
    assert langid.decide(model, ["猫" * 500 + " the cat"], langid.SWITCH)[1][0] < 0.02
    names, scores = langid.decide(model, ["猫" * 500, "", "12"], langid.SWITCH)
    assert names[0] in model.langs and names[1:] == ["und", "und"] and scores.tolist() == [0, 0, 0]


@pytest.mark.parametrize("share", [0.2, 0.5, 0.9])
def test_accepted_equals_the_plain_version(model, docs, share):
    random.seed(6)
    words = ["the", "chat", "кошка", "γάτα", "猫が好き", "고양이", "12", "!", "abв"]
    texts = ODD + [None, "猫" * 1000 + "a", " ".join(random.choices(words, k=40))]
    texts += [" ".join(random.choices(words, weights=[random.random() for _ in words], k=random.randrange(1, 30))) for _ in range(60)]
    texts += [" ".join(t for t, _ in TRAIN)]
    want = set()
    for k, text in enumerate(texts):
        scored = plain_scores(model, text or "")
        if not scored:
            continue
        labels = plain_labels([s for _, s in scored], langid.SWITCH)
        _, script = letters.tables()
        mine = sum(len(w) for (w, s), x in zip(scored, labels) if model.own[script[ord(w[0])]] and math.isfinite(s[x]))
        if mine and mine / sum(len(w) for w, _ in scored) >= share:
            want.add(k)
    got = langid.accepted(docs(*enumerate(texts)), model, share=share)
    assert {r["doc_id"] for r in got.collect()} == want and len(texts) - 1 in want


def test_the_stage_goes_by_labelled_spans(spark, docs, sf_dir):
    given = queries.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    added = docs((-1, "猫" * 1000 + "a", None), (-2, "кошка сидит " * 50 + "b", None), (-3, "1 2 3", "en"), (-4, None, "en"), (-5, "", None))
    kept = corpus_pipeline.languages(spark, given.unionByName(added), sf_dir)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not ids & {-1, -2, -3, -4, -5}
    letters_only = given.where("text rlike '[a-zA-Z]'")
    assert ids == {r["doc_id"] for r in letters_only.collect()}


def test_the_stage_labels_every_text_once(spark, docs, sf_dir, capsys):
    # Twice in a row would be two Python workers a task, each with texts and scores of its own.
    corpus_pipeline.languages(spark, docs(*[(k, t, lang) for k, (t, lang) in enumerate(TRAIN)]), sf_dir).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
