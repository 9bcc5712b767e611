"""The operators against brute force on small tables, and on odd ones."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_data import with_clashes
from tallywright.llm import (
    decontaminate, graph, html_text, katz, langid, mixing, pii, queries, sharding, simhash, tagger, toxicity, vectors,
)

# --- op1 ---


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><head><title>t</title></head><body></body></html>", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<article><h1>A&nbsp;b</h1><p>One,  two\n three.<p>Four<br>five</article><footer>f</footer>", "A b\nOne, two three.\nFour five"),
    ("<nav><p>" + "menu, menu, " * 40 + "</p></nav><main><p>Text.</p></main>", "Text."),
    ("<div id=main><p>Long, enough, text of a page.</p><div class='comments'><p>" + "so, good, " * 50 + "</p></div></div>", "Long, enough, text of a page."),
    ("<body><div class=sidebar><p>x, y, z</p></div><p>Kept, always.</p><form><p>no</p></form><!-- <p>no</p> --><script>'<p>no</p>'</script></body>", "Kept, always."),
    ("<p>a <span style='display: none'>hidden <b>too</b></span> b</p>", "a b"),
    ("<div><p>" + "prose, more prose. " * 20 + "</p><ul>" + "<li><a href=x>link</a>" * 30 + "</ul></div>",
     ("prose, more prose. " * 20).strip() + "\nlink" * 30),
    ("<div class='content with-sidebar'><p>In, here.</p><ol class='commentlist'><li>me, too, here</ol><div class=topnav>x</div></div>", "In, here."),
    ("<p>unclosed <a href='x>broken", "unclosed broken"),
])
def test_main_text(page, text):
    if "broken" in (page or ""):
        assert html_text.main_text(page).startswith("unclosed")
    else:
        assert html_text.main_text(page) == text


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 5000 + "<p>deep</p>") == "deep"
    body = "".join(f"<p>Paragraph {k}, with words.</p>" for k in range(5000))
    assert html_text.main_text(f"<article>{body}</article>").count("\n") == 4999


def test_extract_text(spark, sf_dir):
    df = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "<p>\U0001f600</p>", "x"), (None, None, "<p>a</p>", "x")],
                               "page_id long, url string, html string, text string")
    assert sorted(map(tuple, html_text.extract_text(df).collect()), key=str) == sorted(
        [(1, "u", "", 0), (1, "u", "\U0001f600", 1), (None, None, "a", 1)], key=str)
    assert html_text.extract_text(df.limit(0)).count() == 0
    rows = queries.op1_html_text(spark, sf_dir).collect()
    assert len(rows) == queries.table(spark, sf_dir, "pages").count() and all(r["n_chars"] == len(r["text"]) for r in rows)


# --- links, op2 and its stage ---


def groups_of(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(3)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)]
    pairs += [(5, None), (2000, 2000)]
    df = spark.createDataFrame(pairs, "a long, b long")
    real = [(a, b) for a, b in pairs if b is not None and a != b]
    got = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert got == groups_of(real, {x for p in real for x in p})
    assert graph.components(df.limit(0)).count() == 0


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def test_op2_against_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    near = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = groups_of(near, prints)
    got = {tuple(r) for r in queries.op2_simhash(spark, sf_dir).collect()}
    assert got == {(i, f"{prints[i]:016x}", roots[i]) for i in prints}


def test_no_close_pair_is_lost(spark):
    random.seed(5)
    values = {random.getrandbits(64) for _ in range(40)}
    for v in list(values):
        for count in (1, 2, 3, 4):
            values.add(v ^ sum(1 << b for b in random.sample(range(64), count)))
    signed = [v - (v >> 63 << 64) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {tuple(sorted(r)) for r in simhash.close_pairs(df).collect()}
    assert got == {tuple(sorted(p)) for p in itertools.combinations(signed, 2)
                   if 1 <= ((p[0] ^ p[1]) & (1 << 64) - 1).bit_count() <= 3}


def test_fingerprints_meet_without_a_broadcast(spark):
    # The table is small, but each row of it becomes 33 of the index for either segment.
    fps = spark.range(100).selectExpr("xxhash64(id) fp")
    near = simhash.near_duplicates(spark.range(100).selectExpr("id doc_id", "cast(id as string) text"))
    stay = simhash.fingerprint_groups(fps)
    for df, joins in ((simhash.close_pairs(fps), 4), (near, 3), (stay, 1)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in text and text.count("SortMergeJoin") >= joins


def test_op2_on_odd_rows(spark, odd):
    rows = simhash.near_duplicates(with_clashes(odd)).collect()
    assert len(rows) == odd.count()
    blank = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert {(r["fingerprint"], r["component_id"]) for r in blank} == {("0" * 16, 1)}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    kept = simhash.deduplicate(with_clashes(odd))
    assert kept.columns == with_clashes(odd).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6, 7, 8]
    assert simhash.deduplicate(odd.limit(0)).count() == 0


# --- op3 ---


def test_shards_are_even_and_slots_gapless(spark, odd):
    for df in (odd, with_clashes(spark.range(1003).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text")))):
        rows = sharding.assign(df).collect()
        counts = Counter(r["shard"] for r in rows)
        assert len(rows) == df.count() and max(counts.values()) - min(counts[s] for s in range(8)) <= 1
        for s in counts:
            assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    assert sharding.assign(odd.limit(0)).count() == 0
    sizes = {r["doc_id"]: r["size"] for r in sharding.assign(odd.where("doc_id in (1, 2, 8)")).collect()}
    assert sizes == {1: 1, 2: 1, 8: 13}


def test_one_more_shard_moves_few(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    before, after = ({r["doc_id"]: r["shard"] for r in sharding.assign(df, shards=n, slack=0.2).collect()} for n in (8, 9))
    assert sum(before[k] != after[k] for k in before) / 4000 < 0.25
    assert max(Counter(before.values()).values()) <= math.ceil(4000 * 1.2 / 8)


def test_ring_walk_against_brute_force(spark):
    """Rows that no full shard turned away sit at the first shard clockwise."""
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    points, walks = sharding.ring(4, 32, 17)
    at = df.select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("p")).collect()
    home = {r["doc_id"]: walks[int(np.searchsorted(points, r["p"], "left")) % len(points)][0] for r in at}
    got = {r["doc_id"]: r["shard"] for r in sharding.assign(df, shards=4, virtual=32, slack=5).collect()}
    assert got == home


def test_every_row_is_written_once(spark, odd, tmp_path):
    sharding.write_shards(odd.unionByName(odd.where("doc_id = 5")), f"{tmp_path}/shards", shards=3)
    rows = spark.read.parquet(f"{tmp_path}/shards").collect()
    want = [tuple(r) for r in odd.collect()]
    assert Counter(tuple(r[c] for c in odd.columns) for r in rows) == Counter(want + [r for r in want if r[0] == 5])
    slots = [(r["shard"], r["slot"]) for r in rows]
    assert len(set(slots)) == len(slots) == len(want) + 1


# --- op4 ---


def test_mix_on_odd_rows(spark, odd):
    mixed = queries.mixed(with_clashes(odd).drop("epoch"))
    assert mixed.count() > 0 and set(mixed.columns) == {*with_clashes(odd).columns, "__epoch"} - {"epoch"}
    assert queries.mixed(odd.limit(0)).count() == 0


def test_shortages_go_to_siblings_first(spark):
    rows = [("a", "x", "s1", 100), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "z", "s4", 50)]
    leaves = spark.createDataFrame(rows, f"{mixing.LEVELS[0]} string, {mixing.LEVELS[1]} string, {mixing.LEVELS[2]} string, tokens long")
    given = {r[2]: r["budget"] for r in mixing.leaf_budgets(leaves, (1000, 2150), 1, ({}, {}, {})).collect()}
    # b delivers 50 of its 500; a's 950 are split 475 and 475; s1 delivers 100, s2 the rest of x.
    assert given == {"s4": 50, "s1": 100, "s2": 375, "s3": 475}


# --- op5 ---


def letter_model(*texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])
    out = next(toxicity._count_letters(iter([batch])))
    sums = np.zeros(2 * toxicity.CELLS, np.int64)
    sums[out.column(0).to_numpy()] = out.column(1).to_numpy()
    return toxicity.Letters(sums)


def test_disguised_words_are_read():
    model = letter_model(*["you are a stupid idiot and a loser moron the cat is there on that mat"] * 20)
    reader = toxicity.Reader(model)
    for token in ("stup1d", "stuuuupid", "m0r0n", "l-o-s-e-r", "1d10t", "s t u p i d", "st*pid", "$tupid!"):
        words = reader.words(f"the {token} cat")
        assert words & {"stupid", "moron", "loser", "idiot"}, token
    assert reader.words(None) == set() and reader.words("") == set()
    assert reader.words("x1" * 50_000) >= {"x"}


@pytest.mark.parametrize("text, word", [
    ("i d 1 o t", "idiot"), ("m 0 r 0 n", "moron"), ("1 d 10 t", "idiot"), ("$ t u p ! d", "stupid"), ("m * r * n", "moron"),
    ("a s t u p i d", "stupid"), ("s t u p i d i d i o t", "stupid"), ("s t u p i d i d i o t", "idiot"), ("c a t", "cat"),
    ("y o u a r e s t u p i d", "stupid"), ("y o u  a r e  a  l o s e r", "loser"), ("m, o, r, o, n", "moron"),
    ("the m\no\nr\no\nn sat", "moron"), ("s t u u u u p i d", "stupid"), ("m*o*r*o*n", "moron"), ("s t u p 1 d cat", "stupid"),
])
def test_spelled_words_are_read(text, word):
    model = letter_model(*["you are a stupid idiot and a loser moron the cat is there on that mat"] * 20)
    assert word in toxicity.Reader(model).words(text)


@pytest.mark.parametrize("text, word", [
    *((sign.join(["hello"] * 14 + ["1d10t"] + ["there"] * 14), "idiot") for sign in (",", ".", "_", "-", "/", "|", "*", "</b><b>")),
    ("\u4f60\u771f\u662f1d10t\u554a" + "\u4f60" * 90, "idiot"), ("\u4f60" * 90 + "m0r0n\u554a", "moron"),
    (" ".join("thecatisthereonthatmat" * 9 + "youareastupididiot" + "thecatisthere" * 5), "stupid"),
    (" ".join("thecatisthereonthatmat" * 9 + "stup1d" + "thecatisthere" * 5), "stupid"), ("hello" * 40 + ",l0ser", "loser"),
])
def test_long_stretches_are_read(text, word):
    model = letter_model(*["you are a stupid idiot and a loser moron the cat is there on that mat hello"] * 20)
    assert word in toxicity.Reader(model).words(text)


def test_op5_separates_labels(spark):
    random.seed(7)
    plain = "the cat sat on that mat and then it went out for more of this".split()
    bad = ["stupid", "idiot"]
    texts, labels = [], []
    for k in range(400):
        words = random.choices(plain, k=12)
        toxic = k % 5 == 0
        if toxic:
            words.insert(3, random.choice(bad))
        texts.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labelled = docs.join(spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id")
    model = toxicity.fit(docs, labelled)
    fresh = spark.createDataFrame([(1, "then the stup1d cat"), (2, "the cat sat"), (3, None), (4, ""), (1, "an i d i o t sat")], "doc_id long, text string")
    got = [(r["doc_id"], r["predicted"]) for r in toxicity.score(with_clashes(fresh), model).collect()]
    assert sorted(got) == [(1, 1), (1, 1), (2, 0), (3, 0), (4, 0)]
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, model).collect())
    empty = toxicity.fit(docs.limit(0), labelled.limit(0))
    assert toxicity.score(fresh, empty).count() == 5 and toxicity.score(fresh.limit(0), model).count() == 0


# --- op6 ---


def test_op6_against_brute_force(spark, sf_dir, monkeypatch):
    for name, value in (("WORDS_A_BUCKET", 2000), ("BIGRAMS_A_BUCKET", 10_000), ("BLOCK_CHARS", 100_000)):
        monkeypatch.setattr(katz, name, value)
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text")
    odd_rows = [(-1, None), (-2, ""), (-3, "zzz zzz unseen"), (-3, "The THE the")]
    docs = docs.unionByName(spark.createDataFrame(odd_rows, "doc_id long, text string")).withColumn("held", queries.fold(7) == 2)
    rows = docs.collect()
    texts = [(r["doc_id"], r["held"], (r["text"] or "").encode().lower().split() + [b"\n"]) for r in rows]
    words, pairs, after = Counter(), Counter(), defaultdict(dict)
    for _, held, t in texts:
        if not held:
            words.update(t)
            pairs.update(zip([None, *t], t))
    total, floor = sum(words.values()), sum(words.values()) + len(words) + 1
    d = katz.discounts([sum(1 for v in pairs.values() if v == r) for r in range(1, 7)])
    for (a, b), v in pairs.items():
        after[a][b] = v
    kept = lambda v: v * (d[v] if v <= 5 else 1)
    context = {}
    for a, seen in after.items():
        every, mass = sum(seen.values()), sum(map(kept, seen.values()))
        divisor = every + 1 if mass >= every else every
        context[a] = divisor, (1 - mass / divisor) / (1 - sum((words[b] + 1) / floor for b in seen))

    def p(a, b):
        if b in after.get(a, {}):
            return kept(after[a][b]) / context[a][0]
        return (context[a][1] if a in context else 1) * (words.get(b, 0) + 1) / floor

    for a in (None, b"the", b"of"):
        assert abs(sum(p(a, b) for b in words) + p(a, b"?? unknown") - 1) < 1e-9
    want = defaultdict(list)
    for i, held, t in texts:
        base = sum(math.log10((words.get(w, 0) + 1) / floor) for w in t)
        score = sum(math.log10(p(a, b)) for a, b in zip([None, *t], t))
        want[i, bool(held), len(t), sum(w in words for w in t), total].append((base, score))
    got = defaultdict(list)
    for r in katz.score(with_clashes(docs), "held").collect():
        got[r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]].append((r["base_score"], r["score"]))
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    for key, pairs in want.items():
        for (base, score), (found_base, found) in zip(sorted(pairs), sorted(got[key])):
            # Single probabilities travel in single precision.
            assert abs(base - found_base) < 1e-6 * (1 - base) and abs(score - found) < 1e-6 * (1 - score), key


def test_op6_without_rows_or_training(spark, odd):
    assert katz.score(odd.withColumn("held", F.lit(True)), "held").where("n_known > 0").count() == 0
    assert katz.score(odd.limit(0).withColumn("held", F.lit(True)), "held").count() == 0
    rows = katz.score(odd.withColumn("held", F.lit(False)), "held").collect()
    assert len(rows) == odd.count() and all(r["score"] < 0 for r in rows)


# --- op7 ---


def test_op7_spans_and_odd_rows(spark, odd, docs):
    train = docs(*[(k, t, lang) for k, (t, lang) in enumerate(
        [("the cat sat on that mat and went there with them", "en"), ("le chat est sur le tapis avec une souris et des oiseaux", "fr"),
         ("кошка сидит на ковре", "ru")] * 20)])
    model = langid.fit(train)
    got = {r["doc_id"]: r for r in langid.predict(docs(
        (1, "the cat went there"), (2, None), (3, ""), (4, "123 !?"), (5, "сидит кошка")), model).collect()}
    assert [got[k]["lang_pred"] for k in range(1, 6)] == ["en", "und", "und", "und", "ru"]
    mixed = "the cat sat on that mat and went there " + "avec une souris et des oiseaux sur le tapis"
    spans = langid.language_spans(docs((1, mixed)), model).orderBy("start").collect()
    assert [s["lang"] for s in spans] == ["en", "fr"] and mixed[spans[0]["start"] : spans[0]["end"]].startswith("the cat")
    assert abs(spans[0]["end"] - mixed.index(" avec")) <= 6
    rows = langid.predict(with_clashes(odd), model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert langid.predict(odd.limit(0), model).count() == 0
    none = langid.fit(odd.limit(0))
    assert {r["lang_pred"] for r in langid.predict(odd, none).collect()} == {"und"}
    assert langid.accepted(odd, model).where("text is null or trim(text) = ''").count() == 0


def test_texts_in_many_languages_are_accepted(docs):
    parts = [("the cat sat on that mat and went there with them", "en"), ("le chat est sur le tapis avec une souris et des", "fr"),
             ("кошка сидит на ковре и смотрит на птиц во дворе", "ru")]
    model = langid.fit(docs(*[(k, t, lang) for k, (t, lang) in enumerate(parts * 20)]))
    mixed = " ".join(t for t, _ in parts)
    assert langid.decide(model, [mixed], langid.SWITCH)[1][0] < 0.4
    rows = docs((1, mixed), (2, "고양이가 앉아 있다"), (3, "123 !?"), (4, None), (5, "le chat"))
    assert sorted(r["doc_id"] for r in langid.accepted(rows, model).collect()) == [1, 5]


def test_viterbi_against_brute_force():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 5, 3, 6]
    scores = rng.normal(0, 2, (sum(sizes), 3)).astype(np.float32)
    firsts = np.concatenate(([0], np.cumsum(sizes)))
    labels = langid.viterbi(scores, firsts, 1.5)
    for a, b in zip(firsts, firsts[1:]):
        value = lambda path: sum(scores[a + k, x] for k, x in enumerate(path)) - 1.5 * sum(x != y for x, y in zip(path, path[1:]))
        best = max(itertools.product(range(3), repeat=int(b - a)), key=value)
        assert abs(value(best) - value(labels[a:b])) < 1e-4


def test_op7_held_out_accuracy(spark):
    rows = queries.op7_language(spark, "/root/testdata/sf0.01").join(
        queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


# --- op8 ---


def test_base_spans_are_the_patterns():
    random.seed(4)
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    pieces = ["a.b@c.de", "@@x@y.z.", "1.2.3.4.5.6.7.8", "999.1.1.1", "4111 1111 1111 1111", "+1 (202) 555-0100", " ", "\n", "é", ".", "12", "-"]

    def good(kind, t):
        digits = re.sub("[^0-9]", "", t)
        return (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in t.split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and pii.luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15)

    for _ in range(1500):
        text = "".join(random.choices(pieces, k=random.randrange(12)))
        want = [(k, m.start(), m.end(), True) for k, p in kinds for m in re.finditer(p, text) if good(k, m[0])]
        assert pii.base_spans(text) == want, text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_gradients_and_training():
    labels, allowed = pii._labels()
    t = tagger.Tagger(labels, allowed, size=3, hidden=2)
    rng = np.random.default_rng(1)
    chars, gold = rng.integers(1, 99, (3, 7)), np.zeros((3, 7), int)
    gold[0, 2:4], gold[1, :3] = [1, 2], [3, 4, 4]
    _, g = t._gradients(chars, gold)
    for name, at in (("embed", (chars[0, 1], 1)), ("trans", (1, 2)), ("xf", (0, 1)), ("hb", (1, 3)), ("cf", (2,)), ("out", (1, 1)), ("bias", (0,))):
        kept = t.w[name][at]
        sides = []
        for step in (1e-5, -1e-5):
            t.w[name][at] = kept + step
            sides.append(t._gradients(chars, gold)[0])
        t.w[name][at] = kept
        assert abs((sides[0] - sides[1]) / 2e-5 - g[name][at]) < 1e-6
    losses = tagger.Tagger(labels, allowed).train(chars, gold, 30)
    assert losses[-1] < losses[0] / 3


def test_decoding_against_brute_force():
    labels, allowed = pii._labels()
    t = tagger.Tagger(labels, allowed)
    t.w["trans"] = np.random.default_rng(0).normal(0, 1, (labels, labels))
    trans = t.transitions()
    parts = [np.random.default_rng(k).normal(0, 2, (n, labels)).astype(np.float32) for k, n in enumerate((4, 0, 1, 3))]
    for emissions, path in zip(parts, t.decode(parts)):
        value = lambda p: sum(emissions[k, x] for k, x in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))
        best = max(value(p) for p in itertools.product(range(labels), repeat=len(emissions)))
        assert abs(best - value(path)) < 1e-3


def test_op8_keeps_base_spans_and_finds_more(spark, odd):
    rng = random.Random(1)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    lines = [(k, f"please call +1 {digits(3)} {digits(3)} {digits(4)} or write to p{k}@mail{k % 9}.example.org about order {digits(5)}") for k in range(400)]
    docs = spark.createDataFrame(lines, "doc_id long, text string")
    model = pii.fit(docs, sample=800, epochs=8)
    more = spark.createDataFrame([(1, f"please call (202) 555-0143 or write about order {digits(5)}"), (2, None), (2, "")], "doc_id long, text string")
    got = pii.find(with_clashes(docs.unionByName(more)), model).collect()
    assert len(got) == 403
    assert all([(s["kind"]) for s in r["spans"] if s["base"]] == ["email", "phone"] for r in got[:400])
    assert any(s["kind"] == "phone" and not s["base"] for r in got for s in r["spans"] if r["doc_id"] == 1)
    assert pii.redact(more, model).where("doc_id = 2 and text is null").count() == 1
    assert pii.find(odd, pii.fit(odd.limit(0))).count() == odd.count() and pii.find(odd.limit(0), model).count() == 0


def test_stretches_do_not_cut_blank_free_runs():
    address = "\u00e9" * 70 + "@" + "m\u00fcller" * 12 + ".example"
    text = "word " * 30 + address + " word" * 30
    (a, b), = pii.stretches(text)
    assert a <= text.index(address) and text.index(address) + len(address) <= b < len(text)
    assert pii.stretches(address + " " + "x" * 90) == [(0, len(address))]
    assert pii.stretches("a1" * 100_000) == [(0, 200_000)] and pii.stretches("words alone") == []


# --- op9 ---


@pytest.mark.parametrize("cosine", [0.9, 0.35])
def test_op9_against_brute_force(spark, monkeypatch, cosine):
    monkeypatch.setattr(vectors, "TILE_ROWS", 60)
    monkeypatch.setattr(vectors, "BLOCK_BOXES", 3)
    rng = np.random.default_rng(0)
    rows = rng.normal(0, 1, (300, 16))
    rows[50:90] = rows[7] + rng.normal(0, 0.1, (40, 16))
    rows[100:110] = rows[3]
    rows[110] = rows[3] * 2
    rows[120] = 0
    data = [(k, [float(x) for x in v]) for k, v in enumerate(rows)]
    data += [(400, None), (401, []), (402, [float("nan")] * 16), (403, [None] * 16), (404, [1.0, 2.0]), (405, [float("inf")] + [0.0] * 15), (5, data[5][1])]
    df = with_clashes(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    ok = [(i, np.array(v)) for i, v in data if v and len(v) == 16 and None not in v and np.all(np.isfinite(v)) and np.any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v in ok])
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    place = groups_of(list(zip(*np.nonzero(near))), range(len(ok)))
    least = {}
    for k, root in place.items():
        least[root] = min(least.get(root, 1 << 60), ok[k][0])
    want = Counter((ok[k][0], int(near[k].sum()), least[place[k]], ok[k][0] == least[place[k]]) for k in range(len(ok)))
    good = Counter(i for i, _ in ok)
    want += Counter((i, 0, i, True) for i, _ in data if i not in good)
    assert Counter(map(tuple, vectors.cosine_groups(df, cosine, lead=6).collect())) == want
    assert vectors.cosine_groups(df.limit(0)).count() == 0


def test_op9_compares_every_width(spark):
    data = [(k, [1.0, 0.0, 0.01 * k]) for k in range(4)] + [(10, [1.0, 0.0]), (11, [2.0, 0.0]), (12, [0.0, 1.0]), (20, [3.0]), (21, [0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, vectors.cosine_groups(df).collect()))
    assert got == [*((k, 3, 0, k == 0) for k in range(4)), (10, 1, 10, True), (11, 1, 10, False), (12, 0, 12, True),
                   (20, 0, 20, True), (21, 0, 21, True)]


# --- op10 and its stage ---


def distance(item, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
        before = row
    return min(before)


def test_myers_distance():
    random.seed(1)
    for _ in range(200):
        item = "".join(random.choices("abc", k=random.randint(1, 80)))
        text = "".join(random.choices("abc", k=random.randint(0, 90)))
        assert decontaminate.Pattern(item).best(text)[0] == distance(item, text)


def test_op10_against_brute_force(spark, docs):
    random.seed(2)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta"]
    items = [(k, " ".join(random.choices(words, k=14)) + f" item {k * 7919}") for k in range(12)] + [(50, None), (51, ""), (52, "?!")]
    rows = [(1, None), (2, ""), (3, "é " * 30_000)]
    for k in range(60):
        text = list(" ".join(random.choices(words, k=20)) + " " + items[k % 12][1].upper() + " " + " ".join(random.choices(words, k=10)))
        for _ in range(k // 6):
            text[random.randrange(100, len(text) - 60)] = random.choice("xyz ")
        rows.append((10 + k, "".join(text)))
    rows.append(rows[-60])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for i, t in rows:
        line = decontaminate.normal(t or "") if len(t or "") < 10_000 else ""
        for key, item in items:
            item = decontaminate.normal(item or "")
            if item and line and distance(f" {item} ", f" {line} ") <= int(len(item) * decontaminate.RATE):
                want[i, key] += 1
    df = with_clashes(docs(*rows))
    got = Counter((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, benchmark).collect())
    assert got == want and len(want) > 20
    kept = decontaminate.clean(df, benchmark)
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, _ in rows if not any((i, k) in want for k, _ in items))
    assert decontaminate.contaminated(df.limit(0), benchmark).count() == 0
    assert decontaminate.contaminated(df, benchmark.limit(0)).count() == 0
    assert decontaminate.clean(df, benchmark.limit(0)).count() == len(rows)


def test_op10_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    items = [(k, f"a passage of the benchmark numbered {k} of ten thousand") for k in range(20)]
    df = docs(*[(k, f"before {t} after") for k, t in items])
    found = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string"), rate=0.0)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(k, k) for k, _ in items]


@pytest.mark.parametrize("item, text, held", [
    ("he", "the sheet is there", False), ("42", "page 1421 of 42 pages", False), ("yes", "is it so?\nYes!\nwell", True), ("42", "42.", True),
    ("he is in", "the is into", False), ("he is in", "now he is in, and", True), ("a long passage", "xa long passagex", False),
    ("a long passage", "so a long passage it is", True), ("a long passage", "a long passagex", True), ("two words", "a\ntwo, words\nb", True),
    ("two words", "of two words", False), ("such rather exceedingly long item words", "xsuch rather exceedingly long item wordsx", True),
])
def test_short_items_are_words_of_their_own(item, text, held):
    assert bool(decontaminate.Matcher([(1, item)], decontaminate.RATE).matches(text)) == held


def test_op10_holds_one_block_at_a_time(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    calls = []
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: calls.append(name) or df)
    items = [(k, f"a passage of the benchmark numbered {k} of ten thousand") for k in range(4)] + [(9, "one passage many times over")] * 50
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = docs((1, items[0][1]), (2, items[-1][1]), (3, "clean"))
    blocks = decontaminate._blocks(benchmark, "item_id", "text")
    assert max(b.count() for b in blocks) <= 5
    found = decontaminate.contaminated(df, benchmark, rate=0.0)
    assert Counter((r["doc_id"], r["item_id"]) for r in found.collect()) == {(1, 0): 1, (2, 9): 50}
    assert calls == ["found"] * len(blocks)
    assert [r["doc_id"] for r in decontaminate.clean(df, benchmark).collect()] == [3] and "kept" in calls


@pytest.mark.parametrize("kind", ["int", "string", "decimal(12,2)", "smallint"])
def test_op10_item_ids_of_any_type(spark, docs, kind):
    items = spark.createDataFrame([(k, f"a passage of the benchmark numbered {k}") for k in range(3)], "n int, text string")
    benchmark = items.select(F.col("n").cast(kind).alias("item_id"), "text")
    found = decontaminate.contaminated(docs((1, "x\na passage of the benchmark numbered 2"), (2, None)), benchmark, rate=0.0)
    assert dict(found.dtypes)["item_id"] == kind and [float(r["item_id"]) for r in found.collect()] == [2.0]


@pytest.mark.parametrize("whole_words", [1, 3, 9])
def test_op10_word_edges_against_brute_force(whole_words):
    random.seed(whole_words)
    for _ in range(150):
        items = [(k, " ".join("".join(random.choices("ab", k=random.randint(1, 4))) for _ in range(random.randint(1, 9)))) for k in range(4)]
        parts = [random.choice([t, t + "a", "b" + t, t.replace("a", "b", 1), "ab"]) for _, t in items]
        text = random.choice([" ", "\n", "! "]).join(parts)
        matcher = decontaminate.Matcher(items, 0.15, whole_words)
        line, lines = decontaminate.normal(text), {decontaminate.normal(x) for x in text.splitlines()}
        want = {
            k for k, t in items
            if (t in lines | {line} if t.count(" ") + 1 < whole_words else distance(f" {t} ", f" {line} ") <= int(len(t) * 0.15))
        }
        got = matcher.matches(text)
        assert {k for k, _, _ in got} == want and len(got) == len(want)
        for k, edits, end in got:
            if edits == 0:
                assert line[:end].endswith(items[k][1])
