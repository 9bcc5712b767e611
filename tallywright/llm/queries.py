"""The registered queries of this subpackage: production parameters, whole tables, whole results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import decontaminate, html_text, katz, langid, mixing, negatives, pii, resample, sharding, simhash, substrings, toxicity, vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def sharded(docs: DataFrame) -> DataFrame:
    return sharding.assign(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; counts are at most one apart."""
    return sharded(table(spark, sf_dir, "documents"))


def fold(count: int) -> Column:
    """crc32 of the id as text, by ``count``; a NULL id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(count))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels of four of five folds."""
    docs = table(spark, sf_dir, "documents")
    training = docs.where(fold(5) != 0)
    labelled = toxicity.labelled_texts(training, table(spark, sf_dir, "labels"))
    model = toxicity.fit(training, labelled)
    scores = toxicity.score(docs, model)
    return scores.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a model of six of seven folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.score(docs.withColumn("held", fold(7) == 2), "held")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold(4) != 2))
    return langid.predict(docs, model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the patterns' counts and digest, and all spans."""
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["base"])

    def of(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [of(kind) for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


DOMAIN_WEIGHTS = {"reference": 3, "web": 1}
LANG_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 2}


def domain() -> Column:
    """The tables name no domain; half of the sources, by hash, count as reference works."""
    half = F.substring(F.md5(F.coalesce("source", F.lit(""))), 1, 1) < "8"
    return F.when(half, "reference").otherwise("web")


def mixed(docs: DataFrame) -> DataFrame:
    return mixing.mix(
        docs, domain(), F.col("lang"), F.col("source"), (DOMAIN_WEIGHTS, LANG_WEIGHTS, {})
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a mix of three quarters of all tokens, by epoch."""
    docs = table(spark, sf_dir, "documents")
    return mixed(docs).select(
        "doc_id", domain().alias("domain"), "lang", "source", F.col("__epoch").alias("epoch")
    )


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings at a cosine of 0.9."""
    return vectors.cosine_groups(table(spark, sf_dir, "embeddings"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, and which."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that stood before."""
    docs = table(spark, sf_dir, "documents")
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding; every seventh counts under the next label."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document toward the benchmark's texts, and the rank of the drawn tenth."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_text, op2_simhash, op3_sharding, op4_mixing, op5_toxicity, op6_katz, op7_language, op8_pii, op9_vectors, op10_decontaminate, op11_substrings, op12_negatives, op13_resample)}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries it can express; the others are tested against brute force."""
    return {"op4_mixing": OP4, "op11_substrings": OP11, "op12_negatives": OP12, "op13_resample": OP13}


def _level(name: str, keys: str, parent: str, weights: dict[str, int]) -> str:
    """CTEs that split the budget of ``parent`` (keys, budget) among the nodes of a level."""
    last = keys.split(", ")[-1]
    up = ", ".join(keys.split(", ")[:-1]) or "1"
    weight = "1" if not weights else "case " + last + " " + " ".join(
        f"when '{k}' then {v}" for k, v in weights.items()
    ) + " else 1 end"
    join = f"join {parent} using ({up})" if up != "1" else f"cross join {parent}"
    over = "" if up == "1" else f"partition by {up} "
    return f"""
{name}_caps as (
  select {keys}, sum(tokens * 2) as cap, {weight} as w from leaves group by {keys}),
{name}_ranked as (
  select *, coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) as taken,
    sum(w) over (o rows between current row and unbounded following) as share
  from {name}_caps {join}
  window o as ({over}order by cap::double / w::double, {last})),
{name}_full as (select *, cap * share <= w * (budget - taken) as filled from {name}_ranked),
{name} as (
  select {keys}, case when filled then cap else
      w * (budget - coalesce(sum(cap) filter (filled) over ({over}), 0))
      // (sum(w) filter (not filled) over ({over})) end as budget
  from {name}_full)"""


OP4 = f"""
with d as (
  select doc_id, lang, source,
    case when substr(md5(coalesce(source, '')), 1, 1) < '8' then 'reference' else 'web' end as domain,
    coalesce(lang, '') as l, coalesce(source, '') as s,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n
  from documents),
leaves as (select domain, l, s, sum(n) as tokens from d group by domain, l, s),
everything as (select sum(tokens) * 3 // 4 as budget from leaves),
{_level("domains", "domain", "everything", DOMAIN_WEIGHTS)},
{_level("langs", "domain, l", "domains", LANG_WEIGHTS)},
{_level("sources", "domain, l, s", "langs", {})},
planned as (
  select domain, l, s, case when tokens = 0 then 0 else budget // tokens end as whole,
    case when tokens = 0 then 0 else budget % tokens end as rest
  from leaves join sources using (domain, l, s)),
placed as (
  select *, sum(n) over (partition by domain, l, s
    order by md5('23:' || whole || ':' || coalesce(doc_id::varchar, ''))) as upto
  from d join planned using (domain, l, s)),
copies as (
  select *, whole + (whole < 2 and upto <= rest)::int as copies from placed)
select doc_id, domain, lang, source, epoch::int as epoch
from copies, unnest(range(copies::bigint)) as t(epoch)
"""

OP11 = """
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
places as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d),
windows as (
  select doc_id, i, w[i] as word,
    case when i + 19 <= len(w) then array_to_string(w[i:i + 19], ' ') end as win from places),
found as (
  select *, win is not null and row_number() over (partition by win order by doc_id, i) > 1 as again
  from windows),
covered as (
  select *, max(again::int) over (partition by doc_id order by i
    rows between 19 preceding and current row) as gone from found)
select doc_id, len(any_value(w))::bigint as n_words, coalesce(sum(gone), 0)::bigint as n_removed,
  sha256(coalesce(string_agg(word, ' ' order by i) filter (gone = 0), '')) as kept_sha256
from d left join covered using (doc_id) group by doc_id
"""

OP12 = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    list_dot_product(a.q, b.q)::bigint as score
  from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select anchor_id, positive_id,
  row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::int as rank,
  other_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""

# crc32 of a word's bytes, bit by bit; each distinct word once.
_CRC = """
xor(4294967295::ubigint, list_reduce(
  list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::ubigint),
  lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::ubigint[],
    lambda r, k: case when r % 2 = 1 then xor(r // 2, 3988292384::ubigint) else r // 2 end, xor(c, b)),
  4294967295::ubigint)) % 10000"""

OP13 = f"""
with texts as (
  select doc_id, false as wanted, text from documents
  union all select null, true, text from benchmark),
words as (
  select doc_id, wanted, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word
  from texts),
buckets as (select word, {_CRC} as bucket from (select distinct word from words)),
counts as (
  select bucket, count_if(not wanted) as s, count_if(wanted) as t
  from words join buckets using (word) group by bucket),
totals as (select sum(s) as s_all, sum(t) as t_all from counts),
gains as (
  select bucket, floor(1000 * ln((t + 1)::double * (s_all + 10000)::double
    / ((s + 1)::double * (t_all + 10000)::double)))::bigint as gain
  from counts, totals),
weights as (
  select doc_id, count(*) as n_features, sum(gain)::bigint as total
  from words join buckets using (word) join gains using (bucket) where not wanted group by doc_id),
scored as (
  select doc_id, coalesce(n_features, 0) as n_features,
    coalesce(floor(total::hugeint / n_features), 0)::bigint as weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::ubigint::double as h
  from documents left join weights using (doc_id)),
noisy as (select *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::bigint as score from scored),
ranked as (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
    count(*) over (partition by n_features >= 20) as n
  from noisy)
select doc_id, n_features, weight, score,
  case when n_features >= 20 and place <= n * 10 // 100 then place end as rank
from ranked
"""
