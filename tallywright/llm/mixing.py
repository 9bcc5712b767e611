"""Mixing sources to target weights: budgets flow down a domain-language-source tree.

A node's token budget is split among its children by weight. A child that has fewer tokens (times
the allowed epochs) than its part takes what it has, and the rest goes to its siblings by their
weights; only what all of them cannot take is left to the level above, because a node is never
given more than its leaves can deliver. Each leaf then takes whole epochs and, of the next one, the
prefix of its documents in the order of a seeded hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tallywright.sources.scratch import stored

BUCKET_DIGITS = 4  # hex digits of the hash by which a leaf's tokens are first counted
MOST_BROADCAST = 50_000  # leaves, of some 100 bytes each
WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("__domain", "__lang", "__source")


def _weight(level: Column, weights: dict[str, int]) -> Column:
    """An integer weight; names without one weigh 1."""
    if any(w < 1 for w in weights.values()):
        raise ValueError("weights are integers of at least 1; leave out rows of unwanted nodes")
    if not weights:
        return F.lit(1).cast("decimal(38,0)")
    named = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    return F.coalesce(F.try_element_at(named, level), F.lit(1)).cast("decimal(38,0)")


def split_budget(children: DataFrame, parent: list[str], name: str, weights: dict[str, int]) -> DataFrame:
    """``children`` (parent columns, name, cap, budget of the parent) with each child's ``part``.

    In the order of cap by weight, a child is filled if its cap is at most its weight's part of what
    is left; the others share the rest in proportion, rounded down. Exact in integers. One row a
    tree node, so a window over the siblings is as large as the tree is wide, not as the data.
    """
    siblings = W.Window.partitionBy(*parent) if parent else W.Window.partitionBy(F.lit(0))
    order = siblings.orderBy("ratio", name)
    before = order.rowsBetween(W.Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.Window.unboundedFollowing)
    zero = F.lit(0).cast("decimal(38,0)")
    ranked = (
        children.withColumn("w", _weight(F.col(name), weights))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("w").cast("double"))
        .withColumn("taken", F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("share", F.sum("w").over(after))
        .withColumn("full", F.expr("cap * share <= w * (budget - taken)"))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(siblings), zero))
        .withColumn("others", F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings))
    )
    part = F.when(F.col("full"), F.col("cap")).otherwise(F.expr("(w * rest) div others"))
    return ranked.withColumn("part", part.cast("decimal(38,0)")).drop(
        "w", "ratio", "taken", "share", "full", "rest", "others"
    )


def leaf_budgets(leaves: DataFrame, share: tuple[int, int], epochs: int, weights: tuple[dict, dict, dict]) -> DataFrame:
    """(levels, tokens, budget): every leaf's budget out of ``share`` of all tokens."""
    level = leaves.withColumn("cap", (F.col("tokens") * epochs).cast("decimal(38,0)"))
    tables = [level]
    for depth in (2, 1):
        level = level.groupBy(*LEVELS[:depth]).agg(F.sum("cap").cast("decimal(38,0)").alias("cap"))
        tables.append(level)
    tables.reverse()
    total = leaves.agg(F.sum("tokens").alias("t")).select(
        F.expr(f"cast((cast(coalesce(t, 0) as decimal(38,0)) * {share[0]}) div {share[1]} as decimal(38,0))").alias("budget")
    )
    given = tables[0].join(F.broadcast(total))  # one row
    for depth in range(3):
        parent = list(LEVELS[:depth])
        if depth:
            given = tables[depth].join(given, parent)
        given = split_budget(given, parent, LEVELS[depth], weights[depth])
        given = given.select(*LEVELS[: depth + 1], F.col("part").alias("budget"))
    return leaves.join(given, list(LEVELS)).withColumn("budget", F.col("budget").cast("bigint"))


def _order(seed: int, epoch: Column, id: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch, F.coalesce(F.col(id).cast("string"), F.lit(""))))


def mix(
    docs: DataFrame, domain: Column, lang: Column, source: Column,
    weights: tuple[dict, dict, dict] = ({}, {}, {}), share: tuple[int, int] = (3, 4), epochs: int = 2,
    seed: int = 23, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them, with ``__epoch`` from 0.

    Tokens are runs without white space; ``share`` of all tokens is the budget. A leaf's prefix ends
    before the first document that would exceed its budget; documents with the same id have one
    place in the order and are taken together or not at all. NULL names count as '', NULL texts and
    empty ones as no tokens: they belong to the prefix where their place does. Repeated rows are
    rows of their own. An empty table gives an empty one. Columns of ``docs`` may have any name that
    does not begin with two underscores.

    Tokens are counted once and stored; then a leaf's tokens are summed by hash prefix, and only the
    documents at the cut are ordered, so a leaf with a third of all rows is no single task. Texts
    are not shuffled where the leaves are at most ``MOST_BROADCAST``.
    """
    named = docs.withColumns(
        {n: F.coalesce(c.cast("string"), F.lit("")) for n, c in zip(LEVELS, (domain, lang, source))}
    )
    counted = stored(
        named.select(
            F.col(id).alias("__id"), *LEVELS,
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("n"),
        ),
        "tokens",
    )
    leaves = counted.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    plan = stored(
        leaf_budgets(leaves, share, epochs, weights).select(
            *LEVELS, "tokens", "budget",
            F.expr("case when tokens = 0 then 0 else cast(budget div tokens as int) end").alias("whole"),
            F.expr("case when tokens = 0 then 0 else budget % tokens end").alias("rest"),
        ),
        "budgets",
    )
    # The plan has one row a leaf; sent to the rows if it is small, else joined by their leaf.
    few = plan.count() <= MOST_BROADCAST
    known = F.broadcast if few else (lambda df: df)
    open_leaves = plan.where(F.col("whole") < epochs)
    rows = counted.join(known(open_leaves.select(*LEVELS, "whole", "rest")), list(LEVELS)).withColumn(
        "order", _order(seed, F.col("whole"), "__id")
    ).withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS))
    before = W.Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(W.Window.unboundedPreceding, -1)
    cut = (
        rows.groupBy(*LEVELS, "bucket", "rest").agg(F.sum("n").alias("in_bucket"))
        .withColumn("below", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
    )
    at_cut = cut.where("below <= rest and below + in_bucket > rest").select(*LEVELS, "bucket", "below")
    within = W.Window.partitionBy(*LEVELS).orderBy("order")
    last = (
        rows.join(at_cut, [*LEVELS, "bucket"])
        .groupBy(*LEVELS, "bucket", "rest", "below", "order").agg(F.sum("n").alias("n"))
        .withColumn("upto", F.col("below") + F.sum("n").over(within))
        .where("upto <= rest")
        .groupBy(*LEVELS).agg(F.max("order").alias("upto"))
    )
    # Where no document of the cut's bucket fits, the prefix ends with the bucket before it.
    ends = (
        open_leaves.select(*LEVELS, "whole")
        .join(at_cut.select(*LEVELS, "bucket"), list(LEVELS), "left")
        .join(last, list(LEVELS), "left")
        .select(*LEVELS, F.coalesce("upto", "bucket", F.lit("g")).alias("__upto"))
    )
    limits = plan.select(*LEVELS, F.col("whole").alias("__whole")).join(ends, list(LEVELS), "left")
    in_prefix = F.coalesce(_order(seed, F.col("__whole"), id) <= F.col("__upto"), F.lit(False))
    copies = F.col("__whole") + in_prefix.cast("int")
    return (
        named.join(known(limits), list(LEVELS))
        .withColumn("__copies", copies)
        .where("__copies > 0")
        .withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
        .drop(*LEVELS, "__whole", "__upto", "__copies")
    )
