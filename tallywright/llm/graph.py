"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.sources.scratch import remove, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them; u > v before and after."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least.hint("merge"), "u")
    return (
        moved.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node it reaches.

    Alternates large-star and small-star steps until no link changes, which takes a number of
    rounds logarithmic in the longest chain. Each step is a minimum per node (with a partial step)
    and a sorted join of unique keys, so a node with very many links is split by the skew join and
    no table passes the driver. Every round is written to the shared folder and the one before is deleted. Links with a NULL end and
    links to oneself say nothing and are left out; no links give an empty table.
    """
    spark = links.sparkSession
    edges = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = edges.agg(mark.alias("m")).first()["m"]
    while before[0]:
        after = stored(_small_star(_large_star(edges)), "links")
        remove(spark, edges)
        edges, now = after, after.agg(mark.alias("m")).first()["m"]
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
