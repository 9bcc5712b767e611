"""Exact stratified samples with target shares, without sorting a class in one task.

Every row gets a key that depends only on its id and the seed. A class is sampled by taking
its smallest keys, which makes the sample exact, repeatable, independent of partitioning, and
nested between mixes. The cut is found from counts per key prefix, and only the rows sharing
the prefix at the cut are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv

PREFIX_DIGITS = 4  # 65,536 prefixes per class


def sample_key(row_id: Column, seed: int, ties: list[str] = []) -> Column:
    """Random-looking key: a digest, then the id itself, and ``ties`` to tell rows of one id apart.

    A NULL id is a key like any other.
    """
    text = F.coalesce(row_id.cast("string"), F.lit(""))
    if ties:
        text = F.concat_ws(":", text, F.to_json(F.struct(*ties)))
    return F.concat(F.md5(F.concat(text, F.lit(f":{seed}"))), F.lit(":"), text)


def _targets(df: DataFrame, mixes: dict[str, dict[str, float]]) -> DataFrame:
    rows = [(m, c, float(s)) for m, shares in mixes.items() for c, s in shares.items()]
    return df.sparkSession.createDataFrame(rows, "dataset string, _class string, _share double")


def stratified_mix(
    df: DataFrame,
    mixes: dict[str, dict[str, float]] = fv.MIXES,
    seed: int = fv.SAMPLE_SEED,
    id_col: str = "problem_id",
    class_col: str = "difficulty",
    ties: list[str] = [],
) -> DataFrame:
    """All mixes at once, tagged by ``dataset``.

    Of each class a mix takes ``min(int(rows * share), rows of the class)`` rows, where
    ``rows`` counts the whole input, NULL and repeated ids included. Rows of one id are told apart
    by the columns in ``ties``; where a cut falls between rows that still are equal, the query
    raises. The three readings of ``df`` share its exchanges; store ``df`` first when it is costly
    and has none.

    Nothing but counts and the rows at a cut is shuffled, and the broadcast tables hold at
    most one row per mix and class, whatever the input.
    """
    # Ids and keys that cannot be NULL keep the optimizer from adding a filter to some of the
    # three readings and not to others, which would stop them from sharing exchanges.
    key = F.coalesce(sample_key(F.col(id_col), seed, ties), F.lit(""))
    keyed = df.withColumn("_key", key)
    # Classes no mix names only add to the number of rows, so they are counted together.
    named = sorted({c for shares in mixes.values() for c in shares})
    prefixed = keyed.select(
        F.when(F.col(class_col).isin(named), F.col(class_col)).alias("_class"),
        F.substring("_key", 1, PREFIX_DIGITS).alias("_prefix"),
        "_key",
    )

    # At most 65,536 counts per named class, and as many for the rest, pass these windows.
    counts = prefixed.groupBy("_class", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    in_class = Window.partitionBy("_class")
    running = counts.select(
        "_class", "_prefix", "_n",
        F.sum("_n").over(
            in_class.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
        ).alias("_upto"),
        F.sum("_n").over(in_class).alias("_available"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_rows"),
    )
    wanted = F.floor(F.col("_rows").cast("double") * F.col("_share"))
    before = F.col("_upto") - F.col("_n")
    at_cut = (
        running.join(F.broadcast(_targets(df, mixes)), "_class")
        .withColumn("_wanted", F.least(wanted, F.col("_available")))
        .where((before < F.col("_wanted")) & (F.col("_wanted") <= F.col("_upto")))
        .select("dataset", "_class", "_prefix", (F.col("_wanted") - before).alias("_rank"))
    )

    # The last key taken, from ranking only the rows that share the prefix at the cut.
    at_prefix = Window.partitionBy("dataset", "_class", "_prefix").orderBy("_key")
    cuts = (
        prefixed.join(F.broadcast(at_cut), ["_class", "_prefix"])
        .withColumn("_place", F.row_number().over(at_prefix))
        .withColumn("_with_equals", F.count(F.lit(1)).over(at_prefix))
        .where(F.col("_place") == F.col("_rank"))
        .select(
            "dataset", "_class",
            F.when(F.col("_with_equals") == F.col("_rank"), F.col("_key"))
            .otherwise(F.raise_error(F.concat(F.lit("equal rows at a cut, name columns in ties: "), "_key")))
            .alias("_last"),
        )
    )
    return keyed.join(
        F.broadcast(cuts),
        (F.col(class_col) == F.col("_class")) & (F.col("_key") <= F.col("_last")),
    ).select("dataset", *[F.col(c) for c in df.columns])


def shuffle_rows(df: DataFrame, seed: int = fv.SAMPLE_SEED, id_col: str = "problem_id") -> DataFrame:
    """Rows in a repeatable random order: a range sort by a second key."""
    return df.withColumn("shuffle_key", sample_key(F.col(id_col), seed + 1)).orderBy("shuffle_key")


def mix_summary(
    samples: DataFrame, ks: list[int] = fv.PASS_AT, names: list[str] | None = None
) -> DataFrame:
    """Size, classes and mean pass@k per dataset; NULL shares for a named one without rows."""
    by_class = [F.count_if(F.col("difficulty") == c).alias(f"{c}_Count") for c in fv.CLASSES]
    table = samples.groupBy(F.col("dataset").alias("Dataset")).agg(
        F.count(F.lit(1)).alias("Total_Samples"),
        *by_class,
        *[F.avg(f"pass@{k}").alias(f"Avg_Pass@{k}") for k in ks],
    )
    counted = ["Total_Samples", *[f"{c}_Count" for c in fv.CLASSES]]
    if names is not None:
        wanted = samples.sparkSession.createDataFrame([(n,) for n in names], "Dataset string")
        table = wanted.join(table, "Dataset", "left").fillna(0, counted)
    rows = F.nullif(F.col("Total_Samples"), F.lit(0))
    return table.select(
        "Dataset",
        *counted,
        *[(F.col(f"{c}_Count") / rows).alias(f"{c}_Pct") for c in fv.CLASSES],
        *[F.col(f"Avg_Pass@{k}") for k in ks],
    )
