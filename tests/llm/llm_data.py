"""Column names that clash with those the operators make."""

from pyspark.sql import functions as F

CLASHING = ["a", "b", "u", "v", "fp", "key", "node", "root", "shard", "slot", "row", "rank", "walk", "size", "part", "n",
            "score", "spans", "links", "rep", "unit", "id", "t", "h", "x", "block", "bucket", "label", "epoch", "order"]


def with_clashes(df):
    """``df`` with columns named like those the operators make on their way."""
    return df.withColumns({c: F.lit(1) for c in CLASHING if c not in df.columns})
