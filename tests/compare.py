"""Runs a registered query and its SQL and compares rows as sets with multiplicity."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _family(kind: str) -> str:
    kind = kind.lower()
    return {"varchar": "string", "integer": "int"}.get(kind, kind)


def compare(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """What differs; empty when nothing does."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    left = Counter(tuple(row[n] for n in names) for row in df.collect())
    result = con.execute(sql)
    cols = {c[0]: i for i, c in enumerate(result.description)}
    if sorted(cols) != names:
        return [f"columns {names} against {sorted(cols)}"]
    right = Counter(tuple(row[cols[n]] for n in names) for row in result.fetchall())
    found = []
    spark_types = dict(df.dtypes)
    for c in result.description:
        if _family(str(c[1])) != _family(spark_types[c[0]]):
            found.append(f"type of {c[0]}: {spark_types[c[0]]} against {c[1]}")
    if left != right:
        found.append(
            f"{sum(left.values())} rows against {sum(right.values())}; only in Spark "
            f"{list((left - right).items())[:2]}; only in SQL {list((right - left).items())[:2]}"
        )
    return found
