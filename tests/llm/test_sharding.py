"""Bounded loads on the ring against a walk of every row, where shards overflow."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import sharding


def placed(rows, shards, virtual, slack, seed=17):
    """Shard by id: step by step around the ring, each shard keeps the rows of the smallest ranks it has room for."""
    points, walks = sharding.ring(shards, virtual, seed)
    room = sharding.capacities(len(rows), shards, slack)
    ways = {r["doc_id"]: walks[int(np.searchsorted(points, r["p"], "left")) % len(points)] for r in rows}
    rank = {r["doc_id"]: r["r"] for r in rows}
    waiting, found, step = set(ways), {}, 0
    while waiting:
        here = defaultdict(list)
        for i in waiting:
            here[ways[i][step]].append(i)
        for shard, ids in here.items():
            for i in sorted(ids, key=rank.get)[: room[shard]]:
                found[i] = shard
                waiting.remove(i)
            room[shard] -= min(room[shard], len(ids))
        step += 1
    return found


@pytest.mark.parametrize("count, shards, virtual, slack", [(900, 8, 128, 0.0), (700, 5, 2, 0.0), (640, 6, 1, 0.1), (7, 8, 128, 0.0), (500, 3, 1, 0.3)])
def test_overflow_equals_the_plain_walk(spark, count, shards, virtual, slack):
    df = spark.range(count).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = df.select("doc_id", F.xxhash64(F.lit(17), "doc_id").alias("p"), F.xxhash64(F.lit(18), "doc_id").alias("r")).collect()
    want = placed(rows, shards, virtual, slack)
    got = {r["doc_id"]: r["shard"] for r in sharding.assign(df, shards=shards, virtual=virtual, slack=slack).collect()}
    assert got == want
    points, walks = sharding.ring(shards, virtual, 17)
    home = {r["doc_id"]: walks[int(np.searchsorted(points, r["p"], "left")) % len(points)][0] for r in rows}
    assert any(got[i] != home[i] for i in got) or count < 10
