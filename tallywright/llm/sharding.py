"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

A key belongs to the first virtual node clockwise of its hash. A shard takes no more rows than its
capacity; rows beyond it go on clockwise to the next shard that has room. Who stays in a full shard
is decided by a second hash of the key, so a cut is one threshold per shard and step around the
ring, found from counts by hash prefix. The whole assignment is then an expression of a row's own
hashes and at most ``shards`` squared thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tallywright.sources.scratch import stored

PREFIX = 14  # bits of a hash counted at a time: at most 2**14 counts a shard reach the driver
SLOT_ROWS = 20_000  # rows numbered in one window group, about
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def ring(shards: int, virtual: int, seed: int) -> tuple[np.ndarray, list[list[int]]]:
    """Sorted points of all virtual nodes and, by point, the shards in the order met clockwise."""
    points = sorted(
        (xxhash.xxh64_intdigest(f"{s}/{v}", seed) - (1 << 63), s)
        for s in range(shards)
        for v in range(virtual)
    )
    owners = [s for _, s in points]
    walks = [
        list(dict.fromkeys(owners[(i + j) % len(owners)] for j in range(len(owners))))
        for i in range(len(owners))
    ]
    return np.array([p for p, _ in points], np.int64), walks


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may take: with no slack they add up to all rows and differ by at most one."""
    if slack:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _walk(points: np.ndarray, walks: list[list[int]], position: Column) -> Column:
    """The shards met clockwise of a position, nearest first."""
    ways = np.array(walks, np.int32)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            at = np.searchsorted(points, batch.to_numpy(zero_copy_only=False), "left") % len(points)
            offsets = np.arange(len(at) + 1, dtype=np.int32) * ways.shape[1]
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ways[at].ravel()))

    return F.arrow_udf(run, "array<int>")(position)


class Cuts:
    """Thresholds by step and shard: a row stays where (rank, row) is at most the shard's."""

    def __init__(self):
        self.steps: list[list[tuple[int, int]]] = []

    def at(self, step: int) -> Column:
        return F.element_at("walk", step + 1)

    def stays(self, step: int) -> Column:
        ranks, rows = (F.lit([cut[k] for cut in self.steps[step]]) for k in (0, 1))
        place = self.at(step) + 1
        rank = F.element_at(ranks, place)
        return (F.col("rank") < rank) | ((F.col("rank") == rank) & (F.col("row") <= F.element_at(rows, place)))

    def shard(self) -> Column:
        return F.coalesce(*(F.when(self.stays(k), self.at(k)) for k in range(len(self.steps))))

    def waiting(self, table: DataFrame) -> DataFrame:
        for k in range(len(self.steps)):
            table = table.where(~self.stays(k))
        return table.withColumn("at", self.at(len(self.steps)))


def _prefix(name: str) -> Column:
    return F.shiftright(F.col(name), 64 - PREFIX)


def _boundary(rows: DataFrame, name: str, need: dict[int, int]) -> dict[int, tuple[int, int, int]]:
    """By shard: the prefix of ``name`` that holds the needed row, the rows below it, and its own."""
    counts = rows.groupBy("at", _prefix(name).alias("prefix")).count().collect()
    found = {}
    for s, wanted in need.items():
        below = 0
        for prefix, count in sorted((r["prefix"], r["count"]) for r in counts if r["at"] == s):
            if below + count >= wanted:
                found[s] = (prefix, below, count)
                break
            below += count
    return found


def _within(rows: DataFrame, name: str, found: dict[int, tuple[int, int, int]]) -> DataFrame:
    wanted = [(F.col("at") == s) & (_prefix(name) == prefix) for s, (prefix, _, _) in found.items()]
    condition = wanted[0]
    for more in wanted[1:]:
        condition = condition | more
    return rows.where(condition)


def _cuts(waiting: DataFrame, need: dict[int, int]) -> dict[int, tuple[int, int]]:
    """The (rank, row) of the needed row of each shard in ``need``."""
    found = _boundary(waiting, "rank", need)
    by_shard = W.Window.partitionBy("at")
    upto = by_shard.orderBy("rank").rowsBetween(W.Window.unboundedPreceding, 0)
    left = F.element_at(F.lit([need.get(s, 0) - found[s][1] if s in found else 0 for s in range(max(need) + 1)]), F.col("at") + 1)
    # Repeats of one key have one rank: they are counted before the window sees them.
    ranks = (
        _within(waiting, "rank", found).groupBy("at", "rank").count()
        .withColumn("upto", F.sum("count").over(upto))
        .where((F.col("upto") >= left) & (F.col("upto") - F.col("count") < left))
        .collect()
    )
    cuts = {r["at"]: (r["rank"], MOST) for r in ranks}
    tied = {r["at"]: need[r["at"]] - found[r["at"]][1] - (r["upto"] - r["count"]) for r in ranks}
    tied = {s: tied[s] for r in ranks for s in [r["at"]] if tied[s] < r["count"]}
    if tied:
        same = None
        for s in tied:
            condition = (F.col("at") == s) & (F.col("rank") == cuts[s][0])
            same = condition if same is None else same | condition
        rows = waiting.where(same)
        inner = _boundary(rows, "row", tied)
        wanted = F.element_at(F.lit([tied.get(s, 0) - inner[s][1] if s in inner else 0 for s in range(max(tied) + 1)]), F.col("at") + 1)
        for r in (
            _within(rows, "row", inner)
            .withColumn("n", F.row_number().over(by_shard.orderBy("row")))
            .where(F.col("n") == wanted)
            .collect()
        ):
            cuts[r["at"]] = (cuts[r["at"]][0], r["row"])
    return cuts


def assign(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = 8, virtual: int = 128,
    slack: float = 0.0, seed: int = 17, carried: tuple[str, ...] = (),
) -> DataFrame:
    """(id, size, text_crc32, shard, slot, *carried): every row's shard and its place there.

    Capacity is in rows: ``slack`` 0 gives counts at most one apart; with more slack fewer rows
    leave their first shard, and fewer move when a shard is added. size is the text's UTF-8 bytes
    (NULL: none) and one; slots run from 0 without gaps. Repeated rows and ids are rows like any
    other (a cut among repeats of one key falls between them); NULL ids share one place of the ring.
    An empty table gives an empty one; other columns than ``carried`` are left out.

    Hashes are stored once. Each step around the ring counts the rows still waiting by hash prefix;
    at most ``shards`` * 2**14 counts reach the driver, whatever the size of the table.
    """
    points, walks = ring(shards, virtual, seed)
    table = docs.select(
        F.col(id),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col(id)).alias("position"),
        F.xxhash64(F.lit(seed + 1), F.col(id)).alias("rank"),
        F.xxhash64(F.monotonically_increasing_id()).alias("row"), *carried,
    )
    table = stored(table.withColumn("walk", _walk(points, walks, F.col("position"))).drop("position"), "ring")
    total = table.count()
    room = capacities(total, shards, slack)
    cuts = Cuts()
    waiting = total
    while waiting:
        rows = cuts.waiting(table)
        here = {r["at"]: r["count"] for r in rows.groupBy("at").count().collect()}
        waiting -= sum(min(room[s], n) for s, n in here.items())
        over = {s: room[s] for s, n in here.items() if 0 < room[s] < n}
        step = _cuts(rows, over) if over else {}
        cuts.steps.append(
            [step.get(s, (MOST, MOST) if room[s] else (LEAST, LEAST)) for s in range(shards)]
        )
        room = [room[s] - min(room[s], here.get(s, 0)) for s in range(shards)]
    if not cuts.steps:
        cuts.steps.append([(MOST, MOST)] * shards)

    bits = max(1, (max(total, 1) // (shards * SLOT_ROWS)).bit_length())
    placed = table.select(
        id, "size", "text_crc32", "row", cuts.shard().alias("shard"),
        F.shiftright(F.col("row"), 64 - bits).alias("part"), *carried,
    )
    before = W.Window.partitionBy("shard").orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "part").count()
        .select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    )
    order = W.Window.partitionBy("shard", "part").orderBy("row")
    return (
        placed.withColumn("n", F.row_number().over(order))
        .join(starts, ["shard", "part"])
        .select(id, "size", "text_crc32", "shard", (F.col("start") + F.col("n") - 1).alias("slot"), *carried)
    )


def write_shards(docs: DataFrame, path: str, id: str = "doc_id", shards: int = 8) -> None:
    """Writes ``docs`` as Parquet, one folder a shard: every row once, repeats and NULL ids included.

    Rows are numbered and stored, and joined with their places by that number.
    """
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    places = assign(numbered, id, shards=shards, carried=("__row",)).select("__row", "shard", "slot")
    joined = numbered.join(places, "__row").drop("__row")
    joined.repartitionByRange("shard", "slot").write.partitionBy("shard").parquet(path)
