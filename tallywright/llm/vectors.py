"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned onto their principal axes, the strongest first; a turn
changes no cosine. They are cut into tiles by their leading coordinates. Two tiles are compared
unless the ranges of these coordinates and the longest remainders already keep every cosine below
the threshold. Inside a pair of tiles products grow step by step: after the first leading coordinates
and again after all of these, what the rest can add is at most the product of the suffixes' lengths.
Only pairs that can still reach the threshold go on to the whole product. The turn is for the bounds
only: cosines come from the vectors as given, and those next to the threshold from one formula,
dot / sqrt(square * square), which is exact where the products of the components are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm.graph import components
from tallywright.sources.scratch import stored

TILE_ROWS = 4096  # vectors of a tile, about
SAMPLE_ROWS = 20_000  # vectors the tiles' borders are chosen from; any border gives the same links
BOX = 8  # leading coordinates whose ranges bound a pair of tiles
BLOCK_BOXES = 1024  # boxes that meet as many others in one task
STRIPE = 1024  # rows of one tile compared with the other at a time
MARGIN = 1e-4  # single precision may err by less; survivors are computed in double
NEAR = 1e-9  # double precision may err by less; cosines as near to the threshold are decided by the formula
STEPS = (8,)  # coordinates after which a product is bounded, before all leading ones
TOO_MANY = 0.02  # share of survivors from which a stripe's products are computed as a whole


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.float64).reshape(-1, width)


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector as bytes), NULL for vectors without a direction.

    Components are multiplied by a power of two, which rounds nothing, so that no square overflows.
    """
    for batch in batches:
        found = []
        for value in batch.column(1):
            unit = None
            if value.is_valid and len(value.values) and not value.values.null_count:
                v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(v).max()
                if np.isfinite(top) and top > 0:
                    unit = np.ldexp(v, -int(np.frexp(top)[1])).tobytes()
            found.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "unit"])


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows of length one."""
    return rows / np.sqrt((rows**2).sum(axis=1))[:, None]


def _moments(width: int):
    """(at, sums): the rows of a task's second moments, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _scaled(_matrix(batch.column(0), width))
            total += m.T @ m
        packed = pa.array([r.tobytes() for r in total], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), packed], names=["at", "sums"])

    return run


def _added(width: int):
    def run(group: pa.Table) -> pa.Table:
        total = _matrix(group["sums"], width).sum(axis=0)
        return pa.table({"at": group["at"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    return run


def principal_axes(units: DataFrame, width: int) -> np.ndarray:
    """Columns are the axes, strongest first: eigenvectors of the second moments of all vectors.

    width packed rows of them reach the driver, whatever the number of vectors.
    """
    sums = np.zeros((width, width))
    parts = units.select("unit").mapInArrow(_moments(width), "at int, sums binary")
    for r in parts.groupBy("at").applyInArrow(_added(width), "at int, sums binary").collect():
        sums[r["at"]] = np.frombuffer(r["sums"], np.float64)
    values, axes = np.linalg.eigh(sums)
    return axes[:, np.argsort(-values)]


class Tiles:
    """Borders that halve a sample again and again, along the axis on which it spreads most."""

    def __init__(self, sample: np.ndarray, count: int):
        self.nodes: list[tuple[int, float, int, int]] = []
        self.count = 0
        self.root = self._cut(sample[:, :BOX], max(1, count))

    def _cut(self, rows: np.ndarray, count: int) -> int:
        axis = int(np.argmax(rows.std(axis=0))) if len(rows) > 1 else 0
        border = float(np.median(rows[:, axis])) if len(rows) > 1 else 0.0
        low = rows[:, axis] <= border if len(rows) > 1 else np.zeros(0, bool)
        if count < 2 or len(rows) < 2 or low.all():
            self.count += 1
            return -self.count
        place = len(self.nodes)
        self.nodes.append((0, 0.0, 0, 0))
        left = self._cut(rows[low], count // 2)
        right = self._cut(rows[~low], count - count // 2)
        self.nodes[place] = (axis, border, left, right)
        return place

    def of(self, rows: np.ndarray) -> np.ndarray:
        found = np.zeros(len(rows), np.int32)
        waiting = [(self.root, np.arange(len(rows)))]
        while waiting:
            node, at = waiting.pop()
            if node < 0:
                found[at] = -node - 1
            elif len(at):
                axis, border, left, right = self.nodes[node]
                low = rows[at, axis] <= border
                waiting += [(left, at[low]), (right, at[~low])]
        return found


def _deal(axes: np.ndarray, tiles: Tiles):
    """(tile, reps, rows, times): the vectors of a task, packed by the tile that their turned form is in."""
    width = len(axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1), width)
            turned = _scaled(rows) @ axes[:, :BOX]
            reps = batch.column(0).to_numpy(zero_copy_only=False)
            times = batch.column(2).to_numpy(zero_copy_only=False)
            tile = tiles.of(turned)
            named = np.unique(tile)
            where = [np.flatnonzero(tile == t) for t in named]
            packs = [pa.array([x[at].tobytes() for at in where], pa.binary()) for x in (reps, rows, times)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(named.astype(np.int64)), *packs], names=["tile", "reps", "rows", "times"]
            )

    return run


def _pieces(axes: np.ndarray):
    """(piece, reps, rows, times, box): tiles, sorted, joined to pieces of at most ``TILE_ROWS``."""

    width = len(axes)

    def piece(tile: int, number: int, reps: bytes, rows: bytes, times: bytes) -> pa.RecordBatch:
        turned = _scaled(np.frombuffer(rows, np.float64).reshape(-1, width)) @ axes[:, :BOX]
        rest = np.sqrt(np.maximum(0, 1 - (turned[:, :BOX] ** 2).sum(axis=1)))
        sides = np.concatenate((turned[:, :BOX], rest[:, None]), axis=1)
        box = np.concatenate((sides.min(axis=0), sides.max(axis=0))).tobytes()
        columns = [pa.array([tile << 24 | number], pa.int64())]
        columns += [pa.array([x], pa.binary()) for x in (reps, rows, times, box)]
        return pa.RecordBatch.from_arrays(columns, names=["piece", "reps", "rows", "times", "box"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, number, held = None, 0, [b"", b"", b""]
        sizes = (8, 8 * width, 8)
        for batch in batches:
            for k in range(batch.num_rows):
                now, *more = (c[k].as_py() for c in batch.columns)
                if now != tile:
                    if held[0]:
                        yield piece(tile, number, *held)
                    tile, number, held = now, 0, [b"", b"", b""]
                held = [x + y for x, y in zip(held, more)]
                while len(held[0]) >= 8 * TILE_ROWS:
                    yield piece(tile, number, *(x[: n * TILE_ROWS] for x, n in zip(held, sizes)))
                    held = [x[n * TILE_ROWS :] for x, n in zip(held, sizes)]
                    number += 1
        if held[0]:
            yield piece(tile, number, *held)

    return run


def _reachable(cosine: float):
    """(i, j): pieces i <= j of two blocks whose boxes allow a cosine of ``cosine``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                sides = []
                for name in ("x", "y"):
                    packed = batch.column(name)[k].as_py()
                    sides.append(
                        (np.array([b["piece"] for b in packed], np.int64),
                         np.frombuffer(b"".join(b["box"] for b in packed), np.float64).reshape(len(packed), 2, -1))
                    )
                (first, a), (second, b) = sides
                same = batch.column("bi")[k] == batch.column("bj")[k]
                found: list[list[np.ndarray]] = [[], []]
                for n, one in zip(first, a):
                    low, high = one
                    most = np.maximum.reduce([low * b[:, 0], low * b[:, 1], high * b[:, 0], high * b[:, 1]])
                    can = most.sum(axis=1) >= cosine - MARGIN
                    if same:
                        can &= second >= n
                    found[0].append(np.full(np.count_nonzero(can), n))
                    found[1].append(second[can])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in found], names=["i", "j"]
                )

    return run


def compare(a: np.ndarray, b: np.ndarray, cosine: float, axes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (of a, of b) whose rows have at least that cosine, stripe by stripe.

    ``axes`` are the leading ones, strongest first; any give the same pairs.
    """
    lead = axes.shape[1]
    steps = sorted({min(s, lead) for s in STEPS} | {lead})
    units = [_scaled(x) for x in (a, b)]
    turned = [u @ axes for u in units]

    def ahead(m: np.ndarray, count: int) -> np.ndarray:
        """The first coordinates, and the length of what follows them."""
        rest = np.sqrt(np.maximum(0, 1 - (m[:, :count] ** 2).sum(axis=1)))
        return np.concatenate((m[:, :count], rest[:, None]), axis=1).astype(np.float32)

    first, second = ahead(turned[0], steps[0]), ahead(turned[1], steps[0]).T.copy()
    more = [[ahead(t, s) for t in turned] for s in steps[1:]]
    squares = [(x**2).sum(axis=1) for x in (a, b)]
    for at in range(0, len(a), STRIPE):
        part = slice(at, at + STRIPE)
        can = first[part] @ second >= cosine - MARGIN
        for left, right in more:
            count = np.count_nonzero(can)
            if count > TOO_MANY * can.size:
                can &= left[part] @ right.T >= cosine - MARGIN
            elif count:
                i, j = np.nonzero(can)
                can[i, j] = np.einsum("ij,ij->i", left[part][i], right[j]) >= cosine - MARGIN
        count = np.count_nonzero(can)
        if not count:
            continue
        if count > TOO_MANY * can.size:
            found = units[0][part] @ units[1].T
            i, j = np.nonzero(can & (found >= cosine - NEAR))
            found = found[i, j]
        else:
            i, j = np.nonzero(can)
            found = np.einsum("ij,ij->i", units[0][part][i], units[1][j])
            i, j, found = (x[found >= cosine - NEAR] for x in (i, j, found))
        near = np.flatnonzero(found <= cosine + NEAR)
        x, y = i[near] + at, j[near]
        exact = np.einsum("ij,ij->i", a[x], b[y]) / np.sqrt(squares[0][x] * squares[1][y])
        sure = np.ones(len(i), bool)
        sure[near] = exact >= cosine
        yield i[sure] + at, j[sure]


def _links(axes: np.ndarray, cosine: float, lead: int):
    """(rep, number of links, a linked rep) for each vector of a pair of tiles that has links there.

    The linked ones reach the smallest vector of each component inside the pair, so no list of all
    pairs is made.
    """
    width, leading = len(axes), np.ascontiguousarray(axes[:, :lead])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                same = row["i"] == row["j"]
                reps = [np.frombuffer(row[f"{s}_reps"], np.int64) for s in "ab"]
                times = [np.frombuffer(row[f"{s}_times"], np.int64) for s in "ab"]
                rows = [np.frombuffer(row[f"{s}_rows"], np.float64).reshape(-1, width) for s in "ab"]
                n = len(reps[0])
                links = np.zeros(n if same else n + len(reps[1]), np.int64)
                root = np.arange(len(links))

                def find(x: np.ndarray) -> np.ndarray:
                    up = root[x]
                    while (up != (more := root[up])).any():
                        up = more
                    return up

                for i, j in compare(rows[0], rows[1], cosine, leading):
                    if same:
                        off = i != j
                        i, j = i[off], j[off]
                        links += np.bincount(i, times[0][j], len(links)).astype(np.int64)
                    else:
                        links += np.bincount(i, times[1][j], len(links)).astype(np.int64)
                        j = j + n
                        links += np.bincount(j, times[0][i], len(links)).astype(np.int64)
                    while len(i):
                        x, y = find(i), find(j)
                        apart = x != y
                        if not apart.any():
                            break
                        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
                        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                every = reps[0] if same else np.concatenate(reps)
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every[at]), pa.array(links[at]), pa.array(every[find(at)])],
                    names=["rep", "links", "linked"],
                )

    return run


def _one_by_one(spark: SparkSession) -> SparkSession:
    """A session of its own, with the same settings, in which Python gets rows of several MB one at a time."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return other


def _there(df: DataFrame, spark: SparkSession) -> DataFrame:
    """A stored table in another session."""
    folder = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    return spark.read.schema(df.schema).parquet(*sorted(folder)) if folder else spark.createDataFrame([], df.schema)


def _reached(pieces: DataFrame, cosine: float) -> DataFrame:
    """Pairs of pieces that must be compared; boxes meet in blocks of a bounded number."""
    boxes = pieces.select("piece", "box")
    blocks = -(-pieces.count() // BLOCK_BOXES)
    packed = (
        boxes.withColumn("block", F.pmod(F.xxhash64("piece"), F.lit(blocks)).cast("int"))
        .groupBy("block").agg(F.collect_list(F.struct("piece", "box")).alias("boxes"))
    )
    left = packed.select(
        F.col("block").alias("bi"), F.explode(F.sequence("block", F.lit(blocks - 1))).alias("bj"),
        F.col("boxes").alias("x"),
    )
    right = packed.select(F.col("block").alias("bj"), F.col("boxes").alias("y"))
    pairs = left.join(right, "bj").mapInArrow(_reachable(cosine), "i bigint, j bigint")
    # Between two blocks either piece may have the smaller number; each pair comes once.
    return pairs.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))


def cosine_groups(
    vectors: DataFrame, cosine: float = 0.9, id: str = "vec_id", vector: str = "embedding", lead: int = 24,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    n_links counts the other rows with at least that cosine, component_id is the smallest id reached
    by links, kept says that this is the row's own. Vectors that are NULL, empty, zero or hold NULL
    or non-finite numbers have no links and keep their id. Vectors of different lengths have no
    links; those of each length are compared in a run of their own. Equal vectors are merged
    first, and counted with their number; repeated ids are rows like any other. Ids are integers. An
    empty table gives an empty one; other columns are left out.

    Every pair of pieces whose boxes allow a link is compared once, in a task that holds these two
    pieces; what leaves it is one row a vector, never a list of pairs.
    """
    chosen = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("v"))
    units = stored(chosen.mapInArrow(_unit, "id bigint, unit binary"), "units")
    size = F.octet_length("unit")
    sizes = units.where("unit is not null").select(size.alias("size")).distinct().orderBy("size").collect()
    found = units.where("unit is null").select(
        F.col("id").alias(id), F.lit(0).cast("bigint").alias("n_links"),
        F.col("id").alias("component_id"), F.lit(True).alias("kept"),
    )
    for r in sizes:
        found = _groups_of_width(units.where(size == r["size"]), r["size"] // 8, cosine, id, lead).unionByName(found)
    return found


def _groups_of_width(rows: DataFrame, width: int, cosine: float, id: str, lead: int) -> DataFrame:
    """(id, n_links, component_id, kept) of rows (id, unit) whose vectors all have that length."""
    # Copies, also by a power of two: one vector stands for all, with their number.
    merged = rows.groupBy("unit").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("times"))
    merged = stored(merged.withColumn("rep", F.monotonically_increasing_id()), "merged")
    axes = principal_axes(merged, width)
    total = merged.count()
    fold = 1 << 20
    picked = F.pmod(F.xxhash64("unit"), F.lit(fold)) <= int(min(1.0, SAMPLE_ROWS / total) * fold)
    sample = b"".join(bytes(r["unit"]) for r in merged.where(picked).select("unit").collect())
    tiles = Tiles(_scaled(np.frombuffer(sample, np.float64).reshape(-1, width)) @ axes, -(-total // TILE_ROWS))
    dealt = stored(
        merged.select("rep", "unit", "times").mapInArrow(
            _deal(axes, tiles), "tile bigint, reps binary, rows binary, times binary"
        ),
        "dealt",
    )
    alone = _one_by_one(rows.sparkSession)
    pieces = stored(
        _there(dealt, alone).repartition("tile").sortWithinPartitions("tile").mapInArrow(
            _pieces(axes), "piece bigint, reps binary, rows binary, times binary, box binary"
        ),
        "pieces",
    )
    sides = [
        pieces.select(F.col("piece").alias(k), *(F.col(c).alias(f"{s}_{c}") for c in ("reps", "rows", "times")))
        for k, s in (("i", "a"), ("j", "b"))
    ]
    pairs = stored(_reached(_there(pieces, rows.sparkSession), cosine), "pairs")
    joined = _there(pairs, alone).join(sides[0], "i").join(sides[1], "j")
    found = stored(
        joined.mapInArrow(_links(axes, cosine, min(lead, width)), "rep bigint, links bigint, linked bigint"), "found"
    )
    found = _there(found, rows.sparkSession)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("linked").alias("b")))
    placed = (
        merged.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
        .join(counts, "rep", "left")
    )
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    known = placed.join(smallest, "root").select(
        "unit", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"
    )
    return rows.join(known, "unit").select(
        F.col("id").alias(id), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )
