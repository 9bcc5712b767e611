"""Hard negatives by lists shared within clusters of anchors.

Anchors are clustered by direction. What a row can score with any member of a cluster is at most the row's
length times the cosine of its angle to the cluster's centre less the widest angle of a member, times
the member's length. A cluster's rows, cut into pieces of bounded size, are sorted by that bound once;
every member of the cluster walks the same list, and stops where the bound certifies that no row
that follows can enter its answer. Rows whose bound is too low for all members are not sent there at all.

Positives are found first, in lists of the anchors' own labels: a sixteenth of the rows gives every
anchor a score that its positives reach, which bounds the walk over the others. The scores of the
positives then bound the walk for negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.sources.scratch import stored

MEMBERS = 512  # anchors of a block, about
PIECE = 4096  # rows of a list's piece, about
STEP = 512  # rows that members walk at a time
MOST_CLUSTERS = 256  # parameter of the fit; any number gives the same results
SAMPLE_ANCHORS = 20_000  # anchors the centres are fitted on; any sample gives the same results
ROUNDS = 8
SLACK = 1e-6  # bounds are widened by this share of a row's length, for rounding
EXACT = float(1 << 52)  # products of lengths below this are exact sums of doubles
LARGEST = 1e150  # components beyond count as that, so that no length overflows
_LONG = (1 << 63) - 1


def _whole(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """(id, label, anchor, width, norm, q): floored components as bytes, NULL for unusable vectors."""
    for batch in batches:
        rows = []
        for value in batch.column(3):
            row = (None, None, None)
            if value.is_valid and not value.values.null_count:
                v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all():
                    with np.errstate(over="ignore"):
                        q = np.clip(np.floor(scale * v), -LARGEST, LARGEST)
                    top = float(np.abs(q).max()) if len(q) else 0.0
                    norm = top * float(np.sqrt(((q / top) ** 2).sum())) if top else 0.0
                    row = (len(q), norm, (q.astype(np.int16) if top < 1 << 15 else q).tobytes())
            rows.append(row)
        width, norm, q = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(width, pa.int32()), pa.array(norm, pa.float64()), pa.array(q, pa.binary())],
            names=["id", "label", "anchor", "width", "norm", "q"],
        )


def _matrix(packed: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    found = np.empty((len(packed), width))
    for k, x in enumerate(packed):
        data = x.as_py()
        found[k] = np.frombuffer(data, np.int16 if len(data) == 2 * width else np.float64)
    return found


def _directions(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay."""
    top = np.abs(rows).max(axis=1, initial=0)
    rows = rows / np.where(top > 0, top, 1)[:, None]
    length = np.sqrt((rows**2).sum(axis=1))
    return rows / np.where(length > 0, length, 1)[:, None]


def fit_centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit centres of ``count`` clusters of directions, by spherical k-means from a fixed start."""
    points = _directions(sample)
    points = points[np.abs(points).max(axis=1, initial=0) > 0]
    if not len(points):
        return np.zeros((1, sample.shape[1]))
    centres = points[np.random.default_rng(12).permutation(len(points))[:count]]
    for _ in range(ROUNDS):
        near = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        moved = _directions(sums)
        centres = np.where((np.abs(moved).max(axis=1) > 0)[:, None], moved, centres)
    return centres


def _angles(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_directions(rows) @ centres.T, -1, 1))


def _members(centres: np.ndarray):
    """(rep, cluster, angle) of anchors (rep, q)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1), centres.shape[1])
            angles = _angles(rows, centres)
            near = np.argmin(angles, axis=1)
            # A zero vector scores zero with every row; it widens no cluster.
            angle = np.where(np.abs(rows).max(axis=1, initial=0) > 0, angles[np.arange(len(near)), near], 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(near.astype(np.int32)), pa.array(angle)], names=["rep", "cluster", "angle"]
            )

    return run


def _bounded(centres: np.ndarray, widest: dict[int, float], floors: dict[int, float]):
    """(rep, id, label, norm, q, cluster, bound): rows for each cluster whose floor their bound reaches."""
    clusters = sorted(widest)
    wide = np.array([widest[c] for c in clusters])
    floor = np.array([floors[c] for c in clusters])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(4), centres.shape[1])
            norm = batch.column(3).to_numpy(zero_copy_only=False)[:, None]
            bound = norm * (np.cos(np.maximum(0, _angles(rows, centres[clusters]) - wide)) + SLACK)
            row, at = np.nonzero(bound >= floor)
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(row)) for c in batch.columns), pa.array(np.array(clusters, np.int32)[at]), pa.array(bound[row, at])],
                names=["rep", "id", "label", "norm", "q", "cluster", "bound"],
            )

    return run


_NOTHING = (np.zeros(0, np.int64),) * 4


def walk(
    members: np.ndarray, norms: np.ndarray, lower: np.ndarray, upper: np.ndarray, rows: np.ndarray,
    bounds: np.ndarray, may: Callable[[np.ndarray, slice], np.ndarray], most: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(member, slot, row, score): per member and slot, at least its ``most`` best rows, ties included.

    ``rows`` come with falling ``bounds``. Slot k of a member takes scores from lower[k] to upper[k];
    ``may`` says which of the members at hand may take which rows.
    """
    best = np.full((*lower.shape, most), -np.inf)
    live = np.arange(len(members))
    found: list[list[np.ndarray]] = [[], [], [], []]
    for at in range(0, len(rows), STEP):
        # Certified: neither the slot's least score nor its worst answer so far can be reached any more.
        reach = norms[live, None] * bounds[at] if len(live) else np.zeros((0, 1))
        needed = np.maximum(lower[live], best[live, :, 0])
        live = live[((reach >= needed) & (lower[live] <= upper[live])).any(axis=1)]
        if not len(live):
            break
        part = slice(at, at + STEP)
        score = members[live] @ rows[part].T
        allowed = may(live, part)
        for slot in range(lower.shape[1]):
            fits = allowed & (score >= lower[live, slot, None]) & (score <= upper[live, slot, None])
            fits &= score >= best[live, slot][:, :1]
            who, which = np.nonzero(fits)
            if not len(who):
                continue
            got = score[who, which]
            for k, x in enumerate((live[who], np.full(len(who), slot), which + at, got)):
                found[k].append(x)
            merged = np.concatenate((best[live, slot], np.where(fits, score, -np.inf)), axis=1)
            best[live, slot] = np.sort(np.partition(merged, -most, axis=1)[:, -most:], axis=1)
    if not found[0]:
        return _NOTHING
    member, slot, row, score = (np.concatenate(x) for x in found)
    stay = score >= best[member, slot, 0]
    return member[stay], slot[stay], row[stay], score[stay]


def walk_whole(members: np.ndarray, lower: list, upper: list, rows: np.ndarray, may: Callable, most: int):
    """``walk`` for numbers whose products doubles do not hold: in whole numbers and without bounds."""
    out = []
    others = [[int(x) for x in row] for row in rows]
    for m, member in enumerate(members):
        own = [int(x) for x in member]
        at = np.flatnonzero(may(np.array([m]), slice(0, len(rows)))[0]).tolist()
        scores = [(max(-_LONG, min(_LONG, sum(a * b for a, b in zip(own, others[k])))), k) for k in at]
        for slot, (low, high) in enumerate(zip(lower[m], upper[m])):
            fit = [(x, k) for x, k in scores if (low is None or x >= low) and (high is None or x <= high)]
            least = sorted((x for x, _ in fit), reverse=True)[:most][-1:]
            out += [(m, slot, k, x) for x, k in fit if x >= least[0]]
    return tuple(np.array(x, np.int64) for x in zip(*out)) if out else _NOTHING


def _searched(width: int, same: bool, most: int):
    """(rep, slot, id, score) of a block of members and a piece of their list: the ``most`` best of each slot."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"rep": pa.array([], pa.int64()), "slot": pa.array([], pa.int32()),
                          "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        right = right.sort_by([("bound", "descending")])
        members, rows = _matrix(left["q"], width), _matrix(right["q"], width)
        reps, labels = left["rep"].to_numpy(), left["label"].to_numpy()
        norms, bounds = left["norm"].to_numpy(), right["bound"].to_numpy()
        lows, highs = left["lower"].to_pylist(), left["upper"].to_pylist()
        others, found = right["label"].to_numpy(), right["rep"].to_numpy()

        def may(live: np.ndarray, part: slice) -> np.ndarray:
            if same:
                return (labels[live, None] == others[None, part]) & (reps[live, None] != found[None, part])
            return labels[live, None] != others[None, part]

        if norms.max() * right["norm"].to_numpy().max() < EXACT:
            # Slots a member has not are left empty.
            lower = np.full((len(reps), max(map(len, lows))), np.inf)
            upper = -lower
            for m, (low, high) in enumerate(zip(lows, highs)):
                lower[m, : len(low)] = [-np.inf if x is None else x for x in low]
                upper[m, : len(high)] = [np.inf if x is None else x for x in high]
            member, slot, row, score = walk(members, norms, lower, upper, rows, bounds, may, most)
        else:
            member, slot, row, score = walk_whole(members, lows, highs, rows, may, most)
        if not len(member):
            return empty
        ids = right["id"].combine_chunks()
        # NULL ids come last among equal scores.
        known = np.array(ids.is_valid())
        value = ids.fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((value[row], ~known[row], -score, slot, member))
        member, slot, row, score = member[order], slot[order], row[order], score[order]
        new = np.ones(len(member), bool)
        new[1:] = (member[1:] != member[:-1]) | (slot[1:] != slot[:-1])
        first = np.flatnonzero(new)
        place = np.arange(len(member)) - np.repeat(first, np.diff(np.append(first, len(member))))
        keep = place < most
        return pa.table({"rep": pa.array(reps[member[keep]], pa.int64()), "slot": pa.array(slot[keep].astype(np.int32)),
                         "id": ids.take(pa.array(row[keep])), "score": pa.array(score[keep].astype(np.int64))})

    return run


_FOUND = "rep bigint, slot int, id bigint, score bigint"


class _Lists:
    """Rows and anchors of one width, and the centres of the anchors' clusters."""

    def __init__(self, rows: DataFrame, width: int, anchors: int):
        self.width = width
        self.rows = rows.select("rep", "id", "label", "norm", "q")
        given = rows.where("anchor").select("rep", "q")
        fold = 1 << 20
        picked = F.pmod(F.xxhash64("rep"), F.lit(fold)) <= int(min(1.0, SAMPLE_ANCHORS / anchors) * fold)
        sample = [bytes(r["q"]) for r in given.where(picked).select("q").limit(2 * SAMPLE_ANCHORS).collect()]
        self.centres = fit_centres(
            _matrix(pa.array(sample, pa.binary()), width), min(MOST_CLUSTERS, -(-anchors // MEMBERS))
        )
        placed = given.mapInArrow(_members(self.centres), "rep bigint, cluster int, angle double")
        self.members = stored(
            rows.where("anchor").select("rep", F.col("id").alias("anchor_id"), "label", "norm", "q").join(placed, "rep"), "members"
        )
        self.widest = {
            r["cluster"]: r["angle"]
            for r in self.members.groupBy("cluster").agg(F.max("angle").alias("angle")).collect()
        }

    def floors(self, needs: DataFrame) -> dict[int, float]:
        """Least bound that can still matter to a member, by cluster; ``needs`` is (rep, least).

        Members without a row there need nothing, those with a NULL or a zero vector everything.
        """
        per = F.when((F.col("norm") > 0) & F.col("least").isNotNull(), F.col("least") / F.col("norm")).otherwise(F.lit(float("-inf")))
        found = self.members.join(needs, "rep").groupBy("cluster").agg(F.min(per).alias("floor")).collect()
        known = {r["cluster"]: r["floor"] for r in found}
        return {c: known.get(c, float("inf")) for c in self.widest}

    def search(self, rows: DataFrame, wanted: DataFrame, floors: dict[int, float], same: bool, most: int) -> DataFrame:
        """The ``most`` best of ``rows`` for each slot of the members in ``wanted`` (rep, lower, upper).

        Lists are per cluster, and with ``same`` per label as well. Blocks of members meet pieces of their
        list in groups of bounded size.
        """
        keys = ["label", "cluster"] if same else ["cluster"]
        members = self.members.join(wanted, "rep")
        blocks = members.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("blocks"))
        if same:
            sizes = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
            cells = blocks.join(sizes, "label")
        else:
            cells = blocks.withColumn("pieces", F.lit(-(-rows.count() // PIECE)))
        bounded = rows.mapInArrow(
            _bounded(self.centres, self.widest, floors),
            "rep bigint, id bigint, label bigint, norm double, q binary, cluster int, bound double",
        )

        def dealt(count: str) -> Column:
            return F.pmod(F.xxhash64("rep"), F.col(count)).cast("int")

        def every(count: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

        cell = [F.col(k).alias(f"_{k}") for k in keys]
        lists = bounded.join(cells.where("pieces > 0"), keys).select(
            *cell, dealt("pieces").alias("piece"), every("blocks").alias("block"), "rep", "id", "label", "norm", "q", "bound"
        )
        walkers = members.join(cells.where("pieces > 0"), keys).select(
            *cell, every("pieces").alias("piece"), dealt("blocks").alias("block"), "rep", "label", "norm", "q", "lower", "upper"
        )
        group = [f"_{k}" for k in keys] + ["piece", "block"]
        return walkers.groupBy(*group).cogroup(lists.groupBy(*group)).applyInArrow(
            _searched(self.width, same, most), _FOUND
        )


def _first(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best of each slot, numbered; equal scores by the smaller id, a NULL id last."""
    order = Window.partitionBy("rep", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _positives(lists: _Lists, most: int) -> DataFrame:
    """(rep, slot, id, score, rank): the best other rows of each anchor's own label."""
    everything = F.array(F.lit(None).cast("bigint"))
    reps = lists.members.select("rep")
    part = F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(16)) == 0
    none = dict.fromkeys(lists.widest, float("-inf"))
    begun = _first(
        lists.search(lists.rows.where(part), reps.select("rep", everything.alias("lower"), everything.alias("upper")), none, True, most), most
    )
    begun = stored(begun, "first-positives")
    reached = begun.groupBy("rep").agg(F.max(F.when(F.col("rank") == most, F.col("score"))).alias("least"))
    needs = stored(reps.join(reached, "rep", "left"), "least-positives")
    wanted = needs.select("rep", F.array("least").alias("lower"), everything.alias("upper"))
    rest = lists.search(lists.rows.where(~part), wanted, lists.floors(needs), True, most)
    return stored(_first(begun.drop("rank").unionByName(rest), most), "positives")


def _negatives(lists: _Lists, positives: DataFrame, most: int, percent: int) -> DataFrame:
    """(rep, upper, id, score, rank): the best rows of other labels for each score of a positive."""
    upper = F.col("score")
    # The least whole score that is at least ``percent`` of the positive's; dividends are kept in range.
    lower = F.ceil(upper.cast("decimal(38,0)") * percent / 100).cast("bigint")
    ends = positives.select("rep", upper.alias("upper"), lower.alias("lower")).distinct().where("lower <= upper")
    ends = ends.withColumn("slot", F.row_number().over(Window.partitionBy("rep").orderBy("upper")) - 1)
    ends = stored(ends, "ends")
    listed = F.sort_array(F.collect_list(F.struct("slot", "lower", "upper")))
    wanted = ends.groupBy("rep").agg(listed.alias("ends")).select(
        "rep", F.col("ends.lower").alias("lower"), F.col("ends.upper").alias("upper")
    )
    needs = ends.groupBy("rep").agg(F.min("lower").alias("least"))
    found = _first(lists.search(lists.rows, wanted, lists.floors(needs), False, most), most)
    return found.join(ends.select("rep", "slot", "upper"), ["rep", "slot"])


def mine(
    vectors: DataFrame,
    anchor: Column,
    label: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows for which ``anchor`` holds search among all rows. Components are multiplied by ``scale`` and floored;
    scores are inner products of these whole numbers, exact at any size (beyond 64 bits they count
    as the largest ones there). An anchor's positives are its best other rows of the same ``label``; for
    each, the best rows of other labels are returned whose score is at most the positive's and at
    least ``percent`` of it. Equal scores go by the smaller id, a NULL id last.

    Rows with a NULL label, a NULL vector or NULL or non-finite components take no part; vectors of
    different lengths do not meet, an empty vector is zero and scores zero. Repeated rows are rows like any other. An anchor without positives,
    and a positive without such rows, give no row; a positive with a negative score has none. An
    empty table gives an empty one; other columns are left out. Ids and labels are integers.

    The driver holds a bounded sample of anchors and three numbers a cluster. Where directions say
    little every row goes to every block of anchors: the work then grows with rows times anchors.
    """
    given = vectors.select(
        F.col(id).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).alias("v"),
    ).where("label is not null and v is not null")
    rows = given.mapInArrow(
        lambda batches: _whole(batches, scale),
        "id bigint, label bigint, anchor boolean, width int, norm double, q binary",
    ).where("q is not null")
    rows = stored(rows.withColumn("rep", F.monotonically_increasing_id()), "whole")
    widths = rows.where("anchor").groupBy("width").agg(F.count(F.lit(1)).alias("n")).orderBy("width").collect()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    found = vectors.sparkSession.createDataFrame([], schema)
    for r in widths:
        lists = _Lists(rows.where(F.col("width") == r["width"]), r["width"], r["n"])
        best = _positives(lists, positives)
        hard = _negatives(lists, best, negatives, percent)
        pairs = best.select("rep", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        named = lists.members.select("rep", "anchor_id")
        found = found.unionByName(
            pairs.join(hard.withColumnRenamed("upper", "positive_score"), ["rep", "positive_score"]).join(named, "rep").select(
                "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"),
            )
        )
    return found
