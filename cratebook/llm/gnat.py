"""Hard negatives by exact search in a multiway hyperplane tree.

The root has up to ``WAYS`` split points and so has each of its children; a row belongs to the
child whose point is nearest, which cuts the space by hyperplanes between the points. Every
split point stores the range of its distances to the rows of each sibling subtree. The points
come from a bounded sample of rows, the ranges and the leaves from all rows.

A search asks for the rows whose inner product with an anchor lies in a window. With the norms
in a subtree that is an annulus around the anchor, |a|^2 + |x|^2 - 2 a.x; by the triangle
inequality a subtree can be left out if, seen from some split point, its range of distances
does not meet the annulus. What remains is compared exactly: the rows of a leaf, in blocks,
against the anchors sent there, in chunks.

Three searches follow each other: an anchor's own leaf gives a bound for its fifth-best row of
the same label, all leaves that can reach the bound give its positives, and the windows below
the positives' scores give the negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import col, stored
from cratebook.operators.grouping import top_per_group

#: Most split points of a node, and rows of a leaf that their number aims at.
WAYS = 32
LEAF = 512
#: Rows and components of the sample that split points are chosen from.
SAMPLE = 4096
SAMPLE_VALUES = 1 << 20
#: Rows of a leaf and anchors compared in one task.
BLOCK = 4096
CHUNK = 512

ROW = "uid long, id long, label int, q array<long>"
FOUND = "anchor long, slot int, uid long, id long, score long"
#: Scores stay below this size, so that sums and multiples of them are longs.
LARGEST = 2**59
_FAR = np.iinfo(np.int64).max


class Tree:
    """Split points of the root and of its children, and, once measured, the ranges.

    Leaf ``j * ways + c`` is child c of child j. ``lo``/``hi`` (leaf, point): distances of the
    leaf's rows from the root's points and then from its own parent's; ``norm``: their squared
    lengths; ``size``: how many they are.
    """

    def __init__(self, sample: np.ndarray, rows: int):
        self.ways = int(np.clip(round((rows / LEAF) ** 0.5), 2, WAYS))
        self.root = _apart(sample, self.ways)
        nearest = _distances(sample, self.root).argmin(1) if len(sample) else np.zeros(0, int)
        self.children = [_apart(sample[nearest == j], self.ways) for j in range(len(self.root))]

    def leaf_of(self, v: np.ndarray) -> np.ndarray:
        first = _distances(v, self.root).argmin(1)
        leaf = first * self.ways
        for j in np.unique(first).tolist():
            own = first == j
            leaf[own] += _distances(v[own], self.children[j]).argmin(1)
        return leaf

    def measure(self, v: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[int, int, float, float, int]]:
        """(leaf, point, least, greatest distance, rows); point -1: squared lengths."""
        for one in np.unique(leaf).tolist():
            own = v[leaf == one]
            norm = (own * own).sum(1)
            yield one, -1, norm.min(), norm.max(), len(own)
            for first, points in ((0, self.root), (self.ways, self.children[one // self.ways])):
                d = _distances(own, points)
                for i in range(len(points)):
                    yield one, first + i, d[:, i].min(), d[:, i].max(), len(own)

    def known(self, ranges: list) -> None:
        n = self.ways**2
        self.size = np.zeros(n, int)
        self.norm = np.zeros((n, 2))
        self.lo, self.hi = np.zeros((n, 2 * self.ways)), np.full((n, 2 * self.ways), np.inf)
        for leaf, point, lo, hi, rows in ranges:
            if point < 0:
                self.size[leaf], self.norm[leaf] = rows, (lo, hi)
            else:
                self.lo[leaf, point], self.hi[leaf, point] = lo, hi

    def reached(self, v: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, leaf) where a row may have a score in one of the anchor's windows (the rows
        of ``low`` and ``high``, nan where there is none)."""
        norm = (v * v).sum(1)[:, None]
        found = []
        at_root = _distances(v, self.root)
        for j, points in enumerate(self.children):
            leaves = j * self.ways + np.arange(len(points))
            leaves = leaves[self.size[leaves] > 0]
            d = np.concatenate([at_root, _distances(v, points)], 1)
            used = np.r_[0 : len(self.root), self.ways : self.ways + len(points)]
            for leaf in leaves.tolist():
                lo, hi = self.lo[leaf, used], self.hi[leaf, used]
                nearest = np.maximum(np.maximum(d - hi, lo - d).max(1), 0)[:, None] ** 2
                farthest = (d + hi).min(1)[:, None] ** 2
                slack = 1e-9 * (norm + self.norm[leaf, 1] + 1)
                inner = norm + self.norm[leaf, 0] - 2 * high
                outer = norm + self.norm[leaf, 1] - 2 * low
                meets = ((farthest >= inner - slack) & (nearest <= outer + slack)).any(1)
                found.append(np.stack([np.flatnonzero(meets), np.full(meets.sum(), leaf)]))
        both = np.concatenate([np.zeros((2, 0), int), *found], 1)
        return both[0], both[1]


def _distances(v: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (v * v).sum(1)[:, None] + (points * points).sum(1) - 2 * (v @ points.T)
    return np.sqrt(np.maximum(square, 0))


def _apart(sample: np.ndarray, ways: int) -> np.ndarray:
    """Up to ``ways`` split points far apart: the one farthest from those chosen, of three times
    as many candidates. A node without sample rows has the origin as its only point."""
    some = sample[: 3 * ways]
    if not len(some):
        return np.zeros((1, sample.shape[1]))
    chosen, nearest = [0], _distances(some, some[:1])[:, 0]
    while len(chosen) < ways and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(some, some[chosen[-1:]])[:, 0])
    return some[chosen]


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows; doubles hold components exactly, which stay below 2^30."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), len(flat) // max(1, len(lists))).astype(float)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: by doubles where these hold every sum, else by longs."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _first(anchor: np.ndarray, score: np.ndarray, key: np.ndarray, uid: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` entries of each anchor, best score, smallest id first."""
    order = np.lexsort((uid, key, -score, anchor))
    starts = np.flatnonzero(np.r_[True, anchor[order][1:] != anchor[order][:-1]]) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < most]


def _compare(select: Callable, most: int) -> Callable:
    """For a leaf's block of rows and a chunk of anchors: the first ``most`` rows of each slot.

    ``select`` yields (slot, mask) over anchors x rows from scores, labels and windows.
    """

    def compare(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            uid, mine = rows["uid"].to_numpy(), anchors["uid"].to_numpy()
            key = rows["id"].fill_null(_FAR).to_numpy()
            score = _scores(_matrix(anchors["q"]), _matrix(rows["q"]))
            windows = anchors["windows"].combine_chunks()
            width = int(np.diff(windows.offsets.to_numpy()).max(initial=0))
            bounds = np.full((len(mine), width), -2 * LARGEST)
            for k, window in enumerate(windows.to_pylist()):
                bounds[k, : len(window)] = window
            same = anchors["label"].to_numpy()[:, None] == rows["label"].to_numpy()
            for slot, mask in select(score, same, mine[:, None] == uid, bounds):
                i, j = np.nonzero(mask)
                kept = _first(i, score[i, j], key[j], uid[j], most)
                i, j = i[kept], j[kept]
                out.append((mine[i], np.full(len(i), slot, np.int32), uid[j], j, score[i, j]))
        if not out:
            out = [tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int64, np.int64))]
        anchor, slot, uid, at, score = (np.concatenate(x) for x in zip(*out, strict=True))
        ids = rows["id"].take(pa.array(at)) if rows.num_rows else pa.array([], pa.int64())
        return pa.table([pa.array(anchor), pa.array(slot, pa.int32()), pa.array(uid), ids, pa.array(score)], ["anchor", "slot", "uid", "id", "score"])

    return compare


def _alike(score: np.ndarray, same: np.ndarray, itself: np.ndarray, bounds: np.ndarray) -> Iterator:
    """Rows of the anchor's label, without itself, that reach its bound."""
    yield 0, same & ~itself & (score >= bounds[:, :1])


def _unlike(score: np.ndarray, same: np.ndarray, itself: np.ndarray, bounds: np.ndarray) -> Iterator:
    """For each positive's score p: rows of other labels with 80 p <= 100 score <= 100 p."""
    for slot in range(bounds.shape[1]):
        top = bounds[:, slot : slot + 1]
        # Where an anchor has fewer positives its bound is below every score.
        yield slot, ~same & (score <= top) & (5 * score >= 4 * np.maximum(top, -LARGEST))


def _search(rows: DataFrame, anchors: DataFrame, tree: Tree, route: Callable, select: Callable, most: int) -> DataFrame:
    """(anchor, slot, uid, id, score): what ``select`` finds in the leaves that ``route`` names.

    ``rows`` has uid, id, label, q and leaf; ``anchors`` the same and ``windows``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, leaf = route(tree, batch)
            sent = batch.select(["uid", "label", "q", "windows"]).take(pa.array(at))
            yield pa.record_batch([pa.array(leaf, pa.int32()), *sent.columns], ["to", *sent.schema.names])

    sent = stored(anchors.mapInArrow(send, "to int, uid long, label int, q array<long>, windows array<long>"), "sent")
    spark = rows.sparkSession
    sizes = spark.createDataFrame([(k, int(n)) for k, n in enumerate(tree.size) if n], "leaf int, rows long")
    # One row per leaf, of which there are at most the square of WAYS.
    parts = sizes.join(sent.groupBy(F.col("to").alias("leaf")).agg(F.count(F.lit(1)).alias("n")), "leaf").select(
        "leaf", F.ceil(F.col("rows") / BLOCK).alias("blocks"), F.ceil(F.col("n") / CHUNK).alias("chunks")
    )
    parts = F.broadcast(parts)
    every = lambda name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1))
    left = rows.join(parts, "leaf").select("leaf", F.pmod(F.xxhash64("uid"), F.col("blocks")).alias("block"), every("chunks").alias("chunk"), "uid", "id", "label", "q")
    right = sent.withColumnRenamed("to", "leaf").join(parts, "leaf").select("leaf", every("blocks").alias("block"), F.pmod(F.xxhash64("uid"), F.col("chunks")).alias("chunk"), "uid", "label", "q", "windows")
    keys = ["leaf", "block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compare(select, most), FOUND)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), "uid"]
    return top_per_group(found, ["anchor", "slot"], order, most)


def _own_leaf(tree: Tree, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.arange(batch.num_rows), batch["leaf"].to_numpy()


def _from_bound(tree: Tree, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    low = batch["windows"].flatten().to_numpy().astype(float)[:, None]
    return tree.reached(_matrix(batch["q"]), low, np.full_like(low, np.inf))


def _in_windows(tree: Tree, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    lists = batch["windows"].to_pylist()
    width = max(map(len, lists), default=0)
    high = np.array([w + [np.nan] * (width - len(w)) for w in lists], float).reshape(len(lists), width)
    return tree.reached(_matrix(batch["q"]), 0.8 * high, high)


def _parts(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """(uid, id, label, q): the rows that take part, with whole components of one length."""
    rows = vectors.select(
        col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("label"), col(vector_col).cast("array<double>").alias("v")
    ).where("label IS NOT NULL AND v IS NOT NULL")
    fit = LARGEST / F.greatest(F.size("v"), F.lit(1))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & ((F.abs(x) * scale + 1) * (F.abs(x) * scale + 1) < fit))
    rows = rows.where(sound).select(F.monotonically_increasing_id().alias("uid"), "id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("q"))
    rows = stored(rows, "rows")
    most = rows.agg(F.max(F.size("q"))).first()[0] or 0
    return rows.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(most) - F.size("q"))))


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. Components are multiplied by
    ``scale`` and floored; a score is the integer inner product with the anchor. An anchor's
    positives are its first other rows of the same label, its negatives for each positive the
    first rows of other labels that score 80 to 100 percent of the positive. Higher scores come
    first, ties by smaller id; both lists may be shorter than asked for, or empty.

    Rows with a null label, a null vector, or a null or non-finite component take no part, nor
    do vectors whose scores could leave the range of a long (2^59). Shorter vectors count as
    lengthened by zeros. Repeated rows are rows of their own, as positives, negatives and
    anchors; a row without id is no anchor and comes last among equals. An empty table gives
    no rows.
    """
    rows = _parts(vectors, id_col, vector_col, label_col, scale)
    width = len((rows.select("q").first() or [[]])[0])
    count = rows.count()
    sampled = rows.select("q").orderBy(F.xxhash64("uid")).limit(max(3 * WAYS, min(SAMPLE, SAMPLE_VALUES // max(1, width)))).toArrow()
    tree = Tree(_matrix(sampled["q"]) if count else np.zeros((0, width)), count)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaf_of(_matrix(batch["q"])) if batch.num_rows else np.zeros(0)
            yield pa.record_batch([*batch.columns, pa.array(leaf, pa.int32())], [*batch.schema.names, "leaf"])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(tree.measure(_matrix(batch["q"]), batch["leaf"].to_numpy())) if batch.num_rows else []
            yield pa.record_batch([pa.array([f[k] for f in found], t) for k, t in enumerate(measured)], ["leaf", "point", "lo", "hi", "rows"])

    measured = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
    placed = stored(rows.mapInArrow(place, ROW + ", leaf int"), "placed")
    seen = placed.select("q", "leaf").mapInArrow(ranges, "leaf int, point int, lo double, hi double, rows long")
    # At most the square of WAYS leaves with 2 WAYS + 1 ranges each.
    tree.known([tuple(r) for r in seen.groupBy("leaf", "point").agg(F.min("lo"), F.max("hi"), F.sum("rows")).collect()])

    anchors = placed.where(F.col("id") % every == 0)
    lowest = F.array(F.lit(-LARGEST).cast("long"))
    near = _search(placed, anchors.withColumn("windows", lowest), tree, _own_leaf, _alike, positives)
    bound = near.where(F.col("rank") == positives).select(F.col("anchor").alias("uid"), F.array("score").alias("bound"))
    bounded = anchors.join(bound, "uid", "left").withColumn("windows", F.coalesce("bound", lowest)).drop("bound")
    alike = stored(_search(placed, bounded, tree, _from_bound, _alike, positives), "positives")
    ranked = F.array_sort(F.collect_list(F.struct("rank", "score", "id")))
    asked = alike.groupBy(F.col("anchor").alias("uid")).agg(ranked.alias("p"))
    asked = stored(asked.join(anchors, "uid").withColumn("windows", F.col("p.score")), "windows")
    unlike = _search(placed, asked, tree, _in_windows, _unlike, negatives)
    named = asked.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"), F.posexplode("p").alias("slot", "positive"))
    return unlike.join(named, ["anchor", "slot"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
