"""Near-duplicate embeddings by spherical-cap filters from structured random product codes.

A filter is a direction; a vector belongs to every filter whose direction it meets at cosine
``alpha`` or more. Directions come from a product code: the (randomly rotated) coordinates are
cut into two halves, each half has ``WORDS`` random unit words, and every pair of words is a
direction. So ``WORDS``^2 directions are searched with 2 x ``WORDS`` inner products: a word is
worth trying only if the other half's best word could still lift the sum over the threshold
(list decoding). ``TABLES`` independent codes are joined.

A cap of fixed cosine shrinks exponentially with the dimension, so ``alpha`` follows from the
vectors' length: it is the largest at which two vectors at the wanted cosine share ``SHARED``
filters in the mean (``threshold``: 0.499 at 64 dimensions, 0.364 at 128, 0.215 at 384). A vector then
has about 130 to 150 filters at any length; one with fewer than ``FEWEST`` takes those at a lower
threshold too, since such vectors are the ones that miss each other. Vectors of less than ``LEAST`` dimensions, where a product
code covers the sphere badly, are lengthened by zeros, which changes no cosine. If the wanted
cosine is so low that a vector would need more than ``MOST`` filters, or a given ``alpha`` leaves
fewer than ``SHARED_LEAST`` shared ones, the operator raises.

Vectors that share a filter are candidates. Sign sketches of 128 random hyperplanes travel with
the entries and drop those that are far apart; what is left is verified by cosine in double
precision. Both are made from fixed seeds, so results repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import col, stored
from cratebook.llm.components import components

COSINE = 0.9
WORDS = 2048
TABLES = 3
#: Filters that two vectors at the wanted cosine share in the mean, and the fewest with a given alpha.
SHARED = 40
SHARED_LEAST = 30
#: Most filters of a vector, in the mean, and the fewest of any.
MOST = 4096
FEWEST = 100
#: Shorter vectors are lengthened to so many dimensions.
LEAST = 64
#: Members of a filter compared in one task; larger filters are dealt out in pairs of parts.
PART = 2048
SMALL = 48


@lru_cache(maxsize=8)
def _code(dim: int, words: int, table: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rotation, and the words of each half as columns."""
    rng = np.random.default_rng([dim, words, table])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    halves = [h for h in (dim - dim // 2, dim // 2) if h]
    codes = []
    for h in halves:
        c = rng.standard_normal((words, h))
        codes.append((c / np.linalg.norm(c, axis=1, keepdims=True)).T)
    return rotation, codes


@lru_cache(maxsize=8)
def _planes(dim: int) -> np.ndarray:
    return np.random.default_rng([dim, 128]).standard_normal((dim, 128))


def cap_share(dim: int, alpha: float, cosine: float) -> float:
    """The share of all directions that meet both of two vectors at ``alpha`` or more.

    The projection of a random direction on the plane of the two leaves r or more with
    probability (1 - r^2)^(dim/2 - 1) at every angle; this is summed over the angles.
    """
    half = np.arccos(cosine) / 2
    top = np.arccos(alpha) - half
    if top <= 0:
        return 0.0
    angle = (np.arange(4000) + 0.5) / 4000 * top
    return float(((1 - (alpha / np.cos(angle + half)) ** 2) ** (max(dim, 4) / 2 - 1)).mean() * top / np.pi)


@lru_cache(maxsize=64)
def threshold(dim: int, cosine: float, words: int, tables: int, alpha: float | None = None) -> float:
    """The cosine from which a vector belongs to a filter: ``alpha``, or derived from the dimension."""
    filters = tables * words**2
    if alpha is not None:
        shared = filters * cap_share(dim, alpha, cosine)
        if shared < SHARED_LEAST:
            raise ValueError(f"alpha {alpha}: vectors of {dim} dimensions at cosine {cosine} share {shared:.2g} filters, fewer than {SHARED_LEAST}")
        return alpha
    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if filters * cap_share(dim, middle, cosine) >= SHARED else (low, middle)
    own = filters * cap_share(dim, low, 1.0)
    if filters * cap_share(dim, low, cosine) < SHARED or own > MOST:
        raise ValueError(f"cosine {cosine}: no threshold gives vectors of {dim} dimensions {SHARED} shared filters with at most {MOST} each")
    return low


def far(cosine: float) -> int:
    """Sketch bits of 128 that may differ: seven deviations above the mean (46 at cosine 0.9,
    where 18 differ in the mean; of unrelated vectors 64)."""
    share = np.arccos(cosine) / np.pi
    return int(128 * share + 7 * np.sqrt(128 * share * (1 - share)))


def decode(v: np.ndarray, alpha: float, words: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) for every direction that a unit vector (a row of ``v``) exceeds."""
    rotation, codes = _code(v.shape[1], words, table)
    turned = v @ rotation
    first = turned[:, : codes[0].shape[0]] @ codes[0]
    if len(codes) == 1:
        return np.nonzero(first >= alpha)
    second = turned[:, codes[0].shape[0] :] @ codes[1]
    need = alpha * np.sqrt(2)
    # Words of either half that the other half's best could lift over the threshold.
    i1, w1 = np.nonzero(first >= (need - second.max(1))[:, None])
    i2, w2 = np.nonzero(second >= (need - first.max(1))[:, None])
    n1, n2 = np.bincount(i1, minlength=len(v)), np.bincount(i2, minlength=len(v))
    begin = np.cumsum(n2) - n2
    times = n2[i1]
    a = np.repeat(np.arange(len(i1)), times)
    b = np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin[i1], times)
    over = first[i1[a], w1[a]] + second[i2[b], w2[b]] >= need
    a, b = a[over], b[over]
    return i1[a], w1[a] * words + w2[b]


def filters_of(v: np.ndarray, cosine: float, alpha: float | None, words: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of unit vectors (the rows of ``v``) in all tables."""
    over = threshold(v.shape[1], cosine, words, tables, alpha)
    step, fewest = over / 20, min(FEWEST, tables * words**2 // 4) if alpha is None else 0
    todo, rows, filters = np.arange(len(v)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(todo):
        parts = [decode(v[todo], over, words, table) for table in range(tables)]
        row = np.concatenate([r for r, _ in parts])
        code = np.concatenate([(table << 40) + c for table, (_, c) in enumerate(parts)])
        enough = np.bincount(row, minlength=len(todo)) >= fewest
        rows.append(todo[row[enough[row]]])
        filters.append(code[enough[row]])
        todo, over = todo[~enough], over - step
    return np.concatenate(rows), np.concatenate(filters)


def _entries(classes: DataFrame, cosine: float, alpha: float | None, words: int, tables: int) -> DataFrame:
    """(filter, cls, s0, s1): every class in all its filters, with its sketch."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                cls, lists = batch.column(0).to_numpy(), batch.column(1)
                size = np.diff(lists.offsets.to_numpy())
                for dim in np.unique(size).tolist():
                    own = np.flatnonzero(size == dim)
                    v = np.array(lists.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False), float).reshape(len(own), dim)
                    if alpha is None and dim < LEAST:
                        v = np.pad(v, ((0, 0), (0, LEAST - dim)))
                    bits = np.packbits(v @ _planes(v.shape[1]) > 0, axis=1).view("<i8")
                    row, code = filters_of(v, cosine, alpha, words, tables)
                    yield pa.record_batch(
                        [pa.array(x) for x in ((dim << 48) + code, cls[own[row]], bits[row, 0], bits[row, 1])], ["filter", "cls", "s0", "s1"]
                    )

    return classes.select("cls", "unit").mapInArrow(encode, "filter long, cls long, s0 long, s1 long")


def _near(s: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(s[i] ^ s[j]).sum(-1) <= most


def _candidates(groups: DataFrame, most: int) -> DataFrame:
    """(a, b), a < b: classes of a group (columns lo, hi, list) whose sketches are near."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten()
            cls = flat.field("cls").to_numpy()
            part = flat.field("part").to_numpy()
            s = np.stack([flat.field("s0").to_numpy(), flat.field("s1").to_numpy()], 1).view(np.uint64)
            offsets = lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]
            start, size = offsets[:-1], np.diff(offsets)
            lo, hi = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            left, right = [], []
            for n in np.unique(size[(lo == hi) & (size <= SMALL)]).tolist():
                at = start[(lo == hi) & (size == n)]
                x, y = np.triu_indices(n, 1)
                for k in range(0, len(at), max(1, (1 << 20) // max(1, len(x)))):
                    some = at[k : k + max(1, (1 << 20) // max(1, len(x))), None]
                    i, j = (some + x).ravel(), (some + y).ravel()
                    near = _near(s, i, j, most)
                    left.append(cls[i[near]])
                    right.append(cls[j[near]])
            for g in np.flatnonzero((lo != hi) | (size > SMALL)).tolist():
                own = np.arange(start[g], start[g] + size[g])
                a = own if lo[g] == hi[g] else own[part[own] == lo[g]]
                b = own if lo[g] == hi[g] else own[part[own] == hi[g]]
                for k in range(0, len(a), 256):
                    i, j = np.nonzero(np.bitwise_count(s[a[k : k + 256], None] ^ s[None, b]).sum(-1) <= most)
                    left.append(cls[a[i + k]])
                    right.append(cls[b[j]])
                    if sum(map(len, left)) > 1 << 20:
                        yield _pairs(left, right)
                        left, right = [], []
            yield _pairs(left, right)

    return groups.select("lo", "hi", "list").mapInArrow(compare, "a long, b long")


def _pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    x, y = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (left, right))
    pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1)[x != y], axis=0)
    return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def links(classes: DataFrame, cosine: float = COSINE, alpha: float | None = None, words: int = WORDS, tables: int = TABLES, part: int = PART) -> DataFrame:
    """(a, b): pairs of classes (columns cls, unit: vectors of length one) with the cosine."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine: above 0, at most 1")
    entries = stored(_entries(classes, cosine, alpha, words, tables), "filters")
    shared = stored(entries.groupBy("filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "filters")
    parts = F.ceil(F.col("n") / part).cast("int")
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    members = (
        entries.join(shared, "filter")
        .select("filter", "cls", "s0", "s1", parts.alias("parts"))
        .select("*", own.alias("part"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("filter", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), F.struct("cls", "s0", "s1", "part").alias("m"))
    )
    pairs = _candidates(members.groupBy("filter", "lo", "hi").agg(F.collect_list("m").alias("list")), far(cosine)).distinct()
    left = classes.select(F.col("cls").alias("a"), F.col("unit").alias("u"))
    right = classes.select(F.col("cls").alias("b"), F.col("unit").alias("w"))
    return pairs.join(left, "a").join(right, "b").where(_dot(F.col("u"), F.col("w")) >= cosine).select("a", "b")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    alpha: float | None = None,
    words: int = WORDS,
    tables: int = TABLES,
    part: int = PART,
) -> DataFrame:
    """(<id_col>, n_links, component_id, kept): one row per row.

    ``n_links`` counts the other rows with the cosine or more, ``component_id`` is the smallest
    id that links reach, ``kept`` whether that is the row itself. Equal vectors form a class and
    are compared once. Null or zero vectors, and such with null or non-finite components, link
    with nothing and are their own component; rows without id have no component and link with
    with nothing. Vectors of different lengths never link. An empty table gives none.

    ``alpha`` is derived from the vectors' length unless given; what cannot give a pair at the
    wanted cosine enough shared filters raises (see the module).
    """
    rows = vectors.select(col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("v"))
    sound = F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound & some, F.lit(False)))
    groups = rows.where("sound").groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    # Scaled by the largest component first, so that no square over- or underflows.
    scaled = groups.withColumn("top", F.array_max(F.transform("v", F.abs))).withColumn("w", F.transform("v", lambda x: x / F.col("top")))
    unit = F.transform("w", lambda x: x / F.col("norm"))
    classes = stored(
        scaled.withColumn("norm", F.sqrt(_dot(F.col("w"), F.col("w"))))
        .select(F.monotonically_increasing_id().alias("cls"), "v", "rep", "n", unit.alias("unit")),
        "classes",
    )
    found = stored(links(classes, cosine, alpha, words, tables, part), "pairs")
    sizes = classes.select("cls", "n", "rep")
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = sizes.select(F.col("cls").alias("b"), "n", F.col("rep").alias("rep_b"))
    degrees = both.join(other, "b").groupBy("a").agg(F.sum("n").alias("linked"))
    ends = found.join(sizes.select(F.col("cls").alias("a"), F.col("rep").alias("ra")), "a").join(other.select("b", "rep_b"), "b")
    roots = components(ends.select(F.col("ra").alias("a"), F.col("rep_b").alias("b")))
    named = (
        classes.select("v", "cls", "n", "rep")
        .join(degrees.withColumnRenamed("a", "cls"), "cls", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("v", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    )
    good = rows.where("sound").join(named, "v").select("id", "n_links", F.col("root").alias("component_id"))
    bad = rows.where(~F.col("sound")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return good.unionByName(bad).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
