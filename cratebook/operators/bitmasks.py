"""Sets of few items as bit masks, all compared with all, block by block.

Sets lie in blocks in the order of their ids. A task holds the sets of some blocks as the
smaller ones and meets every block once, in that order, as the larger ones: what it holds at
once is its own sets and one block, however many there are. The sizes of two sets say how many
items they must share to be wanted, so that a pair costs one conjunction, one count of bits
and one comparison, over arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, ShortType, StringType, StructField, StructType

from cratebook.session import cut_lineage

# Pairs that are compared in one step.
CELLS = 1 << 20
# Parts that the smaller sets are dealt to, for each task that runs at a time.
PARTS = 2
# No overlap is enough.
NEVER = 255


@dataclass
class _Sets:
    """Sets with their place in the order of ids (block and place in it)."""

    block: np.ndarray
    place: np.ndarray
    n: np.ndarray
    words: list[np.ndarray]
    carried: dict[str, pa.Array]

    def before(self, ours: np.ndarray, other: _Sets, theirs: np.ndarray) -> np.ndarray:
        """Which of ``ours`` come before those of ``other``, place by place (or all with all)."""
        block, place = self.block[ours], self.place[ours]
        return (block < other.block[theirs]) | ((block == other.block[theirs]) & (place < other.place[theirs]))


def _words(columns: list[str]) -> list[str]:
    return [c for c in columns if c.startswith("mask_")]


def _sets_of(batch: pa.RecordBatch, row: int, narrow: bool) -> _Sets:
    """Sets of one block, a row of arrays."""
    names = [c for c in batch.schema.names if c not in ("part", "large", "block")]
    lists = {c: batch.column(c)[row].values for c in names}
    words = [lists.pop(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in _words(names)]
    n = lists.pop("n").to_numpy(zero_copy_only=False).astype(np.uint8)
    place = np.arange(len(n))
    block = np.full(len(n), batch.column("block")[row].as_py(), np.int64)
    return _Sets(block, place, n, [w.astype(np.uint32) for w in words] if narrow else words, lists)


def _joined(parts: list[_Sets]) -> _Sets:
    """All sets of a task, by size."""
    n = np.concatenate([p.n for p in parts])
    order = np.argsort(n, kind="stable")
    words = [np.concatenate(w)[order] for w in zip(*[p.words for p in parts], strict=True)]
    carried = {c: pa.concat_arrays([p.carried[c] for p in parts]).take(pa.array(order)) for c in parts[0].carried}
    return _Sets(np.concatenate([p.block for p in parts])[order], np.concatenate([p.place for p in parts])[order], n[order], words, carried)


def _meetings(batches: Iterator[pa.RecordBatch], narrow: bool) -> Iterator[tuple[_Sets, list[tuple[int, int, int]], _Sets]]:
    """The task's own sets, where those of each size lie, and one block after another."""
    parts: list[_Sets] = []
    own, sizes = None, []
    for batch in batches:
        for row in range(batch.num_rows):
            block = _sets_of(batch, row, narrow)
            if not batch.column("large")[row].as_py():
                parts.append(block)
                continue
            if own is None:
                own, parts = _joined(parts), []
                found, starts = np.unique(own.n, return_index=True)
                sizes = [(int(n), int(a), int(b)) for n, a, b in zip(found, starts, [*starts[1:], len(own.n)], strict=True)]
            yield own, sizes, block


def _shared(own: _Sets, ours: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Number of items that each of our sets shares with each other one."""
    counts = [np.bitwise_count(mine[ours][:, None] & theirs[None, :]) for mine, theirs in zip(own.words, words, strict=True)]
    return counts[0] if len(counts) == 1 else counts[0] + counts[1]


def _rows(own: _Sets, ours: np.ndarray, block: _Sets, theirs: np.ndarray, overlap: np.ndarray, **more: pa.Array) -> pa.RecordBatch:
    """Rows of found pairs; what is carried is named by its side, the id by the side alone."""
    columns = dict(more)
    for side, sets, at in (("small", own, ours), ("large", block, theirs)):
        for c, values in sets.carried.items():
            columns[side if c == "set_id" else f"{c}_{side}"] = values.take(pa.array(at))
    for c, values in (("n_small", own.n[ours]), ("n_large", block.n[theirs]), ("overlap", overlap)):
        columns[c] = pa.array(values.astype(np.int16))
    return pa.RecordBatch.from_pydict(columns)


def _lister(least: np.ndarray, narrow: bool) -> Callable:
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, sizes, block in _meetings(batches, narrow):
            for n, low, high in sizes:
                some = np.flatnonzero(least[n][block.n] != NEVER)
                if not len(some):
                    continue
                enough, words = least[n][block.n[some]], [w[some] for w in block.words]
                step = max(1, CELLS // len(some))
                for first in range(low, high, step):
                    ours = np.arange(first, min(high, first + step))
                    shared = _shared(own, ours, words)
                    hits = np.flatnonzero(shared >= enough)
                    a, b = np.divmod(hits, len(some))
                    a, b, overlap = ours[a], some[b], shared.ravel()[hits]
                    # Of two sets of one size the smaller is the one with the lower id.
                    once = (block.n[b] > n) | own.before(a, block, b)
                    if once.any():
                        yield _rows(own, a[once], block, b[once], overlap[once])

    return pairs


def _finder(least: Mapping[str, np.ndarray], narrow: bool) -> Callable:
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, np.ndarray] = {}
        for own, sizes, block in _meetings(batches, narrow):
            for kind, wanted in least.items():
                still = open_.setdefault(kind, np.ones(len(own.n), bool))
                for n, low, high in sizes:
                    todo = low + np.flatnonzero(still[low:high])
                    some = np.flatnonzero(wanted[n][block.n] != NEVER)
                    if not len(some) or not len(todo):
                        continue
                    enough, words = wanted[n][block.n[some]], [w[some] for w in block.words]
                    equal = np.flatnonzero(block.n[some] == n)
                    step = max(1, CELLS // len(some))
                    for at in range(0, len(todo), step):
                        ours = todo[at : at + step]
                        shared = _shared(own, ours, words)
                        hits = shared >= enough
                        if len(equal):
                            hits[:, equal] &= own.before(ours[:, None], block, some[equal][None, :])
                        b = hits.argmax(axis=1)
                        got = np.flatnonzero(hits[np.arange(len(ours)), b])
                        if len(got):
                            still[ours[got]] = False
                            kinds = pa.array([kind] * len(got), pa.string())
                            yield _rows(own, ours[got], block, some[b[got]], shared[got, b[got]], kind=kinds)

    return first


def _packer(size: int, columns: list[str]) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                piece = batch.slice(at, size)
                ends = pa.array([0, piece.num_rows], pa.int32())
                yield pa.RecordBatch.from_pydict({c: pa.ListArray.from_arrays(ends, piece.column(c)) for c in columns})

    return pack


def _meet(masks: DataFrame, total: int, most: int) -> DataFrame:
    """Rows as tasks read them: (part, large, block, arrays of sets), a part's own blocks first,
    then all in the order of ids. ``most`` is the number of sets in a block."""
    parts = PARTS * masks.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(most, -(-total // parts)))
    masks = masks.withColumn("n", F.col("n").cast("smallint"))
    types = {f.name: f.dataType for f in masks.schema}
    arrays = StructType([StructField(c, ArrayType(t)) for c, t in types.items()])
    ordered = masks.repartitionByRange("set_id").sortWithinPartitions("set_id").mapInArrow(_packer(size, masks.columns), arrays)
    # Partitions lie in the order of ids, and so do the rows of each.
    blocks = cut_lineage(ordered.withColumn("at", F.monotonically_increasing_id()))
    numbers = blocks.select("at").withColumn("block", F.row_number().over(Window.orderBy("at")).cast("bigint") - 1)
    blocks = blocks.join(F.broadcast(numbers), "at")
    used = max(1, min(parts, numbers.count()))
    own = blocks.select(F.pmod("block", F.lit(used)).cast("int").alias("part"), F.lit(False).alias("large"), "block", *masks.columns)
    every = F.explode(F.sequence(F.lit(0), F.lit(used - 1))).alias("part")
    return own.unionByName(blocks.select(every, F.lit(True).alias("large"), "block", *masks.columns)).repartitionById(
        used, "part"
    ).sortWithinPartitions("large", "block")


def _least(masks: DataFrame, wanted: Mapping[str, Column]) -> tuple[dict[str, np.ndarray], int, bool]:
    """For two sizes the least overlap that is wanted, of each kind; the number of sets; and do
    all masks fit into half a word?"""
    words = _words(masks.columns)
    every = masks.groupBy("n").agg(F.count(F.lit(1)).alias("sets"), *[F.bit_or(w).alias(w) for w in words]).collect()
    most = max((r["n"] for r in every), default=0)
    least = {kind: np.full((most + 1, most + 1), NEVER, np.uint8) for kind in wanted}
    grid = masks.sparkSession.range(1, most + 1).select(F.col("id").alias("n_large"))
    for smaller, larger in (("n_small", "n_large"), ("overlap", "n_small")):
        grid = grid.withColumn(smaller, F.explode(F.sequence(F.lit(1).cast("bigint"), larger)))
    ways = [F.min(F.when(c, F.col("overlap"))).alias(kind) for kind, c in wanted.items()]
    ways += [F.count_if(c).alias(f"{kind}_met") for kind, c in wanted.items()]
    for r in grid.groupBy("n_small", "n_large").agg(*ways).collect():
        for kind in wanted:
            if r[kind] is not None:
                if r[f"{kind}_met"] != r["n_small"] - r[kind] + 1:
                    raise ValueError(f"{kind}: a larger overlap must be wanted too")
                least[kind][r["n_small"], r["n_large"]] = r[kind]
    narrow = len(words) == 1 and all(0 <= r[words[0]] < 1 << 32 for r in every)
    return least, sum(r["sets"] for r in every), narrow


def _schema(masks: DataFrame, *more: StructField) -> StructType:
    fields = list(more)
    carried = [f for f in masks.schema if f.name != "n" and f.name not in _words(masks.columns)]
    for side in ("small", "large"):
        fields += [StructField(side if f.name == "set_id" else f"{f.name}_{side}", f.dataType) for f in carried]
    return StructType(fields + [StructField(c, ShortType()) for c in ("n_small", "n_large", "overlap")])


def _counts(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({c: F.col(c).cast(LongType()) for c in ("n_small", "n_large", "overlap")})


def pairs(masks: DataFrame, wanted: Column, most: int) -> DataFrame:
    """(small, large, n_small, n_large, overlap) of all pairs that are ``wanted``, a condition on
    the last three; and what else ``masks`` carry, for either side."""
    least, total, narrow = _least(masks, {"pair": wanted})
    met = _meet(masks, total, most)
    return _counts(met.mapInArrow(_lister(least["pair"], narrow), _schema(masks)))


def firsts(masks: DataFrame, wanted: Mapping[str, Column], most: int) -> DataFrame:
    """As ``pairs``, with ``kind``: for each set and kind the one with the least larger set. A set
    is compared until it is found, so that the work falls with the number of its pairs."""
    masks = masks.select("set_id", "n", *_words(masks.columns))
    least, total, narrow = _least(masks, wanted)
    met = _meet(masks, total, most)
    return _counts(met.mapInArrow(_finder(least, narrow), _schema(masks, StructField("kind", StringType()))))
