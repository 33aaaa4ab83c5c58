"""Near-duplicates by 64-bit similarity fingerprints.

Two fingerprints that differ in at most three bits agree in at least five of their
eight bytes, position by position. The inverted index therefore need not hold single
bytes, whose lists would grow with the square of the table: it holds the fourteen
quadruples of byte positions in which any five agreeing positions contain one, that is
32 known bits an entry. Pairs that meet there are verified bit by bit; the count of agreeing bytes
comes after that and drops none, since at most three bytes can hold three differing bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import col, fresh, keyed_text, slices, stored
from cratebook.llm.components import components

#: Texts above so many bytes are read in blocks.
BLOCK_BYTES = 1 << 20
#: Postings are compared inside one task up to this length; longer ones are split by further bits.
LIST_LIMIT = 4096
SEED = 42
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _shingles(text: bytes, length: int) -> Iterator[list[bytes]]:
    """The shingles of a text in blocks; together all of them, repeats included."""
    rest: list[bytes] = []
    start, seen = 0, False
    while start < len(text):
        end = start + BLOCK_BYTES
        cut = _SPACE.search(text, end) if end < len(text) else None
        end = cut.start() if cut else len(text)
        words = rest + text[start:end].split()
        start = end
        if len(words) >= length:
            joined = words if length == 1 else [b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)]
            seen = True
            yield joined
            rest = words[len(words) - length + 1 :] if length > 1 else []
        else:
            rest = words
    if not seen and rest:
        yield [b" ".join(rest)]


def fingerprint(text: str, length: int = 3) -> int:
    """Bit i is set if it is set in more than half of the hashes of all shingles; no words: 0."""
    ones, total = np.zeros(64, np.int64), 0
    for block in _shingles(text.encode("utf-8", "surrogatepass").lower(), length):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in block], "<u8")
        for at in range(0, len(hashes), 65536):
            part = hashes[at : at + 65536]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, length: int = 3) -> DataFrame:
    """(id, fp): one row per document, the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = [fingerprint(t.as_py(), length) for t in batch.column(1)]
                yield pa.record_batch([batch.column(0), pa.array(np.array(found, "<u8").view("<i8"))], ["id", "fp"])

    return keyed_text(docs, id_col, text_col).mapInArrow(compute, "id long, fp long")


def blocks(max_bits: int) -> list[list[int]]:
    """Sets of byte positions such that 8 - max_bits agreeing positions contain one of them."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits: 0 to 7")
    if max_bits <= 3:
        return [list(c) for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
    return [list(range(k, 8, max_bits + 1)) for k in range(max_bits + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _linked(fps: np.ndarray, reps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one posting list: pairs of representatives whose fingerprints link."""
    n, fps = len(fps), fps.view(np.uint64)
    octets = [((fps >> np.uint64(8 * p)) & np.uint64(255)).astype(np.uint8) for p in range(8)]
    root, left, right = np.arange(n), [], []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, n, 256):
        # Tally the positional bytes that a pair shares; only pairs with the guaranteed number
        # of them are verified bit by bit.
        shared = np.zeros((min(256, n - at), n), np.uint8)
        for position in range(8):
            shared += octets[position][at : at + 256, None] == octets[position][None, :]
        i, j = np.nonzero((shared >= 8 - max_bits) & (np.arange(at, min(at + 256, n))[:, None] < np.arange(n)[None, :]))
        near = np.bitwise_count(fps[i + at] ^ fps[j]) <= max_bits
        for x, y in zip((i + at)[near].tolist(), j[near].tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                left.append(x)
                right.append(y)
    return reps[left], reps[right]


def _links_of(lists: DataFrame, max_bits: int) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                item = row.values
                a, b = _linked(item.field("fp").to_numpy(), item.field("rep").to_numpy(), max_bits)
                if len(a):
                    yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return lists.select("list").mapInArrow(compute, "a long, b long")


def links(distinct: DataFrame, max_bits: int = 3, limit: int = LIST_LIMIT) -> DataFrame:
    """(a, b): links between the representatives of distinct fingerprints (columns fp, rep)
    which join exactly those that a chain of linking fingerprints joins.

    A posting list is one row of at most ``limit`` fingerprints. Longer lists are split:
    their fingerprints agree in the known bits and differ in at most ``max_bits`` others,
    so that of max_bits + 1 parts of the unknown bits one agrees too. Split again, a list
    has at most as many members as its unknown bits have values: it ends for any input.
    """
    out = []
    full = (1 << 64) - 1
    masks = [sum(0xFF << (8 * p) for p in b) for b in blocks(max_bits)]
    level = distinct.select("fp", "rep", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        keyed = level.withColumn("known", F.col("fp").bitwiseAND(F.col("mask")))
        counts = stored(
            keyed.groupBy("mask", "known").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "postings"
        )
        fits = keyed.join(counts.where(F.col("n") <= limit).drop("n"), ["mask", "known"], "left_semi")
        out.append(_links_of(fits.groupBy("mask", "known").agg(F.collect_list(F.struct("fp", "rep")).alias("list")), max_bits))
        if not counts.where(F.col("n") > limit).limit(1).count():
            break
        used = [r[0] & full for r in counts.where(F.col("n") > limit).select("mask").distinct().collect()]
        finer = F.create_map(*[x for m in used for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in _finer(m, max_bits)]))])
        level = stored(
            keyed.join(counts.where(F.col("n") > limit).drop("n"), ["mask", "known"], "left_semi")
            .select("fp", "rep", F.explode(finer[F.col("mask")]).alias("mask"))
            .distinct(),
            "postings",
        )
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _finer(mask: int, max_bits: int) -> list[int]:
    """The mask with one of max_bits + 1 parts of its unknown bits added, for each part."""
    unknown = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in unknown[k :: max_bits + 1]) for k in range(min(max_bits + 1, len(unknown)))]


def _classes(prints: DataFrame, max_bits: int, limit: int = LIST_LIMIT) -> DataFrame:
    """(fp, class, smallest): the component of every fingerprint of a row with id, and the
    smallest id in it. The nodes are fingerprints, as two of them may share their smallest id."""
    distinct = stored(prints.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("least")), "prints")
    roots = components(links(distinct.select("fp", F.col("fp").alias("rep")), max_bits, limit)).withColumnRenamed("node", "fp")
    named = stored(distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("class")), "prints")
    smallest = named.groupBy("class").agg(F.min("least").alias("smallest"))
    return named.join(smallest, "class").select("fp", "class", "smallest")


def near_duplicates(prints: DataFrame, max_bits: int = 3, limit: int = LIST_LIMIT) -> DataFrame:
    """(id, fp, component_id) for a table (id, fp), one row per row.

    component_id is the smallest id that a chain of fingerprints of at most ``max_bits``
    differing bits reaches, the document itself included. Equal fingerprints meet in one
    group before anything is compared, so copies cost one row. Rows without id have no
    component and link with nothing; repeated rows stay repeated, and rows of one id with
    different fingerprints each have the component of their own; an empty table gives none.
    """
    joined = prints.join(_classes(prints, max_bits, limit), "fp", "left")
    return joined.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("smallest")).alias("component_id"))


def simhash_neardup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 3, max_bits: int = 3
) -> DataFrame:
    """(<id_col>, fingerprint, component_id): one row per document.

    A-Z are lower-cased, words are split at ASCII white space, and the fingerprint takes
    every ``length``-word shingle with its repeats (fewer words: the whole sequence; no
    words, as in null and empty texts: zero, which links like any other). Long texts are
    read in blocks. Other columns of ``docs`` are ignored, whatever their names.
    """
    prints = stored(fingerprints(docs, id_col, text_col, length), "prints")
    return near_duplicates(prints, max_bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near-duplicates: that of the
    smallest id. Rows without id stay. Of several rows of that id in the group one stays; an id
    whose rows belong to several groups is decided in each of them."""
    prints = stored(fingerprints(docs, id_col, text_col, length), "prints")
    classes = stored(_classes(prints, max_bits), "prints")
    found = prints.where("id IS NOT NULL").join(classes, "fp")
    ids = stored(
        found.groupBy("id").agg((F.max("smallest") < F.col("id")).alias("gone"), (F.count(F.lit(1)) > 1).alias("again")).where("gone OR again"),
        "flags",
    )
    key = col(id_col).cast("long")
    stay = docs.join(ids.where("gone AND NOT again"), key == ids["id"], "left_anti")
    again = ids.where("again")
    if not again.limit(1).count():
        return stay
    once = stay.join(again, key == again["id"], "left_anti")

    @F.pandas_udf("long")
    def print_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, length) for t in texts], "<u8").view("<i8"))

    fp, group, digest = fresh(docs, "own_fp"), fresh(docs, "own_class"), fresh(docs, "own_digest")
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = stay.join(again, key == again["id"], "left_semi").select("*", print_of(text).alias(fp), F.sha2(text, 256).alias(digest))
    groups = classes.select(F.col("fp").alias(fp), F.col("class").alias(group), F.col("smallest").alias(fresh(docs, "own_smallest")))
    rows = stored(rows.join(groups, fp).where(key == F.col(fresh(docs, "own_smallest"))), "repeated")
    first = rows.groupBy(group).agg(F.min(digest).alias(digest))
    chosen = rows.join(first, [group, digest], "left_semi").dropDuplicates([group])
    return once.unionByName(chosen.select(*[col(c) for c in docs.columns]))
