"""Benchmark decontamination by a prefix-filtered containment join.

A benchmark item is looked for in windows of a fixed number of words. A window lies in a
document only if all its shingles do, so its prefix is a single shingle, and the rarest one
by document frequency gives the fewest candidates. Shingle counts come from all documents.
A candidate must leave room for the whole window before and after the shingle (position and
length bounds) and is then compared word by word.

The benchmark side is cut into blocks of a bounded number of words; only such a block is ever
sent to the tasks, and the documents pass once per block, whatever the benchmark's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import col, fresh, keyed_text, slices

WINDOW = 10
SHINGLE = 5
#: Most benchmark words sent to a task at once.
BLOCK_WORDS = 1_000_000

# Word characters: digits, letters, and every byte of a code point from U+0080; A-Z lower-cased.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass
class Block:
    """Windows of some benchmark items over a common vocabulary."""

    vocabulary: dict[bytes, int]
    windows: list[np.ndarray]  # distinct windows as word numbers
    items: list[list[str | None]]  # the items each window comes from; None: items without id
    shingles: dict[int, dict[bytes, int]]  # by length: shingle -> number
    of: list[list[int]]  # the shingle numbers of each window, by offset


def _by_name(items: set[str | None]) -> list[str | None]:
    return sorted(items, key=lambda i: (i is None, i or ""))


def make_block(rows: list[tuple[str | None, list[bytes]]], window: int, shingle: int) -> Block:
    vocabulary: dict[bytes, int] = {}
    found: dict[bytes, set[str | None]] = {}
    for item, words in rows:
        ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], "<i4")
        for k in range(max(1, len(ids) - window + 1)):
            if len(ids):
                found.setdefault(ids[k : k + window].tobytes(), set()).add(item)
    windows = [np.frombuffer(w, "<i4") for w in found]
    shingles: dict[int, dict[bytes, int]] = {}
    count, of = 0, []
    for w in windows:
        size = min(shingle, len(w))
        known, own = shingles.setdefault(size, {}), []
        for k in range(len(w) - size + 1):
            key = w[k : k + size].tobytes()
            if key not in known:
                known[key] = count
                count += 1
            own.append(known[key])
        of.append(own)
    return Block(vocabulary, windows, [_by_name(x) for x in found.values()], shingles, of)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, shingle: int, most: int) -> Iterator[Block]:
    """The items in blocks of at most ``most`` words (or one item, if it alone is longer)."""
    rows: list[tuple[str | None, list[bytes]]] = []
    held = 0
    for item, text in benchmark.select(col(id_col).cast("string"), col(text_col).cast("string")).toLocalIterator():
        words = words_of(text or "")
        if rows and held + len(words) > most:
            yield make_block(rows, window, shingle)
            rows, held = [], 0
        if words:
            rows.append((item, words))
            held += len(words)
    yield make_block(rows, window, shingle)


class Texts:
    """The words of some texts as one array of word numbers; words outside the vocabulary and
    the ends of texts are negative."""

    def __init__(self, texts: list[str], vocabulary: dict[bytes, int]):
        split = [words_of(t) for t in texts]
        self.n_words = np.fromiter(map(len, split), np.int64, len(split))
        get = vocabulary.get
        flat = [get(w, -1) for words in split for w in (*words, b" ")]
        self.flat = np.array(flat, "<i4")
        self.starts = np.cumsum(self.n_words + 1) - (self.n_words + 1)

    def shingles(self, table: dict[int, dict[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(position, shingle number) of every known shingle, lengths apart."""
        at, what = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        bad = np.r_[0, np.cumsum(self.flat < 0)]
        for size, known in table.items():
            if len(self.flat) < size:
                continue
            # Only places without a foreign word can hold a shingle of the benchmark.
            clean = np.flatnonzero(bad[size:] == bad[:-size])
            if not len(clean):
                continue
            rows = np.ascontiguousarray(self.flat[clean[:, None] + np.arange(size)])
            numbers = np.array([known.get(r.tobytes(), -1) for r in rows], np.int64)
            at.append(clean[numbers >= 0])
            what.append(numbers[numbers >= 0])
        return np.concatenate(at), np.concatenate(what)


def _rarest(block: Block, counts: dict[int, int]) -> tuple[dict[int, list[tuple[int, int]]], dict[int, dict[bytes, int]]]:
    """By shingle number the (window, offset) it stands for; and the shingles that are used."""
    prefix: dict[int, list[tuple[int, int]]] = {}
    for w, own in enumerate(block.of):
        k = min(range(len(own)), key=lambda k: (counts.get(own[k], 0), own[k]))
        if counts.get(own[k], 0):  # a window with a shingle in no document is in none
            prefix.setdefault(own[k], []).append((w, k))
    return prefix, {n: {b: s for b, s in t.items() if s in prefix} for n, t in block.shingles.items()}


def _find(texts: Texts, block: Block, prefix: dict, used: dict) -> tuple[np.ndarray, dict[int, set[int]]]:
    """Which words stand in a window; and the windows of each text."""
    delta = np.zeros(len(texts.flat) + 1, np.int64)
    inside: dict[int, set[int]] = {}
    at, what = texts.shingles(used)
    order = np.argsort(what, kind="stable")
    at, what = at[order], what[order]
    for s in np.unique(what).tolist():
        places = at[np.searchsorted(what, s) : np.searchsorted(what, s, "right")]
        for w, offset in prefix[s]:
            words = block.windows[w]
            begin = places - offset
            begin = begin[(begin >= 0) & (begin + len(words) <= len(texts.flat))]
            for k, word in enumerate(words.tolist()):
                begin = begin[texts.flat[begin + k] == word]
            if len(begin):
                np.add.at(delta, begin, 1)
                np.add.at(delta, begin + len(words), -1)
                for d in np.unique(np.searchsorted(texts.starts, begin, "right") - 1).tolist():
                    inside.setdefault(d, set()).add(w)
    return np.cumsum(delta[:-1]) > 0, inside


def _runs(hit: np.ndarray) -> list[int]:
    """First and last + 1 of every run of hit words."""
    edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return edges.tolist()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with three columns more, whose names are also given as an attribute of the plan:
    see ``contamination_columns``. One row per row, whole texts.

    * number of words;
    * runs of hit words as [first, last + 1, first, ...], word positions from 0;
    * the ids, as strings, of the items that have a window in the text; one null stands for all
      items without id.

    A null or empty text has no words; an item without words has no windows; equal windows of several items count for each. Either table may be empty.
    """
    n_words, hits, items = contamination_columns(docs)
    spark = docs.sparkSession
    marked = docs.select(
        "*", F.lit(0).cast("long").alias(n_words), F.array().cast("array<int>").alias(hits), F.array().cast("array<string>").alias(items)
    )
    for block in item_blocks(benchmark, item_col, item_text_col, window, shingle, block_words):
        sent = spark.sparkContext.broadcast(block)
        counts = {r["s"]: r["n"] for r in _shingle_counts(docs, text_col, sent).collect()}  # at most the block's shingles
        used = spark.sparkContext.broadcast(_rarest(block, counts))
        marked = _mark(marked, text_col, n_words, hits, items, sent, used)
    return marked


def contamination_columns(docs: DataFrame) -> tuple[str, str, str]:
    return fresh(docs, "n_words"), fresh(docs, "hit_runs"), fresh(docs, "hit_items")


def _shingle_counts(docs: DataFrame, text_col: str, sent) -> DataFrame:
    """(s, n): in how many documents each of the block's shingles occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = sent.value
        total = np.zeros(sum(map(len, block.shingles.values())), np.int64)
        for whole in batches:
            for batch in slices(whole):
                texts = Texts(batch.column(0).to_pylist(), block.vocabulary)
                at, what = texts.shingles(block.shingles)
                pairs = np.unique((np.searchsorted(texts.starts, at, "right") - 1) * max(1, len(total)) + what)
                total += np.bincount(pairs % max(1, len(total)), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["s", "n"])

    texts = docs.select(F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))


def _mark(docs: DataFrame, text_col: str, n_words: str, hits: str, items: str, sent, used) -> DataFrame:
    @F.pandas_udf("n long, hits array<int>, items array<string>")
    def mark(texts_: pd.Series, before: pd.Series, known: pd.Series) -> pd.DataFrame:
        block: Block = sent.value
        prefix, shingles = used.value
        out = []
        start, held, said = 0, 0, texts_.tolist()
        bounds = [0]
        for k, t in enumerate(said):
            held += len(t)
            if held > 8 << 20:
                bounds.append(k + 1)
                held = 0
        for start, end in zip(bounds, [*bounds[1:], len(said)], strict=True):
            texts = Texts(said[start:end], block.vocabulary)
            hit, inside = _find(texts, block, prefix, shingles)
            for d in range(end - start):
                n, first = int(texts.n_words[d]), int(texts.starts[d])
                if d not in inside:
                    out.append((n, before[start + d], known[start + d]))
                    continue
                own = hit[first : first + n].copy()
                old = list(before[start + d])
                for a, b in zip(old[::2], old[1::2], strict=True):
                    own[a:b] = True
                named = {i for w in inside[d] for i in block.items[w]} | set(known[start + d])
                out.append((n, _runs(own), _by_name(named)))
        return pd.DataFrame(out, columns=["n", "hits", "items"])

    made = fresh(docs, "marks")
    kept = [c for c in docs.columns if c not in (n_words, hits, items)]
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    found = docs.select("*", mark(text, col(hits), col(items)).alias(made))
    return found.select(
        *[col(c) for c in kept],
        col(made)["n"].alias(n_words),
        col(made)["hits"].alias(hits),
        col(made)["items"].alias(items),
    )


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """(<id_col>, n_words, n_hit, n_items, items_sha256, contaminated): one row per document."""
    own = keyed_text(docs, id_col, text_col)
    marked = contamination(own, benchmark, "id", "text", **named)
    runs = F.transform(F.col("hit_runs"), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    marked = marked.withColumn("n_hit", F.aggregate(runs, F.lit(0).cast("long"), lambda s, x: s + x))
    return marked.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **named) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of a benchmark item."""
    _, hits, _ = contamination_columns(docs)
    return contamination(docs, benchmark, text_col=text_col, **named).where(F.size(col(hits)) == 0).select(*[col(c) for c in docs.columns])
