"""Token ids as binary files: one concatenated id array, document boundaries in Elias-Fano code.

A file set is a Parquet folder, so that any store that Spark writes will hold it and a lost task
leaves nothing behind. Its rows are blocks of a bounded number of ids, in ascending id order by
(part, seq):

====== ======================================================================
part   number of the ordered task; seq: number of the block within it
n_docs documents that end in the block; n_ids: ids in it
n_null how many of the documents have no id; they come first
docs   the documents' ids, little-endian 64-bit (0 where there is none)
ids    all token ids, little-endian 32-bit, end id of every document included
ends   the documents' ends within ``ids``: an ``EliasFano`` string
====== ======================================================================

The ends of n documents over u ids take n * (2 + log2(u / n)) bits and a little for select,
not 64 bits each; a document's offset is found by two selects without reading the others'. The
offsets of many documents are selected together, by counts of ones per byte and a table of the
places of ones in a byte.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cratebook.llm.common import keyed_text, slices
from cratebook.session import scratch_path

#: A block is closed at so many ids or documents (a longer document is a block of its own).
BLOCK_IDS = 1 << 20
BLOCK_DOCS = 1 << 14
END_ID = 1
#: Most words remembered by a worker process, and most other runs.
MEMO_RUNS = 900_000
#: Bytes of text encoded together: a run is looked up once in them.
BATCH_IN = 8 << 20
#: Every so many ones the place of a one is noted.
EVERY = 64

_HEAD = struct.Struct("<QQB")
#: Where the k-th one stands in a byte.
_PLACES = np.array([(np.flatnonzero([byte >> b & 1 for b in range(8)]).tolist() + [8] * 8)[:8] for byte in range(256)])


class EliasFano:
    """An ascending list of n numbers up to u: low bits packed, high bits as a unary string."""

    def __init__(self, raw: bytes):
        self.n, self.u, self.low_bits = _HEAD.unpack_from(raw)
        n_low, n_high = -(-self.n * self.low_bits // 8), -(-(self.n + (self.u >> self.low_bits) + 1) // 8)
        at = _HEAD.size
        self.low = np.frombuffer(raw, np.uint8, n_low, at)
        self.high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        # Byte in which the one with number EVERY * k stands, and the ones before that byte.
        self.marks = np.frombuffer(raw, "<u4", -1, at + n_low + n_high).reshape(-1, 2)

    @staticmethod
    def write(values: np.ndarray, u: int) -> bytes:
        values = np.asarray(values, np.int64)
        n = len(values)
        low_bits = max(0, (u // n).bit_length() - 1) if n else 0
        low = np.packbits(((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8).ravel(), bitorder="little")
        bits = np.zeros(-(-(n + (u >> low_bits) + 1) // 8) * 8, np.uint8)
        places = (values >> low_bits) + np.arange(n)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little")
        before = np.r_[0, np.cumsum(np.bitwise_count(high))]
        byte = places[::EVERY] >> 3
        marks = np.stack([byte, before[byte]], 1).astype("<u4")
        return _HEAD.pack(n, u, low_bits) + low.tobytes() + high.tobytes() + marks.tobytes()

    def select(self, k: int) -> int:
        """The k-th number, from 0: jump to the noted byte, count ones from there."""
        byte, ones = (int(x) for x in self.marks[k // EVERY])
        while True:
            run = np.cumsum(np.bitwise_count(self.high[byte : byte + EVERY]))
            if len(run) and ones + int(run[-1]) > k:
                break
            byte, ones = byte + EVERY, ones + int(run[-1])
        step = int(np.searchsorted(run, k - ones, "right"))
        ones += int(run[step - 1]) if step else 0
        inside = np.flatnonzero(np.unpackbits(self.high[byte + step : byte + step + 1], bitorder="little"))
        return self._number((byte + step) * 8 + int(inside[k - ones]), k)

    def _number(self, place: int, k: int) -> int:
        first, low = k * self.low_bits, 0
        for b in range(self.low_bits):
            low |= int(self.low[(first + b) >> 3] >> ((first + b) & 7) & 1) << b
        return (place - k) << self.low_bits | low

    def selects(self, ks: np.ndarray) -> np.ndarray:
        """The numbers with ranks ``ks``, all at once."""
        ones = np.cumsum(np.bitwise_count(self.high), dtype=np.int64)
        byte = np.searchsorted(ones, ks, "right")
        inside = ks - np.where(byte > 0, ones[np.maximum(byte, 1) - 1], 0)
        numbers = (byte * 8 + _PLACES[self.high[byte], inside] - ks) << self.low_bits
        for b in range(self.low_bits):
            bit = ks * self.low_bits + b
            numbers |= ((self.low[bit >> 3] >> (bit & 7)) & 1).astype(np.int64) << b
        return numbers

    def span(self, k: int) -> tuple[int, int]:
        """Where document k begins and ends."""
        return (self.select(k - 1) if k else 0), self.select(k)

    def spans(self, ks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where documents ``ks`` begin and end."""
        last = self.selects(ks)
        first = np.zeros(len(ks), np.int64)
        first[ks > 0] = self.selects(ks[ks > 0] - 1)
        return first, last


# The splitting pattern and normalisers of the public word tokenizer.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = ["NFC", "Replace", "Lowercase"]
WORD_END = "</w>"

# A run of letters up to U+00FF, and behind it ASCII marks only.
_PLAIN = r"^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!\"#$%&()*+,\-./:;<=>?@\[\\\]^_{|}~]*)$"
# Arrow splits at these too, the tokenizer does not.
_SEPARATORS = "[\x1c-\x1f]"


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple:
    """The library's tokenizer; and, if its words are letter runs with a marked last token, which
    ids end a word."""
    import tokenizers

    library = tokenizers.Tokenizer.from_file(path)
    rules = json.loads(library.to_str())
    splits = [p.get("pattern", {}).get("Regex") for p in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
    normal = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
    if splits[:1] != [_SPLIT] or normal != _NORMAL or rules["model"].get("end_of_word_suffix") != WORD_END:
        return library, None
    names = [library.id_to_token(i) or "" for i in range(library.get_vocab_size())]
    return library, np.array([n.endswith(WORD_END) for n in names])


class WordTokenizer:
    """Ids of texts by the tokenizers library, for tokenizers that never join across white space.

    Each distinct run between spaces is encoded once for all texts given together. A run of letters
    (up to U+00FF) before ASCII marks is a word of its own to the tokenizer, whatever its case;
    such words go to the library many at a time, and the marks behind their last tokens tell them
    apart again. Words and other runs are remembered, up to a bound.
    """

    def __init__(self, path: str, most: int = MEMO_RUNS):
        self.library, self.ends = _tokenizer(path)
        self.most = most
        self.words: dict[str, bytes] = {"": b""}
        self.others: dict[str, bytes] = {"": b""}

    def _single(self, runs: list[str]) -> Iterator[bytes]:
        for at in range(0, len(runs), 20_000):
            for e in self.library.encode_batch_fast(runs[at : at + 20_000], add_special_tokens=False):
                yield struct.pack(f"<{len(e.ids)}I", *e.ids)

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Lower-case letter words, joined by spaces for the library."""
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            ids = np.array(self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(some):
                yield from self._single(some)
                continue
            raw, first = ids.tobytes(), 0
            for end in (4 * last).tolist():
                yield raw[first:end]
                first = end

    def _known(self, runs: pa.Array, memo: dict[str, bytes], encode: Callable[[list[str]], Iterator[bytes]]) -> pa.Array:
        """The ids of every run, those new to ``memo`` by the library."""
        coded = runs.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(memo) > self.most:
            memo.clear()
            memo[""] = b""
        new = [n for n in names if n not in memo]
        memo.update(zip(new, encode(new), strict=True))
        return pa.array(map(memo.__getitem__, names), pa.large_binary()).take(coded.indices)

    def _encode(self, runs: pa.Array) -> pa.Array:
        if self.ends is None:
            return self._known(runs, self.others, self._single)
        plain = pc.extract_regex(runs, _PLAIN)
        is_plain = plain.is_valid()
        heads = pc.if_else(is_plain, pc.utf8_lower(pc.struct_field(plain, "head")), "")
        tails = pc.if_else(is_plain, pc.struct_field(plain, "tail"), runs)
        first, behind = self._known(heads, self.words, self._words), self._known(tails, self.others, self._single)
        return pc.binary_join_element_wise(first, behind, pa.scalar(b"", pa.large_binary()))

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of every text."""
        whole = pa.array(texts, pa.large_string())
        if pc.any(pc.match_substring_regex(whole, _SEPARATORS)).as_py():
            # No tokenizer joins across a plain space either, whatever else is in the run.
            split = pc.split_pattern(whole, " ")
        else:
            split = pc.utf8_split_whitespace(whole)
        coded = split.values.dictionary_encode()
        ids = self._encode(coded.dictionary).take(coded.indices)
        bounds = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[split.offsets.to_numpy()].tolist()
        raw = memoryview(ids.buffers()[2])
        for first, end in zip(bounds, bounds[1:], strict=False):
            yield bytes(raw[first:end])


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The process's tokenizer: what one task has learned serves the next."""
    return WordTokenizer(path)


_BLOCK = "part int, seq int, n_docs long, n_null long, n_ids long, docs binary, ids binary, ends binary"
_BLOCK_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_ids", pa.int64()),
        ("docs", pa.binary()), ("ids", pa.binary()), ("ends", pa.binary()),
    ]
)


def _block(seq: int, docs: list[int | None], chunks: list[bytes]) -> pa.RecordBatch:
    lengths = np.fromiter(map(len, chunks), np.int64, len(chunks)) // 4
    ends = np.cumsum(lengths)
    u, names = int(ends[-1]), np.array([d or 0 for d in docs], "<i8").tobytes()
    row = (TaskContext.get().partitionId(), seq, len(docs), docs.count(None), u, names, b"".join(chunks), EliasFano.write(ends, u))
    return pa.record_batch([pa.array([x], f.type) for x, f in zip(row, _BLOCK_ARROW, strict=True)], schema=_BLOCK_ARROW)


def write_ids(
    docs: DataFrame,
    path: str,
    encoder: Callable[[], Callable[[list[str]], Iterator[bytes]]],
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    block_docs: int = BLOCK_DOCS,
) -> None:
    """Write the ids of all texts in ascending order of their ids.

    Null and empty texts hold the end id only. Rows without id come first; rows that share an id
    follow one another by the hash of their texts, equal ones in any order. An empty table gives an empty file set. ``encoder`` makes, within a task, a function
    from texts to their little-endian 32-bit ids.
    """
    closing = struct.pack("<I", end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, seq, held = encoder(), 0, 0
        names: list[int | None] = []
        chunks: list[bytes] = []
        for whole in batches:
            for batch in slices(whole, most=BATCH_IN):
                for name, ids in zip(batch.column(0).to_pylist(), ids_of(batch.column(1).to_pylist()), strict=True):
                    if names and (held + len(ids) // 4 >= block_ids or len(names) >= block_docs):
                        yield _block(seq, names, chunks)
                        names, chunks, held, seq = [], [], 0, seq + 1
                    names.append(name)
                    chunks.append(ids + closing)
                    held += len(ids) // 4 + 1
        if names:
            yield _block(seq, names, chunks)

    # The last key tells equal rows apart, so that a large group of them is split too.
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("tie")]
    rows = keyed_text(docs, id_col, text_col).withColumn("tie", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    ordered.mapInArrow(encode, _BLOCK).write.option("compression", "zstd").parquet(path)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(path)


def _bases(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, base): the ids before every block. Running sums go part by part, and over one
    row per part."""
    heads = _blocks(spark, path).select("part", "seq", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return heads.withColumn("within", within).join(before, "part").select("part", "seq", (F.col("before") + F.col("within")).alias("base"))


def read_documents(spark: SparkSession, path: str, row: Callable[[bytes], tuple], schema: str, types: list[pa.DataType]) -> DataFrame:
    """(id, start, n_tokens, *schema): every document of a file set; ``row`` makes the further
    columns from a document's ids as bytes. ``start`` counts the ids of all documents before."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, nulls, docs, ids, ends in zip(*[batch.column(k).to_pylist() for k in range(6)], strict=True):
                names = np.frombuffer(docs, "<i8")
                n = len(names)
                first, last = EliasFano(ends).spans(np.arange(n))
                more = [row(ids[4 * a : 4 * b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                named = pa.array(names, pa.int64(), mask=np.arange(n) < nulls)
                columns = [np.full(n, part, np.int32), np.full(n, seq, np.int32), named, first, last - first]
                made = [pa.array(x, t) for x, t in zip(zip(*more, strict=True), types, strict=True)]
                yield pa.record_batch([*map(pa.array, columns), *made], ["part", "seq", "id", "first", "n_tokens", *[f"c{k}" for k in range(len(types))]])

    rows = _blocks(spark, path).select("part", "seq", "n_null", "docs", "ids", "ends")
    read = rows.mapInArrow(decode, f"part int, seq int, id long, first long, n_tokens long, {schema}")
    joined = read.join(_bases(spark, path), ["part", "seq"]).withColumn("start", F.col("base") + F.col("first"))
    return joined.select("id", "start", "n_tokens", *read.columns[5:])


def read_one(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each, if rows share the id), by its block's select structure."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nulls, docs, ids, ends in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                names, code = np.frombuffer(docs, "<i8")[nulls:], EliasFano(ends)
                for k in range(nulls + int(np.searchsorted(names, doc_id)), nulls + int(np.searchsorted(names, doc_id, "right"))):
                    a, b = code.span(k)
                    yield pa.record_batch([pa.array([np.frombuffer(ids[4 * a : 4 * b], "<u4").astype(np.int64).tolist()], pa.list_(pa.int64()))], ["ids"])

    return [r[0] for r in _blocks(spark, path).select("n_null", "docs", "ids", "ends").mapInArrow(find, "ids array<long>").collect()]


def encoded_checksums(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(<id_col>, start, n_tokens, ids_crc32): writes the file set into the shared folder, and
    reads from it where each document lies, its length with the end id, and its ids' checksum."""
    spark = docs.sparkSession
    path = scratch_path(spark, "ids")
    write_ids(docs, path, lambda: word_tokenizer(tokenizer_file), id_col, text_col)
    found = read_documents(spark, path, lambda ids: (zlib.crc32(ids),), "ids_crc32 long", [pa.int64()])
    return found.withColumnRenamed("id", id_col)
