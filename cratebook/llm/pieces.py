"""Subword encoding and decoding with a byte-fallback BPE piece model.

The model file only supplies pieces and scores. Encoding runs in rounds over flat symbol
arrays: in every word the best-ranked neighbouring pair is found by a segmented minimum,
its leftmost occurrence is merged in all words at once, finished words are set aside, and
the arrays are compacted until no pair is left.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cratebook.llm.common import keyed_text, slices

SPACE = "▁"
NO_PAIR = np.int64(1) << 40


#: Bytes of text encoded together: a word is merged once in them.
BATCH_IN = 8 << 20


@dataclass
class Pieces:
    """Lookup tables of a piece model."""

    names: list[str]
    singles: np.ndarray  # by code point: its piece, or -1 - code point
    bytes_: list[int]  # ids of the 256 byte pieces
    keys: np.ndarray  # left * size + right, ascending
    ranks: np.ndarray  # rank of the merged piece
    merged: np.ndarray  # its id
    alone: np.ndarray  # by rank: nothing that the merged piece can join ranks above it
    joins: set[str]  # neighbouring characters inside any piece
    special: set[int]
    size: int
    longest: int


@lru_cache(maxsize=4)
def read_pieces(model_file: str) -> Pieces:
    """Tables from the model file. Supported: BPE pieces, identity normalisation, a dummy
    space in front, white space kept, byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    bytes_ = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
    if not all(model.is_byte(i) for i in bytes_) or model.normalize("a  b\nÅ Å") != "▁a▁▁b\nÅ▁Å":
        raise ValueError("this piece model is of another kind")
    ids = {p: i for i, p in enumerate(names) if i not in special}
    score = {i: model.get_score(i) for i in ids.values()}
    order = {i: k for k, i in enumerate(sorted(score, key=lambda i: (-score[i], i)))}
    keys, ranks, merged = [], [], []
    best_with: dict[int, int] = {}
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                keys.append(left * size + right)
                ranks.append(order[i])
                merged.append(i)
                for part in (left, right):
                    best_with[part] = min(best_with.get(part, size), order[i])
    singles = -1 - np.arange(0x110000, dtype=np.int64)
    for piece, i in ids.items():
        if len(piece) == 1:
            singles[ord(piece)] = i
    at = np.argsort(np.array(keys, np.int64))
    alone = np.zeros(size, bool)
    for i, k in order.items():
        alone[k] = best_with.get(i, size) > k
    return Pieces(
        names,
        singles,
        bytes_,
        np.array(keys, np.int64)[at],
        np.array(ranks, np.int64)[at],
        np.array(merged, np.int64)[at],
        alone,
        {p[k : k + 2] for p in ids for k in range(len(p) - 1)},
        special,
        size,
        max(map(len, ids)),
    )


def _pair_ranks(model: Pieces, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Index into the pair tables, or -1."""
    key = left * model.size + right
    at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
    return np.where((model.keys[at] == key) & (left >= 0) & (right >= 0), at, -1)


def merge_rounds(model: Pieces, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all words together. ``symbols``: ids, negative for characters without a piece;
    ``word``: the ascending word number of every symbol. Both are returned merged.

    A word merges its leftmost best pair in a round; further occurrences of that same rank
    go in the same round only if no pair made by it could come before them, or if the
    occurrence before is so far that no piece could reach across.
    """
    done_symbols, done_words = [], []
    pair = np.full(len(symbols), -1, np.int64)
    inside = np.flatnonzero(word[1:] == word[:-1])
    pair[inside] = _pair_ranks(model, symbols[inside], symbols[inside + 1])
    while len(symbols):
        rank = np.where(pair >= 0, model.ranks[pair], NO_PAIR)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        length = np.diff(np.r_[first, len(word)])
        best = np.minimum.reduceat(rank, first)
        over = np.repeat(best == NO_PAIR, length)
        if over.any():
            done_symbols.append(symbols[over])
            done_words.append(word[over])
            symbols, word, pair, rank, best_at = symbols[~over], word[~over], pair[~over], rank[~over], best[best != NO_PAIR]
            length = length[best != NO_PAIR]
            if not len(symbols):
                break
        else:
            best_at = best
        hit = np.flatnonzero(rank == np.repeat(best_at, length))
        # Of overlapping occurrences every other one counts, from the left.
        opens = np.r_[True, hit[1:] != hit[:-1] + 1]
        place = np.arange(len(hit))
        hit = hit[(place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0]
        leftmost = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
        far = np.r_[True, hit[1:] - hit[:-1] >= 4 * model.longest]
        hit = hit[leftmost | far | model.alone[rank[hit]]]
        symbols[hit] = model.merged[pair[hit]]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        now = np.cumsum(keep)[hit] - 1
        symbols, word, pair = symbols[keep], word[keep], pair[keep]
        touched = np.zeros(len(symbols), bool)
        touched[now] = True
        touched[now[now > 0] - 1] = True
        again = np.flatnonzero(touched)
        last = again + 1 >= len(symbols)
        again_in = again[~last]
        same = word[again_in] == word[again_in + 1]
        pair[again] = -1
        again_in = again_in[same]
        pair[again_in] = _pair_ranks(model, symbols[again_in], symbols[again_in + 1])
    if not done_symbols:
        return symbols, word
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
    at = np.argsort(word, kind="stable")
    return symbols[at], word[at]


def encode_words(model: Pieces, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another (spaces already written as U+2581), and where each
    word ends."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    symbols, word = merge_rounds(model, model.singles[points], np.repeat(np.arange(len(words)), lengths))
    strange = symbols < 0
    if strange.any():
        spelled = [[model.bytes_[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")] for i in symbols[strange].tolist()]
        times = np.ones(len(symbols), np.int64)
        times[strange] = list(map(len, spelled))
        word, symbols = np.repeat(word, times), np.repeat(symbols, times)
        symbols[symbols < 0] = [i for ids in spelled for i in ids]
    return symbols.astype("<i4"), np.searchsorted(word, np.arange(1, len(words) + 1))


_SPACED = re.compile(r" *[^ ]+| +$")


def words_of(text: str) -> list[str]:
    """Parts of a text that no merge crosses: spaces and what follows them. Joined they are
    the text with its dummy space."""
    if not text:
        return []
    text = text.replace(SPACE, " ") if SPACE in text else text
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _SPACED.findall(" " + text)
    return text.split(" ")


#: Most words merged at once.
MOST_WORDS = 100_000
#: Words up to this length are merged as they are.
SHORT_WORD = 24


def _parts(model: Pieces, word: str) -> list[str]:
    """Cut a long word, or one over several lines, where its two neighbouring characters
    stand together in no piece."""
    word = word.replace(" ", SPACE) if word[:1] == " " else SPACE + word
    if len(word) <= SHORT_WORD and "\n" not in word:
        return [word]
    cuts = [0, *[k for k in range(1, len(word)) if word[k - 1 : k + 1] not in model.joins], len(word)]
    return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _joined(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """Large-binary values run together: as many as ``sizes`` tells into each result."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64, len(values) + 1)[np.r_[0, np.cumsum(sizes)]] if len(values) else np.zeros(len(sizes) + 1, np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at), data or pa.py_buffer(b"")])


class Encoder:
    """Encodes texts. Each distinct word of the texts given together is merged once, at most
    ``most`` words at a time; nothing is kept from one call to the next."""

    def __init__(self, model: Pieces, most: int = MOST_WORDS):
        self.model, self.most = model, most
        self.decimals = pa.array([f"{i},".encode() for i in range(model.size)], pa.large_binary())

    def _merged(self, words: list[str]) -> pa.Array:
        ids, ends = encode_words(self.model, words)
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(np.arange(len(ids) + 1) * 4), pa.py_buffer(ids)])
        return _joined(whole, np.diff(ends, prepend=0))

    def _words(self, words: list[str]) -> pa.Array:
        """The ids of every word, little-endian."""
        cut = [_parts(self.model, w) for w in words]
        parts = pa.array([p for c in cut for p in c], pa.large_string()).dictionary_encode()
        distinct = parts.dictionary.to_pylist()
        merged = [self._merged(distinct[at : at + self.most]) for at in range(0, len(distinct), self.most)]
        known = pa.concat_arrays(merged) if merged else pa.array([], pa.large_binary())
        return _joined(known.take(parts.indices), np.fromiter(map(len, cut), np.int64, len(cut)))

    def _texts(self, split: pa.Array) -> Iterator[tuple[bytes, str]]:
        """``split``: the words of every text, as a list array."""
        words = split.values.dictionary_encode()
        ids = _joined(self._words(words.dictionary.to_pylist()).take(words.indices), np.diff(split.offsets.to_numpy()))
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)
        flat = np.frombuffer(ids.buffers()[2], "<i4", int(at[-1]) // 4)
        said = _joined(self.decimals.take(pa.array(flat)), np.diff(at) // 4)
        for raw, numbers in zip(ids, said, strict=True):
            yield raw.as_py(), numbers.as_py()[:-1].decode()

    def __call__(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and in decimal."""
        # Most texts are cut at single spaces; the others need a closer look.
        usual = [bool(t) and SPACE not in t and "  " not in t and t[0] != " " and t[-1] != " " for t in texts]
        plain = pc.split_pattern(pa.array([t for t, u in zip(texts, usual, strict=True) if u], pa.large_string()), " ")
        other = pa.array([words_of(t) for t, u in zip(texts, usual, strict=True) if not u], pa.list_(pa.large_string()))
        of_plain, of_other = self._texts(plain), self._texts(other)
        for u in usual:
            yield next(of_plain if u else of_other)


def decoder(model: Pieces) -> Callable[[list[int]], str]:
    """Ids to text: pieces joined, U+2581 as space without the dummy one in front, runs of
    byte pieces read as UTF-8 with U+FFFD for each invalid byte; control pieces give nothing."""
    table = [b"" if i in model.special else p.replace(SPACE, " ").encode() for i, p in enumerate(model.names)]
    for b, i in enumerate(model.bytes_):
        table[i] = bytes([b])
    is_byte, control = set(model.bytes_), {i for i in model.special if i not in model.bytes_}
    unknown = " ⁇ ".encode()
    table[0] = unknown
    for i in control - {0}:
        table[i] = b"\xff"  # never valid: sends the ids down the careful path

    def read(run: bytes) -> str:
        out, k = [], 0
        while k < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[k : k + n].decode())
                    k += n
                    break
                except UnicodeDecodeError:
                    if n == 4 or k + n >= len(run):
                        out.append("�")
                        k += 1
                        break
        return "".join(out)

    def decode(ids: list[int]) -> str:
        if not ids:
            return ""
        start = next((k for k, i in enumerate(ids) if i not in control or i == 0), len(ids))
        whole = b"".join([table[i] for i in ids])
        if start < len(ids) and model.names[ids[start]].startswith(SPACE):
            whole = whole[1:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            out, run = [], b""
            for k, i in enumerate(ids):
                if i in is_byte:
                    run += table[i]
                    continue
                out.append(read(run))
                run, piece = b"", "" if i in control and i else table[i].decode()
                out.append(piece[1:] if k == start and model.names[i].startswith(SPACE) else piece)
            return "".join([*out, read(run)])

    return decode


def _encoded(docs: DataFrame, model_file: str, id_col: str, text_col: str, row: Callable, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = read_pieces(model_file)
        encoder, decode = Encoder(model), decoder(model)
        for whole in batches:
            for batch in slices(whole, most=BATCH_IN):
                out = [row(ids, said, decode) for ids, said in encoder(batch.column(1).to_pylist())]
                arrays = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), row.types, strict=True)]
                yield pa.record_batch([batch.column(0), *arrays], schema=pa.schema([("id", pa.int64()), *[(f"c{k}", t) for k, t in enumerate(row.types)]]))

    return keyed_text(docs, id_col, text_col).mapInArrow(run, schema)


def encode_decode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(<id_col>, ids, decoded): the ids of every text, and the text these ids decode to.

    No begin or end ids, no sampling. Null and empty texts have no ids; one row per row;
    other columns are ignored whatever their names; the table may be empty.
    """

    def row(ids: bytes, said: str, decode: Callable) -> tuple:
        got = np.frombuffer(ids, "<i4")
        return got.tolist(), decode(got.tolist())

    row.types = [pa.list_(pa.int32()), pa.string()]
    return _encoded(docs, model_file, id_col, text_col, row, "id long, c0 array<int>, c1 string").toDF(id_col, "ids", "decoded")


def encode_decode_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(<id_col>, n_tokens, ids_sha256, decoded_sha256): as ``encode_decode``, each text's ids
    and decoded text reduced to digests where they are made, before rows leave the task."""

    def row(ids: bytes, said: str, decode: Callable) -> tuple:
        got = np.frombuffer(ids, "<i4").tolist()
        back = decode(got).encode("utf-8", "surrogatepass")
        return len(got), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(back).hexdigest()

    row.types = [pa.int64(), pa.string(), pa.string()]
    return _encoded(docs, model_file, id_col, text_col, row, "id long, c0 long, c1 string, c2 string").toDF(
        id_col, "n_tokens", "ids_sha256", "decoded_sha256"
    )
