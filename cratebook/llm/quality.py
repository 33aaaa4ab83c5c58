"""Document quality: random-indexing word vectors, pooled, and a small network over them.

Every word falls into one of ``BUCKETS`` buckets by its checksum; a bucket has a sparse random
index vector of few +1 and -1. A bucket's word vector adds to its own index vector the index
vectors of all words that stand near its words anywhere in the corpus. A document is the mean
of its words' vectors. Words are letters, digits or marks in a run, and signs for words in
capitals, words that repeat the one before, and lines that repeat an earlier one.

The context sums are whole numbers added up in a table of fixed size, so they cover the whole
corpus and do not depend on the order of tasks. The network is fitted on a sample of at most
``SAMPLE`` rows per label (a stated bound) outside the held-out third; a temperature fitted on
a part that the weights did not see calibrates its probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import MEMO_WORDS, col, keyed_text, slices

BUCKETS = 1 << 14
DIM = 64
NONZERO = 4
REACH = 2
SAMPLE = 4000
HIDDEN = 24
#: Tokens whose contexts are summed at once.
CHUNK = 1 << 19
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _index() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's index vector; the last row, for document ends, is empty."""
    rng = np.random.default_rng(9)
    place = rng.integers(0, DIM, (BUCKETS + 1, NONZERO))
    sign = rng.choice([-1, 1], (BUCKETS + 1, NONZERO)).astype(float)
    sign[-1] = 0
    return place, sign


class Tokens:
    """Texts to bucket numbers; remembers words, up to a bound."""

    def __init__(self) -> None:
        self.memo: dict[str, tuple[int, ...]] = {}
        self.again, self.same_line = (self._bucket(s) for s in ("<again>", "<line again>"))

    @staticmethod
    def _bucket(word: str) -> int:
        return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS

    def _learn(self, word: str) -> tuple[int, ...]:
        own = self._bucket(word.lower())
        got = (own, self._bucket("<capitals>")) if len(word) > 1 and word.isupper() else (own,)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        self.memo[word] = got
        return got

    def __call__(self, text: str) -> list[int]:
        out: list[int] = []
        memo, last = self.memo, None
        for m in _TOKEN.finditer(text):
            word = m.group()
            got = memo.get(word) or self._learn(word)
            out += got
            if word == last:
                out.append(self.again)
            last = word
        lines = [x for x in text.split("\n") if x]
        out += [self.same_line] * (len(lines) - len(set(lines)))
        return out


def context_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """For each bucket the sum of the index vectors near its words, over all documents.

    Each task adds up a table of fixed size and sends its rows; tasks of the next stage each own
    some buckets and add what comes in, batch by batch. The result has ``BUCKETS`` rows always.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = _index()
        total = np.zeros(BUCKETS * DIM + DIM, np.int64)
        tokens = Tokens()

        def flush(flat: list[int]) -> None:
            w = np.array(flat, np.int64)
            for reach in range(1, REACH + 1):
                for a, b in ((w[:-reach], w[reach:]), (w[reach:], w[:-reach])):
                    base = a * DIM
                    for k in range(NONZERO):
                        got = np.bincount(base + place[b, k], sign[b, k], len(total))
                        np.add(total, got.astype(np.int64), out=total)

        flat: list[int] = []
        gap = [BUCKETS] * REACH
        for whole in batches:
            for batch in slices(whole):
                for text in batch.column(0).to_pylist():
                    flat += tokens(text)
                    flat += gap
                    if len(flat) > CHUNK:
                        flush(flat)
                        flat = []
        if flat:
            flush(flat)
        table = total[: BUCKETS * DIM].reshape(BUCKETS, DIM)
        some = np.flatnonzero(table.any(1))
        for at in range(0, len(some), 4096):
            part = some[at : at + 4096]
            yield pa.record_batch([pa.array(part), pa.array([r.tobytes() for r in table[part].astype("<i4" if abs(table).max() < 1 << 31 else "<i8")])], ["bucket", "sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = np.frombuffer(raw, "<i4" if len(raw) == 4 * DIM else "<i8")
                total[bucket] = total[bucket] + row if bucket in total else row.astype(np.int64)
        if total:
            yield pa.record_batch([pa.array(list(total)), pa.array([r.tobytes() for r in total.values()])], ["bucket", "sums"])

    texts = docs.select(F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = texts.mapInArrow(add, "bucket long, sums binary").repartition("bucket").mapInArrow(merge, "bucket long, sums binary")
    out = np.zeros((BUCKETS, DIM), np.int64)
    for bucket, raw in parts.collect():  # at most BUCKETS rows
        out[bucket] += np.frombuffer(bytes(raw), "<i8")
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Own index vector and normed context, with a zero row for texts without words."""
    place, sign = _index()
    own = np.zeros((BUCKETS, DIM))
    for k in range(NONZERO):
        np.add.at(own, (np.arange(BUCKETS), place[:-1, k]), sign[:-1, k])
    near = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1)
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1)
    return (own + near).astype(np.float32)


@dataclass
class Network:
    """Two layers: tanh units, then a logistic one whose logit is divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 600, rate: float = 0.01, ridge: float = 1e-4) -> Network:
    """Full-batch Adam on the weighted log loss; every fifth row only fits the temperature."""
    rng = np.random.default_rng(5)
    fit = np.arange(len(y)) % 5 != 0
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-6
    z, t, m = (x[fit] - mean) / scale, y[fit], weight[fit] / weight[fit].sum()
    p = [rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, rounds + 1):
        h = np.tanh(z @ p[0] + p[1])
        error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -50, 50))) - t) * m
        back = np.outer(error, p[2]) * (1 - h * h)
        grads = [z.T @ back + ridge * p[0], back.sum(0), h.T @ error + ridge * p[2], np.array([error.sum()])]
        for a, g, u, v in zip(p, grads, first, second, strict=True):
            u += 0.1 * (g - u)
            v += 0.001 * (g * g - v)
            a -= rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    if (~fit).any():
        raw, rest, w = net.logits(x[~fit]), y[~fit], weight[~fit]
        heats = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        losses = [(w * np.logaddexp(0, np.where(rest == 1, -raw, raw) / k)).sum() for k in heats]
        net.temperature = float(heats[int(np.argmin(losses))])
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None
    base: float

    def pool(self, tokens: Tokens, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), DIM))
        for k, t in enumerate(texts):
            ids = tokens(t)
            if ids:
                out[k] = self.vectors[ids].mean(0, dtype=np.float64)
        return out

    def score(self, tokens: Tokens, texts: list[str]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.base)
        return self.network(self.pool(tokens, texts))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = SAMPLE) -> Model:
    """Word vectors from all documents, the network from labelled rows outside the held-out
    third. With one label only, its share is every text's score; without labels one half."""
    vectors = word_vectors(context_sums(docs, text_col))
    known = (
        labels.select(col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    by = [F.xxhash64("id"), F.col("id")]
    chosen = known.where("label = 0").orderBy(*by).limit(most).unionByName(known.where("label = 1").orderBy(*by).limit(most))
    unfitted = Model(vectors, None, shares.get(1, 0) / sum(shares.values()) if shares else 0.5)
    sent = docs.sparkSession.sparkContext.broadcast(unfitted)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for whole in batches:
            for batch in slices(whole):
                x = sent.value.pool(tokens, batch.column(1).to_pylist())
                yield pa.record_batch([batch.column(0), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "label", "x"])

    joined = keyed_text(docs, id_col, text_col).join(F.broadcast(chosen), "id").select("id", "text", "label")  # at most 2 * most rows
    pooled = joined.mapInArrow(pool, "id long, label int, x binary").groupBy("id").agg(F.min(F.struct("label", "x")).alias("r"))
    rows = pooled.select("id", "r.*").orderBy(*by).collect()
    y = np.array([r[1] for r in rows], float)
    if not (y == 1).any() or not (y == 0).any():
        return unfitted
    x = np.stack([np.frombuffer(bytes(r[2]), float) for r in rows])
    # Rows weigh as in the labelled population: the sample holds equal numbers at most.
    weight = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    return Model(vectors, train(x, y, weight), unfitted.base)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(<id_col>, held_out, score, predicted): one row per document.

    Null and empty texts have a vector of zeros and are scored like any other; rows without id
    are not held out; repeated rows get equal scores; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens()
        for texts in parts:
            yield pd.Series(sent.value.score(tokens, texts.tolist()))

    own = keyed_text(docs, id_col, text_col).select("id", F.round(score("text"), 6).alias("score"))
    return own.select(
        F.col("id").alias(id_col),
        F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
