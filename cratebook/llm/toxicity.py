"""Toxicity as ordinal regression with a cumulative link.

P(grade >= k) = logistic(w . x - cut_k) for k = 1, 2, 3: one weight vector for all grades and
ascending cuts. x are log counts of words and word beginnings that the labelled rows set apart.
The expected severity is the sum of the three probabilities; a text is rejected when grade 1
or more is likelier than not.

Labels say toxic or not. Toxic rows are graded by how many telling words they hold: the lowest,
middle and highest third of the labelled toxic rows. The model is fitted on a sample of at most
``SAMPLE`` rows per label (a stated bound), chosen by the hash of their ids; it scores every
whole text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import MEMO_WORDS, col, keyed_text, slices

#: Most labelled rows taken for each label.
SAMPLE = 3000
#: Most features kept.
FEATURES = 1024
GRADES = 3
#: The feature number under which a sampled row carries its number of words, behind the others.
WORDS = 0
#: A feature's likelihood ratio must exceed so many times the logarithm of the features tried.
BAR = 1.3
BEGINNINGS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: a third, by the id's checksum."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def features_of(word: str) -> list[int]:
    """Numbers of a word and of its beginnings."""
    names = [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n]]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) for n in names]


@dataclass
class Model:
    place: dict[int, int] = field(default_factory=dict)
    # of the features, and last of the number of words, against chance hits in long texts
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cuts: np.ndarray = field(default_factory=lambda: np.full(GRADES, np.inf))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= 1), ..., P(grade >= 3) of every row."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - (x @ self.weights)[:, None], -60, 60)))


class Scorer:
    """Feature rows of texts; remembers words, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def row(self, text: str) -> np.ndarray:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        x, memo, place = np.zeros(len(self.model.weights)), self.memo, self.model.place
        words = 0
        for word in map(str.lower, (m.group() for m in _WORD.finditer(text))):
            hit = memo.get(word, 0)
            if hit == 0:
                hit = memo[word] = [place[f] for f in features_of(word) if f in place] or None
            words += 1
            if hit:
                x[hit] += 1
        x[-1:] = words
        return np.log1p(x)

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), GRADES))
        for k, t in enumerate(texts):
            out[k] = self.model.probabilities(self.row(t)[None, :])[0]
        return out


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """(label, ids, counts): features of at most ``most`` learnable rows per label."""
    known = (
        labels.select(col(id_col).cast("long").alias("id"), col(label_col).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    by = [F.xxhash64("id"), F.col("id")]
    chosen = known.where("label = 0").orderBy(*by).limit(most).unionByName(known.where("label = 1").orderBy(*by).limit(most))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for i, t, y in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                    words = Counter(m.group().lower() for m in _WORD.finditer(t))
                    seen: Counter[int] = Counter()
                    for w, n in words.items():
                        for f in features_of(w):
                            seen[f] += n
                    seen[WORDS] = sum(words.values())
                    rows.append((i, y, np.fromiter(seen.keys(), "<u4", len(seen)).tobytes(), np.fromiter(seen.values(), "<u4", len(seen)).tobytes()))
                yield pa.record_batch(
                    [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                    ["id", "label", "ids", "counts"],
                )

    joined = keyed_text(docs, id_col, text_col).join(F.broadcast(chosen), "id").select("id", "text", "label")  # at most 2 * most rows
    # Rows that share an id count once.
    rows = joined.mapInArrow(count, "id long, label int, ids binary, counts binary")
    return rows.groupBy("id").agg(F.min(F.struct("label", "ids", "counts")).alias("r")).select("r.*").orderBy("label", "ids", "counts")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = SAMPLE) -> Model:
    """Learn from labelled rows outside the held-out third. Without toxic rows nothing is toxic."""
    # Row by row, so that the driver holds the sample's feature numbers once and nothing beside.
    y_, ids, counts, length_ = [], [], [], []
    for label, raw_ids, raw_counts in _sample(docs, labels, id_col, text_col, label_col, most).toLocalIterator():
        y_.append(label)
        ids.append(np.frombuffer(bytes(raw_ids), "<u4")[:-1])
        counts.append(np.frombuffer(bytes(raw_counts), "<u4")[:-1])
        length_.append(int(np.frombuffer(bytes(raw_counts), "<u4")[-1]))
    y, length = np.array(y_, int), np.array(length_, int)
    if not (y == 1).any() or not (y == 0).any():
        return Model()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    every, bad = np.unique(np.concatenate([i for i, t in zip(ids, y, strict=True) if t]), return_counts=True)
    all_features, good_all = np.unique(np.concatenate([i for i, t in zip(ids, y, strict=True) if not t]), return_counts=True)
    at = np.minimum(np.searchsorted(all_features, every), max(0, len(all_features) - 1))
    good = np.where(all_features[at] == every, good_all[at], 0) if len(all_features) else np.zeros(len(every), int)
    tried = max(2, int((bad + good >= 3).sum()) + int((good_all >= 3).sum()) - int(((good >= 3)).sum()))
    del all_features, good_all
    # Signed likelihood ratio of a feature's documents being toxic more often than chance says;
    # the bar rises with the number of features that are tried.
    share, both = n1 / (n1 + n0), bad + good
    ratio = 2 * (bad * np.log(bad / (both * share)) + good * np.log(np.maximum(good, 1e-9) / (both * (1 - share))))
    ratio[bad <= both * share] = 0
    order = np.lexsort((every, -ratio))
    keep = every[np.sort(order[: min(FEATURES, int((ratio > BAR * np.log(tried)).sum()))])]
    x = np.zeros((len(y), len(keep)))
    for k, (own, n) in enumerate(zip(ids, counts, strict=True)):
        if len(keep):
            place = np.minimum(np.searchsorted(keep, own), len(keep) - 1)
            hit = keep[place] == own
            x[k, place[hit]] = n[hit]
    grade = np.zeros(len(y), int)
    held = x.sum(1)
    edges = np.quantile(held[y == 1], [1 / 3, 2 / 3])
    grade[y == 1] = 1 + (held[y == 1][:, None] > edges[None, :]).sum(1)
    model = Model({int(f): k for k, f in enumerate(keep)})
    model.weights, model.cuts = _ordinal(np.log1p(np.c_[x, length]), grade)
    return model


def _cuts(theta: np.ndarray, k: int) -> np.ndarray:
    """Ascending by construction: a first cut, and exponentials of gaps."""
    return np.r_[theta[k], theta[k] + np.cumsum(np.exp(theta[k + 1 :]))]


def _likelihood(theta: np.ndarray, x: np.ndarray, grade: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood of the grades with a ridge on the weights, and its gradient.

    ``theta``: weights, first cut, logs of the gaps between cuts. P(grade = k) is a difference
    of neighbouring cumulative probabilities.
    """
    n, k = x.shape
    w, gaps, rows = theta[:k], np.exp(theta[k + 1 :]), np.arange(n)
    z = np.clip((x @ w)[:, None] - _cuts(theta, k)[None, :], -60, 60)
    above = np.c_[np.ones(n), 1 / (1 + np.exp(-z)), np.zeros(n)]
    p = np.maximum(above[rows, grade] - above[rows, grade + 1], 1e-12)
    slope = above * (1 - above)
    up, down = slope[rows, grade] / p, slope[rows, grade + 1] / p
    # d log p / d score, and / d cut_j for the cut below and above the grade.
    d_cut = np.zeros((n, GRADES + 2))
    np.add.at(d_cut, (rows, grade), -up)
    np.add.at(d_cut, (rows, grade + 1), down)
    of_cut = d_cut[:, 1 : GRADES + 1].mean(0)
    gradient = np.r_[
        -(x.T @ (up - down)) / n + ridge * w,
        -of_cut.sum(),
        [-of_cut[j + 1 :].sum() * gaps[j] for j in range(GRADES - 1)],
    ]
    return float(-np.log(p).mean() + ridge * (w @ w) / 2), gradient


def _ordinal(x: np.ndarray, grade: np.ndarray, rounds: int = 600, rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending cuts by gradient descent (Adam) on the likelihood of the grades."""
    k = x.shape[1]
    theta = np.r_[np.zeros(k), 1.0, np.zeros(GRADES - 1)]
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        _, gradient = _likelihood(theta, x, grade, ridge)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:k], _cuts(theta, k)


def _chances(model: Model) -> Column:
    @F.pandas_udf("array<double>")
    def chances(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in parts:
            yield pd.Series(list(scorer(texts.tolist())), dtype=object)

    return chances


def severity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(<id_col>, severity, p_toxic, grade, toxic): one row per document.

    ``severity`` is the expected grade, ``grade`` the number of cuts that are likelier passed
    than not. Null and empty texts have no features and get the base rate. Repeated rows get
    equal results; other columns are ignored.
    """
    own = keyed_text(docs, id_col, text_col)
    p = own.select("id", _chances(model)(F.col("text")).alias("p"))
    return p.select(
        F.col("id").alias(id_col),
        F.round(F.aggregate("p", F.lit(0.0), lambda a, b: a + b), 6).alias("severity"),
        F.round(F.col("p")[0], 6).alias("p_toxic"),
        F.size(F.filter("p", lambda v: v >= 0.5)).alias("grade"),
        (F.col("p")[0] >= 0.5).alias("toxic"),
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text is not rejected; all columns."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    return docs.where(_chances(model)(text)[0] < 0.5)
