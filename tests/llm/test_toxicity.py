"""The ordinal model against numeric gradients and plain scoring."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest

from cratebook.llm import toxicity


def problem(seed, n=60, k=5):
    rng = np.random.default_rng(seed)
    x = np.log1p(rng.poisson(1.0, (n, k)))
    score = x @ rng.normal(size=k) + rng.logistic(size=n)
    return x, np.digitize(score, [0.0, 1.0, 2.0])


@pytest.mark.parametrize("seed", range(4))
def test_gradient_equals_differences(seed):
    x, grade = problem(seed)
    theta = np.random.default_rng(seed).normal(scale=0.5, size=x.shape[1] + toxicity.GRADES)
    _, gradient = toxicity._likelihood(theta, x, grade, 0.01)
    for k in range(len(theta)):
        step = np.zeros_like(theta)
        step[k] = 1e-6
        up, down = (toxicity._likelihood(theta + s, x, grade, 0.01)[0] for s in (step, -step))
        assert gradient[k] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_likelihood_is_that_of_the_grades():
    x, grade = problem(9, 20)
    theta = np.random.default_rng(1).normal(size=x.shape[1] + toxicity.GRADES)
    cuts = [-math.inf, *toxicity._cuts(theta, x.shape[1]), math.inf]
    total = 0.0
    for row, g in zip(x, grade, strict=True):
        score = float(row @ theta[: x.shape[1]])
        at_least = [1.0 if c == -math.inf else 0.0 if c == math.inf else 1 / (1 + math.exp(c - score)) for c in cuts]
        total -= math.log(at_least[g] - at_least[g + 1])
    assert toxicity._likelihood(theta, x, grade, 0.0)[0] == pytest.approx(total / len(x))


def test_no_other_parameters_are_likelier():
    x, grade = problem(3, 300, 3)
    weights, cuts = toxicity._ordinal(x, grade, rounds=3000, ridge=0.0)
    theta = np.r_[weights, cuts[0], np.log(np.diff(cuts))]
    best, gradient = toxicity._likelihood(theta, x, grade, 0.0)
    assert np.abs(gradient).max() < 1e-3 and (np.diff(cuts) > 0).all()
    rng = np.random.default_rng(0)
    assert all(toxicity._likelihood(theta + rng.normal(scale=0.05, size=len(theta)), x, grade, 0.0)[0] > best - 1e-6 for _ in range(200))


def plain_score(model, text):
    """Expected grade of a text, word by word."""
    words = [w.lower() for w in re.findall(r"[^\W\d_]+", text or "")]
    x = [0] * len(model.weights)
    for w in words:
        for name in [w, *[f"{w[:n]}*" for n in toxicity.BEGINNINGS if len(w) >= n]]:
            place = model.place.get(zlib.crc32(name.encode()))
            if place is not None:
                x[place] += 1
    if x:
        x[-1] = len(words)
    score = sum(math.log1p(v) * w for v, w in zip(x, model.weights, strict=True))
    return [1 / (1 + math.exp(min(60, max(-60, c - score)))) for c in model.cuts]


def test_scores_equal_plain_scoring(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.severity(docs, model).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        p = plain_score(model, text)
        assert got[doc_id]["severity"] == pytest.approx(sum(p), abs=2e-6)
        assert got[doc_id]["p_toxic"] == pytest.approx(p[0], abs=2e-6)
        assert got[doc_id]["grade"] == sum(v >= 0.5 for v in p) and got[doc_id]["toxic"] == (p[0] >= 0.5)


def test_held_out_toxic_rows_are_found(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    known = docs.join(labels.select("doc_id", "toxic"), "doc_id").where(toxicity.held_out(docs["doc_id"])).select("doc_id", "text", "toxic")
    rows = toxicity.severity(known, model).withColumnRenamed("toxic", "said").join(known, "doc_id").select("said", "toxic").collect()
    caught = [r["said"] for r in rows if r["toxic"]]
    wrong = [r["said"] for r in rows if not r["toxic"]]
    assert len(caught) > 30 and sum(caught) / len(caught) > 0.9 and sum(wrong) / len(wrong) < 0.02
