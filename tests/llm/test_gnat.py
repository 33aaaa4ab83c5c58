"""Hard negatives against comparing everything, on awkward rows."""

from __future__ import annotations

from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from cratebook.llm import gnat

SCHEMA = "vec_id long, embedding array<double>, label int, uid long, leaf int, windows int, `a.b` int"


def plain(rows, every=100):
    parts = []
    for uid, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and isfinite(x) for x in v):
            parts.append((uid, i, label, [floor(Fraction(x) * 256) for x in v]))
    out = []
    for a in parts:
        if a[1] is None or a[1] % every:
            continue
        score = {b[0]: sum(x * y for x, y in zip(a[3], b[3])) for b in parts}
        order = sorted((b for b in parts if b[0] != a[0]), key=lambda b: (-score[b[0]], b[1] is None, b[1] or 0))
        for p in [b for b in order if b[2] == a[2]][:5]:
            ps = score[p[0]]
            near = [b for b in order if b[2] != a[2] and 80 * ps <= 100 * score[b[0]] <= 100 * ps][:5]
            out += [(a[1], p[1], k + 1, n[1], ps, score[n[0]]) for k, n in enumerate(near)]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    vectors = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in gnat.hard_negatives(vectors, **options).collect()), key=repr)


def clustered(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((6, dim))
    v = centers[rng.integers(0, 6, n)] + 0.4 * rng.standard_normal((n, dim))
    return [(k, x.tolist(), int(rng.integers(0, 4))) for k, x in enumerate(v)]


def test_clusters(spark):
    rows = clustered(3000, 8)
    want = plain(rows)
    assert len(want) > 500
    assert found(spark, rows) == want


def test_awkward_rows(spark):
    rows = [
        *clustered(300, 4, 1),
        (300, None, 1), (400, [1.0, None, 0.0, 0.0], 1), (500, [1.0, float("nan"), 0.0, 0.0], 1), (600, [float("inf")] * 4, 1),
        (700, [1.0, 0.0, 0.0, 0.0], None), (800, [0.0] * 4, 2), (900, [], 2), (1000, [1.0, 1.0], 3),
        (None, [1.0, 1.0, 1.0, 1.0], 3), (200, [1.0, 1.0, 1.0, 1.0], 3), (1100, [-1e-3, 0.5, 2.0**20, 0.1], 0),
        *[(2000 + k, [1.0, 1.0, 1.0, 1.0], k % 2) for k in range(40)],
    ]
    assert found(spark, rows) == plain(rows)


def test_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(gnat, "BLOCK", 50)
    monkeypatch.setattr(gnat, "CHUNK", 3)
    rows = [(k, [1.0, 2.0, 3.0], k % 3) for k in range(400)] + [(400 + k, v, label) for k, v, label in clustered(400, 3, 2)]
    assert found(spark, rows, every=10) == plain(rows, 10)


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 1)], [(100, [], 1), (200, [], 1), (3, [], 2)]], ids=["none", "one", "no components"])
def test_small_tables(spark, rows):
    assert found(spark, rows) == plain(rows)


def test_subtrees_are_eliminated():
    rows = np.array([v for _, v, _ in clustered(20000, 8, 3)])
    q = np.floor(rows * 256)
    tree = gnat.Tree(q[:4096], len(q))
    leaf = tree.leaf_of(q)
    tree.known(list(tree.measure(q, leaf)))
    a = q[:200]
    best = (a @ q.T).max(1)[:, None]
    row, to = tree.reached(a, 0.99 * best, best)
    filled = (tree.size > 0).sum()
    assert len(row) < 0.5 * filled * len(a)
    score = a @ q.T
    for k in range(len(a)):
        inside = (score[k] >= 0.99 * best[k]) & (score[k] <= best[k])
        assert set(leaf[inside]) <= set(to[row == k])
