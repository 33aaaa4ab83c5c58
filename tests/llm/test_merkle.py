"""The manifest against a plain tree, on awkward rows."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from cratebook.llm import merkle
from tests.llm import brute

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, position long, digest string, tree int, `a.b` int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[k : k + 3])) for k in range(0, len(last), 3)])
    return levels


def plain(rows):
    """One result row per row, from the contract."""
    leaf = {k: digest("".join(map(field, r[:5]))) for k, r in enumerate(rows)}
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = [k for k, r in enumerate(rows) if r[1] == s]
        own.sort(key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf[k]))
        trees[s] = own, levels_of([leaf[k] for k in own])
    top = levels_of([trees[s][1][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        own, levels = trees[s]
        for at, k in enumerate(own):
            r = list(rows[k])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                r[4] = r[4].replace("\n", "")
            folded, proof = digest("".join(map(field, r[:5]))), ""
            for place, tree in ((at, levels), (i, top)):
                for level in tree[:-1]:
                    run = range(place - place % 3, min(place - place % 3 + 3, len(level)))
                    folded = digest("".join(folded if n == place else level[n] for n in run))
                    proof += "".join(level[n] for n in run if n != place)
                    place //= 3
            out.append((rows[k][0], leaf[k], levels[-1][0], top[-1][0], digest(proof), folded, folded == top[-1][0]))
    return out


def found(spark, rows):
    docs = spark.createDataFrame([(*r, 7, "x", 7, 7) for r in rows], SCHEMA)
    cut = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return [tuple(r) for r in merkle.manifest(docs, changed_text=text).collect()]


AWKWARD = [
    (None, None, None, None, None),
    (None, "", "", 0, ""),
    *[(k, "hot", "en", k, f"line {k}\nnext é") for k in range(800)],
    *[(5000, "copies", "de", 1, "same\n")] * 10,
    (7, None, "fr", 3, "a\nb" * 20000),
    (8, "ü", None, None, "\n"),
    (9, "z", "en", 1, None),
]


@pytest.mark.parametrize("rows", [AWKWARD, AWKWARD[2:3], AWKWARD[2:5], AWKWARD[2:6], []], ids=["awkward", "one", "three", "four", "none"])
def test_manifest(spark, rows):
    got, want = found(spark, rows), plain(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(rows) < 100 or {r[-1] for r in want} == {True, False}


def test_many_sources(spark):
    rows = [(k, f"s{k % 740}", "en", 1, f"{k}") for k in range(1500)]
    assert sorted(found(spark, rows)) == sorted(plain(rows))


def test_untampered_verifies(spark):
    docs = spark.createDataFrame([(*r, 7, "x", 7, 7) for r in AWKWARD[:20]], SCHEMA)
    assert all(r.verified for r in merkle.manifest(docs).collect())
    assert brute.sha("") == digest("")
