"""Features of small collections, found where their rows meet, and of large ones, counted value by value."""

from __future__ import annotations

import math
import random
import statistics
from collections import Counter

import pytest

from cratebook.functions import music
from cratebook.operators import features, grouping

AS_OF = "2024-01-11 00:00:00"
COLUMNS = "playlist_id string, track_id string, popularity int, duration_ms bigint, added_at string, release_date string, primary_artist_id string"


@pytest.fixture(scope="module")
def data():
    """Collections of 1 to 400 rows with nulls, ties and repeated rows, one without any value, and rows of none."""
    draw = random.Random(3)

    def row(k, n):
        track = draw.randrange(n)
        gone = draw.random()
        return (
            k,
            None if gone < 0.1 else f"t{track}",
            None if track % 5 == 0 else track * 37 % 101,
            None if gone > 0.95 else track * 1000 + 7,
            None if gone > 0.9 else f"2024-01-{1 + track % 9:02d} 06:00:00",
            draw.choice([None, "1999", "2001-05", "2010-10-10", "soon"]),
            None if track % 7 == 3 else f"a{track % 11}",
        )

    rows = [row(f"p{n}", n) for n in (1, 2, 3, 10, 400) for _ in range(n)]
    return rows * 2 + [("empty", *[None] * 6), (None, "t1", 1, 1, None, None, "a1")]


@pytest.fixture
def wide(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def brute(rows):
    """The figures of one collection."""
    found = {}
    tier = [music.TIER_NAMES[5 if p is None else sum(p > bound for _, bound in music.POPULARITY_TIERS)] for _, t, p, *_ in rows if t is not None]
    for t in music.TIER_NAMES:
        found[f"pct_{t}"] = tier.count(t) / len(tier) if tier else None
    year = [int(r[5][:4]) for r in rows if r[5] not in (None, "soon")]
    age = [10 - int(r[4][8:10]) + 0.75 for r in rows if r[4] is not None]
    metrics = {"popularity": [r[2] for r in rows], "duration_ms": [r[3] for r in rows], "release_year": year, "added_age_days": age}
    for name, values in metrics.items():
        v = [x for x in values if x is not None]
        found[f"{name}_mean"] = statistics.fmean(v) if v else None
        found[f"{name}_median"] = statistics.median(v) if v else None
        found[f"{name}_min"], found[f"{name}_max"] = (min(v), max(v)) if v else (None, None)
        if name != "added_age_days":
            found[f"{name}_std"] = statistics.stdev(v) if len(v) > 1 else None
    n = Counter(a for a, _ in {(r[6], r[1]) for r in rows if r[6] is not None and r[1] is not None})
    shares = [x / n.total() for x in n.values()]
    found["artist_hhi"] = sum(s * s for s in shares) if n else None
    found["artist_entropy"] = -sum(s * math.log(s + 1e-12) for s in shares) if n else None
    return found


@pytest.mark.parametrize("limit", [1_000_000, 320, 16], ids=["small", "both", "large"])
def test_features_of_every_size(data, wide, monkeypatch, limit):
    monkeypatch.setattr(grouping, "SORTED", limit)
    got = {r["playlist_id"]: r.asDict() for r in features.all_features(wide, AS_OF).collect()}
    assert sorted(got) == ["empty", "p1", "p10", "p2", "p3", "p400"]
    for k, figures in got.items():
        want = brute([r for r in data if r[0] == k])
        assert set(figures) == {"playlist_id", *want}
        for name, value in want.items():
            assert figures[name] == (value if value is None else pytest.approx(value, abs=1e-9)), (k, name)


def test_columns_do_not_depend_on_the_size(wide, monkeypatch):
    types = features.all_features(wide, AS_OF).dtypes
    assert dict(types)["popularity_min"] == "int" and dict(types)["duration_ms_max"] == "bigint"
    bare = wide.select("playlist_id", "track_id")
    assert sorted(r[0] for r in features.all_features(bare, AS_OF).collect()) == ["empty", "p1", "p10", "p2", "p3", "p400"]


def test_only_large_collections_are_counted_value_by_value(wide, monkeypatch):
    """Each row of a counted collection gives one row per metric to the exchange."""
    counted = []

    def spy(rows, *args):
        counted.append(rows)
        return grouping.value_counts(rows, *args)

    monkeypatch.setattr(features, "value_counts", spy)
    monkeypatch.setattr(grouping, "SORTED", 320)
    features.all_features(wide, AS_OF)
    assert [{r[0] for r in rows.select("playlist_id").collect()} for rows in counted] == [{"p400"}]


def test_split_unwritten(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(grouping, "SORTED", 160)
    spark.range(2000).selectExpr("if(id < 1000, 0, id) AS k", "id AS v", "cast(null AS int) AS gone").write.parquet(f"{tmp_path}/t.parquet")
    rows = spark.read.parquet(f"{tmp_path}/t.parquet")
    spark.sparkContext.setJobGroup("split", "planning")
    few, many = grouping.split_unwritten(rows, "k")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("split")
    spark.sparkContext.setJobGroup("split run", "running")
    both = few.selectExpr("*", "false AS large").unionByName(many.selectExpr("*", "true AS large"))
    assert sorted((r.k, r.v, r.large) for r in both.collect()) == sorted((0 if i < 1000 else i, i, i < 1000) for i in range(2000))
    plan = both._jdf.queryExecution().executedPlan()
    both.collect()
    assert plan.toString().split("== Initial Plan ==")[0].count("t.parquet") == 1
