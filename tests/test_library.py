"""Wide table, features, profiles and statistics on small hand-made tables."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cratebook.operators import features, grouping, library, profiles, statistics


@pytest.fixture(scope="module")
def tables(spark):
    playlists = spark.createDataFrame(
        [
            ("p1", "AJFindsJan25", 4, True, False), ("p2", "Rock", 2, True, False), ("p3", "Rock", 0, True, False),
            ("p4", "Theirs", 1, False, False), ("like", "Liked Songs", 1, True, True), ("p5", "2024-01", 1, True, False),
        ],
        "playlist_id string, name string, track_count bigint, is_owned boolean, is_liked_songs boolean",
    )
    members = spark.createDataFrame(
        [
            ("p1", "t1", "2024-01-01 00:00:00", 0), ("p1", "t2", "2024-01-03 00:00:00", 1), ("p1", "t1", None, 2),
            ("p1", "t3", "oops", 3), ("p2", "t2", "2023-06-01 00:00:00", 0), ("p2", "gone", "2023-06-02 00:00:00", 1),
            ("p4", "t4", "2020-01-01 00:00:00", 0), ("like", "t1", "2024-02-02 00:00:00", 0), ("p5", "t3", "2024-01-01 00:00:00", 0),
        ],
        "playlist_id string, track_id string, added_at string, position bigint",
    )
    tracks = spark.createDataFrame(
        [
            ("t1", "One", 100_000, 20, "1999", ["rock"], "u1"), ("t2", "Two", 200_000, 21, "2001-05", ["pop", "rock"], "u2"),
            ("t3", "Three", 300_000, None, "bad", None, "u3"), ("t4", "Four", 400_000, 100, None, [], "u4"),
        ],
        "track_id string, name string, duration_ms bigint, popularity int, release_date string, genres array<string>, uri string",
    )
    credits = spark.createDataFrame(
        [("t1", "a1", 0), ("t1", "a2", 1), ("t2", "a2", 0), ("t3", "a3", 1), ("t4", "a9", 0)],
        "track_id string, artist_id string, position int",
    )
    artists = spark.createDataFrame(
        [("a1", "Ann", ["jazz", "rock"], 50, 10), ("a2", "Bob", ["rock", "folk"], 60, 20), ("a3", "Cyd", [], 70, 30)],
        "artist_id string, name string, genres array<string>, popularity int, followers bigint",
    )
    return playlists, members, tracks, credits, artists


def test_wide_keeps_unowned_memberships(tables, rows):
    wide = library.library_wide(*tables)
    assert wide.count() == 9
    assert rows(wide.where("playlist_id = 'p4'"), "name", "name_track", "uri_track", "primary_artist_id", "primary_artist") == [
        (None, "Four", "u4", "a9", None)
    ]
    # A credited artist only at position 1 is no primary artist.
    assert rows(wide.where("playlist_id = 'p5'"), "primary_artist_id") == [(None,)]
    fallback = library.primary_artist(tables[3], tables[4], fallback=True)
    assert rows(fallback.where("track_id = 't3'"), "primary_artist") == [("Cyd",)]


def test_scope(tables, rows):
    scope = library.library_scope(*tables, exclude_liked=True, exclude_monthly=True)
    assert rows(scope.playlists, "playlist_id") == [("p1",), ("p2",), ("p3",)]
    assert rows(scope.tracks, "track_id") == [("t1",), ("t2",), ("t3",)]
    assert rows(scope.artists, "artist_id") == [("a1",), ("a2",), ("a3",)]
    only = library.library_scope(*tables, include_only=["Rock"], exclude_names=["x"])
    assert rows(only.playlists, "playlist_id") == [("p2",), ("p3",)]


def test_find_by_name(tables, rows):
    playlists = tables[0]
    assert rows(library.find_by_name(playlists, "Theirs"), "playlist_id") == [("p4",)]
    for name in ("Rock", "absent"):
        with pytest.raises(PySparkException, match="collections are named"):
            library.find_by_name(playlists, name).collect()


def test_item_genres_keep_the_first_seen_order(tables):
    got = {r["track_id"]: r["genres"] for r in library.item_genres(tables[3], tables[4]).collect()}
    assert got["t1"] == ["jazz", "rock", "folk"] and got["t2"] == ["rock", "folk"] and "t3" not in got


def test_features(tables):
    wide = library.library_wide(*tables)
    got = {r["playlist_id"]: r.asDict() for r in features.all_features(wide, "2024-01-11 00:00:00").collect()}
    p1 = got["p1"]
    assert p1["popularity_mean"] == pytest.approx(61 / 3) and p1["popularity_median"] == 20
    assert p1["duration_ms_median"] == 150_000 and p1["duration_ms_min"] == 100_000
    assert (p1["added_age_days_min"], p1["added_age_days_max"], p1["added_age_days_median"]) == (8.0, 10.0, 9.0)
    assert p1["release_year_median"] == 1999 and p1["release_year_max"] == 2001
    assert p1["pct_underground"] == 0.5 and p1["pct_niche"] == 0.25 and p1["pct_unknown"] == 0.25 and p1["pct_mainstream"] == 0
    # Two artists with one distinct track each; the track without primary artist is left out.
    assert p1["artist_hhi"] == 0.5 and p1["artist_entropy"] == pytest.approx(math.log(2))
    assert got["p5"]["popularity_std"] is None and got["p5"]["artist_hhi"] is None
    assert sum(p1[f"pct_{t}"] for t in ("underground", "niche", "moderate", "popular", "mainstream", "unknown")) == 1


def test_features_without_columns(tables, rows):
    bare = tables[1].select("playlist_id", "track_id")
    assert rows(features.profile_features(bare)) == [("like",), ("p1",), ("p2",), ("p4",), ("p5",)]


def test_concentration_matches_the_definition(spark):
    data = [("p", f"a{i}", f"t{i}-{j}") for i in range(9) for j in range(1 + i % 4)]
    df = spark.createDataFrame(data * 2, "playlist_id string, primary_artist_id string, track_id string")
    n = [1 + i % 4 for i in range(9)]
    shares = [x / sum(n) for x in n]
    got = features.artist_concentration(df).first()
    assert got["artist_hhi"] == pytest.approx(sum(p * p for p in shares))
    assert got["artist_entropy"] == pytest.approx(-sum(p * math.log(p + 1e-12) for p in shares))


def test_genre_profiles_and_neighbours(tables, rows):
    playlists, members, _, credits, artists = tables
    found = profiles.genre_profiles(members, credits, artists)
    assert rows(found.where("playlist_id = 'p1'"), "genre", "n") == [("folk", 1), ("jazz", 2), ("rock", 3)]
    near = profiles.similar_by_genre(found, playlists, "p1", top_n=10).collect()
    assert [r["playlist_id"] for r in near][:2] == ["p2", "like"] or [r["playlist_id"] for r in near][:2] == ["like", "p2"]
    assert {r["playlist_id"]: round(r["similarity"], 6) for r in near}["p3"] == 0.0
    assert len(near) == 5 and "p1" not in {r["playlist_id"] for r in near}
    followed = profiles.similar_by_genre(found, playlists, "p1", only_followed=True)
    assert rows(followed, "playlist_id") == [("p4",)]


def test_collection_statistics(tables):
    playlists, members, tracks, credits, artists = tables
    primary = library.primary_artist(credits, artists)
    got = {r["playlist_id"]: r for r in statistics.collection_stats(playlists, members, tracks, primary).collect()}
    p1, empty = got["p1"], got["p3"]
    assert (p1["total_tracks"], p1["total_duration_ms"], p1["avg_popularity"]) == (4, 700_000, 20.3)
    assert p1["top_artists"] == ["Ann", "Bob"] and p1["top_genres"] == ["rock", "pop"]
    assert (p1["first_year"], p1["last_year"]) == (1999, 2001)
    assert (empty["total_tracks"], empty["total_duration_hours"], empty["top_artists"], empty["first_year"]) == (0, 0.0, [], None)


def test_health(tables):
    playlists, members, tracks, _, _ = tables
    check = {r["playlist_id"]: r for r in statistics.health_check(playlists, members, tracks).collect()}
    assert check["p1"]["warnings"] == ["1 duplicate track(s)", "1 tracks missing popularity data"]
    assert check["p3"]["issues"] == ["empty"] and not check["p3"]["healthy"]
    assert check["p2"]["warnings"] == ["1 tracks missing popularity data", "1 tracks missing duration data"]
    score = {r["playlist_id"]: r["score"] for r in statistics.health_score(playlists, members, tracks).collect()}
    assert score["p1"] == 100 - 20 - 2 - 5 and score["p4"] == 80 and score["p3"] == 0


def test_stale_and_organisation(tables, rows):
    playlists, members, *_ = tables
    good = members.where("added_at <> 'oops' or added_at is null")
    stale = statistics.stale_collections(playlists, good, "2024-06-01 00:00:00")
    # The latest time of p2 lies 365 days back to the day: not yet stale.
    assert rows(stale, "playlist_id", "days_since_update") == [("p4", 1613)]
    report = statistics.organization_report(playlists, good, "2024-06-01 00:00:00").first()
    assert (report["total_playlists"], report["empty_playlists"], report["empty_names"]) == (6, 1, "Rock")
    assert (report["total_duplicates"], report["n_genre"], report["n_automated"]) == (1, 2, 1)
    assert rows(library.name_collisions(playlists)) == [("Rock", 2, "p3")]
    assert rows(library.completeness(members, playlists), "n_rows", "expected_rows", "complete") == [(9, 8, True)]


def test_histogram_edges(spark, rows):
    tracks = spark.createDataFrame(
        [(0, "1960"), (100, "2028"), (100, "2029"), (50, "2030"), (None, "1959"), (99, None)], "popularity int, release_date string"
    )
    bins = {r["bin"]: r["n"] for r in statistics.popularity_histogram(tracks).collect()}
    assert len(bins) == 20 and (bins[0], bins[10], bins[19]) == (1, 1, 3)
    years = {r["year"]: r["n"] for r in statistics.release_year_histogram(tracks).collect()}
    assert len(years) == 69 and (years[1960], years[2028], sum(years.values())) == (1, 2, 3)


def test_columns_are_found_under_other_names(spark):
    df = spark.createDataFrame([("u", "x", "t")], "spotify_track_uri string, track_added_at string, played_at string")
    assert library.canonical_columns(df).columns == ["track_uri", "added_at", "timestamp"]
    both = spark.createDataFrame([("a", "b")], "track_uri string, spotify_track_uri string")
    assert library.canonical_columns(both).columns == both.columns


def test_mood_tags(spark):
    counts = spark.createDataFrame([("p", m, n) for m, n in [("A", 3), ("B", 3), ("C", 1), ("D", 9)]], "playlist_id string, mood string, n bigint")
    assert profiles.mood_tag_lists(counts, max_tags=2).first()["moods"] == ["D", "A"]
    assert profiles.mood_tag_lists(counts, min_count=2).first()["moods"] == ["D", "A", "B"]


def test_library_status(spark, tables, rows):
    named = {"playlists": tables[0], "tracks": tables[2]}
    assert rows(statistics.library_status(named)) == [("last_sync", "Never"), ("playlists_count", "6"), ("tracks_count", "4"), ("user_id", "Unknown")]
    meta = spark.createDataFrame([("last_sync_utc", "2024-01-01"), ("me_id", "me"), ("other", "x")], "key string, value string")
    assert rows(statistics.library_status(named, meta))[0] == ("last_sync", "2024-01-01")


def flat(df):
    return sorted(df.collect(), key=str)


def test_large_and_small_collections_have_the_same_statistics(spark, monkeypatch):
    """Rows of a small collection meet once; a larger one is summed per label first."""
    rows = [(k, t, t * 7 % 11 if t % 4 else None, t * 1000, f"{1990 + t % 9}", f"a{t % 3}") for k in (1, 2, 3) for t in range(k * 3)]
    wide = spark.createDataFrame(rows, "playlist_id long, track_id long, popularity int, duration_ms long, release_date string, artist string")
    tracks = wide.select("track_id", "duration_ms", "popularity", "release_date").distinct()
    tracks = tracks.withColumn("genres", F.array(F.lit("x"), (F.col("track_id") % 4).cast("string")))
    primary = wide.select("track_id", F.col("artist").alias("primary_artist")).distinct()
    playlists = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "playlist_id long, name string")

    def stats():
        return statistics.collection_stats(playlists, wide.select("playlist_id", "track_id"), tracks, primary)

    few = flat(stats())
    monkeypatch.setattr(grouping, "WHOLE", 5)
    assert few == flat(stats())
    assert few[3]["total_tracks"] == 9 and few[3]["top_genres"][0] == "x" and few[4]["top_artists"] == []
