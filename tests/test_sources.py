"""Files in, tables out: pages, exports, sinks and streams."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from cratebook import schemas
from cratebook.sources import exports, pages, tables
from cratebook.streaming import jobs


def write(folder, name, value):
    """Files of several lines, as exports come."""
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(value, indent=1), encoding="utf-8")
    return str(folder)


def test_collection_pages(spark, tmp_path, rows):
    page = {
        "items": [
            {"id": "1", "name": "My Playlist", "description": "d", "public": True, "collaborative": False, "snapshot_id": "s",
             "tracks": {"total": 10}, "owner": {"id": "test_user", "display_name": "T"}, "uri": "u", "images": [{"url": "x"}]},
            {"id": "2", "name": "Other", "owner": None},
        ],
        "next": None,
    }
    read = pages.read_pages(spark, write(tmp_path / "c", "page.json", page), schemas.COLLECTION_PAGE, True)
    got = pages.flatten_collections(read, "test_user", 5)
    assert got.columns == [f.split()[0] for f in schemas.TABLES["playlists"].split(", ")]
    assert rows(got, "playlist_id", "name", "track_count", "is_owned", "is_liked_songs", "snapshot_id") == [
        ("1", "My Playlist", 10, True, False, "s"), ("2", "Other", None, False, False, None),
        ("__liked_songs__", pages.LIKED_NAME, 5, True, True, "liked_songs_5"),
    ]
    empty = pages.read_pages(spark, write(tmp_path / "e", "page.json", {"items": [], "next": None}), schemas.COLLECTION_PAGE, True)
    assert rows(pages.flatten_collections(empty, "test_user", 0), "playlist_id", "is_liked_songs") == [("__liked_songs__", True)]


def test_one_page_per_line(spark, tmp_path):
    lines = "\n".join(json.dumps({"items": [{"id": str(i)}]}) for i in range(3))
    (tmp_path / "pages.json").write_text(lines + "\nbroken", encoding="utf-8")
    read = pages.read_pages(spark, str(tmp_path), schemas.COLLECTION_PAGE)
    assert pages.flatten_collections(read, "me").count() == 3


def test_membership_pages_keep_position_gaps(spark, tmp_path, rows):
    one = {"playlist_id": "p", "offset": 0, "items": [
        {"added_at": "2024-01-01T00:00:00Z", "added_by": {"id": "me"}, "track": {"id": "a", "uri": "ua", "is_local": True}},
        {"added_at": "2024-01-02T00:00:00Z", "track": {"id": None}}, {"added_at": "bad", "track": None},
        {"added_at": "bad", "added_by": None, "track": {"id": "b"}}]}
    two = {"playlist_id": "p", "offset": 100, "items": [{"track": {"id": "c"}}]}
    write(tmp_path / "m", "1.json", one)
    read = pages.read_pages(spark, write(tmp_path / "m", "2.json", two), schemas.MEMBERSHIP_PAGE, True)
    assert rows(pages.flatten_membership(read), "track_id", "position", "is_local", "added_by") == [
        ("a", 0, True, "me"), ("b", 3, None, None), ("c", 100, None, None),
    ]
    liked = pages.flatten_liked(read, "owner")
    assert rows(liked, "playlist_id", "is_local", "added_by")[0] == ("__liked_songs__", False, "owner")


def test_item_responses(spark, tmp_path, rows):
    track = {"id": "t", "name": "T", "duration_ms": 1, "album": None, "external_ids": {"isrc": "i"}, "uri": "u",
             "artists": [{"id": None, "name": "x"}, {"id": "a2"}, {"id": "a3"}]}
    folder = write(tmp_path / "t", "1.json", {"tracks": [track, None, dict(track)]})
    read = pages.read_pages(spark, folder, schemas.ITEMS_RESPONSE, True)
    known = spark.createDataFrame([("t", ["rock"])], "track_id string, genres array<string>")
    assert rows(pages.flatten_items(read, known), "track_id", "isrc", "album_id", "genres") == [("t", "i", None, ["rock"])]
    assert rows(pages.flatten_items(read), "genres") == [(None,)]
    # The missing first id leaves no primary artist.
    assert rows(pages.flatten_item_creators(read)) == [("t", "a2", 1), ("t", "a3", 2)]
    folder = write(tmp_path / "a", "1.json", {"artists": [{"id": "a", "genres": None, "followers": {"total": 3}}, {"id": "a", "genres": None, "followers": {"total": 3}}]})
    creators = pages.flatten_creators(pages.read_pages(spark, folder, schemas.CREATORS_RESPONSE, True))
    assert rows(creators, "artist_id", "genres", "followers") == [("a", [], 3)]


def test_market_pages(spark, tmp_path, rows):
    album = {"id": "1", "name": "A", "artists": [{"name": "X"}, {"name": None}, {"name": "Z"}]}
    folder = write(tmp_path / "n", "1.json", {"albums": {"items": [album] * 60}})
    read = pages.read_pages(spark, folder, pages.MARKET_SCHEMAS["new_releases"], True)
    got = pages.new_releases(read)
    assert got.count() == 60 and got.first()["artist_names"] == "X, , Z"
    folder = write(tmp_path / "p", "1.json", {"playlists": {"items": [{"id": "1", "description": "d" * 600}, {"id": "2"}]}})
    found = pages.market_playlists(pages.read_pages(spark, folder, pages.MARKET_SCHEMAS["playlists"], True))
    assert rows(found, "playlist_id", F.length("description")) == [("1", 500), ("2", 0)]
    nothing = pages.read_pages(spark, write(tmp_path / "q", "1.json", {"albums": None}), pages.MARKET_SCHEMAS["new_releases"], True)
    assert pages.new_releases(nothing).count() == 0


@pytest.fixture
def export(tmp_path):
    account, extended, tech = tmp_path / "account", tmp_path / "extended", tmp_path / "tech"
    basic = [{"endTime": "2024-01-01 12:30", "artistName": "A", "trackName": "T", "msPlayed": ms} for ms in (29_999, 30_000)]
    write(account, "StreamingHistory_music_0.json", basic)
    write(account, "StreamingHistory_podcast_0.json", basic)
    plays = [
        {"ts": "2024-01-06T23:00:00Z", "ms_played": 30_000, "spotify_track_uri": "spotify:track:x", "skipped": s} for s in (None, True, False)
    ]
    write(extended, "Streaming_History_Audio_2024_1.json", [*plays, {"ts": "2024-01-06T23:00:00Z", "ms_played": 29_999}])
    write(account, "SearchQueries.json", [{"searchTime": "2025-10-04T22:39:02.044Z[UTC]", "searchQuery": "q"}, {"searchTime": "nope"}])
    write(account, "Follow.json", {"userIsFollowing": ["a", "b"], "userIsBlocking": ["c"]})
    write(account, "YourLibrary.json", {"tracks": [
        {"uri": "spotify:track:x", "name": "T", "artist": {"name": "A"}, "addedAt": "2024-01-01"}, {"uri": None, "album": {"name": "B"}, "addedAt": "?"}]})
    write(account, "Wrapped2023.json", {"y": 2023})
    write(account, "Wrapped2024.json", {"y": 2024})
    write(tech, "PlaybackError.json", [{"timestamp_utc": "2024-01-01T00:00:01Z", "fatal": True}, {"context_time": 5}])
    write(tech, "PlaybackRetry.json", [{"context_time": 1704067200000}])
    write(tech, "WebapiEvent.json", [])
    return str(account), str(extended), str(tech)


def test_export_loaders(spark, export, rows):
    account, extended, tech = export
    assert rows(exports.load_basic(spark, account), "ms_played", "hour", "day_of_week", "day_of_week_num", "month", "source") == [
        (30_000, 12, "Monday", 0, "2024-01", "basic")
    ]
    long = exports.load_extended(spark, extended)
    assert long.count() == 2 and rows(long, "day_of_week_num", "minutes_played") == [(5, 0.5)] * 2
    shown = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS")
    assert rows(exports.load_search(spark, account), shown, "hour") == [("2025-10-04 22:39:02.044", 22), (None, None)]
    assert rows(exports.load_follow(spark, account)) == [("a", "following"), ("b", "following"), ("c", "blocking")]
    assert rows(exports.load_library(spark, account), "track_id", "artist_name", "album_name", F.col("added_date").cast("string")) == [
        ("", "", "B", None), ("x", "A", "", "2024-01-01")
    ]
    assert rows(exports.load_wrapped(spark, account)) == [("Wrapped2024.json", '{\n "y": 2024\n}')]
    assert rows(exports.load_wrapped(spark, account, preferred="Wrapped2030.json"), "file") == [("Wrapped2023.json",)]
    # One text time in the log decides for the whole log.
    assert rows(exports.load_tech_log(spark, tech, "PlaybackError.json"), "month") == [("2024-01",), (None,)]
    assert rows(exports.load_tech_log(spark, tech, "PlaybackRetry.json"), "month") == [("2024-01",)]


def test_sync_skips_what_is_there(spark, export, tmp_path, rows):
    folder = str(tmp_path / "tables")
    first = tables.sync_exports(spark, *export, folder)
    assert {r["table"]: (r["status"], r["rows"]) for r in first.collect()} == {
        "streaming_history": ("written", 2), "search_queries": ("written", 2), "wrapped_data": ("written", 1),
        "follow_data": ("written", 3), "library_snapshot": ("written", 2), "playback_errors": ("written", 2),
        "playback_retries": ("written", 1), "webapi_events": ("written", 0),
    }
    assert {r["status"] for r in tables.sync_exports(spark, *export, folder).collect()} == {"present"}
    assert {r["status"] for r in tables.sync_exports(spark, *export, folder, force=True).collect()} == {"written"}
    assert tables.load_table(spark, folder, "streaming_history").count() == 2


def test_tables(spark, tmp_path, rows):
    folder = str(tmp_path)
    assert tables.load_table(spark, folder, "artists").schema.names == ["artist_id", "name", "genres", "popularity", "followers", "uri"]
    with pytest.raises(FileNotFoundError):
        tables.load_table(spark, folder, "unknown")
    df = spark.createDataFrame([("t", "a", 0)], schemas.TABLES["track_artists"])
    for fmt in tables.FORMATS:
        tables.save_table(df, folder, "track_artists", fmt)
        tables.save_table(df, folder, "track_artists", fmt)
        assert rows(tables.load_table(spark, folder, "track_artists", fmt)) == [("t", "a", 0)]
    assert tables.export_table(df, f"{folder}/deep/er/x").endswith("/x.parquet")
    assert spark.read.parquet(tables.export_table(df, f"{folder}/x.xlsx")).count() == 1
    assert tables.export_table(df, f"{folder}/x.csv").endswith(".csv")


def test_history_is_partitioned_by_month(spark, export, tmp_path):
    path = tables.write_history(tables.load_history(spark, *export[:2]), str(tmp_path / "h"))
    plan = spark.read.parquet(path).where("month = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


PLAY = "event_id bigint, timestamp timestamp, listener bigint, track_uri string, ms_played bigint, skipped boolean"


def land(spark, folder, data):
    df = spark.createDataFrame(data, PLAY.replace("timestamp timestamp", "timestamp string"))
    df.withColumn("timestamp", F.to_timestamp("timestamp")).coalesce(1).write.mode("append").parquet(folder)


def test_stream_ingest_equals_batch_and_restarts(spark, tmp_path, rows):
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land(spark, folder, [(1, "2024-01-01 10:00:00", 1, "a", 30_000, None), (2, "2024-01-01 11:00:00", 1, "a", 29_999, None),
                         (3, "2024-01-01 12:00:00", 1, "b", 40_000, True)])

    def run():
        jobs.ingest_available(jobs.read_stream(spark, folder, PLAY), sink, state, ["event_id"])
        return rows(jobs.read_plays(spark, sink, "event_id bigint, hour int"))

    assert rows(jobs.read_plays(spark, sink, "event_id bigint, hour int")) == []
    assert run() == [(1, 10)]
    assert run() == [(1, 10)]
    # A repeat and a new play arrive in a later file.
    land(spark, folder, [(1, "2024-01-01 10:00:00", 1, "a", 30_000, None), (4, "2024-01-01 13:00:00", 2, "a", 50_000, False)])
    assert run() == [(1, 10), (4, 13)]


def test_late_plays_are_kept_and_late_repeats_are_not(spark, tmp_path, rows):
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    runs = [
        [(1, "2024-03-01 10:00:00", 1, "a", 30_000, None)],
        [(2, "2024-03-02 10:00:00", 1, "a", 30_000, None)],
        [(3, "2024-01-01 10:00:00", 1, "a", 30_000, None), (4, "2023-11-20 10:00:00", 1, "b", 30_000, None)],  # 100 days late
        [(4, "2023-11-20 10:00:00", 1, "b", 30_000, None), (1, "2024-03-01 10:00:00", 1, "a", 30_000, None)],  # repeats
        [(5, "2024-03-03 10:00:00", 1, "a", 30_000, None), (5, "2024-03-03 10:00:00", 1, "a", 30_000, None)],
    ]
    for data in runs:
        land(spark, folder, data)
        jobs.ingest_available(jobs.read_stream(spark, folder, PLAY), sink, state, ["event_id"])
    assert rows(jobs.read_plays(spark, sink, "event_id bigint, month string")) == [
        (1, "2024-03"), (2, "2024-03"), (3, "2024-01"), (4, "2023-11"), (5, "2024-03")
    ]
    # Everything once more, by a job that knows nothing of the first one's progress.
    jobs.ingest_available(jobs.read_stream(spark, folder, PLAY), sink, str(tmp_path / "new state"), ["event_id"])
    assert spark.read.parquet(sink).count() == 5


def test_a_batch_reads_the_keys_of_its_own_months(spark, tmp_path, rows, monkeypatch):
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    read, plans = jobs._present, []

    def spy(*args):
        found = read(*args)
        plans.append(found)
        return found

    land(spark, folder, [(k, f"2024-0{k}-01 10:00:00", 1, "a", 30_000, None) for k in range(1, 6)])
    jobs.ingest_available(jobs.read_stream(spark, folder, PLAY), sink, state, ["event_id"])
    monkeypatch.setattr(jobs, "_present", spy)
    land(spark, folder, [(9, "2024-02-01 10:00:00", 1, "a", 30_000, None)])
    jobs.ingest_available(jobs.read_stream(spark, folder, PLAY), sink, state, ["event_id"])
    seen = plans[-1].where((F.col("batch") != "x") & F.col("month").isin(["2024-02"]))
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ = 2024-02", seen._jdf.queryExecution().executedPlan().toString())
    assert rows(jobs.read_plays(spark, sink, "event_id bigint")) == [(1,), (2,), (3,), (4,), (5,), (9,)]


def test_counts_before_the_first_batch(spark, tmp_path):
    assert jobs.read_counts(spark, str(tmp_path / "none")).collect() == []
    assert jobs.fold_counts(spark, str(tmp_path / "none")) is None


def test_batches_are_folded_and_read_once(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(jobs, "GENERATION", 3)
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    folded = []
    for k in range(14):
        land(spark, folder, [(k, f"2024-01-{1 + k % 4:02d} 10:00:00", 1, "a", 10 + k, None)])
        jobs.count_available(jobs.read_stream(spark, folder, PLAY), sink, state)
        if k in (4, 6, 13):
            folded.append(jobs.fold_counts(spark, sink))
        want = {d: [10 + i for i in range(k + 1) if i % 4 == d] for d in range(4)}
        got = rows(jobs.read_counts(spark, sink), F.date_format("start", "dd"), "play_count", "total_ms")
        assert got == [(f"{d + 1:02d}", len(x), sum(x)) for d, x in want.items() if x]
    assert folded == [0, 1, 3]
    # Generations of the earlier folds are empty, those of the last one are still there.
    files = jobs._present(spark, f"{sink}/batches", "gen bigint, batch bigint").select("gen").distinct().collect()
    assert sorted(r["gen"] for r in files) == [2, 3, 4]
    plan = jobs.read_counts(spark, sink)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(gen#\d+L?\), \(gen#\d+L? > 3\)", plan)
    assert any("/folded/upto=3/" in f for f in jobs.read_counts(spark, sink).inputFiles())


def test_many_batches_are_read_as_one(spark, tmp_path):
    """A thousand folded batches are one table in the plan, without a file of theirs."""
    sink = str(tmp_path / "out")
    rows = spark.range(5000).selectExpr("timestamp'2024-01-01' AS start", "'a' AS track_uri", "1L AS play_count", "2L AS total_ms", "id % 1001 AS batch")
    rows.selectExpr("*", "batch div 100 AS gen").repartition(1).write.partitionBy("gen", "batch").parquet(f"{sink}/batches")
    assert jobs.fold_counts(spark, sink) == 9
    counts = jobs.read_counts(spark, sink)
    assert [tuple(r)[1:] for r in counts.collect()] == [("a", 5000, 10_000)]
    read = [f for f in counts.inputFiles() if "/batches/" not in f]
    assert len(read) == 1


def test_added_counts_keep_late_rows(spark, tmp_path, rows):
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        jobs.count_available(jobs.read_stream(spark, folder, PLAY), sink, state)
        return rows(jobs.read_counts(spark, sink), F.date_format("start", "dd"), "track_uri", "play_count", "total_ms")

    land(spark, folder, [(1, "2024-01-01 10:00:00", 1, "a", 10, None), (3, "2024-01-04 00:00:00", 1, "b", 30, None)])
    assert run() == [("01", "a", 1, 10), ("04", "b", 1, 30)]
    # Days late, and nothing new in the last run.
    land(spark, folder, [(4, "2024-01-01 12:00:00", 1, "a", 99, None)])
    assert run() == run() == [("01", "a", 2, 109), ("04", "b", 1, 30)]


def test_stream_first_plays(spark, tmp_path, rows):
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for play in [(1, "2024-01-01 10:00:00", 1, "a", 10, None)], [(2, "2024-02-01 10:00:00", 1, "a", 10, None), (3, "2024-02-01 10:00:00", 2, "a", 10, None)]:
        land(spark, folder, play)
        jobs.run_available(jobs.first_plays(jobs.read_stream(spark, folder, PLAY)), sink, state)
    assert rows(spark.read.parquet(sink)) == [(1, "a"), (2, "a")]


def test_streams_read_tables_that_are_folders(spark, small, tmp_path):
    import shutil

    from cratebook.testbed.queries import QUERIES

    for table in ("events", "lineitem", "orders", "part", "customer", "nation", "supplier", "region"):
        shutil.copy(f"{small}/{table}.parquet", tmp_path / f"{table}.parquet")
    (tmp_path / "events.parquet").unlink()
    spark.read.parquet(f"{small}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_first_plays", "stream_ingest_history", "stream_play_counts"):
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()), key=repr) == sorted(map(tuple, QUERIES[name](spark, small).collect()), key=repr)
