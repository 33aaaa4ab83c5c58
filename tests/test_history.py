"""Play history, selections and plans on small hand-made tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cratebook.operators import plays, selection
from cratebook.plans import archive, protect, refresh
from cratebook.sources import tables


@pytest.fixture(scope="module")
def history(spark):
    data = [
        ("2024-01-05 08:00:00", "a", 40_000), ("2024-01-05 09:00:00", "a", 40_000), ("2024-01-06 13:00:00", "b", 90_000),
        ("2024-01-07 19:00:00", "b", 50_000), ("2024-02-01 00:00:00", "a", 10_000), ("2024-02-02 00:30:00", "c", 70_000),
        ("2024-02-29 06:00:00", "", 99_000), ("2023-02-28 06:00:00", "d", 1), ("2024-02-03 06:00:00", None, 5), ("2024-02-10 06:00:00", "d", None),
    ]
    df = spark.createDataFrame(data, "timestamp string, track_uri string, ms_played bigint")
    return df.withColumn("timestamp", F.to_timestamp("timestamp"))


def uris(df):
    return [r["track_uri"] for r in df.collect()]


def test_rankings(history):
    # Ties in plays are broken by length; the empty track uses up a place of the limit.
    assert uris(plays.most_played(history)) == ["a", "b", "c", "d"]
    assert uris(plays.most_played(history, "2024-01")) == ["b", "a"]
    assert uris(plays.most_played(history, "2024-02", limit=2)) == ["c"]
    assert uris(plays.daypart_top(history, "morning")) == ["a", "d"]
    assert uris(plays.daypart_top(history, "evening")) == ["b"]
    assert uris(plays.daypart_top(history, "weekend")) == ["b", "d"]
    assert uris(plays.daypart_top(history, "noon")) == []
    assert uris(plays.repeat_items(history)) == ["a"]
    assert uris(plays.repeat_items(history, "2024-01", min_repeats=2)) == ["a", "b"]


def test_discovery(history):
    assert uris(plays.discovery(history, limit=3)) == ["d", "a", "b"]
    assert uris(plays.discovery(history, "2024-02")) == ["c", ""]
    by_year = plays.discovery_by_year(history).where("year = 2024").orderBy("rank")
    assert uris(by_year) == ["a", "b", "c", "d", ""]
    ever = plays.discovery_by_year(history, scope="all_history").where("year = 2024").orderBy("rank")
    assert uris(ever) == ["a", "b", "c", ""]


def test_on_this_day(history, rows):
    # 365 days before 29 February 2024 is 28 February.
    assert rows(plays.on_this_day(history, "2024-02-28")) == [("d", 1)]


def test_history_union(spark, history):
    basic = history.select("timestamp", "ms_played").withColumn("source", F.lit("basic"))
    none = history.where("false").withColumn("source", F.lit("extended"))
    assert plays.history_union(basic, none).count() == 10
    some = history.where("timestamp < '2024-01-06'").withColumn("source", F.lit("extended"))
    assert plays.history_union(basic, some).count() == 3
    assert plays.history_union(basic, some, fill_gaps=True).count() == 3 + 7


def test_rerank_is_stable(spark, history):
    items = spark.createDataFrame([("x", 0), ("c", 1), ("a", 2), ("y", 3), ("b", 4)], "track_uri string, rank int")
    assert uris(plays.rerank_by_plays(items, history)) == ["a", "b", "c", "x", "y"]


@pytest.fixture(scope="module")
def members(spark):
    data = [
        (1, "a", "2024-01-02", 0), (1, "b", "2024-01-03", 1), (1, "a", "2024-01-04", 2), (1, "a", "2024-01-05", 3),
        (2, "b", "2023-01-01", 0), (2, "c", "2024-05-01", 1), (3, "d", "2024-03-01", 0), (3, "c", "2024-03-02", 1),
        (3, "e", "2024-03-03", 2), (3, "f", "2024-03-04", 3),
    ]
    df = spark.createDataFrame(data, "playlist_id bigint, track_id string, added_at string, position bigint")
    return df.withColumn("added_at", F.to_timestamp("added_at")).withColumn("track_uri", F.col("track_id"))


def test_duplicates_go_except_the_first(members, rows):
    assert rows(selection.positions_to_remove(members)) == [(1, "a", 2), (1, "a", 3)]


def test_merge_goes_into_the_oldest(spark, members, rows):
    groups = spark.createDataFrame([("g", 1, 0), ("g", 2, 1), ("g", 3, 2)], "group_id string, playlist_id bigint, ordinal int")
    merged = selection.merge_collections(members, groups)
    assert rows(merged, "target_id", "track_id", "source_id", "action") == [
        (2, "a", 1, "add"), (2, "b", 2, "keep"), (2, "c", 2, "keep"), (2, "d", 3, "add"), (2, "e", 3, "add"), (2, "f", 3, "add"),
    ]
    assert rows(selection.merge_report(merged)) == [("g", 2, 4, 2, 6)]
    fresh = selection.merge_collections(members, groups, keep="new")
    assert {r["target_id"] for r in fresh.collect()} == {1}


def test_mix(spark, members, rows):
    chosen = spark.createDataFrame([(3, 0), (1, 1)], "playlist_id bigint, ordinal int")
    # Six different items, two collections: three each; the second has only two left.
    assert rows(selection.mix_collections(members, chosen), "track_id") == [("a",), ("b",), ("c",), ("d",), ("e",)]
    # Weighted: 4/6 and 2/6 of six items.
    weighted = selection.mix_collections(members, chosen, "weighted")
    assert rows(weighted, "track_id") == [("a",), ("b",), ("c",), ("d",), ("e",), ("f",)]
    by_time = selection.mix_collections(members, chosen, "chronological").orderBy("sort_key")
    assert [r["track_id"] for r in by_time.collect()] == ["a", "b", "d", "c", "e", "f"]
    one = selection.mix_collections(members.repartition(7), chosen, "shuffled").orderBy("sort_key")
    two = selection.mix_collections(members.repartition(1), chosen, "shuffled").orderBy("sort_key")
    assert one.collect() == two.collect() and one.count() == 6


def test_preservation(spark, members):
    after = members.where("track_id <> 'e' and not (playlist_id = 2 and track_id = 'c')")
    removed = spark.createDataFrame([(3, "e")], "playlist_id bigint, track_id string")
    added = spark.createDataFrame([(1, "z")], "playlist_id bigint, track_id string")
    got = {r["playlist_id"]: r for r in selection.preservation_check(members, after, added, removed).collect()}
    assert got[3]["preserved"] and not got[3]["count_decrease"]
    assert got[2]["unexpected_removals"] == 1 and got[2]["count_decrease"] and not got[2]["preserved"]
    assert got[1]["missing_additions"] == 1 and not got[1]["preserved"]


def test_representative(spark, members):
    tracks = spark.createDataFrame([("a", 5), ("b", 9), ("c", None), ("d", 1)], "track_id string, popularity int")

    def chosen(strategy):
        return {r["playlist_id"]: r["track_id"] for r in selection.representative_item(members, tracks, strategy).collect()}

    assert chosen("most_popular") == {1: "b", 2: "b", 3: "d"}
    assert chosen("most_recent") == {1: "a", 2: "c", 3: "f"}
    assert chosen("first") == {1: "a", 2: "b", 3: "d"}


def test_snapshot_diff(spark, rows):
    now = spark.createDataFrame([(1, "x"), (2, "y2"), (4, None), (5, "n")], "playlist_id bigint, snapshot_id string")
    state = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, None)], "playlist_id bigint, snapshot_id string")
    assert rows(refresh.snapshot_diff(now, state)) == [(1, "unchanged"), (2, "changed"), (3, "removed"), (4, "unchanged"), (5, "new")]
    assert rows(refresh.snapshot_diff(now, state, force=True)) == [(1, "changed"), (2, "changed"), (3, "removed"), (4, "changed"), (5, "new")]


def test_refresh(spark, rows):
    schema = "playlist_id bigint, track_id string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], schema)
    fetched = spark.createDataFrame([(1, "WRONG"), (2, "c"), (2, "e"), (5, "f")], schema)
    now = spark.createDataFrame([(1, "x"), (2, "y2"), (5, "n")], "playlist_id bigint, snapshot_id string")
    state = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "playlist_id bigint, snapshot_id string")
    done = refresh.incremental_refresh(now, state, old, fetched, "2024-01-01")
    assert rows(done.members) == [(1, "a"), (2, "c"), (2, "e"), (5, "f")]
    assert done.counts.first().asDict() == {"checked": 3, "updated": 2, "removed": 1, "rows_written": 3, "net_added": 2}
    kept = refresh.incremental_refresh(now, state, old, fetched, "2024-01-01", keep_removed=True)
    assert (3, "d") in rows(kept.members)


@pytest.fixture(scope="module")
def shelf(spark):
    return spark.createDataFrame(
        [(1, "AJFindsJan23"), (2, "AJTopJan23"), (3, "AJTopFeb23"), (4, "AJTop23"), (5, "AJFindsDec24"), (6, "AJDiscovery22"), (7, "Mine")],
        "playlist_id bigint, name string",
    )


def test_archive_plan(spark, shelf, rows):
    data = [(1, "a", 0), (2, "x", 0), (2, "y", 1), (3, "y", 0), (3, "z", 1), (4, "x", 0), (5, "late", 0), (6, "w", 0)]
    members = spark.createDataFrame(data, "playlist_id bigint, track_uri string, position bigint")
    liked = spark.createDataFrame(
        [("l1", "2022-03-01", 0), ("l2", "2022-03-02", 1), ("l1", "2022-05-01", 2), ("l3", "2024-11-20", 3)],
        "track_uri string, added_at string, position bigint",
    ).withColumn("added_at", F.to_timestamp("added_at"))
    history = spark.createDataFrame(
        [("2022-01-01", "q", 1), ("2022-01-02", "r", 1), ("2022-01-03", "r", 1), ("2023-04-04", "z", 1), ("2023-04-05", "z", 1)],
        "timestamp string, track_uri string, ms_played bigint",
    ).withColumn("timestamp", F.to_timestamp("timestamp"))
    plan = archive.archive_plan(shelf, members, liked, history, "2024-12-15", keep_months=1)
    got = rows(plan.rows, "year", "type", "track_uri", "action", "plays")
    assert got == sorted(
        [
            (2022, "monthly", "l1", "create", 0), (2022, "monthly", "l2", "create", 0),
            (2022, "most_played", "q", "create", 0), (2022, "most_played", "r", "create", 0),
            # AJDiscovery22 exists and 2022 has no monthly collections: left alone.
            (2023, "monthly", "a", "create", 0),
            # AJTop23 exists and has x already; z is played most.
            (2023, "most_played", "y", "add", 0), (2023, "most_played", "z", "add", 2),
            (2023, "discovery", "z", "create", 0),
            (2024, "monthly", "l3", "create", 0),
        ],
        key=repr,
    )
    assert rows(plan.deletable, "source_id") == [(1,), (2,), (3,)]


def test_monthly_plan_has_empty_months(spark, shelf, rows):
    liked = spark.createDataFrame(
        [("a", "2024-12-03", 0), ("late", "2024-12-04", 1), ("b", "2024-10-04", 2)], "track_uri string, added_at string, position bigint"
    ).withColumn("added_at", F.to_timestamp("added_at"))
    members = spark.createDataFrame([(5, "late")], "playlist_id bigint, track_uri string")
    headers, plan = archive.monthly_plan(liked, shelf, members, "2024-12-31")
    assert rows(headers, "name", "action", "items", "to_add") == [
        ("AJFindsDec24", "add", 2, 1), ("AJFindsNov24", "create", 0, 0), ("AJFindsOct24", "create", 1, 1),
    ]
    assert rows(plan, "period", "track_uri", "action") == [("2024-10", "b", "create"), ("2024-12", "a", "add")]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_month_ranges_reach_the_scan(spark, shelf, rows, tmp_path, kind):
    """Labels of months become a range on the stored column; the rows are those of the labels."""
    days = [("2024-09-30", 0), ("2024-10-01", 1), ("2024-11-15", 2), ("2024-12-31", 3), ("2025-01-01", 4), (None, 5)]
    stored = spark.createDataFrame(days, "added_at string, position bigint").select(
        F.concat(F.lit("t"), F.col("position").cast("string")).alias("track_uri"), F.col("added_at").cast(kind).alias("added_at"), "position"
    )
    stored.write.parquet(str(tmp_path / "liked"))
    liked = spark.read.parquet(str(tmp_path / "liked"))
    members = spark.createDataFrame([], "playlist_id bigint, track_uri string")
    _, plan = archive.monthly_plan(liked, shelf, members, "2024-12-31")
    assert rows(plan, "track_uri") == [("t1",), ("t2",), ("t3",)]
    periods = archive.liked_by_period(liked, cutoff="2024-11", since="2024-10")
    assert rows(periods.where("period_type = 'monthly'"), "track_uri") == [("t1",), ("t2",)]
    text = periods._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters") :]
    if kind != "string":
        assert "GreaterThanOrEqual(added_at" in pushed and "LessThan(added_at" in pushed


def test_on_this_day_reads_one_day_of_a_stored_history(spark, rows, tmp_path):
    data = [("2020-06-14 23:59:59", "a"), ("2021-06-15 00:00:00", "b"), ("1999-06-15 10:00:00", "b"), ("2022-06-15 23:59:59", "c"), ("2020-06-16 00:00:00", "a"), (None, "d")]
    history = spark.createDataFrame(data, "timestamp string, track_uri string").withColumn("timestamp", F.to_timestamp("timestamp"))
    path = tables.write_history_by_day(history, str(tmp_path / "h"))
    kept = plays.on_this_day(spark.read.parquet(path), "2023-06-15")
    assert rows(kept) == rows(plays.on_this_day(history, "2023-06-15")) == [("b", 2), ("c", 1)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(month_day#\d+\), \(month_day#\d+ = 06-15\)\]", plan)
    leap = plays.on_this_day(history, "2021-02-28", years_ago=1)
    assert leap.count() == 0


def test_rename_skips_taken_names(spark, rows):
    shelf = spark.createDataFrame(
        [(1, "AJAutoJan25"), (2, "AJFindsFeb25"), (3, "AJAutoFeb25"), (4, "xAUTO"), (5, "plain")], "playlist_id bigint, name string"
    )
    changes = {"Auto": "Finds", "auto": "finds", "AUTO": "FINDS"}
    assert rows(archive.rename_plan(shelf, changes)) == [(1, "AJAutoJan25", "AJFindsJan25"), (4, "xAUTO", "xFINDS")]


def test_description_delta(spark, rows):
    shelf = spark.createDataFrame(
        [
            (1, "AJFindsJan25", "", "s1"), (2, "Mine", "Old (x)\nmore", "s2"), (3, "AJTop24", "AJTop24", "s3"),
            (4, "Seen", "a (b)", "s4"), (5, "Empty", "a (b)", "s5"), (6, "Same", "Same line", "s6"),
        ],
        "playlist_id bigint, name string, description string, snapshot_id string",
    )
    state = spark.createDataFrame([(4, "s4"), (2, "older")], "playlist_id bigint, snapshot_id string")
    members = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 6)], "playlist_id bigint")
    got = rows(archive.description_delta(shelf, members, state), "playlist_id", "new_description")
    assert got == [(1, "Liked songs from Jan 25"), (2, "Old")]


def test_backup_and_restore(spark, members, rows, tmp_path):
    shelf = spark.createDataFrame([(1, "One"), (9, "None")], "playlist_id bigint, name string")
    records, items = protect.backup_snapshot(shelf, members, "2024-06-01 10:00:00")
    later, more = protect.backup_snapshot(shelf, members.where("position = 0"), "2024-08-01 10:00:00")
    path = str(tmp_path / "backups")
    protect.write_backup(records, items, path)
    protect.write_backup(later, more, path)
    records, items = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/items")
    listed = [(r["playlist_id"], r["track_count"]) for r in protect.list_backups(records).collect()]
    assert listed == [(1, 1), (9, 0), (1, 4), (9, 0)]
    plan = protect.restore_plan(records, items, "1_20240601_100000")
    assert rows(plan, "playlist_id", "track_uri", "position") == [(1, "a", 0), (1, "a", 2), (1, "a", 3), (1, "b", 1)]
    assert protect.restore_plan(records, items, "1_20240601_100000", 77).select("playlist_id").distinct().collect() == [(77,)]
    assert rows(protect.restore_counts(plan, members)) == [(1, 4, 4)]
    assert protect.restore_plan(records, items).count() == 5
    assert protect.expired_backups(records, "2024-08-02", 30).count() == 2
    assert protect.retained_backups(records, "2024-08-02", 30).count() == 2


def test_only_contained_collections_may_go(spark, rows):
    members = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (2, "c"), (3, "c"), (3, "d"), (4, "x")], "playlist_id bigint, track_id string"
    )
    requests = spark.createDataFrame([(1, 2), (3, 2), (4, None)], "playlist_id bigint, target_id bigint")
    verdicts = protect.delete_verdicts(requests, members)
    assert rows(verdicts, "playlist_id", "missing", "allowed") == [(1, 0, True), (3, 1, False), (4, 0, True)]
    assert rows(protect.apply_deletes(members, verdicts), "playlist_id") == [(2,)] * 3 + [(3,)] * 2
    circle = spark.createDataFrame([(1, 2), (2, 1)], "playlist_id bigint, target_id bigint")
    assert not any(r["allowed"] for r in protect.delete_verdicts(circle, members).collect())
    after, checked = protect.safe_remove(members, spark.createDataFrame([(3, "d"), (3, "zz")], "playlist_id bigint, track_id string"))
    assert rows(after.where("playlist_id = 3"), "track_id") == [("c",)]
    assert rows(checked, "playlist_id", "removals", "preserved") == [(3, 1, True)]
