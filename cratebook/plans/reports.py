"""The insights report as one long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.operators import overlap, plays, profiles, statistics
from cratebook.operators.grouping import top_rows


def _section(df: DataFrame, name: str, rank: Column, label: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("section"),
        rank.cast("int").alias("rank"),
        label.cast("string").alias("label"),
        value.cast("double").alias("value"),
    )


def insights_report(
    playlists: DataFrame,
    playlist_tracks: DataFrame,
    tracks: DataFrame,
    history: DataFrame | None = None,
    as_of: str | None = None,
    days: int = 30,
    health: int = 0,
    size_threshold: int = 20,
) -> DataFrame:
    """(section, rank, label, value): counts, genres, recent listening, closest pairs,
    merge candidates, and with ``health`` the scores of the first so many owned collections,
    best first."""
    mine = playlists.where(F.col("is_owned"))
    totals = playlist_tracks.agg(
        F.count(F.lit(1)).alias("entries"), F.countDistinct("track_id").alias("unique_tracks")
    ).withColumns(
        {
            "playlists": playlists.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "owned_playlists": mine.agg(F.count(F.lit(1)).alias("n")).scalar(),
        }
    )
    counts = totals.select(
        F.explode(
            F.create_map(
                *[x for c in ("entries", "unique_tracks", "playlists", "owned_playlists") for x in (F.lit(c), F.col(c))]
            )
        ).alias("label", "value")
    )
    report = _section(counts, "counts", F.lit(1), F.col("label"), F.col("value"))
    genres = top_rows(profiles.genre_distribution(tracks), [F.desc("n"), "genre"], 10)
    report = report.unionByName(
        _section(genres, "genres", F.col("rank"), F.col("genre"), F.col("percentage"))
    )
    if history is not None:
        recent = plays.recent_listening(history, as_of, days)
        report = report.unionByName(
            recent.select("section", F.col("rank").cast("int").alias("rank"), "label", "value")
        )
    sets = playlist_tracks.select(F.col("playlist_id").alias("set_id"), F.col("track_id").alias("item_id"))
    labels = playlists.select(F.col("playlist_id").alias("set_id"), "name")
    both = F.concat_ws(" + ", "name1", "name2")
    similar = overlap.similar_collections(sets, labels, limit=5)
    similar = top_rows(similar, [F.desc("similarity"), "set1", "set2"], 5)
    report = report.unionByName(_section(similar, "similar", F.col("rank"), both, F.col("similarity")))
    own_names = mine.select(F.col("playlist_id").alias("set_id"), "name")
    merges = overlap.merge_candidates(
        sets.join(own_names, "set_id", "left_semi"), own_names, size_threshold=size_threshold, limit=3
    )
    merges = top_rows(merges, [F.desc("similarity"), "set1", "set2"], 3)
    report = report.unionByName(_section(merges, "merge", F.col("rank"), both, F.col("similarity")))
    if health:
        first = mine.orderBy("playlist_id").limit(health)
        scores = statistics.health_score(first, playlist_tracks, tracks).join(
            first.select("playlist_id", "name"), "playlist_id"
        )
        ranked = top_rows(scores, [F.desc("score"), "playlist_id"], health)
        report = report.unionByName(
            _section(ranked, "health", F.col("rank"), F.col("name"), F.col("score"))
        )
    return report
