"""Genre and mood profiles of collections, kept as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.functions import music
from cratebook.operators.grouping import ordered_list, top_per_group


def genre_profiles(
    playlist_tracks: DataFrame, track_artists: DataFrame, artists: DataFrame
) -> DataFrame:
    """(playlist_id, genre, n) through the primary artist; repeated memberships count again.

    Memberships are counted per (collection, artist) before genres are attached,
    so the genre explosion works on the reduced rows.
    """
    primary = track_artists.where(F.col("position") == 0).select("track_id", "artist_id")
    per_artist = (
        playlist_tracks.join(primary, "track_id")
        .groupBy("playlist_id", "artist_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return (
        per_artist.join(artists.select("artist_id", "genres"), "artist_id")
        .select("playlist_id", "rows", F.explode(F.coalesce("genres", F.array())).alias("genre"))
        .groupBy("playlist_id", "genre")
        .agg(F.sum("rows").alias("n"))
    )


def top_genres(profiles: DataFrame, top_n: int = 10) -> DataFrame:
    return top_per_group(profiles, ["playlist_id"], [F.desc("n"), "genre"], top_n)


def similar_by_genre(
    profiles: DataFrame,
    playlists: DataFrame,
    playlist_id: object,
    top_n: int = 10,
    only_followed: bool = False,
    only_owned: bool = False,
) -> DataFrame:
    """Collections nearest to one collection by cosine of genre counts.

    The source profile is joined on genre, so every candidate profile is read
    once; candidates without a common genre score 0 and still rank.
    """
    source = profiles.where(F.col("playlist_id") == playlist_id).select(
        "genre", F.col("n").alias("source_n")
    )
    norms = (
        profiles.join(source, "genre", "left")
        .groupBy("playlist_id")
        .agg(
            F.sum(F.col("n") * F.coalesce("source_n", F.lit(0))).alias("dot"),
            F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"),
        )
    )
    source_norm = source.agg(F.sqrt(F.sum(F.col("source_n") * F.col("source_n"))).alias("s")).scalar()
    wanted = playlists.where(F.col("playlist_id") != playlist_id)
    if only_followed:
        wanted = wanted.where(~F.col("is_owned"))
    if only_owned:
        wanted = wanted.where(F.col("is_owned"))
    score = F.coalesce(F.try_divide(F.col("dot"), F.col("norm") * source_norm), F.lit(0.0))
    return (
        wanted.select("playlist_id", "name", "is_owned", "track_count")
        .join(norms, "playlist_id", "left")
        .select("playlist_id", "name", score.alias("similarity"), "is_owned", "track_count")
        .orderBy(F.desc(F.round("similarity", 9)), "playlist_id")
        .limit(top_n)
    )


def genre_distribution(items: DataFrame, genres: str = "genres", top_n: int = 10) -> DataFrame:
    """Genre counts over tracks and their percentage of all mentions."""
    counts = (
        items.select(F.explode(genres).alias("genre")).groupBy("genre").agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return (
        counts.withColumn("percentage", F.col("n") / total * 100)
        .orderBy(F.desc("n"), "genre")
        .limit(top_n)
    )


def item_moods(features: DataFrame, valence: str = "valence", energy: str = "energy") -> DataFrame:
    label: Column = music.mood(F.col(valence), F.col(energy))
    return features.withColumn("mood", label).where(F.col("mood").isNotNull())


def mood_counts(playlist_tracks: DataFrame, moods: DataFrame) -> DataFrame:
    return (
        playlist_tracks.join(moods.select("track_id", "mood"), "track_id")
        .groupBy("playlist_id", "mood")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def mood_tag_lists(counts: DataFrame, max_tags: int = 5, min_count: int = 1) -> DataFrame:
    """Most frequent moods per collection. The count limit applies to the first
    ``2 * max_tags`` moods, as the list is cut twice."""
    ranked = top_per_group(counts, ["playlist_id"], [F.desc("n"), "mood"], 2 * max_tags)
    kept = ranked.where(F.col("n") >= min_count)
    return kept.groupBy("playlist_id").agg(
        F.slice(ordered_list("mood"), 1, max_tags).alias("moods")
    )
