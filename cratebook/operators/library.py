"""Scope filters and the joins that build the wide table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.functions import music, names


def owned(playlists: DataFrame) -> DataFrame:
    return playlists.where(F.col("is_owned"))


def followed(playlists: DataFrame) -> DataFrame:
    return playlists.where(~F.col("is_owned"))


def monthly_playlists(playlists: DataFrame) -> DataFrame:
    return owned(playlists).where(names.is_monthly_name(F.col("name")))


def find_by_name(playlists: DataFrame, name: str) -> DataFrame:
    """Exactly one row, or the job fails when it runs."""
    hits = playlists.where(F.col("name") == name)
    # A global aggregate has one row even without hits, so the check always runs.
    single = hits.agg(
        F.count(F.lit(1)).alias("n"), F.any_value(F.struct(*playlists.columns)).alias("found")
    )
    complaint = F.concat(F.col("n").cast("string"), F.lit(f" collections are named {name}"))
    checked = F.when(F.col("n") == 1, F.col("found")).otherwise(F.raise_error(complaint))
    return single.select(checked.alias("found")).select("found.*")


def _distinct_keys(keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Only the keys, each once: a hot key is reduced before it is shuffled."""
    return keys.select(*([on] if isinstance(on, str) else on)).distinct()


def keep_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(_distinct_keys(keys, on), on, "left_semi")


def keep_not_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(_distinct_keys(keys, on), on, "left_anti")


@dataclass(frozen=True)
class Scope:
    playlists: DataFrame
    playlist_tracks: DataFrame
    tracks: DataFrame
    track_artists: DataFrame
    artists: DataFrame


def library_scope(
    playlists: DataFrame,
    playlist_tracks: DataFrame,
    tracks: DataFrame,
    track_artists: DataFrame,
    artists: DataFrame,
    exclude_liked: bool = False,
    exclude_monthly: bool = False,
    include_only: Sequence[str] | None = None,
    exclude_names: Sequence[str] | None = None,
) -> Scope:
    """Owned collections after the options, and only what they reach downstream."""
    kept = owned(playlists)
    if exclude_liked:
        kept = kept.where(~F.col("is_liked_songs"))
    if exclude_monthly:
        kept = kept.where(~names.is_monthly_name(F.col("name")))
    if include_only:
        kept = kept.where(F.col("name").isin(list(include_only)))
    if exclude_names:
        kept = kept.where(F.col("name").isNull() | ~F.col("name").isin(list(exclude_names)))
    members = keep_in(playlist_tracks, kept, "playlist_id")
    items = keep_in(tracks, members, "track_id")
    credits = keep_in(track_artists, members, "track_id")
    return Scope(kept, members, items, credits, keep_in(artists, credits, "artist_id"))


def primary_artist(track_artists: DataFrame, artists: DataFrame, fallback: bool = False) -> DataFrame:
    """One artist row per track: position 0, or with ``fallback`` the lowest position."""
    if fallback:
        first = track_artists.groupBy("track_id").agg(
            F.min(F.struct("position", "artist_id")).alias("first")
        ).select("track_id", F.col("first.artist_id").alias("artist_id"))
    else:
        first = track_artists.where(F.col("position") == 0).select("track_id", "artist_id")
    details = artists.select(
        "artist_id",
        F.col("name").alias("primary_artist"),
        F.col("genres").alias("primary_genres"),
        F.col("popularity").alias("primary_artist_popularity"),
        F.col("followers").alias("primary_artist_followers"),
    )
    return first.join(details, "artist_id", "left").withColumnRenamed("artist_id", "primary_artist_id")


def library_wide(
    playlists: DataFrame,
    playlist_tracks: DataFrame,
    tracks: DataFrame,
    track_artists: DataFrame,
    artists: DataFrame,
    owned_only: bool = True,
) -> DataFrame:
    """Memberships with collection, track and primary artist.

    Memberships of collections that are not owned stay, with null collection columns.
    """
    collections = owned(playlists) if owned_only else playlists
    items = tracks.withColumnRenamed("name", "name_track")
    if "uri" in items.columns:
        items = items.withColumnRenamed("uri", "uri_track")
    # Track and artist are joined first: one row per track, far smaller than memberships.
    # A full join: a membership of an unknown track may still have a credited artist.
    described = items.join(primary_artist(track_artists, artists), "track_id", "full")
    return (
        playlist_tracks.join(collections, "playlist_id", "left").join(described, "track_id", "left")
    )


def enriched_members(playlist_tracks: DataFrame, tracks: DataFrame) -> DataFrame:
    return playlist_tracks.join(tracks, "track_id", "left")


def item_genres(track_artists: DataFrame, artists: DataFrame) -> DataFrame:
    """All genres of a track's artists, each once, in first-seen order.

    The list is built from distinct genres, so its length is bounded by the
    genre vocabulary however many credits a track has.
    """
    seen = (
        track_artists.join(artists.select("artist_id", "genres"), "artist_id")
        .select("track_id", "position", F.posexplode(music.clean_genre_array(F.col("genres"))))
        .groupBy("track_id", F.col("col").alias("genre"))
        .agg(F.min(F.struct("position", "pos")).alias("first"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("first", "genre")))
    return seen.groupBy("track_id").agg(F.transform(ordered, lambda g: g["genre"]).alias("genres"))


def item_set(playlist_tracks: DataFrame, playlist_id: object = None) -> DataFrame:
    """Distinct items of every collection, or of one; missing items are skipped."""
    if playlist_id is not None:
        playlist_tracks = playlist_tracks.where(F.col("playlist_id") == playlist_id)
    return playlist_tracks.select("playlist_id", "track_uri").dropna().distinct()


def liked_items(playlist_tracks: DataFrame, playlists: DataFrame) -> DataFrame:
    """Items of the liked collection; ``position`` holds the order they were saved in."""
    liked = playlists.where(F.col("is_liked_songs"))
    return keep_in(playlist_tracks, liked, "playlist_id").where(F.col("track_uri").isNotNull())


# Alternative column names, first present one wins.
ALTERNATIVES = {
    "track_uri": ["track_uri", "spotify_track_uri"],
    "added_at": ["added_at", "playlist_added_at", "track_added_at"],
    "timestamp": ["timestamp", "endTime", "played_at"],
}


def canonical_columns(df: DataFrame, wanted: Sequence[str] = tuple(ALTERNATIVES)) -> DataFrame:
    """Rename the first present alternative of each wanted column to its usual name."""
    for name in wanted:
        present = next((c for c in ALTERNATIVES[name] if c in df.columns), None)
        if present is not None and present != name:
            df = df.withColumnRenamed(present, name)
    return df


def completeness(playlist_tracks: DataFrame, playlists: DataFrame) -> DataFrame:
    """Row and distinct counts; ``complete`` is false below 90 % of the announced rows."""
    announced = owned(playlists).agg(F.coalesce(F.sum("track_count"), F.lit(0)).alias("n")).select("n")
    counted = playlist_tracks.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("playlist_id").alias("n_playlists"),
        F.countDistinct("track_id").alias("n_tracks"),
    )
    expected: Column = announced.scalar()
    return counted.withColumn("expected_rows", expected).withColumn(
        "complete", F.col("n_rows") >= 0.9 * F.col("expected_rows")
    )


def name_collisions(playlists: DataFrame, order: str = "playlist_id") -> DataFrame:
    return (
        playlists.where(F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n"), F.max_by("playlist_id", order).alias("last_playlist_id"))
        .where(F.col("n") > 1)
    )
