"""Landed API pages (nested JSON) to tidy tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratebook import schemas
from cratebook.schemas import LIKED_PLAYLIST_ID


# How the synthetic liked collection is described.
LIKED_NAME = "❤️ Liked Songs"
LIKED_DESCRIPTION = "Your liked songs - the master playlist"


def read_pages(spark: SparkSession, path: str, schema: str, one_per_file: bool = False) -> DataFrame:
    """One page per line, which splits large files; or one page per file, over any
    number of lines. Damaged pages become null rows, which flatten to nothing."""
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    return reader.option("multiLine", one_per_file).json(path)


def parse_pages(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Pages held as text in a column."""
    return df.select(F.from_json(column, schema).alias("page")).select("page.*")


def _items(pages: DataFrame, field: str) -> DataFrame:
    return pages.select(F.explode(field).alias("x")).where(F.col("x").isNotNull())


def flatten_collections(
    pages: DataFrame, me: str, liked_total: Column | int | None = None, liked_name: str = LIKED_NAME
) -> DataFrame:
    """Collections; with ``liked_total`` also the synthetic liked collection."""
    x = F.col("x")
    listed = _items(pages, "items").select(
        x["id"].alias("playlist_id"),
        x["name"].alias("name"),
        x["description"].alias("description"),
        x["public"].alias("public"),
        x["collaborative"].alias("collaborative"),
        x["snapshot_id"].alias("snapshot_id"),
        x["tracks"]["total"].alias("track_count"),
        x["owner"]["id"].alias("owner_id"),
        x["owner"]["display_name"].alias("owner_name"),
        F.coalesce(x["owner"]["id"] == me, F.lit(False)).alias("is_owned"),
        F.lit(False).alias("is_liked_songs"),
        x["uri"].alias("uri"),
    )
    if liked_total is None:
        return listed
    total = F.lit(liked_total).cast("bigint") if isinstance(liked_total, int) else liked_total
    values = {
        "playlist_id": F.lit(LIKED_PLAYLIST_ID),
        "name": F.lit(liked_name),
        "description": F.lit(LIKED_DESCRIPTION),
        "public": F.lit(False),
        "collaborative": F.lit(False),
        "snapshot_id": F.concat(F.lit("liked_songs_"), total.cast("string")),
        "track_count": total.cast("bigint"),
        "owner_id": F.lit(me),
        "owner_name": F.lit("You"),
        "is_owned": F.lit(True),
        "is_liked_songs": F.lit(True),
        "uri": F.lit(None).cast("string"),
    }
    liked = pages.sparkSession.range(1).select(*[v.alias(k) for k, v in values.items()])
    return liked.unionByName(listed)


def flatten_membership(pages: DataFrame) -> DataFrame:
    """Memberships. The position counts every item of a page, also those without an
    id, which are dropped afterwards. ``offset`` is the number of items before the page."""
    x = F.col("x")
    return (
        pages.select("playlist_id", F.coalesce("offset", F.lit(0)).alias("offset"), F.posexplode("items").alias("at", "x"))
        .where(x["track"]["id"].isNotNull())
        .select(
            "playlist_id",
            x["track"]["id"].alias("track_id"),
            x["track"]["uri"].alias("track_uri"),
            F.coalesce(x["is_local"], x["track"]["is_local"]).alias("is_local"),
            x["added_at"].try_cast("timestamp").alias("added_at"),
            x["added_by"]["id"].alias("added_by"),
            (F.col("offset") + F.col("at")).alias("position"),
        )
    )


def flatten_liked(pages: DataFrame, me: str) -> DataFrame:
    """Saved items as memberships of the liked collection."""
    return flatten_membership(pages.withColumn("playlist_id", F.lit(LIKED_PLAYLIST_ID))).withColumns(
        {"added_by": F.lit(me), "is_local": F.coalesce("is_local", F.lit(False))}
    )


def _one_per_id(df: DataFrame, key: str) -> DataFrame:
    """One row per id. Copies of an id are compared as a whole, so the choice does not
    depend on the order of the input, and an aggregate reduces hot ids early."""
    rest = [c for c in df.columns if c != key]
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("r"))
    return kept.select(key, "r.*")


def flatten_items(responses: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Tracks. Genres found earlier (``known``) are carried over."""
    x = F.col("x")
    tracks = _one_per_id(
        _items(responses, "tracks").select(
            x["id"].alias("track_id"),
            x["name"].alias("name"),
            x["duration_ms"].alias("duration_ms"),
            x["explicit"].alias("explicit"),
            x["popularity"].alias("popularity"),
            x["album"]["id"].alias("album_id"),
            x["album"]["name"].alias("album_name"),
            x["album"]["release_date"].alias("release_date"),
            x["track_number"].alias("track_number"),
            x["external_ids"]["isrc"].alias("isrc"),
            x["uri"].alias("uri"),
        ),
        "track_id",
    )
    if known is None:
        return tracks.withColumn("genres", F.lit(None).cast("array<string>"))
    return tracks.join(known.select("track_id", "genres").dropDuplicates(["track_id"]), "track_id", "left")


def flatten_item_creators(responses: DataFrame) -> DataFrame:
    """Credits in order. A credit without id is dropped but keeps its position."""
    return (
        _items(responses, "tracks")
        .where(F.col("x.id").isNotNull())
        .select(F.col("x.id").alias("track_id"), F.posexplode("x.artists").alias("position", "a"))
        .where(F.col("a.id").isNotNull())
        .select("track_id", F.col("a.id").alias("artist_id"), "position")
        .distinct()
    )


def flatten_creators(responses: DataFrame) -> DataFrame:
    x = F.col("x")
    return _one_per_id(
        _items(responses, "artists").select(
            x["id"].alias("artist_id"),
            x["name"].alias("name"),
            F.coalesce(x["genres"], F.array().cast("array<string>")).alias("genres"),
            x["popularity"].alias("popularity"),
            x["followers"]["total"].alias("followers"),
            x["uri"].alias("uri"),
        ),
        "artist_id",
    )


DESCRIPTION_LENGTH = 500  # fixed value: longer descriptions are cut

MARKET_SCHEMAS: dict[str, str] = {
    "new_releases": (
        "albums STRUCT<items ARRAY<STRUCT<id STRING, name STRING, release_date STRING, album_type STRING,"
        " total_tracks BIGINT, artists ARRAY<STRUCT<name STRING>>, uri STRING>>>"
    ),
    "categories": ("categories STRUCT<items ARRAY<STRUCT<id STRING, name STRING>>>"),
    "playlists": (
        "playlists STRUCT<items ARRAY<STRUCT<id STRING, name STRING, description STRING,"
        " tracks STRUCT<total BIGINT>, uri STRING>>>"
    ),
    "search_tracks": (
        "tracks STRUCT<items ARRAY<STRUCT<id STRING, name STRING, artists ARRAY<STRUCT<name STRING>>,"
        " album STRUCT<name STRING, release_date STRING>, duration_ms BIGINT, popularity INT, uri STRING>>>"
    ),
}


def _artist_names(x: Column) -> Column:
    found = F.coalesce(x["artists"], F.array().cast("array<struct<name:string>>"))
    return F.array_join(F.transform(found, lambda a: F.coalesce(a["name"], F.lit(""))), ", ")


def _market(pages: DataFrame, field: str, columns: dict[str, Column]) -> DataFrame:
    """All items of each response; how many it may hold is the request's affair."""
    return pages.select(F.explode(f"{field}.items").alias("x")).select(*[c.alias(n) for n, c in columns.items()])


def new_releases(pages: DataFrame) -> DataFrame:
    x = F.col("x")
    return _market(
        pages,
        "albums",
        {
            "album_id": x["id"],
            "name": x["name"],
            "release_date": x["release_date"],
            "album_type": x["album_type"],
            "total_tracks": x["total_tracks"],
            "artist_names": _artist_names(x),
            "uri": x["uri"],
        },
    )


def categories(pages: DataFrame) -> DataFrame:
    x = F.col("x")
    return _market(pages, "categories", {"id": x["id"], "name": x["name"]})


def market_playlists(pages: DataFrame) -> DataFrame:
    """Collections of a category, or found by a search."""
    x = F.col("x")
    return _market(
        pages,
        "playlists",
        {
            "playlist_id": x["id"],
            "name": x["name"],
            "description": F.substring(F.coalesce(x["description"], F.lit("")), 1, DESCRIPTION_LENGTH),
            "tracks_total": x["tracks"]["total"],
            "uri": x["uri"],
        },
    )


def search_tracks(pages: DataFrame) -> DataFrame:
    x = F.col("x")
    return _market(
        pages,
        "tracks",
        {
            "track_id": x["id"],
            "name": x["name"],
            "artist_names": _artist_names(x),
            "album_name": x["album"]["name"],
            "release_date": x["album"]["release_date"],
            "duration_ms": x["duration_ms"],
            "popularity": x["popularity"],
            "uri": x["uri"],
        },
    )


PAGE_SCHEMAS = {
    "collections": schemas.COLLECTION_PAGE,
    "membership": schemas.MEMBERSHIP_PAGE,
    "items": schemas.ITEMS_RESPONSE,
    "creators": schemas.CREATORS_RESPONSE,
}
