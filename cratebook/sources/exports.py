"""Account export files (JSON arrays) to tidy tables. A missing file is an empty table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratebook import schemas
from cratebook.functions import times
from cratebook.functions.music import uri_item
from cratebook.sources import arrays

# File name patterns of the export.
FILES = {
    "basic": "StreamingHistory_music_*.json",
    "extended": "Streaming_History_Audio_*.json",
    "search": "SearchQueries.json",
    "follow": "Follow.json",
    "library": "YourLibrary.json",
    "wrapped": "Wrapped*.json",
    "playback_errors": "PlaybackError.json",
    "playback_retries": "PlaybackRetry.json",
    "webapi_events": "WebapiEvent.json",
}
TECH_TABLES = ["playback_errors", "playback_retries", "webapi_events"]


def read_records(spark: SparkSession, folder: str, pattern: str, schema: str, array: bool = True) -> DataFrame:
    """All records of the matching files, each one JSON array (or objects one after another),
    in splits: a large file is read by many tasks."""
    found = arrays.records(spark, folder, pattern, array)
    return found.select(F.from_json("value", f"STRUCT<{schema}>").alias("r")).select("r.*")


def basic_history(records: DataFrame, minimum: int = schemas.MIN_PLAY_MS) -> DataFrame:
    plays = records.where(times.meaningful_play(F.col("msPlayed"), minimum=minimum)).select(
        F.to_timestamp("endTime", "yyyy-MM-dd HH:mm").alias("timestamp"),
        F.col("artistName").alias("artist_name"),
        F.col("trackName").alias("track_name"),
        F.col("msPlayed").alias("ms_played"),
    )
    return times.with_time_parts(plays).withColumn("source", F.lit("basic"))


def extended_history(records: DataFrame, minimum: int = schemas.MIN_PLAY_MS) -> DataFrame:
    """Other export columns pass through."""
    skipped = F.col("skipped") if "skipped" in records.columns else None
    kept = records.where(times.meaningful_play(F.col("ms_played"), skipped, minimum))
    named = kept.withColumnsRenamed(
        {
            "ts": "timestamp",
            "master_metadata_track_name": "track_name",
            "master_metadata_album_artist_name": "artist_name",
            "master_metadata_album_album_name": "album_name",
            "spotify_track_uri": "track_uri",
        }
    ).withColumn("timestamp", F.to_timestamp("timestamp"))
    return times.with_time_parts(named).withColumn("source", F.lit("extended"))


def load_basic(spark: SparkSession, folder: str, pattern: str = FILES["basic"]) -> DataFrame:
    return basic_history(read_records(spark, folder, pattern, schemas.BASIC_HISTORY))


def load_extended(spark: SparkSession, folder: str, pattern: str = FILES["extended"]) -> DataFrame:
    return extended_history(read_records(spark, folder, pattern, schemas.EXTENDED_HISTORY))


def search_queries(records: DataFrame) -> DataFrame:
    stripped = F.regexp_replace("searchTime", r"\[UTC\]$", "")
    parsed = records.withColumn("timestamp", F.try_to_timestamp(stripped)).drop("searchTime")
    return parsed.withColumns(
        {
            "date": F.to_date("timestamp"),
            "hour": F.hour("timestamp"),
            "month": times.month_label(F.col("timestamp")),
        }
    )


def load_search(spark: SparkSession, folder: str, pattern: str = FILES["search"]) -> DataFrame:
    return search_queries(read_records(spark, folder, pattern, schemas.SEARCH_FILE))


def follow_data(records: DataFrame) -> DataFrame:
    """(user, relationship) from the three lists."""
    def pairs(kind: str, field: str) -> Column:
        users = F.coalesce(F.col(field), F.array().cast("array<string>"))
        return F.transform(users, lambda u: F.struct(u.alias("user"), F.lit(kind).alias("relationship")))

    everyone = F.concat(
        pairs("following", "userIsFollowing"),
        pairs("followed_by", "userIsFollowedBy"),
        pairs("blocking", "userIsBlocking"),
    )
    return records.select(F.inline(everyone))


def load_follow(spark: SparkSession, folder: str, pattern: str = FILES["follow"]) -> DataFrame:
    return follow_data(read_records(spark, folder, pattern, schemas.FOLLOW_FILE, array=False))


def library_snapshot(records: DataFrame) -> DataFrame:
    t = F.col("t")

    def text(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    added = F.try_to_timestamp(t["addedAt"])
    return records.select(F.explode("tracks").alias("t")).select(
        text(t["uri"]).alias("track_uri"),
        text(t["name"]).alias("track_name"),
        text(t["artist"]["name"]).alias("artist_name"),
        text(t["album"]["name"]).alias("album_name"),
        added.alias("added_at"),
        F.to_date(added).alias("added_date"),
        uri_item(text(t["uri"])).alias("track_id"),
    )


def load_library(spark: SparkSession, folder: str, pattern: str = FILES["library"]) -> DataFrame:
    return library_snapshot(read_records(spark, folder, pattern, schemas.LIBRARY_FILE, array=False))


def tech_log(records: DataFrame) -> DataFrame:
    """Time from ``timestamp_utc`` when the log has it anywhere, else from ``context_time``."""
    has_text = records.agg(F.max(F.col("timestamp_utc").isNotNull()).alias("x")).scalar()
    parsed = F.when(has_text, F.try_to_timestamp("timestamp_utc")).otherwise(
        F.timestamp_millis("context_time")
    )
    stamped = records.withColumn("timestamp", parsed)
    return stamped.withColumns(
        {"date": F.to_date("timestamp"), "month": times.month_label(F.col("timestamp"))}
    )


def load_tech_log(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return tech_log(read_records(spark, folder, pattern, schemas.TECH_LOG))


def load_wrapped(
    spark: SparkSession, folder: str, preferred: str = "Wrapped2024.json", pattern: str = FILES["wrapped"]
) -> DataFrame:
    """(file, body): the preferred year if present, else the first file by name."""
    below, _, names = pattern.rpartition("/")
    texts = (
        spark.read.option("pathGlobFilter", names)
        .text(f"{folder}/{below}" if below else folder, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))
    )
    return texts.orderBy((F.col("file") != preferred).cast("int"), "file").limit(1)
