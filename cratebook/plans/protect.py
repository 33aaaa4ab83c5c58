"""Backups, restore plans and gates before anything is deleted.

A backup is kept as one row per item: a collection of any size fits, and a
restore reads only its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook.functions import times
from cratebook.operators.library import keep_in, keep_not_in
from cratebook.operators.selection import preservation_check


def backup_snapshot(
    playlists: DataFrame, members: DataFrame, as_of: str, reason: str = "before_change"
) -> tuple[DataFrame, DataFrame]:
    """(records, items) of every collection in ``playlists``; keyed by ``backup_id``."""
    stamp = F.lit(as_of).cast("timestamp")
    backup_id = F.concat(
        F.col("playlist_id").cast("string"), F.lit("_"), F.date_format(stamp, "yyyyMMdd_HHmmss")
    )
    sizes = members.groupBy("playlist_id").agg(F.count(F.lit(1)).alias("track_count"))
    optional = [c for c in ("description", "public", "collaborative") if c in playlists.columns]
    records = playlists.select("playlist_id", "name", *optional).join(sizes, "playlist_id", "left").select(
        backup_id.alias("backup_id"),
        "playlist_id",
        F.col("name").alias("playlist_name"),
        *optional,
        F.coalesce("track_count", F.lit(0)).cast("bigint").alias("track_count"),
        stamp.alias("backup_timestamp"),
        F.to_date(stamp).alias("backup_date"),
        F.lit(reason).alias("backup_reason"),
    )
    items = keep_in(members, playlists, "playlist_id").select(
        backup_id.alias("backup_id"), "playlist_id", "track_uri", "position", F.to_date(stamp).alias("backup_date")
    )
    return records, items


def write_backup(records: DataFrame, items: DataFrame, path: str) -> None:
    """Append below ``path``, one folder per backup date."""
    for name, df in (("records", records), ("items", items)):
        df.write.mode("append").partitionBy("backup_date").parquet(f"{path}/{name}")


def restore_plan(
    records: DataFrame, items: DataFrame, backup_id: str | None = None, target_id: object = None
) -> DataFrame:
    """Rows that restore one backup, or every backup given, each into its own
    collection or into ``target_id``."""
    if backup_id is not None:
        records = records.where(F.col("backup_id") == backup_id)
        items = items.where(F.col("backup_id") == backup_id)
    target = F.col("playlist_id") if target_id is None else F.lit(target_id)
    return items.join(records.select("backup_id", "playlist_name"), "backup_id").select(
        target.alias("playlist_id"), "playlist_name", "track_uri", "position"
    )


def restore_counts(plan: DataFrame, members: DataFrame) -> DataFrame:
    """Dry run: what a restore would bring back and what it would clear."""
    current = keep_in(members, plan, "playlist_id").select("playlist_id", "track_uri")
    ours = plan.groupBy("playlist_id").agg(F.count(F.lit(1)).alias("to_restore"))
    theirs = current.groupBy("playlist_id").agg(F.count(F.lit(1)).alias("to_clear"))
    return ours.join(theirs, "playlist_id", "left").withColumn(
        "to_clear", F.coalesce("to_clear", F.lit(0))
    )


def list_backups(records: DataFrame, playlist_id: object = None, limit: int = 20) -> DataFrame:
    if playlist_id is not None:
        records = records.where(F.col("playlist_id") == playlist_id)
    return records.orderBy(F.desc("backup_timestamp"), "backup_id").limit(limit)


def expired_backups(records: DataFrame, as_of: str, keep_days: int = 30) -> DataFrame:
    return records.where(F.col("backup_timestamp") < times.days_before(as_of, keep_days))


def retained_backups(records: DataFrame, as_of: str, keep_days: int = 30) -> DataFrame:
    return records.where(F.col("backup_timestamp") >= times.days_before(as_of, keep_days))


def delete_verdicts(requests: DataFrame, members: DataFrame) -> DataFrame:
    """Verdict per request (playlist_id, target_id): every item must be in the target.

    Without a target nothing has to be preserved. Returns missing counts and ``allowed``.
    """
    ours = members.select("playlist_id", "track_id").dropna().distinct()
    wanted = requests.where(F.col("target_id").isNotNull()).join(ours, "playlist_id")
    targets = ours.withColumnRenamed("playlist_id", "target_id")
    missing = (
        keep_not_in(wanted, keep_in(targets, requests, "target_id"), ["target_id", "track_id"])
        .groupBy("playlist_id", "target_id")
        .agg(F.count(F.lit(1)).alias("missing"))
    )
    # Its own copy must outlive it: a target that is itself deleted is no target.
    doomed = requests.select(F.col("playlist_id").alias("target_id")).distinct().withColumn("doomed", F.lit(True))
    return (
        requests.join(missing, ["playlist_id", "target_id"], "left")
        .join(doomed, "target_id", "left")
        .select(
            "playlist_id",
            "target_id",
            F.coalesce("missing", F.lit(0)).alias("missing"),
            F.coalesce("doomed", F.lit(False)).alias("target_also_deleted"),
        )
        .withColumn("allowed", (F.col("missing") == 0) & ~F.col("target_also_deleted"))
    )


def apply_deletes(members: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Next version of the memberships without the collections allowed to go."""
    return keep_not_in(members, verdicts.where("allowed"), "playlist_id")


def safe_remove(
    members: DataFrame, removals: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(next members, verdicts) after removing (playlist_id, track_id) rows.

    Removing takes all occurrences; the verdict is the preservation check.
    """
    after = keep_not_in(members, removals, ["playlist_id", "track_id"])
    touched = keep_in(members, removals, "playlist_id")
    verdicts = preservation_check(
        before=touched, after=keep_in(after, removals, "playlist_id"), expected_removals=keep_in(
            removals, touched, ["playlist_id", "track_id"]
        )
    )
    return after, verdicts
