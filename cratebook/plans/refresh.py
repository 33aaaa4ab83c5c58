"""Incremental refresh from snapshots: what changed, and the next table version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook.operators.library import keep_in, keep_not_in
from cratebook.operators.selection import concat_replace


def snapshot_diff(playlists: DataFrame, state: DataFrame, force: bool = False) -> DataFrame:
    """(playlist_id, status): new, changed, unchanged, or removed.

    With ``force`` every present collection counts as changed.
    """
    now = playlists.select("playlist_id", F.col("snapshot_id").alias("now"), F.lit(True).alias("here"))
    then = state.select("playlist_id", F.col("snapshot_id").alias("then"), F.lit(True).alias("known"))
    status = (
        F.when(F.col("here").isNull(), "removed")
        .when(F.col("known").isNull(), "new")
        .when(F.lit(force) | ~F.col("now").eqNullSafe(F.col("then")), "changed")
        .otherwise("unchanged")
    )
    return now.join(then, "playlist_id", "full").select("playlist_id", status.alias("status"))


@dataclass(frozen=True)
class Refresh:
    """``members`` is the next version, to be written to a new place; ``state`` goes with it."""

    members: DataFrame
    state: DataFrame
    counts: DataFrame


def incremental_refresh(
    playlists: DataFrame,
    state: DataFrame,
    members: DataFrame,
    fetched: DataFrame,
    as_of: str,
    force: bool = False,
    keep_removed: bool = False,
) -> Refresh:
    """Replace the memberships of new and changed collections by ``fetched`` rows.

    Tables derived from memberships are rebuilt from the new version. Memberships of
    removed collections go too, unless ``keep_removed``.
    """
    diff = snapshot_diff(playlists, state, force)
    touched = diff.where(F.col("status").isin("new", "changed"))
    replaced = touched if keep_removed else diff.where(F.col("status") != "unchanged")
    fresh = keep_in(fetched, touched, "playlist_id")
    next_members = concat_replace(members, fresh, replaced)
    next_state = playlists.select(
        "playlist_id", "snapshot_id", F.lit(as_of).cast("timestamp").alias("synced_at")
    )

    def count(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    new_keys = ["playlist_id", "track_id"]
    counts = diff.agg(
        F.count_if(F.col("status") != "removed").alias("checked"),
        F.count_if(F.col("status").isin("new", "changed")).alias("updated"),
        F.count_if(F.col("status") == "removed").alias("removed"),
    ).withColumns(
        {
            "rows_written": count(fresh),
            "net_added": count(keep_not_in(fresh.select(*new_keys).distinct(), members, new_keys)),
        }
    )
    return Refresh(next_members, next_state, counts)
