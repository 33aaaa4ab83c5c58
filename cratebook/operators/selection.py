"""Choosing, merging and mixing items of collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.functions import music
from cratebook.operators.grouping import counted_row_number
from cratebook.operators.library import keep_in, keep_not_in
from cratebook.operators.statistics import earliest_added


def random_order(item: Column, seed: int) -> Column:
    """Reproducible order that does not depend on partitions."""
    return F.xxhash64(F.lit(seed), item)


def positions_to_remove(playlist_tracks: DataFrame) -> DataFrame:
    """Every occurrence of an item in a collection except its lowest position.

    The first position is an aggregate and is joined back, so an item that fills
    a third of the table is never sorted in one task.
    """
    first = playlist_tracks.groupBy("playlist_id", "track_id").agg(
        F.min("position").alias("first_position"), F.count(F.lit(1)).alias("n")
    )
    doubled = first.where(F.col("n") > 1).drop("n")
    return (
        playlist_tracks.join(doubled, ["playlist_id", "track_id"])
        .where(F.col("position") > F.col("first_position"))
        .select("playlist_id", "track_id", "position")
    )


def representative_item(
    playlist_tracks: DataFrame,
    tracks: DataFrame,
    strategy: str = "most_popular",
    seed: int = 42,
    order: Column | None = None,
) -> DataFrame:
    """One item per collection: most_popular, most_recent, first or random.

    Ties go to the lower position. ``order`` replaces the random order.
    """
    members = playlist_tracks.select("playlist_id", "track_id", "added_at", "position")
    at = -F.col("position")
    if strategy == "most_popular":
        members = members.join(tracks.select("track_id", "popularity"), "track_id", "left")
        weight = F.struct(F.coalesce("popularity", F.lit(-1)), at)
    elif strategy == "most_recent":
        weight = F.struct("added_at", at)
    elif strategy == "random":
        weight = F.struct(random_order(F.col("track_id"), seed) if order is None else order, at)
    else:
        weight = F.struct(at)
    return members.groupBy("playlist_id").agg(F.max_by("track_id", weight).alias("track_id"))


def time_capsule(
    liked: DataFrame, tracks: DataFrame, year: int, count: int = 50, seed: int = 42, order: Column | None = None
) -> DataFrame:
    """Liked tracks released in ``year``, up to ``count`` in random order."""
    chosen = tracks.where(music.release_year(F.col("release_date")) == year)
    return _draw(keep_in(chosen, liked, "track_id"), count, seed, order)


# Genres of each theme.
THEMES = {
    "workout": ["Hip-Hop", "Electronic", "Dance", "Rock"],
    "study": ["Classical", "Jazz", "Electronic", "Ambient"],
    "chill": ["R&B/Soul", "Jazz", "Indie", "Folk"],
    "party": ["Dance", "Electronic", "Hip-Hop", "Pop"],
    "roadtrip": ["Rock", "Pop", "Country/Folk", "Hip-Hop"],
}


def theme_selection(
    liked: DataFrame,
    tracks: DataFrame,
    track_artists: DataFrame,
    artists: DataFrame,
    genres: Sequence[str],
    count: int = 50,
    seed: int = 42,
    order: Column | None = None,
    case_insensitive: bool = False,
) -> DataFrame:
    """Liked tracks whose own or artists' genres meet ``genres``."""
    wanted = [g.lower() for g in genres] if case_insensitive else list(genres)
    listed = F.array(*[F.lit(g) for g in wanted])

    def hits(column: str) -> Column:
        values = F.col(column)
        if case_insensitive:
            values = F.transform(values, lambda g: F.lower(g))
        return F.coalesce(F.arrays_overlap(values, listed), F.lit(False))

    mine = keep_in(tracks, liked, "track_id")
    by_artist = keep_in(track_artists, artists.where(hits("genres")), "artist_id")
    matching = (
        mine.where(hits("genres")).select("track_id").unionByName(by_artist.select("track_id"))
    )
    return _draw(keep_in(mine, matching, "track_id"), count, seed, order)


def _draw(df: DataFrame, count: int, seed: int, order: Column | None) -> DataFrame:
    key = random_order(F.col("track_id"), seed) if order is None else order
    return df.orderBy(key, "track_id").limit(count)


def delta_add(
    desired: DataFrame, existing: DataFrame, on: str | Sequence[str] = "track_uri", item: str = "track_uri"
) -> DataFrame:
    """Desired rows not present yet; missing and empty items are left out."""
    return keep_not_in(desired.where(F.col(item) != ""), existing, on)


def merge_collections(
    playlist_tracks: DataFrame, groups: DataFrame, keep: str = "earliest"
) -> DataFrame:
    """Merge the collections of each group. ``groups`` is (group_id, playlist_id, ordinal).

    The target is the member with the earliest ``added_at`` (``keep="earliest"``,
    ties by ordinal) or a new collection (``keep="new"``, first given first).
    Returns (group_id, target_id, track_id, source_id, action): ``keep`` for items
    the target has, ``add`` for items that come from ``source_id``. Works on any
    number of groups and members at once.
    """
    if keep == "earliest":
        ages = groups.join(earliest_added(playlist_tracks), "playlist_id", "left")
        rank = F.struct(F.col("earliest").isNull(), "earliest", "ordinal")
    else:
        ages, rank = groups, F.struct("ordinal")
    targets = ages.groupBy("group_id").agg(F.min_by("playlist_id", rank).alias("target_id"))
    members = playlist_tracks.select("playlist_id", "track_id").distinct().join(groups, "playlist_id")
    marked = members.join(targets, "group_id").withColumn(
        "place",
        F.struct((F.col("playlist_id") != F.col("target_id")).alias("other"), "ordinal", "playlist_id"),
    )
    # One row per item of the union: from the target if it has it, else from the
    # first source in the given order.
    merged = marked.groupBy("group_id", "target_id", "track_id").agg(
        F.min("place").alias("place"), F.count(F.lit(1)).alias("copies")
    )
    return merged.select(
        "group_id",
        "target_id",
        "track_id",
        F.col("place.playlist_id").alias("source_id"),
        F.when(F.col("place.other"), "add").otherwise("keep").alias("action"),
        "copies",
    )


def merge_report(merged: DataFrame) -> DataFrame:
    """Per group: items added, items that were in several members, final size."""
    return merged.groupBy("group_id", "target_id").agg(
        F.count_if(F.col("action") == "add").alias("added"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
        F.count(F.lit(1)).alias("final_count"),
    )


def preservation_check(
    before: DataFrame,
    after: DataFrame,
    expected_additions: DataFrame | None = None,
    expected_removals: DataFrame | None = None,
    key: str = "playlist_id",
    item: str = "track_id",
) -> DataFrame:
    """Per collection: unexpected removals, missing additions, and the verdict."""

    def flags(df: DataFrame | None, name: str) -> DataFrame:
        if df is None:
            df = before.limit(0)
        return df.select(key, item, F.lit(1).alias(name)).distinct()

    # One full join on (collection, item) answers every question.
    both = flags(before, "was").join(flags(after, "is"), [key, item], "full")
    for df, name in ((expected_additions, "to_add"), (expected_removals, "to_remove")):
        both = both.join(flags(df, name), [key, item], "full")
    lost = F.col("was").isNotNull() & F.col("is").isNull() & F.col("to_remove").isNull()
    missing = F.col("to_add").isNotNull() & F.col("is").isNull()
    counts = both.groupBy(key).agg(
        F.count("was").alias("before_count"),
        F.count("is").alias("after_count"),
        F.count("to_remove").alias("removals"),
        F.count_if(lost).alias("unexpected_removals"),
        F.count_if(missing).alias("missing_additions"),
    )
    shrunk = F.col("after_count") < F.col("before_count") - F.col("removals")
    return counts.withColumn("count_decrease", shrunk).withColumn(
        "preserved",
        (F.col("unexpected_removals") == 0) & (F.col("missing_additions") == 0) & ~shrunk,
    )


def concat_replace(old: DataFrame, fresh: DataFrame, changed: DataFrame, key: str = "playlist_id") -> DataFrame:
    """Old rows of unchanged keys together with the fresh rows."""
    return keep_not_in(old, changed, key).unionByName(fresh, allowMissingColumns=True)


def mix_collections(
    playlist_tracks: DataFrame,
    chosen: DataFrame,
    strategy: str = "balanced",
    seed: int = 42,
    order: Column | None = None,
) -> DataFrame:
    """Union of the chosen collections in the given order, first occurrence wins.

    ``chosen`` is (playlist_id, ordinal). Strategies: balanced (equal quota), weighted
    (quota by collection size), shuffled, chronological. Returns (track_id,
    playlist_id, ordinal, rank) where rank orders the items inside their source; for
    shuffled and chronological sort by ``sort_key``.
    """
    first_at = playlist_tracks.join(chosen, "playlist_id").groupBy("playlist_id", "ordinal", "track_id").agg(
        F.min("position").alias("position"), F.min("added_at").alias("added_at")
    )
    sizes = first_at.groupBy("playlist_id", "ordinal").agg(F.count(F.lit(1)).alias("size"))
    unique = first_at.groupBy("track_id").agg(
        F.min(F.struct("ordinal", "playlist_id", "position", "added_at")).alias("s")
    ).select("track_id", "s.*")
    if strategy == "shuffled":
        key = random_order(F.col("track_id"), seed) if order is None else order
        return unique.select("track_id", "playlist_id", "ordinal", key.alias("sort_key"))
    if strategy == "chronological":
        return unique.select("track_id", "playlist_id", "ordinal", F.col("added_at").alias("sort_key"))
    total = unique.agg(F.count(F.lit(1)).alias("n")).scalar()
    if strategy == "balanced":
        members = sizes.agg(F.count(F.lit(1)).alias("n")).scalar()
        quota = F.floor(total / members)
    else:
        all_sizes = sizes.agg(F.sum("size").alias("n")).scalar()
        quota = F.floor(total * (F.col("size") / all_sizes))
    ranked = counted_row_number(
        unique, ["playlist_id"], F.expr("position div 1000"), ["position"], name="rank"
    )
    return (
        ranked.join(sizes.select("playlist_id", "size"), "playlist_id")
        .where(F.col("rank") <= quota)
        .select("track_id", "playlist_id", "ordinal", "rank")
    )
