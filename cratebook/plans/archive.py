"""Archive planning: what to create, what to add, what may go.

Plans are tables of rows to add; nothing is written anywhere else. The order of
items is kept as data in the order columns of each plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.functions import names, texts, times
from cratebook.functions.names import NameStyle
from cratebook.operators import plays
from cratebook.operators.grouping import top_rows
from cratebook.operators.library import keep_in, keep_not_in
from cratebook.operators.selection import delta_add
from cratebook.session import cut_lineage

DEFAULT_STYLE = NameStyle()


def name_ids(playlists: DataFrame) -> DataFrame:
    """(name, playlist_id): of equal names the last collection is meant."""
    return playlists.where(F.col("name").isNotNull()).groupBy("name").agg(
        F.max("playlist_id").alias("playlist_id")
    )


def upsert_plan(desired: DataFrame, playlists: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of ``desired`` (name, track_uri, ...) to add, each with its ``action``.

    ``create`` when no collection has the name, else ``add`` for missing items. The
    desired rows are written once; of the memberships only those of the named
    collections are compared.
    """
    located = cut_lineage(desired.join(name_ids(playlists), "name", "left"))
    existing = keep_in(members, located.where(F.col("playlist_id").isNotNull()), "playlist_id")
    missing = delta_add(located, existing, on=["playlist_id", "track_uri"])
    return missing.withColumn("action", F.when(F.col("playlist_id").isNull(), "create").otherwise("add"))


def liked_by_period(liked: DataFrame, cutoff: str | None = None, since: str | None = None) -> DataFrame:
    """Liked items per month and per year, each item once per period at its first place.

    Columns: period_type, period, track_uri, added_at, position. Months after ``cutoff`` and
    before ``since`` (``yyyy-MM``) are left out of both, as a range of times.
    """
    added = times.in_months(liked, "added_at", since, cutoff).withColumn("month", times.month_label(F.col("added_at")))
    periods = F.array(
        F.struct(F.lit("monthly").alias("period_type"), F.col("month").alias("period")),
        F.struct(F.lit("yearly").alias("period_type"), F.substring("month", 1, 4).alias("period")),
    )
    both = added.select("track_uri", "added_at", "position", F.inline(periods))
    return plays.ordered_distinct(both, ["period_type", "period"], ["added_at", "position"])


def monthly_plan(
    liked: DataFrame,
    playlists: DataFrame,
    members: DataFrame,
    as_of: str,
    months: int = 3,
    style: NameStyle = DEFAULT_STYLE,
) -> tuple[DataFrame, DataFrame]:
    """(headers, rows) for the last ``months`` calendar months, the current included.

    A month without liked items still has a header.
    """
    labels = [times.months_back(as_of, k) for k in range(months)]
    calendar = liked.sparkSession.createDataFrame([(label,) for label in labels], "period string")
    calendar = calendar.withColumn("name", names.archive_name("monthly", month=F.col("period"), style=style))
    recent = times.in_months(liked, "added_at", labels[-1], labels[0]) if labels else liked.where("false")
    month = times.month_label(F.col("added_at")).alias("period")
    by_month = plays.ordered_distinct(recent.select("track_uri", "added_at", "position", month), ["period"], ["added_at", "position"])
    rows = upsert_plan(calendar.join(by_month, "period"), playlists, members)
    sizes = by_month.groupBy("period").agg(F.count(F.lit(1)).alias("items"))
    added = rows.groupBy("period").agg(F.count(F.lit(1)).alias("to_add"))
    headers = (
        calendar.join(name_ids(playlists), "name", "left")
        .join(sizes, "period", "left")
        .join(added, "period", "left")
        .select(
            "period",
            "name",
            "playlist_id",
            F.when(F.col("playlist_id").isNull(), "create").otherwise("add").alias("action"),
            F.coalesce("items", F.lit(0)).alias("items"),
            F.coalesce("to_add", F.lit(0)).alias("to_add"),
        )
    )
    return headers, rows


def current_year_plan(
    liked: DataFrame,
    history: DataFrame,
    playlists: DataFrame,
    members: DataFrame,
    as_of: str,
    liked_scope: str = "all",
    limit: int = 100,
    style: NameStyle = DEFAULT_STYLE,
) -> DataFrame:
    """Additions to the three archives of the current year.

    ``liked_scope="all"`` takes every liked item, ``"year"`` only this year's.
    """
    start = F.trunc(F.lit(as_of).cast("date"), "year")
    year = F.year(start)

    def in_year(df: DataFrame, column: str) -> DataFrame:
        # A range in the column's own type, so that a scan can use it.
        kind = dict(df.dtypes)[column]
        return df.where((F.col(column) >= start.cast(kind)) & (F.col(column) < F.add_months(start, 12).cast(kind)))

    if liked_scope == "year":
        liked = in_year(liked, "added_at")
    finds = plays.ordered_distinct(liked, [], ["added_at", "position"]).select(
        F.lit("monthly").alias("type"), "track_uri", F.col("position").alias("rank")
    )
    this_year = in_year(history, "timestamp")
    best = top_rows(plays.play_stats(this_year), plays.ranking("track_uri"), limit)
    top = best.where(F.col("track_uri") != "").select(F.lit("most_played").alias("type"), "track_uri", "rank")
    firsts = top_rows(plays.first_plays(this_year), ["first_play", "track_uri"], limit)
    fresh = firsts.select(F.lit("discovery").alias("type"), "track_uri", "rank")
    desired = finds.unionByName(top).unionByName(fresh)
    kind = F.col("type")
    name: Column = F.lit(None).cast("string")
    for key in ("monthly", "most_played", "discovery"):
        fixed = names.archive_name("yearly" if key == "monthly" else key, year=year, style=style)
        name = F.when(kind == key, fixed).otherwise(name)
    return upsert_plan(desired.withColumn("name", name), playlists, members)


@dataclass(frozen=True)
class ArchivePlan:
    """``rows`` to add, and the monthly collections that may be deleted afterwards."""

    rows: DataFrame
    deletable: DataFrame


def _yearly_name(kind: Column, year: Column, style: NameStyle) -> Column:
    options = {
        "monthly": names.archive_name("yearly", year=year, style=style),
        "most_played": names.archive_name("most_played", year=year, style=style),
        "discovery": names.archive_name("discovery", year=year, style=style),
    }
    result = F.lit(None).cast("string")
    for key, text in options.items():
        result = F.when(kind == key, text).otherwise(result)
    return result


def archive_plan(
    playlists: DataFrame,
    members: DataFrame,
    liked: DataFrame,
    history: DataFrame,
    as_of: str,
    keep_months: int = 3,
    limit: int = 100,
    style: NameStyle = DEFAULT_STYLE,
) -> ArchivePlan:
    """Yearly archives per type. A type takes the items of its old monthly collections;
    without any, liked items by year (monthly), the year's most played or its first
    plays. Only existing archives of years with monthly collections are extended.

    Row order: ``plays`` descending (for most played built from monthly collections),
    then ``source_id``, then ``place``.
    """
    cutoff = times.months_back(as_of, keep_months)
    parts = names.auto_name_parts(F.col("name"), style.owner, style.prefixes)
    # Of equal names only the last collection is known by that name. These are few: written, so
    # that joins know their size and memberships need not be shuffled to find theirs.
    monthly = cut_lineage(
        name_ids(playlists)
        .select("playlist_id", "name", parts.alias("p"))
        .where(F.col("p").isNotNull() & (F.col("p.period") <= cutoff))
        .select(F.col("playlist_id").alias("source_id"), F.col("p.type").alias("type"), F.col("p.year").alias("year"))
    )
    nothing = F.lit(None).cast("bigint")

    content = members.select(F.col("playlist_id").alias("source_id"), "track_uri", F.col("position").alias("place"))
    from_monthly = plays.ordered_distinct(
        monthly.join(content, "source_id"), ["year", "type"], ["source_id", "place"]
    )
    yearly_counts = plays.play_stats(history.withColumn("year", F.year("timestamp")), "year")
    counted = (
        from_monthly.join(yearly_counts.select("year", "track_uri", "play_count"), ["year", "track_uri"], "left")
        .withColumn(
            "plays",
            F.when(F.col("type") == "most_played", F.coalesce("play_count", F.lit(0))).otherwise(0),
        )
        .select("year", "type", "track_uri", "plays", "source_id", "place")
    )

    by_year = times.in_months(liked, "added_at", last=cutoff).withColumn("year", F.year(F.col("added_at").cast("timestamp")))
    liked_rows = plays.ordered_distinct(by_year, ["year"], ["added_at", "position"])
    with_year = history.withColumn("year", F.year("timestamp"))
    fallback = (
        liked_rows.select("year", F.lit("monthly").alias("type"), "track_uri", F.col("position").alias("place"))
        .unionByName(
            plays.most_played_by(with_year, "year", limit).select(
                "year", F.lit("most_played").alias("type"), "track_uri", F.col("rank").alias("place")
            )
        )
        .unionByName(
            plays.discovery_by_year(history, limit).select(
                "year", F.lit("discovery").alias("type"), "track_uri", F.col("rank").alias("place")
            )
        )
    )
    # The monthly collections win for their whole (year, type).
    spare = keep_not_in(fallback, from_monthly, ["year", "type"]).select(
        "year", "type", "track_uri", F.lit(0).cast("bigint").alias("plays"), nothing.alias("source_id"), "place"
    )
    desired = counted.unionByName(spare).withColumn(
        "name", _yearly_name(F.col("type"), F.col("year"), style)
    )
    with_monthly = monthly.select("year").distinct().withColumn("has_monthly", F.lit(True))
    existing = name_ids(playlists).select("name", F.lit(True).alias("exists"))
    open_rows = (
        desired.join(existing, "name", "left")
        .join(with_monthly, "year", "left")
        .where(F.col("exists").isNull() | F.col("has_monthly"))
        .drop("exists", "has_monthly")
    )
    rows = upsert_plan(open_rows, playlists, members)

    # A monthly collection may go when each of its items is in its archive afterwards.
    targets = monthly.select("year", "type").distinct().withColumn("name", _yearly_name(F.col("type"), F.col("year"), style))
    target_items = (
        cut_lineage(targets.join(name_ids(playlists), "name"))
        .join(members.select("playlist_id", "track_uri"), "playlist_id")
        .select("year", "type", "track_uri")
        .unionByName(rows.select("year", "type", "track_uri"))
    )
    wanted = monthly.join(content.select("source_id", "track_uri"), "source_id").distinct()
    lost = keep_not_in(wanted, target_items, ["year", "type", "track_uri"])
    return ArchivePlan(rows, keep_not_in(monthly, lost, "source_id"))


def rename_plan(playlists: DataFrame, changes: dict[str, str]) -> DataFrame:
    """(playlist_id, old_name, new_name) for names with an old prefix.

    A target name that exists already, or that two collections would get, is
    skipped; in the second case the lowest id is renamed.
    """
    known = name_ids(playlists)
    proposed = known.select(
        "playlist_id", F.col("name").alias("old_name"), names.renamed(F.col("name"), changes).alias("name")
    ).where(F.col("name").isNotNull() & (F.col("name") != F.col("old_name")))
    free = keep_not_in(proposed, known, "name")
    return free.groupBy(F.col("name").alias("new_name")).agg(
        F.min(F.struct("playlist_id", "old_name")).alias("first")
    ).select("first.playlist_id", "first.old_name", "new_name")


def description_delta(
    playlists: DataFrame,
    members: DataFrame,
    state: DataFrame,
    owner: str = names.OWNER,
    prefixes: dict[str, str] | None = None,
    compose: bool = True,
) -> DataFrame:
    """Changed descriptions of collections that have items and a new snapshot.

    The first line is kept; an empty line or the bare name is replaced by what an
    automated name says, or by the name.
    """
    seen = state.select("playlist_id", F.col("snapshot_id").alias("seen"))
    due = playlists.join(seen, "playlist_id", "left").where(
        F.col("snapshot_id").isNull() | ~F.col("snapshot_id").eqNullSafe(F.col("seen"))
    )
    filled = due.join(members.select("playlist_id").distinct(), "playlist_id", "left_semi")
    line = F.trim(F.substring_index(F.trim("description"), "\n", 1))
    derived = texts.base_line(F.col("name"), owner, prefixes)
    base = F.when(
        (F.col("line") == "") | (F.col("line") == F.trim("name")), F.coalesce(derived, F.col("name"))
    ).otherwise(F.col("line"))
    # One step per column: a single nested expression would be too large to compile.
    return (
        filled.select("playlist_id", "name", F.coalesce("description", F.lit("")).alias("description"), "snapshot_id")
        .withColumn("line", line)
        .withColumn("base", F.trim(base))
        .withColumn("simple", texts.simple_description(F.col("base")))
        .withColumn("new_description", texts.publishable_description(F.col("simple"), compose=compose))
        .where((F.trim("new_description") != "") & (F.col("new_description") != F.col("description")))
        .select("playlist_id", "name", "description", "new_description", "snapshot_id")
    )
