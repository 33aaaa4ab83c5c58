"""Listening history: rankings, first plays, patterns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.functions import times
from cratebook.functions.music import uri_item
from cratebook.operators.grouping import counted_row_number, top_per_group, top_rows


def ranking(item: str) -> list[Column]:
    return [F.desc("play_count"), F.desc("total_ms"), F.col(item).asc()]


def play_stats(history: DataFrame, *keys: str, item: str = "track_uri") -> DataFrame:
    """Plays (with a length) and total length per track, and per extra key."""
    return (
        history.where(F.col(item).isNotNull())
        .groupBy(*keys, item)
        .agg(F.count("ms_played").alias("play_count"), F.coalesce(F.sum("ms_played"), F.lit(0)).alias("total_ms"))
    )


def _in_month(history: DataFrame, month: str | None) -> DataFrame:
    """A month becomes a time range, which a scan can push down."""
    if month is None:
        return history
    kind = dict(history.dtypes)["timestamp"]
    start = F.lit(f"{month}-01 00:00:00").cast(kind)
    return history.where(
        (F.col("timestamp") >= start) & (F.col("timestamp") < F.add_months(start, 1).cast(kind))
    )


def _usable(df: DataFrame, item: str) -> DataFrame:
    return df.where(F.col(item) != "")


def most_played(
    history: DataFrame, month: str | None = None, limit: int = 50, item: str = "track_uri"
) -> DataFrame:
    """Best ``limit`` tracks; an empty track is dropped after the cut."""
    best = play_stats(_in_month(history, month), item=item).orderBy(*ranking(item)).limit(limit)
    return _usable(best, item)


def most_played_by(
    history: DataFrame, period: str, limit: int = 50, item: str = "track_uri"
) -> DataFrame:
    """Best tracks of every period at once. ``period`` is a column of ``history``."""
    stats = play_stats(history.where(F.col(period).isNotNull()), period, item=item)
    return _usable(top_per_group(stats, [period], ranking(item), limit), item)


def daypart_top(
    history: DataFrame, part: str, month: str | None = None, limit: int = 50, item: str = "track_uri"
) -> DataFrame:
    chosen = _in_month(history, month).where(times.in_daypart(F.col("timestamp"), part))
    return most_played(chosen, None, limit, item)


def repeat_items(
    history: DataFrame,
    month: str | None = None,
    min_repeats: int = 3,
    limit: int = 50,
    item: str = "track_uri",
) -> DataFrame:
    counts = (
        _in_month(history, month)
        .where(F.col(item).isNotNull())
        .groupBy(item)
        .agg(F.count(F.lit(1)).alias("play_count"))
        .where(F.col("play_count") >= min_repeats)
    )
    return _usable(counts.orderBy(F.desc("play_count"), item).limit(limit), item)


def first_plays(history: DataFrame, *keys: str, item: str = "track_uri") -> DataFrame:
    """First play per track (and extra key): an aggregate, so a track that holds a
    third of all plays is reduced before the shuffle."""
    return (
        history.where(F.col(item).isNotNull())
        .groupBy(*keys, item)
        .agg(F.min("timestamp").alias("first_play"))
    )


def discovery(
    history: DataFrame, month: str | None = None, limit: int = 50, item: str = "track_uri"
) -> DataFrame:
    """Tracks in order of first play; with ``month`` those first played in it."""
    firsts = first_plays(history, item=item)
    if month is not None:
        firsts = firsts.where(times.month_label(F.col("first_play")) == month)
    return firsts.orderBy("first_play", item).limit(limit)


def discovery_by_month(history: DataFrame, limit: int = 50, item: str = "track_uri") -> DataFrame:
    firsts = first_plays(history, item=item).withColumn("month", times.month_label(F.col("first_play")))
    return top_per_group(firsts, ["month"], ["first_play", item], limit)


def discovery_by_year(
    history: DataFrame, limit: int = 100, scope: str = "period", item: str = "track_uri"
) -> DataFrame:
    """``scope="period"``: first play within each year; ``"all_history"``: first ever."""
    if scope == "period":
        firsts = first_plays(history.withColumn("year", F.year("timestamp")), "year", item=item)
    else:
        firsts = first_plays(history, item=item).withColumn("year", F.year("first_play"))
    return top_per_group(firsts.where(F.col("year").isNotNull()), ["year"], ["first_play", item], limit)


#: Partition column of a history kept by the day of the year.
DAY_OF_YEAR = "month_day"


def day_of_year(ts: Column) -> Column:
    """``MM-dd``."""
    return F.date_format(ts, "MM-dd")


def on_this_day(
    history: DataFrame, as_of: str, limit: int = 50, years_ago: int = 1, item: str = "track_uri"
) -> DataFrame:
    """Most played on the calendar day that lies ``365 * years_ago`` days back, in every year.

    A history written by ``tables.write_history_by_day`` is read for that day only.
    """
    day = f"{date.fromisoformat(as_of[:10]) - timedelta(days=365 * years_ago):%m-%d}"
    kept = F.col(DAY_OF_YEAR) if DAY_OF_YEAR in history.columns else day_of_year(F.col("timestamp"))
    same_day = kept == day
    counts = (
        history.where(same_day & F.col(item).isNotNull())
        .groupBy(item)
        .agg(F.count(F.lit(1)).alias("play_count"))
    )
    return counts.orderBy(F.desc("play_count"), item).limit(limit)


def rerank_by_plays(
    items: DataFrame, history: DataFrame, rank: str = "rank", item: str = "track_uri"
) -> DataFrame:
    """Order by play count, unplayed last; equal counts keep their old rank, then the item decides."""
    counts = play_stats(history, item=item).select(item, "play_count")
    return (
        items.join(counts, item, "left")
        .withColumn("play_count", F.coalesce("play_count", F.lit(0)))
        .orderBy(F.desc("play_count"), rank, item)
    )


def listening_patterns(
    history: DataFrame, track: str = "track_id", artist: str = "artist_id"
) -> DataFrame:
    """(section, label, n): totals, plays per hour, plays per weekday.

    A missing track or artist column counts as 0.
    """
    ts = F.col("timestamp")

    def distinct(name: str) -> Column:
        return F.countDistinct(name) if name in history.columns else F.lit(0).cast("bigint")

    # Both distributions come from one pass over 24 x 7 cells.
    cells = history.groupBy(F.hour(ts).alias("hour"), F.date_format(ts, "EEEE").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = history.agg(
        F.count(F.lit(1)).alias("total_plays"),
        distinct(track).alias("unique_tracks"),
        distinct(artist).alias("unique_artists"),
        F.unix_seconds(F.min(ts).cast("timestamp")).alias("first_second"),
        F.unix_seconds(F.max(ts).cast("timestamp")).alias("last_second"),
    )
    names = totals.columns
    sections = [
        totals.select(F.expr(f"stack({len(names)}, {', '.join(f"'{n}', {n}" for n in names)}) AS (label, n)"))
        .select(F.lit("total").alias("section"), "label", "n"),
        cells.groupBy(F.col("hour").cast("string").alias("label"))
        .agg(F.sum("n").alias("n"))
        .select(F.lit("hour").alias("section"), "label", "n"),
        cells.groupBy(F.col("day").alias("label"))
        .agg(F.sum("n").alias("n"))
        .select(F.lit("weekday").alias("section"), "label", "n"),
    ]
    return sections[0].unionByName(sections[1]).unionByName(sections[2])


def recent_listening(
    history: DataFrame,
    as_of: str,
    days: int = 30,
    artist: str = "artist_name",
    track: str = "track_name",
) -> DataFrame:
    """(section, rank, label, value) over the last ``days`` days."""
    # The bound takes the column's own type, so that the scan can use it.
    start = times.days_before(as_of, days).cast(dict(history.dtypes)["timestamp"])
    recent = history.where(F.col("timestamp") >= start)

    def top(column: Column, section: str, limit: int) -> DataFrame:
        counts = (
            recent.select(column.cast("string").alias("label"))
            .where(F.col("label").isNotNull())
            .groupBy("label")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        best = top_rows(counts, [F.desc("n"), "label"], limit)
        return best.select(F.lit(section).alias("section"), "rank", "label", F.col("n").cast("double").alias("value"))

    # A missing name counts as one more distinct name.
    names = F.countDistinct(track) + F.max(F.when(F.col(track).isNull(), 1).otherwise(0))
    summary = recent.agg(
        F.round(F.sum("ms_played") / 3_600_000, 1).alias("listening_hours"),
        F.try_divide(names, F.count(F.lit(1))).alias("discovery_rate"),
    )
    single = summary.select(
        F.expr("stack(2, 'listening_hours', listening_hours, 'discovery_rate', discovery_rate) AS (label, value)")
    ).select(F.lit("summary").alias("section"), F.lit(1).alias("rank"), "label", "value")
    return (
        top(F.col(artist), "top_artists", 10)
        .unionByName(top(F.col(track), "top_tracks", 10))
        .unionByName(top(F.hour("timestamp"), "peak_hours", 5))
        .unionByName(single)
    )


def history_freshness(history: DataFrame, as_of: str, stale_after: int = 30) -> DataFrame:
    return history.agg(F.max("timestamp").alias("last_play")).select(
        "last_play",
        F.floor(times.age_days(as_of, F.col("last_play"))).cast("bigint").alias("days_old"),
        (F.floor(times.age_days(as_of, F.col("last_play"))) > stale_after).alias("stale"),
    )


def history_union(basic: DataFrame, extended: DataFrame, fill_gaps: bool = False) -> DataFrame:
    """One history. Extended rows win: basic rows are used only when no extended row
    exists, or with ``fill_gaps`` also outside the extended time range."""
    span = extended.agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    ts = F.col("timestamp")
    spare = low.isNull()
    if fill_gaps:
        spare = spare | (ts < low) | (ts > high)
    both = basic.where(spare).unionByName(extended, allowMissingColumns=True)
    for name in ("track_uri", "album_name", "skipped"):
        if name not in both.columns:
            both = both.withColumn(name, F.lit(None).cast("boolean" if name == "skipped" else "string"))
    return both.withColumn("track_id", uri_item(F.col("track_uri")))


def sorted_history(history: DataFrame) -> DataFrame:
    """Oldest first; the other columns order plays of the same time."""
    return history.orderBy("timestamp", *[c for c in history.columns if c != "timestamp"])


def ordered_distinct(
    items: DataFrame, keys: Sequence[str], order: Sequence[str], item: str = "track_uri"
) -> DataFrame:
    """Each item once per group, at its first place in ``order``."""
    first = F.min(F.struct(*order)).alias("first")
    return items.where(F.col(item).isNotNull()).groupBy(*keys, item).agg(first).select(
        *keys, item, "first.*"
    )


def ranked(items: DataFrame, keys: Sequence[str], step: Column, order: Sequence[str]) -> DataFrame:
    return counted_row_number(items, keys, step, order, name="rank")
