"""Listening history over the long (order lines) and short (events) play tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratebook.functions import times
from cratebook.operators import plays
from cratebook.session import scratch_path
from cratebook.sources import tables
from cratebook.testbed.queries_library import r6
from cratebook.testbed.registry import entry
from cratebook.testbed.virtual import AS_OF, AS_OF_SHORT

STATS_SQL = "count(ms_played) AS play_count, CAST(sum(ms_played) AS BIGINT) AS total_ms"
RANK_SQL = "play_count DESC, total_ms DESC, track_uri"


def second(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def second_sql(column):
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


@entry(
    "meaningful_play",
    """SELECT 'long' AS source, count(*) AS n, CAST(sum(ms_played) AS BIGINT) AS ms FROM plays_long WHERE ms_played >= 30000
UNION ALL SELECT 'short', count(*), CAST(sum(ms_played) AS BIGINT) FROM plays_short
WHERE ms_played >= 30000 AND NOT coalesce(skipped, false)""",
    ("plays_long", "plays_short"),
)
def meaningful_play(v):
    def total(df, source):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum("ms_played").alias("ms")).select(
            F.lit(source).alias("source"), "n", "ms"
        )

    long = v.plays_long().where(times.meaningful_play(F.col("ms_played")))
    short = v.plays_short().where(times.meaningful_play(F.col("ms_played"), F.col("skipped")))
    return total(long, "long").unionByName(total(short, "short"))


DAYPART_SQL = """CASE WHEN hour(timestamp) < 6 THEN 'night' WHEN hour(timestamp) < 12 THEN 'morning'
  WHEN hour(timestamp) < 18 THEN 'afternoon' ELSE 'evening' END"""


@entry(
    "daypart",
    f"""SELECT {DAYPART_SQL} AS part, isodow(timestamp) >= 6 AS weekend, count(*) AS n
FROM plays_short GROUP BY 1, 2""",
    ("plays_short",),
)
def daypart(v):
    ts = F.col("timestamp")
    return (
        v.plays_short()
        .groupBy(times.daypart(ts).alias("part"), times.in_daypart(ts, "weekend").alias("weekend"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@entry(
    "time_parts",
    """SELECT event_id, strftime(timestamp, '%Y-%m-%d') AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
  dayname(timestamp) AS day_of_week, CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week_num,
  strftime(timestamp, '%Y-%m') AS month, round(ms_played / 60000, 6) AS minutes_played FROM plays_short""",
    ("plays_short",),
)
def time_parts(v):
    parts = times.with_time_parts(v.plays_short()).withColumn("date", F.col("date").cast("string"))
    return r6(
        parts.select("event_id", "date", "hour", "day_of_week", "day_of_week_num", "month", "minutes_played"),
        "minutes_played",
    )


@entry("play_stats", f"SELECT track_uri, {STATS_SQL} FROM plays_long GROUP BY 1", ("plays_long",))
def play_stats(v):
    return plays.play_stats(v.plays_long())


@entry(
    "most_played",
    f"SELECT track_uri, {STATS_SQL} FROM plays_long GROUP BY 1 ORDER BY {RANK_SQL} LIMIT 50",
    ("plays_long",),
)
def most_played(v):
    return plays.most_played(v.plays_long())


@entry(
    "most_played_month",
    f"""SELECT track_uri, {STATS_SQL} FROM plays_long WHERE strftime(timestamp, '%Y-%m') = '1998-06'
GROUP BY 1 ORDER BY {RANK_SQL} LIMIT 50""",
    ("plays_long",),
)
def most_played_month(v):
    return plays.most_played(v.plays_long(), "1998-06")


@entry(
    "most_played_every_month",
    f"""WITH s AS (SELECT strftime(timestamp, '%Y-%m') AS month, track_uri, {STATS_SQL} FROM plays_long GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (PARTITION BY month ORDER BY {RANK_SQL}) AS INTEGER) AS rank
FROM s QUALIFY rank <= 50""",
    ("plays_long",),
)
def most_played_every_month(v):
    history = v.plays_long().withColumn("month", times.month_label(F.col("timestamp")))
    return plays.most_played_by(history, "month")


def _daypart_top(part: str, condition: str):
    @entry(
        f"daypart_top_{part}",
        f"""SELECT track_uri, {STATS_SQL} FROM plays_short WHERE {condition}
GROUP BY 1 ORDER BY {RANK_SQL} LIMIT 50""",
        ("plays_short",),
    )
    def query(v):
        return plays.daypart_top(v.plays_short(), part)


for _part, _condition in (
    ("morning", "hour(timestamp) >= 6 AND hour(timestamp) < 12"),
    ("afternoon", "hour(timestamp) >= 12 AND hour(timestamp) < 18"),
    ("evening", "hour(timestamp) >= 18"),
    ("night", "hour(timestamp) < 6"),
    ("weekend", "isodow(timestamp) >= 6"),
):
    _daypart_top(_part, _condition)


@entry(
    "repeat_items",
    """SELECT track_uri, count(*) AS play_count FROM plays_long GROUP BY 1 HAVING count(*) >= 3
ORDER BY play_count DESC, track_uri LIMIT 50""",
    ("plays_long",),
)
def repeat_items(v):
    return plays.repeat_items(v.plays_long())


@entry(
    "repeat_items_month",
    """SELECT track_uri, count(*) AS play_count FROM plays_long WHERE strftime(timestamp, '%Y-%m') = '1999-03'
GROUP BY 1 HAVING count(*) >= 2 ORDER BY play_count DESC, track_uri LIMIT 50""",
    ("plays_long",),
)
def repeat_items_month(v):
    return plays.repeat_items(v.plays_long(), "1999-03", min_repeats=2)


FIRSTS_SQL = "SELECT track_uri, min(timestamp) AS f FROM plays_long GROUP BY 1"


@entry(
    "discovery_all",
    f"""SELECT track_uri, {second_sql('f')} AS first_play FROM ({FIRSTS_SQL}) ORDER BY f, track_uri LIMIT 50""",
    ("plays_long",),
)
def discovery_all(v):
    return plays.discovery(v.plays_long()).withColumn("first_play", second("first_play"))


@entry(
    "discovery_month",
    f"""SELECT track_uri, {second_sql('f')} AS first_play FROM ({FIRSTS_SQL})
WHERE strftime(f, '%Y-%m') = '1995-02' ORDER BY f, track_uri LIMIT 50""",
    ("plays_long",),
)
def discovery_month(v):
    return plays.discovery(v.plays_long(), "1995-02").withColumn("first_play", second("first_play"))


@entry(
    "discovery_every_month",
    f"""SELECT track_uri, {second_sql('f')} AS first_play, strftime(f, '%Y-%m') AS month,
  CAST(row_number() OVER (PARTITION BY strftime(f, '%Y-%m') ORDER BY f, track_uri) AS INTEGER) AS rank
FROM ({FIRSTS_SQL}) QUALIFY rank <= 50""",
    ("plays_long",),
)
def discovery_every_month(v):
    return plays.discovery_by_month(v.plays_long()).withColumn("first_play", second("first_play"))


@entry(
    "discovery_every_year",
    f"""SELECT year, track_uri, {second_sql('f')} AS first_play,
  CAST(row_number() OVER (PARTITION BY year ORDER BY f, track_uri) AS INTEGER) AS rank
FROM (SELECT CAST(year(timestamp) AS INTEGER) AS year, track_uri, min(timestamp) AS f FROM plays_long GROUP BY 1, 2)
QUALIFY rank <= 100""",
    ("plays_long",),
)
def discovery_every_year(v):
    return plays.discovery_by_year(v.plays_long()).withColumn("first_play", second("first_play"))


@entry(
    "first_plays_per_listener",
    f"""SELECT listener, track_uri, {second_sql('min(timestamp)')} AS first_play FROM plays_long GROUP BY 1, 2""",
    ("plays_long",),
)
def first_plays_per_listener(v):
    return plays.first_plays(v.plays_long(), "listener").withColumn("first_play", second("first_play"))


ON_THIS_DAY_SQL = """SELECT track_uri, count(*) AS play_count FROM plays_long
WHERE month(timestamp) = month(DATE '1999-06-15' - 365) AND day(timestamp) = day(DATE '1999-06-15' - 365)
GROUP BY 1 ORDER BY play_count DESC, track_uri LIMIT 50"""


@entry("on_this_day", ON_THIS_DAY_SQL, ("plays_long",))
def on_this_day(v):
    return plays.on_this_day(v.plays_long(), "1999-06-15")


@entry("on_this_day_stored", ON_THIS_DAY_SQL, ("plays_long",))
def on_this_day_stored(v):
    """From a history that is kept by the day of the year."""
    path = tables.write_history_by_day(v.plays_long().select("timestamp", "track_uri"), scratch_path(v.spark, "history"))
    return plays.on_this_day(v.spark.read.parquet(path), "1999-06-15")


@entry(
    "rerank_by_plays",
    """WITH c AS (SELECT track_id, count(ms_played) AS n FROM plays_short GROUP BY 1)
SELECT p_partkey AS track_id, p_size AS rank, coalesce(n, 0) AS play_count FROM part LEFT JOIN c ON p_partkey = track_id""",
    ("plays_short",),
)
def rerank_by_plays(v):
    items = v.table("part").select(F.col("p_partkey").alias("track_id"), F.col("p_size").alias("rank"))
    return plays.rerank_by_plays(items, v.plays_short(), item="track_id")


@entry(
    "history_sort",
    f"SELECT event_id, {second_sql('timestamp')} AS timestamp FROM plays_short ORDER BY plays_short.timestamp",
    ("plays_short",),
)
def history_sort(v):
    return plays.sorted_history(v.plays_short()).select("event_id", second("timestamp").alias("timestamp"))


@entry(
    "listening_patterns",
    """SELECT 'total' AS section, 'total_plays' AS label, count(*) AS n FROM plays_short
UNION ALL SELECT 'total', 'unique_tracks', count(DISTINCT track_uri) FROM plays_short
UNION ALL SELECT 'total', 'unique_artists', count(DISTINCT listener) FROM plays_short
UNION ALL SELECT 'total', 'first_second', CAST(floor(epoch(min(timestamp))) AS BIGINT) FROM plays_short
UNION ALL SELECT 'total', 'last_second', CAST(floor(epoch(max(timestamp))) AS BIGINT) FROM plays_short
UNION ALL SELECT 'hour', CAST(hour(timestamp) AS VARCHAR), count(*) FROM plays_short GROUP BY 2
UNION ALL SELECT 'weekday', dayname(timestamp), count(*) FROM plays_short GROUP BY 2""",
    ("plays_short",),
)
def listening_patterns(v):
    return plays.listening_patterns(v.plays_short(), artist="listener")


def recent_of(v, days=365):
    history = (
        v.plays_long()
        .join(v.artists().select("artist_id", F.col("name").alias("artist_name")), "artist_id", "left")
        .join(v.tracks().select("track_id", F.col("uri").alias("track_name")), "track_id", "left")
    )
    return plays.recent_listening(history, AS_OF, days)


@entry(
    "recent_listening",
    f"""
WITH r AS (SELECT l.*, s_name AS artist FROM plays_long l LEFT JOIN supplier ON artist_id = s_suppkey
           WHERE timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS),
a AS (SELECT artist AS label, count(*) AS n FROM r GROUP BY 1),
t AS (SELECT track_uri AS label, count(*) AS n FROM r GROUP BY 1),
h AS (SELECT CAST(hour(timestamp) AS VARCHAR) AS label, count(*) AS n FROM r GROUP BY 1)
SELECT 'top_artists' AS section, CAST(row_number() OVER (ORDER BY n DESC, label) AS INTEGER) AS rank, label,
  CAST(n AS DOUBLE) AS value FROM a QUALIFY rank <= 10
UNION ALL SELECT 'top_tracks', CAST(row_number() OVER (ORDER BY n DESC, label) AS INTEGER) AS rank, label,
  CAST(n AS DOUBLE) FROM t QUALIFY rank <= 10
UNION ALL SELECT 'peak_hours', CAST(row_number() OVER (ORDER BY n DESC, label) AS INTEGER) AS rank, label,
  CAST(n AS DOUBLE) FROM h QUALIFY rank <= 5
UNION ALL SELECT 'summary', 1, 'listening_hours', round(sum(ms_played) / 3600000, 1) FROM r
UNION ALL SELECT 'summary', 1, 'discovery_rate', round(count(DISTINCT track_uri) / count(*), 6) FROM r""",
    ("plays_long",),
)
def recent_listening(v):
    return r6(recent_of(v), "value")


@entry(
    "history_freshness",
    f"""SELECT {second_sql('max(timestamp)')} AS last_play,
  CAST(floor(epoch(TIMESTAMP '{AS_OF_SHORT}' - max(timestamp)) / 86400) AS BIGINT) AS days_old,
  floor(epoch(TIMESTAMP '{AS_OF_SHORT}' - max(timestamp)) / 86400) > 30 AS stale FROM plays_short""",
    ("plays_short",),
)
def history_freshness(v):
    return plays.history_freshness(v.plays_short(), AS_OF_SHORT).withColumn("last_play", second("last_play"))


def _basic(v):
    return v.plays_long().select("timestamp", "ms_played", F.lit("basic").alias("source"))


def _extended(v):
    return v.plays_short().select("timestamp", "ms_played", "track_uri", "skipped", F.lit("extended").alias("source"))


def _union_summary(df):
    return df.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms_played").alias("ms"), F.countDistinct("track_id").alias("tracks")
    )


@entry(
    "history_union",
    """SELECT 'extended' AS source, count(*) AS n, CAST(sum(ms_played) AS BIGINT) AS ms,
  count(DISTINCT track_id) AS tracks FROM plays_short""",
    ("plays_short",),
)
def history_union(v):
    return _union_summary(plays.history_union(_basic(v), _extended(v)))


@entry(
    "history_union_filled",
    """SELECT 'extended' AS source, count(*) AS n, CAST(sum(ms_played) AS BIGINT) AS ms,
  count(DISTINCT track_id) AS tracks FROM plays_short
UNION ALL SELECT 'basic', count(*), CAST(sum(ms_played) AS BIGINT), 0 FROM plays_long
WHERE timestamp < (SELECT min(timestamp) FROM plays_short) OR timestamp > (SELECT max(timestamp) FROM plays_short)""",
    ("plays_long", "plays_short"),
)
def history_union_filled(v):
    return _union_summary(plays.history_union(_basic(v), _extended(v), fill_gaps=True))
