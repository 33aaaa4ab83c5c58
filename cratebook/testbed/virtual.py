"""A media library derived from the star-schema test tables.

Customers act as collections, order lines as memberships and plays, parts as
tracks, suppliers as artists, and the event stream as a second play history.
``SQL`` holds the same derivation for the independent SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratebook.operators.grouping import counted_row_number

AS_OF = "2001-12-31 00:00:00"
AS_OF_SHORT = "2024-01-31 00:00:00"
SEED = 42
OLD_STATE_CUTOFF = "2001-01-01"

MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def name_parts(spark: SparkSession) -> DataFrame:
    """(slot, fixed, lead) for key % 168: a whole name, or the start of one that ends in
    the key. A table instead of one long expression, which every filter on names
    would repeat."""
    slot = F.col("id")
    month = (slot % 84) % 12 + 1
    year = F.expr("1995 + (id % 84) div 12").cast("string")
    mon = F.substring(F.lit(MONTHS), (month * 3 - 2).cast("int"), F.lit(3))
    yy = F.substring(year, 3, 2)
    kind = slot % 8
    fixed = (
        F.when(kind == 0, F.concat(F.lit("AJFinds"), mon, yy))
        .when(kind == 1, F.concat(F.lit("AJTop"), yy))
        .when(kind == 2, F.concat(F.lit("AJDiscovery"), yy))
        .when(kind == 3, F.concat(mon, F.lit("'"), yy))
        .when(kind == 4, F.concat(year, F.lit("-"), F.lpad(month.cast("string"), 2, "0")))
    )
    lead = F.when(kind == 5, "New rock ").when(kind == 6, "Liked ")
    return spark.range(168).select(slot.alias("slot"), fixed.alias("fixed"), lead.alias("lead"))


class VirtualLibrary:
    """Lazy DataFrames of the library over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _lines(self) -> DataFrame:
        return self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    def playlists(self, before: str | None = None) -> DataFrame:
        """``before`` gives the older state: only orders up to that day count."""
        orders = self.table("orders")
        if before is not None:
            orders = orders.where(F.col("o_orderdate") <= F.lit(before).cast("timestamp_ntz"))
        lines = self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        state = lines.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("lines"), F.max("l_orderkey").alias("last_order")
        )
        key = F.col("c_custkey")
        return (
            self.table("customer")
            .join(state, key == F.col("o_custkey"), "left")
            .join(F.broadcast(name_parts(self.spark)), key % 168 == F.col("slot"))
            .select(
                key.alias("playlist_id"),
                F.coalesce("fixed", F.concat("lead", key.cast("string")), "c_name").alias("name"),
                F.concat(F.lit("Segment "), F.lower("c_mktsegment")).alias("description"),
                F.lit(False).alias("public"),
                F.lit(False).alias("collaborative"),
                F.col("last_order").cast("string").alias("snapshot_id"),
                F.coalesce("lines", F.lit(0)).cast("bigint").alias("track_count"),
                F.col("c_nationkey").cast("string").alias("owner_id"),
                (F.col("c_nationkey") < 20).alias("is_owned"),
                (key == 0).alias("is_liked_songs"),
            )
        )

    def order_playlists(self) -> DataFrame:
        """Orders as collections; some have no lines."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("playlist_id"),
            F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"),
            (F.col("o_orderstatus") != "P").alias("is_owned"),
            F.lit(False).alias("is_liked_songs"),
        )

    def playlist_tracks(self) -> DataFrame:
        return self._lines().select(
            F.col("o_custkey").alias("playlist_id"),
            F.col("l_partkey").alias("track_id"),
            track_uri(F.col("l_partkey")).alias("track_uri"),
            F.col("o_orderdate").alias("added_at"),
        )

    def positioned_tracks(self) -> DataFrame:
        """Memberships with their position; order days are the counting steps. Lines that are
        equal up to the track give the same rows whichever comes first, so that no further
        column of the order need travel."""
        order = LINE_ORDER[:3]
        ranked = counted_row_number(
            self._lines().select("o_custkey", "o_orderdate", *order), ["o_custkey"], F.col("o_orderdate"), order, name="nr"
        )
        return ranked.select(
            F.col("o_custkey").alias("playlist_id"),
            F.col("l_partkey").alias("track_id"),
            track_uri(F.col("l_partkey")).alias("track_uri"),
            F.col("o_orderdate").alias("added_at"),
            (F.col("nr") - 1).alias("position"),
        )

    def tracks(self) -> DataFrame:
        key = F.col("p_partkey")
        day = F.date_format(
            F.date_add(F.lit("1995-01-01").cast("date"), (key % 12000).cast("int")), "yyyy-MM-dd"
        )
        length = F.when(key % 3 == 0, 4).when(key % 3 == 1, 7).otherwise(10)
        words = F.split("p_name", " ")
        return self.table("part").select(
            key.alias("track_id"),
            F.col("p_name").alias("name"),
            F.round(F.col("p_retailprice") * 1000).cast("bigint").alias("duration_ms"),
            F.when(key % 50 != 0, F.least(F.col("p_size") * 2, F.lit(100))).cast("int").alias("popularity"),
            F.substring(day, F.lit(1), length).alias("release_date"),
            F.array(F.lower("p_type"), F.get(words, F.lit(0)), F.get(words, F.lit(1))).alias("genres"),
            F.col("p_brand").alias("album_name"),
            track_uri(key).alias("uri"),
        )

    def track_artists(self) -> DataFrame:
        pairs = self.table("lineitem").select("l_partkey", "l_suppkey").distinct()
        ranked = counted_row_number(
            pairs, ["l_partkey"], F.expr("l_suppkey div 1000"), ["l_suppkey"], name="nr"
        )
        return ranked.select(
            F.col("l_partkey").alias("track_id"),
            F.col("l_suppkey").alias("artist_id"),
            (F.col("nr") - 1).alias("position"),
        )

    def artists(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("artist_id"),
                F.col("s_name").alias("name"),
                F.array(F.lower("n_name")).alias("genres"),
                (F.col("s_suppkey") % 101).cast("int").alias("popularity"),
                F.floor("s_acctbal").cast("bigint").alias("followers"),
            )
        )

    def plays_long(self) -> DataFrame:
        return self._lines().select(
            F.col("l_shipdate").alias("timestamp"),
            F.col("o_custkey").alias("listener"),
            F.col("l_partkey").alias("track_id"),
            F.col("l_suppkey").alias("artist_id"),
            track_uri(F.col("l_partkey")).alias("track_uri"),
            (F.col("l_quantity") * 10000).cast("bigint").alias("ms_played"),
        )

    def plays_short(self) -> DataFrame:
        track = F.get_json_object("props", "$.k").cast("bigint")
        return self.table("events").select(
            "event_id",
            F.col("ts").alias("timestamp"),
            F.col("user_id").alias("listener"),
            track.alias("track_id"),
            track_uri(track).alias("track_uri"),
            F.round(F.col("value") * 1000).cast("bigint").alias("ms_played"),
            (F.col("event_type") == "error").alias("skipped"),
        )

    def error_log(self) -> DataFrame:
        code = F.get_json_object("props", "$.k").cast("bigint") % 7
        return self.table("events").where(F.col("event_type") == "error").select(
            F.col("ts").alias("timestamp"),
            F.concat(F.lit("E"), code.cast("string")).alias("message_error_code"),
            (F.col("value") > 20).alias("fatal"),
        )

    def track_features(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("track_id"), (key % 11 / 10).alias("valence"), (key % 7 / 6).alias("energy")
        )

    def overlap_sets(self, family: str) -> DataFrame:
        """(set_id, item_id) rows, duplicates included."""
        if family == "order_part":
            return self.table("lineitem").select(
                F.col("l_orderkey").alias("set_id"), F.col("l_partkey").alias("item_id")
            )
        if family == "user_hour":
            return self.table("events").select(
                F.col("user_id").alias("set_id"), F.hour("ts").cast("bigint").alias("item_id")
            )
        if family == "customer_day":
            return self.table("orders").select(
                F.col("o_custkey").alias("set_id"), F.dayofmonth("o_orderdate").cast("bigint").alias("item_id")
            )
        if family == "nation_part":
            return (
                self._lines()
                .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
                .select(
                    F.col("c_nationkey").cast("bigint").alias("set_id"),
                    F.col("l_partkey").alias("item_id"),
                )
            )
        raise ValueError(family)

    def overlap_names(self, family: str) -> DataFrame:
        """(set_id, name) with names of several lengths."""
        if family == "order_part":
            return self.table("orders").select(
                F.col("o_orderkey").alias("set_id"),
                F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"),
            )
        if family == "user_hour":
            return self.table("events").select(F.col("user_id").alias("set_id")).distinct().withColumn(
                "name", F.concat(F.lit("User "), F.col("set_id").cast("string"))
            )
        if family == "customer_day":
            return self.table("customer").select(F.col("c_custkey").alias("set_id"), F.col("c_name").alias("name"))
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("set_id"), F.col("n_name").alias("name")
        )


def track_uri(key: Column) -> Column:
    return F.concat(F.lit("spotify:track:"), key.cast("string"))


_MONTH = f"substr('{MONTHS}', CAST((c_custkey % 84) % 12 AS INTEGER) * 3 + 1, 3)"
_YEAR = "CAST(1995 + (c_custkey % 84) // 12 AS VARCHAR)"
_ORDER = ", ".join(["o_orderdate", *LINE_ORDER])


def _playlists_sql(where: str) -> str:
    return f"""SELECT c_custkey AS playlist_id,
    CASE c_custkey % 8
      WHEN 0 THEN 'AJFinds' || {_MONTH} || substr({_YEAR}, 3, 2)
      WHEN 1 THEN 'AJTop' || substr({_YEAR}, 3, 2)
      WHEN 2 THEN 'AJDiscovery' || substr({_YEAR}, 3, 2)
      WHEN 3 THEN {_MONTH} || '''' || substr({_YEAR}, 3, 2)
      WHEN 4 THEN {_YEAR} || '-' || lpad(CAST((c_custkey % 84) % 12 + 1 AS VARCHAR), 2, '0')
      WHEN 5 THEN 'New rock ' || c_custkey
      WHEN 6 THEN 'Liked ' || c_custkey
      ELSE c_name END AS name,
    'Segment ' || lower(c_mktsegment) AS description,
    CAST(last_order AS VARCHAR) AS snapshot_id,
    CAST(coalesce(lines, 0) AS BIGINT) AS track_count,
    c_nationkey < 20 AS is_owned, c_custkey = 0 AS is_liked_songs
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS lines, max(l_orderkey) AS last_order
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey {where} GROUP BY o_custkey
  ) ON c_custkey = o_custkey"""


# name -> (query, names it reads)
SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "playlists": (_playlists_sql(""), ()),
    "old_playlists": (_playlists_sql(f"WHERE o_orderdate <= TIMESTAMP '{OLD_STATE_CUTOFF}'"), ()),
    "order_playlists": (
        "SELECT o_orderkey AS playlist_id, 'Order ' || o_orderkey AS name,"
        " o_orderstatus <> 'P' AS is_owned FROM orders",
        (),
    ),
    "playlist_tracks": (
        f"""SELECT o_custkey AS playlist_id, l_partkey AS track_id,
    'spotify:track:' || l_partkey AS track_uri, o_orderdate AS added_at,
    row_number() OVER (PARTITION BY o_custkey ORDER BY {_ORDER}) - 1 AS position
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        (),
    ),
    "tracks": (
        """SELECT p_partkey AS track_id, p_name AS name,
    CAST(round(p_retailprice * 1000) AS BIGINT) AS duration_ms,
    CASE WHEN p_partkey % 50 <> 0 THEN least(p_size * 2, 100) END AS popularity,
    substr(strftime(DATE '1995-01-01' + CAST(p_partkey % 12000 AS INTEGER), '%Y-%m-%d'), 1,
           CASE p_partkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 7 ELSE 10 END) AS release_date,
    [lower(p_type), split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] AS genres,
    p_brand AS album_name,
    'spotify:track:' || p_partkey AS uri FROM part""",
        (),
    ),
    "track_artists": (
        """SELECT l_partkey AS track_id, l_suppkey AS artist_id,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) - 1 AS position
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
        (),
    ),
    "artists": (
        """SELECT s_suppkey AS artist_id, s_name AS name, [lower(n_name)] AS genres,
    CAST(s_suppkey % 101 AS INTEGER) AS popularity, CAST(floor(s_acctbal) AS BIGINT) AS followers
  FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
        (),
    ),
    "plays_long": (
        """SELECT l_shipdate AS timestamp, o_custkey AS listener, l_partkey AS track_id,
    l_suppkey AS artist_id, 'spotify:track:' || l_partkey AS track_uri,
    CAST(l_quantity * 10000 AS BIGINT) AS ms_played
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        (),
    ),
    "plays_short": (
        """SELECT event_id, ts AS timestamp, user_id AS listener,
    CAST(json_extract(props, '$.k') AS BIGINT) AS track_id,
    'spotify:track:' || CAST(json_extract(props, '$.k') AS BIGINT) AS track_uri,
    CAST(round(value * 1000) AS BIGINT) AS ms_played, event_type = 'error' AS skipped FROM events""",
        (),
    ),
    "error_log": (
        """SELECT ts AS timestamp, 'E' || (CAST(json_extract(props, '$.k') AS BIGINT) % 7)
      AS message_error_code, value > 20 AS fatal FROM events WHERE event_type = 'error'""",
        (),
    ),
    "track_features": (
        "SELECT p_partkey AS track_id, (p_partkey % 11) / 10 AS valence,"
        " (p_partkey % 7) / 6 AS energy FROM part",
        (),
    ),
    "wide": (
        """SELECT pt.playlist_id, pt.track_id, pt.track_uri, pt.added_at, pt.position,
    p.name, p.track_count, t.name AS name_track, t.duration_ms, t.popularity, t.release_date,
    ta.artist_id AS primary_artist_id, a.name AS primary_artist,
    a.popularity AS primary_artist_popularity, a.followers AS primary_artist_followers
  FROM playlist_tracks pt
  LEFT JOIN (SELECT * FROM playlists WHERE is_owned) p ON pt.playlist_id = p.playlist_id
  LEFT JOIN tracks t ON pt.track_id = t.track_id
  LEFT JOIN (SELECT * FROM track_artists WHERE position = 0) ta ON pt.track_id = ta.track_id
  LEFT JOIN artists a ON ta.artist_id = a.artist_id""",
        ("playlists", "playlist_tracks", "tracks", "track_artists", "artists"),
    ),
    "order_part": ("SELECT DISTINCT l_orderkey AS set_id, l_partkey AS item_id FROM lineitem", ()),
    "user_hour": ("SELECT DISTINCT user_id AS set_id, CAST(hour(ts) AS BIGINT) AS item_id FROM events", ()),
    "customer_day": (
        "SELECT DISTINCT o_custkey AS set_id, CAST(day(o_orderdate) AS BIGINT) AS item_id FROM orders",
        (),
    ),
    "nation_part": (
        """SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS set_id, l_partkey AS item_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
        (),
    ),
}


def with_tables(*names: str, body: str) -> str:
    """``body`` preceded by the WITH list of the named tables and what they read."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for needed in SQL[name][1]:
            add(needed)
        ordered.append(name)

    for name in names:
        add(name)
    head = ",\n".join(f"{name} AS (\n  {SQL[name][0]}\n)" for name in ordered)
    body = body.strip()
    recursive = body.upper().startswith("WITH RECURSIVE ")
    if recursive:
        return f"WITH RECURSIVE {head},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
