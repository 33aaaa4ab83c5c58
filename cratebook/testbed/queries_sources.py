"""Sources, sinks and streams: tables are nested to JSON, landed and read back."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook import schemas
from cratebook.session import scratch_path
from cratebook.sources import exports, pages, tables
from cratebook.streaming import jobs
from cratebook.testbed.queries_plays import second, second_sql
from cratebook.testbed.queries_library import r6
from cratebook.testbed.registry import entry

PAGE = 50


def paged(df: DataFrame, item, chunk, field: str, *keys: str, order=None) -> DataFrame:
    """Text pages of at most ``PAGE`` items each, as an API would have sent them."""
    order = F.lit(0) if order is None else order
    cells = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.to_json(item).alias("j"))))
    # The items are JSON already: joined as text, so that nulls inside stay as they are.
    listed = F.concat(F.lit("["), F.array_join(F.transform(cells, lambda c: c["j"]), ","), F.lit("]"))
    grouped = df.groupBy(*keys, chunk.alias("chunk")).agg(listed.alias("items"))
    head = [F.concat(F.lit(f'"{k}":"'), F.col(k).cast("string"), F.lit('",')) for k in keys]
    offset = F.concat(F.lit('"offset":'), (F.col("chunk") * PAGE).cast("string"), F.lit(","))
    page = F.concat(F.lit("{"), *head, offset, F.lit(f'"{field}":'), F.col("items"), F.lit("}"))
    return grouped.select(page.alias("page"))


def text(column: str):
    return F.col(column).cast("string")


@entry(
    "flatten_collections",
    """SELECT CAST(playlist_id AS VARCHAR) AS playlist_id, name, description, snapshot_id, track_count,
  is_owned, false AS is_liked_songs FROM playlists
UNION ALL SELECT '__liked_songs__', '❤️ Liked Songs', 'Your liked songs - the master playlist',
  'liked_songs_' || (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem), true, true""",
    ("playlists",),
)
def flatten_collections(v):
    owner = F.when(F.col("is_owned"), "me").otherwise(text("owner_id"))
    item = F.struct(
        text("playlist_id").alias("id"), "name", "description", "public", "collaborative", "snapshot_id",
        F.struct(F.col("track_count").alias("total")).alias("tracks"), F.struct(owner.alias("id")).alias("owner"),
    )
    landed = paged(v.playlists(), item, F.floor(F.col("playlist_id") / PAGE), "items")
    total = v.table("lineitem").agg(F.count(F.lit(1)).alias("n")).scalar()
    parsed = pages.parse_pages(landed, "page", schemas.COLLECTION_PAGE)
    return pages.flatten_collections(parsed, "me", total).select(
        "playlist_id", "name", "description", "snapshot_id", "track_count", "is_owned", "is_liked_songs"
    )


def membership_pages(v, *keys):
    """What was added on a Sunday has lost its id."""
    known = F.when(F.weekday("added_at") != 6, text("track_id"))
    item = F.struct(
        second("added_at").alias("added_at"),
        F.struct(F.lit("me").alias("id")).alias("added_by"),
        F.struct(known.alias("id"), F.col("track_uri").alias("uri"), F.lit(False).alias("is_local")).alias("track"),
    )
    return paged(
        v.positioned_tracks(), item, F.floor(F.col("position") / PAGE), "items", *keys, order=F.col("position")
    )


MEMBER_SQL = f"""SELECT CAST(playlist_id AS VARCHAR) AS playlist_id, CAST(track_id AS VARCHAR) AS track_id, track_uri,
  false AS is_local, {second_sql('added_at')} AS added_at, 'me' AS added_by, position
FROM playlist_tracks WHERE isodow(added_at) <> 7"""


@entry("flatten_membership", MEMBER_SQL, ("playlist_tracks",))
def flatten_membership(v):
    parsed = pages.parse_pages(membership_pages(v, "playlist_id"), "page", schemas.MEMBERSHIP_PAGE)
    return pages.flatten_membership(parsed).withColumn("added_at", second("added_at"))


@entry(
    "flatten_liked",
    MEMBER_SQL.replace("CAST(playlist_id AS VARCHAR)", "'__liked_songs__'").replace("'me'", "'somebody'"),
    ("playlist_tracks",),
)
def flatten_liked(v):
    parsed = pages.parse_pages(membership_pages(v, "playlist_id"), "page", schemas.MEMBERSHIP_PAGE)
    return pages.flatten_liked(parsed, "somebody").withColumn("added_at", second("added_at"))


def item_responses(v):
    """Each track in two responses."""
    item = F.struct(
        text("track_id").alias("id"), "name", "duration_ms", "popularity",
        F.struct(F.col("album_name").alias("name"), "release_date").alias("album"), "uri",
    )
    by_fifty = paged(v.tracks(), item, F.floor(F.col("track_id") / PAGE), "tracks")
    by_forty = paged(v.tracks(), item, F.floor(F.col("track_id") / 40), "tracks")
    return pages.parse_pages(by_fifty.unionByName(by_forty), "page", schemas.ITEMS_RESPONSE)


def order_responses(v):
    """Orders as tracks credited to customer, priority and status; the customer of an
    open order has no id."""
    credits = F.array(
        F.struct(F.when(F.col("o_orderstatus") != "O", text("o_custkey")).alias("id")),
        F.struct(F.col("o_orderpriority").alias("id")),
        F.struct(F.col("o_orderstatus").alias("id")),
    )
    item = F.struct(text("o_orderkey").alias("id"), credits.alias("artists"))
    landed = paged(v.table("orders"), item, F.floor(F.col("o_orderkey") / PAGE), "tracks")
    return pages.parse_pages(landed, "page", schemas.ITEMS_RESPONSE)


@entry(
    "flatten_items",
    """SELECT CAST(track_id AS VARCHAR) AS track_id, name, duration_ms, popularity, album_name, release_date, uri,
  array_to_string(genres, '|') AS genres FROM tracks""",
    ("tracks",),
)
def flatten_items(v):
    known = v.tracks().select(text("track_id").alias("track_id"), "genres")
    return pages.flatten_items(item_responses(v), known).select(
        "track_id", "name", "duration_ms", "popularity", "album_name", "release_date", "uri",
        F.array_join("genres", "|").alias("genres"),
    )


@entry(
    "flatten_item_creators",
    """SELECT CAST(o_orderkey AS VARCHAR) AS track_id, CAST(o_custkey AS VARCHAR) AS artist_id, 0 AS position
  FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, 1 FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, 2 FROM orders""",
)
def flatten_item_creators(v):
    return pages.flatten_item_creators(order_responses(v))


@entry(
    "flatten_creators",
    """SELECT CAST(artist_id AS VARCHAR) AS artist_id, name, array_to_string(genres, '|') AS genres, popularity, followers
FROM artists""",
    ("artists",),
)
def flatten_creators(v):
    item = F.struct(
        text("artist_id").alias("id"), "name", "genres", "popularity",
        F.struct(F.col("followers").alias("total")).alias("followers"),
    )
    landed = paged(v.artists(), item, F.floor(F.col("artist_id") / PAGE), "artists")
    parsed = pages.parse_pages(landed.unionByName(landed), "page", schemas.CREATORS_RESPONSE)
    return pages.flatten_creators(parsed).select(
        "artist_id", "name", F.array_join("genres", "|").alias("genres"), "popularity", "followers"
    )


def wrapped_pages(v, item, df, key, field):
    inner = paged(df, item, F.floor(F.col(key) / PAGE), "items").select(
        F.concat(F.lit(f'{{"{field}":'), F.col("page"), F.lit("}")).alias("page")
    )
    return inner


def market_artists():
    return F.array(F.struct(text("p_brand").alias("name")), F.struct(F.lower("p_type").alias("name"))).alias("artists")


MARKET_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS {id}, p_name AS name, p_brand || ', ' || lower(p_type) AS artist_names"


@entry(
    "market_new_releases",
    MARKET_SQL.format(id="album_id") + ", p_type AS album_type, CAST(p_size AS BIGINT) AS total_tracks FROM part",
)
def market_new_releases(v):
    item = F.struct(
        text("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("album_type"),
        F.col("p_size").alias("total_tracks"), market_artists(),
    )
    landed = wrapped_pages(v, item, v.table("part"), "p_partkey", "albums")
    return pages.new_releases(pages.parse_pages(landed, "page", pages.MARKET_SCHEMAS["new_releases"])).select(
        "album_id", "name", "artist_names", "album_type", "total_tracks"
    )


@entry(
    "market_search_tracks",
    MARKET_SQL.format(id="track_id")
    + ", p_brand AS album_name, CAST(round(p_retailprice * 1000) AS BIGINT) AS duration_ms, p_size AS popularity FROM part",
)
def market_search_tracks(v):
    item = F.struct(
        text("p_partkey").alias("id"), F.col("p_name").alias("name"), market_artists(),
        F.struct(F.col("p_brand").alias("name")).alias("album"),
        F.round(F.col("p_retailprice") * 1000).cast("bigint").alias("duration_ms"), F.col("p_size").alias("popularity"),
    )
    landed = wrapped_pages(v, item, v.table("part"), "p_partkey", "tracks")
    parsed = pages.parse_pages(landed, "page", pages.MARKET_SCHEMAS["search_tracks"])
    return pages.search_tracks(parsed).select(
        "track_id", "name", "artist_names", "album_name", "duration_ms", "popularity"
    )


@entry("market_categories", "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier")
def market_categories(v):
    item = F.struct(text("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    landed = wrapped_pages(v, item, v.table("supplier"), "s_suppkey", "categories")
    return pages.categories(pages.parse_pages(landed, "page", pages.MARKET_SCHEMAS["categories"]))


@entry(
    "market_playlists",
    """SELECT CAST(doc_id AS VARCHAR) AS playlist_id, source AS name, substr(text, 1, 500) AS description,
  n_chars AS tracks_total FROM documents""",
)
def market_playlists(v):
    """Documents as long collection descriptions."""
    item = F.struct(
        text("doc_id").alias("id"), F.col("source").alias("name"), F.col("text").alias("description"),
        F.struct(F.col("n_chars").alias("total")).alias("tracks"),
    )
    landed = wrapped_pages(v, item, v.table("documents"), "doc_id", "playlists")
    return pages.market_playlists(pages.parse_pages(landed, "page", pages.MARKET_SCHEMAS["playlists"])).select(
        "playlist_id", "name", "description", "tracks_total"
    )


def land_arrays(records: DataFrame, folder: str) -> None:
    """The records as JSON array files, one per task, written line by line."""

    def array_lines(batches):
        started = False
        for batch in batches:
            if batch.num_rows:
                marks = pa.array(["," if started else "["] + [","] * (batch.num_rows - 1))
                started = True
                yield pa.record_batch([pc.binary_join_element_wise(marks, batch.column("value"), "")], ["value"])
        yield pa.record_batch([pa.array(["]" if started else "[]"])], ["value"])

    lines = records.select(F.to_json(F.struct(*records.columns)).alias("value"))
    lines.mapInArrow(array_lines, "value string").write.text(folder)


def landed(v, label: str, arrays=None, objects=None) -> str:
    """A folder with one folder of export files per name: arrays, or one object a line."""
    folder = scratch_path(v.spark, label)
    for name, records in (arrays or {}).items():
        land_arrays(records, f"{folder}/{name}")
    for name, records in (objects or {}).items():
        records.write.json(f"{folder}/{name}")
    return folder


def basic_records(v):
    return v.plays_long().select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("endTime"),
        F.concat(F.lit("Artist "), text("artist_id")).alias("artistName"),
        F.concat(F.lit("Track "), text("track_id")).alias("trackName"),
        F.col("ms_played").alias("msPlayed"),
    )


def extended_records(v):
    return v.plays_short().select(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        "ms_played",
        F.concat(F.lit("Track "), text("track_id")).alias("master_metadata_track_name"),
        F.concat(F.lit("Artist "), text("listener")).alias("master_metadata_album_artist_name"),
        F.col("track_uri").alias("spotify_track_uri"),
        F.when(F.col("skipped"), True).alias("skipped"),
    )


PARTS_SQL = """strftime(timestamp, '%Y-%m-%d') AS date, CAST(hour(timestamp) AS INTEGER) AS hour, dayname(timestamp) AS day_of_week,
  CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week_num, strftime(timestamp, '%Y-%m') AS month,
  round(ms_played / 60000, 6) AS minutes_played"""


def shown(df):
    return r6(
        df.withColumns({"timestamp": second("timestamp"), "date": F.col("date").cast("string")}), "minutes_played"
    )


@entry(
    "load_history_basic",
    f"""SELECT {second_sql('timestamp')} AS timestamp, 'Artist ' || artist_id AS artist_name, 'Track ' || track_id AS track_name,
  ms_played, {PARTS_SQL}, 'basic' AS source FROM plays_long WHERE ms_played >= 30000""",
    ("plays_long",),
)
def load_history_basic(v):
    folder = landed(v, "basic", {"basic": basic_records(v)})
    return shown(exports.load_basic(v.spark, folder, "basic/part-*"))


@entry(
    "load_history_extended",
    f"""SELECT {second_sql('timestamp')} AS timestamp, 'Artist ' || listener AS artist_name, 'Track ' || track_id AS track_name,
  track_uri, ms_played, {PARTS_SQL}, 'extended' AS source FROM plays_short WHERE ms_played >= 30000 AND NOT skipped""",
    ("plays_short",),
)
def load_history_extended(v):
    folder = landed(v, "extended", {"extended": extended_records(v)})
    return shown(exports.load_extended(v.spark, folder, "extended/part-*")).select(
        "timestamp", "artist_name", "track_name", "track_uri", "ms_played", "date", "hour", "day_of_week",
        "day_of_week_num", "month", "minutes_played", "source",
    )


def search_records(v):
    """Searches of failed events have a damaged time."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z[UTC]'")
    return v.table("events").select(
        F.when(F.col("event_type") == "error", "soon").otherwise(stamp).alias("searchTime"),
        F.concat(F.lit("song \"{"), text("event_id"), F.lit("}\"")).alias("searchQuery"),
    )


@entry(
    "load_search_queries",
    f"""SELECT 'song "{{' || event_id || '}}"' AS "searchQuery", CASE WHEN event_type <> 'error' THEN {second_sql('ts')} END AS timestamp,
  CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m') END AS month,
  CASE WHEN event_type <> 'error' THEN CAST(hour(ts) AS INTEGER) END AS hour FROM events""",
)
def load_search_queries(v):
    """Search texts hold quotes and braces, so that records can only be told apart by reading them."""
    folder = landed(v, "search", {"search": search_records(v)})
    found = exports.load_search(v.spark, folder, "search/part-*")
    return found.select("searchQuery", second("timestamp").alias("timestamp"), "month", "hour")


def follow_records(v):
    users = v.table("events").select("event_type", F.concat(F.lit("u"), text("user_id")).alias("user")).distinct()

    def those(kind):
        return F.when(F.col("event_type") == kind, F.array("user"))

    return users.select(
        those("view").alias("userIsFollowing"), those("click").alias("userIsFollowedBy"), those("error").alias("userIsBlocking")
    )


@entry(
    "load_follow",
    """SELECT DISTINCT 'u' || user_id AS user, CASE event_type WHEN 'view' THEN 'following' WHEN 'click' THEN 'followed_by'
  ELSE 'blocking' END AS relationship FROM events WHERE event_type IN ('view', 'click', 'error')""",
)
def load_follow(v):
    folder = landed(v, "follow", objects={"follow": follow_records(v)})
    return exports.load_follow(v.spark, folder, "follow/part-*")


def library_records(v):
    artist = F.when(
        F.col("l_suppkey") % 4 != 0, F.struct(F.concat(F.lit("Artist "), text("l_suppkey")).alias("name"))
    )
    track = F.struct(
        F.concat(F.lit("spotify:track:"), text("l_partkey")).alias("uri"),
        artist.alias("artist"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("addedAt"),
    )
    # One object per order, with its lines as tracks.
    return v.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(track).alias("tracks")).select("tracks")


@entry(
    "load_library_snapshot",
    f"""SELECT 'spotify:track:' || l_partkey AS track_uri, CAST(l_partkey AS VARCHAR) AS track_id,
  CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 'Artist ' || l_suppkey END AS artist_name, '' AS album_name,
  {second_sql('l_shipdate')} AS added_at, strftime(l_shipdate, '%Y-%m-%d') AS added_date FROM lineitem""",
)
def load_library_snapshot(v):
    folder = landed(v, "library", objects={"library": library_records(v)})
    return exports.load_library(v.spark, folder, "library/part-*").select(
        "track_uri", "track_id", "artist_name", "album_name", second("added_at").alias("added_at"),
        F.col("added_date").cast("string").alias("added_date"),
    )


def tech_records(events, as_text: bool):
    """A technical log of events, with times as text or in milliseconds."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp_utc")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).alias("context_time")
    return events.select(stamp if as_text else millis, (F.col("value") > 20).alias("fatal"), text("event_id").alias("message_error_code"))


@entry(
    "load_tech_log",
    f"""SELECT CAST(event_id AS VARCHAR) AS message_error_code, value > 20 AS fatal, 'text' AS kind, {second_sql('ts')} AS timestamp,
  strftime(ts, '%Y-%m') AS month FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), value > 20, 'millis', {second_sql('ts')}, strftime(ts, '%Y-%m') FROM events""",
)
def load_tech_log(v):
    events = v.table("events")
    folder = landed(v, "tech", {"text": tech_records(events, True), "millis": tech_records(events, False)})

    def read(kind):
        return exports.load_tech_log(v.spark, folder, f"{kind}/part-*").select(
            "message_error_code", "fatal", F.lit(kind).alias("kind"), second("timestamp").alias("timestamp"), "month"
        )

    return read("text").unionByName(read("millis"))


def wrapped_records(v):
    """A yearly summary, one record per hour of the day, in one file."""
    plays = v.plays_short().groupBy(F.hour("timestamp").alias("hour"))
    return plays.agg(F.count(F.lit(1)).alias("plays"), F.sum("ms_played").alias("total_ms")).coalesce(1)


@entry(
    "load_wrapped",
    """SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS plays, CAST(sum(round(value * 1000)) AS BIGINT) AS total_ms
FROM events GROUP BY 1""",
)
def load_wrapped(v):
    """The summary is read back whole."""
    folder = landed(v, "wrapped", {"wrapped": wrapped_records(v)})
    body = F.from_json("body", "ARRAY<STRUCT<hour BIGINT, plays BIGINT, total_ms BIGINT>>")
    return exports.load_wrapped(v.spark, folder, pattern="wrapped/part-*").select(F.inline(body))


@entry(
    "sync_exports",
    """SELECT 'streaming_history' AS "table", 'written' AS status, count(*) AS rows FROM plays_short WHERE ms_played >= 30000 AND NOT skipped
UNION ALL SELECT 'search_queries', 'written', count(*) FROM events
UNION ALL SELECT 'wrapped_data', 'written', 1
UNION ALL SELECT 'follow_data', 'written', count(*) FROM (SELECT DISTINCT user_id, event_type FROM events WHERE event_type IN ('view', 'click', 'error'))
UNION ALL SELECT 'library_snapshot', 'written', count(*) FROM lineitem
UNION ALL SELECT 'playback_errors', 'written', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'playback_retries', 'written', count(*) FROM events WHERE event_type = 'click'
UNION ALL SELECT 'webapi_events', 'written', count(*) FROM events WHERE event_type = 'view'""",
    ("plays_short",),
)
def sync_exports(v):
    """All eight tables from files of their kinds."""
    account = landed(
        v, "account", {"basic": basic_records(v), "search": search_records(v), "wrapped": wrapped_records(v)},
        {"follow": follow_records(v), "library": library_records(v)},
    )
    extended = landed(v, "extended", {"extended": extended_records(v)})
    kinds = {"playback_errors": "error", "playback_retries": "click", "webapi_events": "view"}
    events = v.table("events")
    tech = landed(v, "tech", {t: tech_records(events.where(F.col("event_type") == k), t != "playback_retries") for t, k in kinds.items()})
    names = ["basic", "search", "wrapped", "follow", "library", "extended", *kinds]
    patterns = {name: f"{name}/part-*" for name in names}
    return tables.sync_exports(v.spark, account, extended, tech, scratch_path(v.spark, "tables"), patterns=patterns)


def _round_trip(name: str, write_and_read):
    @entry(
        name,
        f"""SELECT playlist_id, track_id, {second_sql('added_at')} AS added_at, position FROM playlist_tracks""",
        ("playlist_tracks",),
    )
    def query(v):
        rows = v.positioned_tracks().select("playlist_id", "track_id", second("added_at").alias("added_at"), "position")
        return write_and_read(v.spark, rows, scratch_path(v.spark, name))


TRIP_SCHEMA = "playlist_id BIGINT, track_id BIGINT, added_at STRING, position BIGINT"
_round_trip("save_table", lambda s, df, p: s.read.parquet(tables.save_table(df, p, "members")))
_round_trip("load_table", lambda s, df, p: (tables.save_table(df, p, "members"), tables.load_table(s, p, "members"))[1])
_round_trip(
    "export_table_csv",
    lambda s, df, p: s.read.schema(TRIP_SCHEMA).option("header", True).csv(tables.export_table(df, f"{p}/members.csv")),
)
_round_trip("export_table_parquet", lambda s, df, p: s.read.parquet(tables.export_table(df, f"{p}/members")))
_round_trip("save_json", lambda s, df, p: s.read.schema(TRIP_SCHEMA).json(tables.save_json(df, f"{p}/members.json")))


def event_stream(v):
    plays = v.table("events")
    # As a pattern the path may be one file or the folder of files that a cluster writes.
    raw = jobs.read_stream(v.spark, f"{v.folder}/events[.]parquet", plays.schema)
    track = F.get_json_object("props", "$.k").cast("bigint")
    return raw.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("listener"),
        F.concat(F.lit("spotify:track:"), track.cast("string")).alias("track_uri"),
        F.round(F.col("value") * 1000).cast("bigint").alias("ms_played"),
        (F.col("event_type") == "error").alias("skipped"),
    )


def streamed(v, stream: DataFrame, label: str, partition_by=None) -> DataFrame:
    sink = scratch_path(v.spark, f"{label}-sink")
    jobs.run_available(stream, sink, scratch_path(v.spark, f"{label}-state"), partition_by)
    return v.spark.read.parquet(sink)


@entry(
    "stream_ingest_history",
    f"""SELECT event_id, {second_sql('timestamp')} AS timestamp, CAST(hour(timestamp) AS INTEGER) AS hour,
  strftime(timestamp, '%Y-%m') AS month FROM plays_short WHERE ms_played >= 30000 AND NOT skipped""",
    ("plays_short",),
)
def stream_ingest_history(v):
    """Every play arrives twice, in one run and in the next; each is kept once."""
    twice = event_stream(v).unionByName(event_stream(v))
    sink, state = scratch_path(v.spark, "ingest-sink"), scratch_path(v.spark, "ingest-state")
    jobs.ingest_available(twice, sink, state, ["event_id"])
    jobs.ingest_available(event_stream(v), sink, scratch_path(v.spark, "ingest-again"), ["event_id"])
    plays = jobs.read_plays(v.spark, sink, "event_id bigint, timestamp timestamp, hour int, month string")
    return plays.select("event_id", second("timestamp").alias("timestamp"), "hour", "month")


@entry(
    "stream_play_counts",
    """SELECT strftime(timestamp, '%Y-%m-%d') AS day, track_uri, count(ms_played) AS play_count,
  CAST(sum(ms_played) AS BIGINT) AS total_ms FROM plays_short GROUP BY 1, 2""",
    ("plays_short",),
)
def stream_play_counts(v):
    sink = scratch_path(v.spark, "counts-sink")
    jobs.count_available(event_stream(v), sink, scratch_path(v.spark, "counts-state"))
    counts = jobs.read_counts(v.spark, sink)
    return counts.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "track_uri", "play_count", "total_ms")


@entry("stream_first_plays", "SELECT DISTINCT listener, track_uri FROM plays_short", ("plays_short",))
def stream_first_plays(v):
    return streamed(v, jobs.first_plays(event_stream(v)), "first")
