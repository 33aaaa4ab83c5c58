"""Names, descriptions, refresh, archive and protection plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratebook.functions import music, names, texts, times
from cratebook.functions.names import NameStyle
from cratebook.operators import library, overlap, profiles
from cratebook.plans import archive, protect, refresh, reports
from cratebook.testbed.queries_library import LIBRARY, MOOD_SQL, MONTHS, r6, stats_of
from cratebook.testbed.queries_overlap import pairs_sql
from cratebook.testbed.queries_plays import second, second_sql
from cratebook.testbed.registry import entry
from cratebook.testbed.virtual import AS_OF, OLD_STATE_CUTOFF

MON_SQL = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(month(o_orderdate) AS INTEGER) - 2, 3)"
YY_SQL = "strftime(o_orderdate, '%y')"


@entry(
    "period_end",
    f"""SELECT o_orderkey,
  {second_sql("last_day(o_orderdate) + INTERVAL '23:59:59'")} AS month_end,
  strftime(o_orderdate, '%Y') || '-12-31 23:59:59' AS year_end, CAST(NULL AS VARCHAR) AS bad_end FROM orders""",
)
def period_end(v):
    day = F.col("o_orderdate")
    month, year = F.date_format(day, "yyyy-MM"), F.date_format(day, "yyyy")
    return v.table("orders").select(
        "o_orderkey",
        second(times.period_end(F.lit("month"), month)).alias("month_end"),
        second(times.period_end(F.lit("year"), year)).alias("year_end"),
        second(times.period_end(F.lit("month"), F.concat(F.lit("x"), month))).alias("bad_end"),
    )


LONG_MONTHS = ", ".join(f"'{m}'" for m in names.MONTHS_LONG)


@entry(
    "archive_name",
    f"""SELECT o_orderkey, 'AJFinds' || {MON_SQL} || {YY_SQL} AS monthly, 'AJTop' || {MON_SQL} || {YY_SQL} AS top,
  'AJFinds' || {YY_SQL} AS yearly, 'AJDiscovery' || {YY_SQL} AS yearly_discovery,
  'AJ FINDS' || upper(list_extract([{LONG_MONTHS}], month(o_orderdate))) || '-' || strftime(o_orderdate, '%Y') AS long_upper,
  'aj_finds' || strftime(o_orderdate, '%m') || strftime(o_orderdate, '%Y') AS numeric_lower FROM orders""",
)
def archive_name(v):
    day = F.col("o_orderdate")
    month, year = F.date_format(day, "yyyy-MM"), F.year(day)
    loud = NameStyle(date_format="long", month_separator="dash", prefix_separator="space", capitalization="upper")
    quiet = NameStyle(date_format="numeric", prefix_separator="underscore", capitalization="lower")
    return v.table("orders").select(
        "o_orderkey",
        names.archive_name("monthly", month=month).alias("monthly"),
        names.archive_name("most_played", month=month).alias("top"),
        names.archive_name("yearly", year=year).alias("yearly"),
        names.archive_name("discovery", year=year).alias("yearly_discovery"),
        names.archive_name("monthly", month=month, style=loud).alias("long_upper"),
        names.archive_name("monthly", month=month, style=quiet).alias("numeric_lower"),
    )


@entry(
    "archive_description",
    f"SELECT o_orderkey, 'Liked songs from ' || {MON_SQL} || ' ' || strftime(o_orderdate, '%Y') AS description FROM orders",
)
def archive_description(v):
    period = F.date_format("o_orderdate", "MMM yyyy")
    return v.table("orders").select(
        "o_orderkey", texts.archive_description(F.lit("Liked songs"), period).alias("description")
    )


BASE_LINE_SQL = rf"""CASE
  WHEN regexp_matches(name, '(?i)^AJFinds({MONTHS})\d\d$') THEN 'Liked songs from ' || substr(name, 8, 3) || ' ' || substr(name, 11, 2)
  WHEN regexp_matches(name, '(?i)^AJTop({MONTHS})\d\d$') THEN 'Most played from ' || substr(name, 6, 3) || ' ' || substr(name, 9, 2)
  WHEN regexp_matches(name, '(?i)^AJDiscovery({MONTHS})\d\d$') THEN 'Discovery from ' || substr(name, 12, 3) || ' ' || substr(name, 15, 2)
  WHEN regexp_matches(name, '(?i)^AJFinds\d\d\d\d$') THEN 'Liked songs from ' || substr(name, 8)
  WHEN regexp_matches(name, '(?i)^AJFinds\d\d$') THEN 'Liked songs from 20' || substr(name, 8) END"""
NAMES_SQL = """n AS (SELECT playlist_id, name FROM playlists
  UNION ALL SELECT playlist_id, replace(replace(name, 'Finds', 'discovery'), 'AJTop', 'ajfinds') FROM playlists
  UNION ALL SELECT playlist_id, replace(name, 'Finds', 'TOP') FROM playlists
  UNION ALL SELECT playlist_id, replace(name, 'AJTop', 'AJFinds20') FROM playlists)"""


@entry(
    "base_line_from_name",
    f"WITH {NAMES_SQL} SELECT playlist_id, name, {BASE_LINE_SQL} AS line FROM n",
    ("playlists",),
)
def base_line_from_name(v):
    base = v.playlists().select("playlist_id", "name")

    def changed(*pairs):
        name = F.col("name")
        for old, new in pairs:
            name = F.replace(name, F.lit(old), F.lit(new))
        return base.select("playlist_id", name.alias("name"))

    everything = (
        base.unionByName(changed(("Finds", "discovery"), ("AJTop", "ajfinds")))
        .unionByName(changed(("Finds", "TOP")))
        .unionByName(changed(("AJTop", "AJFinds20")))
    )
    return everything.select("playlist_id", "name", texts.base_line(F.col("name")).alias("line"))


SPACE_SQL = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
CONTROL_SQL = r"[\x00-\x08\x0B-\x0C\x0E-\x1F\x7F]"


@entry(
    "strip_parens",
    rf"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text,
    '{SPACE_SQL}*\([^)]*\){SPACE_SQL}*', ' ', 'g'), '{SPACE_SQL}*\[[^\]]*\]{SPACE_SQL}*', ' ', 'g'),
    '{SPACE_SQL}+', ' ', 'g')) AS text FROM documents""",
)
def strip_parens(v):
    return v.table("documents").select("doc_id", texts.strip_parens(F.col("text")).alias("text"))


@entry(
    "clean_description",
    rf"""WITH c AS (SELECT doc_id, regexp_replace(text, '{CONTROL_SQL}', '', 'g') AS t FROM documents),
l AS (SELECT doc_id, t, position(chr(10) IN t) AS p FROM c),
s AS (SELECT doc_id, t, p, CASE WHEN p > 0 THEN substr(t, 1, p - 1) ELSE t END AS a, CASE WHEN p > 0 THEN substr(t, p + 1) ELSE '' END AS b FROM l)
SELECT doc_id, CASE WHEN length(t) <= 300 THEN t
  WHEN p > 0 AND length(a) <= 290 THEN a || chr(10) || substr(b, 1, 295 - length(a)) || '...'
  ELSE substr(t, 1, 297) || '...' END AS text FROM s""",
)
def clean_description(v):
    return v.table("documents").select("doc_id", texts.clean_description(F.col("text")).alias("text"))


@entry(
    "publishable_description",
    r"""WITH c AS (SELECT doc_id, regexp_replace(nfc_normalize(text),
    '[\p{C}\x{FE00}-\x{FE0F}\x{1F300}-\x{1FAFF}]', '', 'g') AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) <= 300 THEN t ELSE substr(t, 1, 297) || '...' END AS text FROM c""",
)
def publishable_description(v):
    return v.table("documents").select("doc_id", texts.publishable_description(F.col("text")).alias("text"))


TAGS_SQL = f"""m AS (SELECT playlist_id, {MOOD_SQL} AS mood, count(*) AS n
   FROM playlist_tracks JOIN track_features USING (track_id) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY playlist_id ORDER BY n DESC, mood) AS k FROM m),
tags AS (SELECT playlist_id, string_agg(mood, ' • ' ORDER BY k) FILTER (WHERE k <= 5) AS tags FROM r GROUP BY 1)"""


def tags_of(v):
    counts = profiles.mood_counts(v.playlist_tracks(), profiles.item_moods(v.track_features()))
    return profiles.mood_tag_lists(counts)


@entry(
    "mood_line",
    f"""WITH {TAGS_SQL}
SELECT playlist_id, description || chr(10) || 'Moods: ' || tags AS appended, 'Moods: ' || tags AS alone,
  description || chr(10) || 'Moods: ' || tags || chr(10) || chr(10) || 'Tail' AS replaced
FROM playlists JOIN tags USING (playlist_id)""",
    ("playlists", "playlist_tracks", "track_features"),
)
def mood_line(v):
    old = F.concat(F.col("description"), F.lit("\nMoods: $1 old\nleft over\n\nTail"))
    return (
        v.playlists()
        .join(tags_of(v), "playlist_id")
        .select(
            "playlist_id",
            texts.with_mood_line(F.col("description"), F.col("moods")).alias("appended"),
            texts.with_mood_line(F.lit(""), F.col("moods")).alias("alone"),
            texts.with_mood_line(old, F.col("moods")).alias("replaced"),
        )
    )


@entry(
    "rich_description",
    f"""WITH {TAGS_SQL},
d AS (SELECT pt.playlist_id, t.duration_ms, t.popularity, CAST(substr(t.release_date, 1, 4) AS INTEGER) AS y, a.name AS artist
      FROM playlist_tracks pt LEFT JOIN tracks t USING (track_id)
      LEFT JOIN track_artists ta ON ta.track_id = pt.track_id AND ta.position = 0
      LEFT JOIN artists a ON a.artist_id = ta.artist_id),
s AS (SELECT playlist_id, count(*) AS n, round(sum(duration_ms) / 3600000, 1) AS h, round(avg(popularity), 1) AS pop,
        min(y) AS y1, max(y) AS y2 FROM d GROUP BY 1),
ac AS (SELECT playlist_id, artist, row_number() OVER (PARTITION BY playlist_id ORDER BY count(*) DESC, artist) AS k
       FROM d GROUP BY 1, 2),
al AS (SELECT playlist_id, string_agg(artist, ', ' ORDER BY k) AS top FROM ac WHERE k <= 3 GROUP BY 1)
SELECT playlist_id, concat_ws(chr(10), description,
  concat_ws(' | ', '📊 ' || n || ' tracks',
    CASE WHEN h > 0 THEN '⏱️ ' || CASE WHEN h < 1 THEN CAST(CAST(floor(h * 60) AS BIGINT) AS VARCHAR) || ' min' ELSE CAST(h AS VARCHAR) || ' hr' END END,
    CASE WHEN pop > 0 THEN '⭐ ' || CAST(pop AS VARCHAR) || '/100' END,
    '📅 ' || CASE WHEN y1 = y2 THEN CAST(y1 AS VARCHAR) ELSE y1 || '-' || y2 END),
  CASE WHEN length(top) <= 50 THEN '🎤 ' || top END, tags) AS text
FROM playlists JOIN s USING (playlist_id) LEFT JOIN al USING (playlist_id) LEFT JOIN tags USING (playlist_id)""",
    (*LIBRARY, "track_features"),
)
def rich_description(v):
    moods = tags_of(v).select("playlist_id", texts.mood_tags(F.col("moods")).alias("tags"))
    return (
        stats_of(v)
        .where(F.col("total_tracks") > 0)
        .join(v.playlists().select("playlist_id", "description"), "playlist_id")
        .join(moods, "playlist_id", "left")
        .select(
            "playlist_id",
            texts.rich_description(
                F.col("description"), F.col("total_tracks"), F.col("total_duration_hours"),
                F.col("avg_popularity"), F.col("first_year"), F.col("last_year"), F.col("top_artists"), F.col("tags"),
            ).alias("text"),
        )
    )


@entry(
    "description_delta",
    f"""
WITH p AS (SELECT playlist_id, name, CASE WHEN starts_with(name, 'AJ') THEN ''
    WHEN starts_with(name, 'New') OR starts_with(name, 'Liked') THEN name ELSE description || ' (auto) [x]' END AS description,
    description AS plain, snapshot_id FROM playlists),
o AS (SELECT playlist_id, snapshot_id FROM old_playlists),
w AS (SELECT p.playlist_id, p.name, p.description, p.snapshot_id,
    CASE WHEN description = '' OR description = name THEN coalesce({BASE_LINE_SQL}, name) ELSE plain END AS new_description
  FROM p LEFT JOIN o USING (playlist_id)
  WHERE p.snapshot_id IS DISTINCT FROM o.snapshot_id AND playlist_id IN (SELECT playlist_id FROM playlist_tracks))
SELECT * FROM w WHERE new_description <> description""",
    ("playlists", "old_playlists", "playlist_tracks"),
)
def description_delta(v):
    name = F.col("name")
    current = (
        F.when(name.startswith("AJ"), "")
        .when(name.startswith("New") | name.startswith("Liked"), name)
        .otherwise(F.concat("description", F.lit(" (auto) [x]")))
    )
    described = v.playlists().withColumn("description", current)
    return archive.description_delta(described, v.playlist_tracks(), v.playlists(before=OLD_STATE_CUTOFF))


@entry(
    "rename_plan",
    """WITH n AS (SELECT name AS old_name, max(playlist_id) AS playlist_id FROM playlists GROUP BY 1),
c AS (SELECT *, CASE WHEN contains(old_name, 'Top') THEN replace(old_name, 'Top', 'Best')
    WHEN contains(old_name, 'Discovery') THEN replace(old_name, 'Discovery', 'New')
    WHEN contains(old_name, 'rock') THEN replace(old_name, 'rock', 'pop') END AS new_name FROM n)
SELECT playlist_id, old_name, new_name FROM c WHERE new_name IS NOT NULL AND new_name NOT IN (SELECT old_name FROM n)""",
    ("playlists",),
)
def rename_plan(v):
    return archive.rename_plan(v.playlists(), {"Top": "Best", "Discovery": "New", "rock": "Pop"})


STATE_SQL = """now AS (SELECT playlist_id, snapshot_id FROM playlists WHERE is_owned),
st AS (SELECT playlist_id, snapshot_id FROM old_playlists WHERE snapshot_id IS NOT NULL),
diff AS (SELECT playlist_id, CASE WHEN n.playlist_id IS NULL THEN 'removed' WHEN s.playlist_id IS NULL THEN 'new'
    WHEN n.snapshot_id IS DISTINCT FROM s.snapshot_id THEN 'changed' ELSE 'unchanged' END AS status
  FROM now n FULL JOIN st s USING (playlist_id))"""


def state_of(v):
    return v.playlists(before=OLD_STATE_CUTOFF).where(F.col("snapshot_id").isNotNull())


@entry("snapshot_diff", f"WITH {STATE_SQL} SELECT * FROM diff", ("playlists", "old_playlists"))
def snapshot_diff(v):
    return refresh.snapshot_diff(library.owned(v.playlists()), state_of(v))


REFRESH_SQL = f"""WITH {STATE_SQL},
old AS (SELECT playlist_id, track_id FROM playlist_tracks WHERE added_at <= TIMESTAMP '{OLD_STATE_CUTOFF}'),
t AS (SELECT playlist_id FROM diff WHERE status IN ('new', 'changed')),
fresh AS (SELECT playlist_id, track_id FROM playlist_tracks SEMI JOIN t USING (playlist_id)),
nxt AS (SELECT playlist_id, track_id FROM old WHERE playlist_id NOT IN (SELECT playlist_id FROM diff WHERE status <> 'unchanged')
  UNION ALL SELECT * FROM fresh)"""


def refresh_of(v):
    now = v.playlist_tracks()
    then = now.where(F.col("added_at") <= F.lit(OLD_STATE_CUTOFF).cast("timestamp_ntz"))
    return refresh.incremental_refresh(library.owned(v.playlists()), state_of(v), then, now, AS_OF)


@entry(
    "incremental_refresh",
    REFRESH_SQL + " SELECT playlist_id, count(*) AS n, CAST(sum(track_id) AS BIGINT) AS id_sum FROM nxt GROUP BY 1",
    ("playlists", "old_playlists", "playlist_tracks"),
)
def incremental_refresh(v):
    return refresh_of(v).members.groupBy("playlist_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("track_id").alias("id_sum")
    )


@entry(
    "incremental_refresh_counts",
    REFRESH_SQL
    + """ SELECT (SELECT count(*) FROM diff WHERE status <> 'removed') AS checked, (SELECT count(*) FROM t) AS updated,
  (SELECT count(*) FROM diff WHERE status = 'removed') AS removed, (SELECT count(*) FROM fresh) AS rows_written,
  (SELECT count(*) FROM (SELECT DISTINCT playlist_id, track_id FROM fresh) ANTI JOIN old USING (playlist_id, track_id)) AS net_added""",
    ("playlists", "old_playlists", "playlist_tracks"),
)
def incremental_refresh_counts(v):
    return refresh_of(v).counts


# The saved items of all owned collections act as the liked items here.
LIKED_SQL = """liked AS (SELECT track_uri, added_at, position, playlist_id FROM playlist_tracks
  SEMI JOIN (SELECT playlist_id FROM playlists WHERE is_owned) USING (playlist_id))"""


def liked_of(v):
    return library.keep_in(v.positioned_tracks(), library.owned(v.playlists()), "playlist_id")


@entry(
    "liked_by_period",
    f"""WITH {LIKED_SQL},
b AS (SELECT 'monthly' AS period_type, strftime(added_at, '%Y-%m') AS period, * FROM liked WHERE strftime(added_at, '%Y-%m') <= '2000-06'
  UNION ALL SELECT 'yearly', strftime(added_at, '%Y'), * FROM liked WHERE strftime(added_at, '%Y-%m') <= '2000-06')
SELECT period_type, period, track_uri, {second_sql('min(added_at)')} AS added_at,
  arg_min(position, (added_at, position)) AS position FROM b GROUP BY 1, 2, 3""",
    ("playlists", "playlist_tracks"),
)
def liked_by_period(v):
    return archive.liked_by_period(liked_of(v), "2000-06").withColumn("added_at", second("added_at"))


IDS_SQL = "ids AS (SELECT name, max(playlist_id) AS playlist_id FROM playlists GROUP BY 1)"
MONTHLY_SQL = f"""WITH {LIKED_SQL}, {IDS_SQL},
cal AS (SELECT strftime(d, '%Y-%m') AS period, 'AJFinds' || strftime(d, '%b%y') AS name
        FROM (SELECT DATE '2001-09-01' - INTERVAL (i) MONTH AS d FROM range(24) r(i))),
lm AS (SELECT strftime(added_at, '%Y-%m') AS period, track_uri, min(added_at) AS added_at,
        arg_min(position, (added_at, position)) AS position FROM liked GROUP BY 1, 2),
want AS (SELECT period, name, playlist_id, track_uri, added_at, position FROM cal JOIN lm USING (period) LEFT JOIN ids USING (name)),
rws AS (SELECT * FROM want WHERE (playlist_id, track_uri) NOT IN (SELECT (playlist_id, track_uri) FROM playlist_tracks) OR playlist_id IS NULL)"""


def monthly_plan_of(v):
    return archive.monthly_plan(
        liked_of(v), v.playlists(), v.playlist_tracks(), "2001-09-20", months=24
    )


@entry(
    "monthly_plan",
    MONTHLY_SQL
    + f""" SELECT period, name, playlist_id, track_uri, {second_sql('added_at')} AS added_at, position,
  CASE WHEN playlist_id IS NULL THEN 'create' ELSE 'add' END AS action FROM rws""",
    ("playlists", "playlist_tracks"),
)
def monthly_plan(v):
    return monthly_plan_of(v)[1].withColumn("added_at", second("added_at"))


@entry(
    "monthly_plan_headers",
    MONTHLY_SQL
    + """ SELECT period, name, playlist_id, CASE WHEN playlist_id IS NULL THEN 'create' ELSE 'add' END AS action,
  (SELECT count(*) FROM lm WHERE lm.period = cal.period) AS items,
  (SELECT count(*) FROM rws WHERE rws.period = cal.period) AS to_add
FROM cal LEFT JOIN ids USING (name)""",
    ("playlists", "playlist_tracks"),
)
def monthly_plan_headers(v):
    return monthly_plan_of(v)[0]


YEAR_STATS_SQL = """ys AS (SELECT CAST(year(timestamp) AS INTEGER) AS year, track_uri, count(ms_played) AS pc, sum(ms_played) AS ms,
    min(timestamp) AS f FROM plays_long GROUP BY 1, 2),
topy AS (SELECT year, track_uri, row_number() OVER (PARTITION BY year ORDER BY pc DESC, ms DESC, track_uri) AS rk FROM ys QUALIFY rk <= 100),
discy AS (SELECT year, track_uri, row_number() OVER (PARTITION BY year ORDER BY f, track_uri) AS rk FROM ys QUALIFY rk <= 100)"""


@entry(
    "current_year_plan",
    f"""WITH {LIKED_SQL}, {IDS_SQL}, {YEAR_STATS_SQL},
d AS (SELECT 'monthly' AS type, track_uri, arg_min(position, (added_at, position)) AS rank, 'AJFinds00' AS name FROM liked GROUP BY 2
  UNION ALL SELECT 'most_played', track_uri, rk, 'AJTop00' FROM topy WHERE year = 2000
  UNION ALL SELECT 'discovery', track_uri, rk, 'AJDiscovery00' FROM discy WHERE year = 2000)
SELECT type, track_uri, rank, name, playlist_id, CASE WHEN playlist_id IS NULL THEN 'create' ELSE 'add' END AS action
FROM d LEFT JOIN ids USING (name)
WHERE playlist_id IS NULL OR (playlist_id, track_uri) NOT IN (SELECT (playlist_id, track_uri) FROM playlist_tracks)""",
    ("playlists", "playlist_tracks", "plays_long"),
)
def current_year_plan(v):
    return archive.current_year_plan(
        liked_of(v), v.plays_long(), v.playlists(), v.playlist_tracks(), "2000-12-31"
    )


ARCHIVE_SQL = f"""WITH {LIKED_SQL}, {IDS_SQL}, {YEAR_STATS_SQL},
mon AS (SELECT playlist_id AS source_id, CASE WHEN name LIKE 'AJFinds%' THEN 'monthly' WHEN name LIKE 'AJTop%' THEN 'most_played'
      ELSE 'discovery' END AS type, CAST(2000 + CAST(right(name, 2) AS INTEGER) AS INTEGER) AS year
    FROM ids WHERE regexp_matches(name, '^AJ(Finds|Top|Discovery)({MONTHS})[0-9][0-9]$')
      AND (2000 + CAST(right(name, 2) AS INTEGER)) || '-' ||
        lpad(CAST((position(left(right(name, 5), 3) IN 'JanFebMarAprMayJunJulAugSepOctNovDec') + 2) // 3 AS VARCHAR), 2, '0') <= '2001-12'),
fm AS (SELECT year, type, track_uri, min((source_id, position)) AS o FROM mon JOIN playlist_tracks ON source_id = playlist_id GROUP BY 1, 2, 3),
c AS (SELECT fm.year, type, fm.track_uri, CASE WHEN type = 'most_played' THEN coalesce(pc, 0) ELSE 0 END AS plays, o[1] AS source_id, o[2] AS place
  FROM fm LEFT JOIN ys ON ys.year = fm.year AND ys.track_uri = fm.track_uri),
fb AS (SELECT CAST(year(added_at) AS INTEGER) AS year, 'monthly' AS type, track_uri, arg_min(position, (added_at, position)) AS place
      FROM liked WHERE strftime(added_at, '%Y-%m') <= '2001-12' GROUP BY 1, 3
  UNION ALL SELECT year, 'most_played', track_uri, rk FROM topy UNION ALL SELECT year, 'discovery', track_uri, rk FROM discy),
d AS (SELECT * FROM c UNION ALL SELECT year, type, track_uri, 0, NULL, place FROM fb
      WHERE (year, type) NOT IN (SELECT (year, type) FROM fm)),
n AS (SELECT *, CASE type WHEN 'monthly' THEN 'AJFinds' WHEN 'most_played' THEN 'AJTop' ELSE 'AJDiscovery' END
        || substr(CAST(year AS VARCHAR), 3, 2) AS name FROM d),
rws AS (SELECT n.*, playlist_id, CASE WHEN playlist_id IS NULL THEN 'create' ELSE 'add' END AS action
  FROM n LEFT JOIN ids USING (name) WHERE playlist_id IS NULL OR (year IN (SELECT year FROM mon)
    AND (playlist_id, track_uri) NOT IN (SELECT (playlist_id, track_uri) FROM playlist_tracks)))"""


def archive_of(v):
    # keep_months=0 plans every month up to the reference day.
    return archive.archive_plan(
        v.playlists(), v.positioned_tracks(), liked_of(v), v.plays_long(), AS_OF, keep_months=0
    )


@entry(
    "archive_plan",
    ARCHIVE_SQL + " SELECT year, type, track_uri, plays, source_id, place, name, playlist_id, action FROM rws",
    ("playlists", "playlist_tracks", "plays_long"),
)
def archive_plan(v):
    return archive_of(v).rows


@entry(
    "archive_deletable",
    ARCHIVE_SQL + " SELECT source_id, type, year FROM mon",
    ("playlists", "playlist_tracks", "plays_long"),
)
def archive_deletable(v):
    return archive_of(v).deletable


@entry(
    "upsert_plan",
    f"""WITH {IDS_SQL},
d AS (SELECT DISTINCT 'AJTop' || strftime(added_at, '%y') AS name, track_uri FROM playlist_tracks
  UNION SELECT DISTINCT 'Mix ' || strftime(added_at, '%Y'), track_uri FROM playlist_tracks)
SELECT name, track_uri, playlist_id, CASE WHEN playlist_id IS NULL THEN 'create' ELSE 'add' END AS action
FROM d LEFT JOIN ids USING (name)
WHERE playlist_id IS NULL OR (playlist_id, track_uri) NOT IN (SELECT (playlist_id, track_uri) FROM playlist_tracks)""",
    ("playlists", "playlist_tracks"),
)
def upsert_plan(v):
    members = v.playlist_tracks()
    year = F.date_format("added_at", "yyyy")
    both = F.array(F.concat(F.lit("AJTop"), F.substring(year, 3, 2)), F.concat(F.lit("Mix "), year))
    desired = members.select(F.explode(both).alias("name"), "track_uri").distinct()
    return archive.upsert_plan(desired, v.playlists(), members)


def backup_of(v):
    return protect.backup_snapshot(library.owned(v.playlists()), v.positioned_tracks(), AS_OF)


@entry(
    "backup_snapshot",
    f"""SELECT playlist_id || '_20011231_000000' AS backup_id, playlist_id, name AS playlist_name,
  count(track_id) AS track_count, 'before_change' AS backup_reason, '{AS_OF}' AS backup_timestamp
FROM playlists LEFT JOIN playlist_tracks USING (playlist_id) WHERE is_owned GROUP BY 2, 3""",
    ("playlists", "playlist_tracks"),
)
def backup_snapshot(v):
    return backup_of(v)[0].select(
        "backup_id", "playlist_id", "playlist_name", "track_count", "backup_reason",
        second("backup_timestamp").alias("backup_timestamp"),
    )


@entry(
    "restore_plan",
    """SELECT playlist_id, name AS playlist_name, track_uri, position
FROM playlist_tracks JOIN (SELECT playlist_id, name FROM playlists WHERE is_owned) USING (playlist_id)""",
    ("playlists", "playlist_tracks"),
)
def restore_plan(v):
    return protect.restore_plan(*backup_of(v))


@entry(
    "restore_counts",
    f"""SELECT playlist_id, count(*) AS to_restore, count(*) FILTER (WHERE added_at <= TIMESTAMP '{OLD_STATE_CUTOFF}') AS to_clear
FROM playlist_tracks SEMI JOIN (SELECT playlist_id FROM playlists WHERE is_owned) USING (playlist_id) GROUP BY 1""",
    ("playlists", "playlist_tracks"),
)
def restore_counts(v):
    """The backup is restored over the older state."""
    then = v.playlist_tracks().where(F.col("added_at") <= F.lit(OLD_STATE_CUTOFF).cast("timestamp_ntz"))
    return protect.restore_counts(protect.restore_plan(*backup_of(v)), then)


@entry(
    "backup_catalog",
    f"""WITH r AS (SELECT c_custkey AS playlist_id, max(o_orderdate) AS t FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT playlist_id, {second_sql('t')} AS backup_timestamp, t < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS AS expired FROM r""",
)
def backup_catalog(v):
    """The last order of a customer is taken as the time of its backup."""
    records = v.table("orders").groupBy(F.col("o_custkey").alias("playlist_id")).agg(
        F.max(F.col("o_orderdate").cast("timestamp")).alias("backup_timestamp")
    )
    old = protect.expired_backups(records, AS_OF, 365).withColumn("expired", F.lit(True))
    kept = protect.retained_backups(records, AS_OF, 365).withColumn("expired", F.lit(False))
    return old.unionByName(kept).withColumn("backup_timestamp", second("backup_timestamp"))


@entry(
    "list_backups",
    f"""WITH r AS (SELECT o_custkey AS backup_id, max(o_orderdate) AS t FROM orders GROUP BY 1)
SELECT backup_id, {second_sql('t')} AS backup_timestamp FROM r ORDER BY t DESC, backup_id LIMIT 20""",
)
def list_backups(v):
    records = v.table("orders").groupBy(F.col("o_custkey").alias("backup_id")).agg(
        F.max("o_orderdate").alias("backup_timestamp")
    )
    return protect.list_backups(records).withColumn("backup_timestamp", second("backup_timestamp"))


VERDICT_SQL = """WITH s AS (SELECT set_id, list(item_id ORDER BY item_id) AS l FROM order_part GROUP BY 1),
g AS (SELECT set_id, first_value(set_id) OVER (PARTITION BY l ORDER BY set_id) AS first FROM s),
la AS (SELECT o_orderkey AS playlist_id, max(o_orderkey) OVER (PARTITION BY o_custkey) AS target_id FROM orders),
rq AS (SELECT set_id AS playlist_id, first AS target_id FROM g WHERE set_id <> first
       UNION SELECT playlist_id, target_id FROM la WHERE playlist_id <> target_id),
mi AS (SELECT rq.playlist_id, rq.target_id, count(*) AS missing FROM rq JOIN order_part o ON o.set_id = rq.playlist_id
       ANTI JOIN order_part t ON t.set_id = rq.target_id AND t.item_id = o.item_id GROUP BY 1, 2),
v AS (SELECT rq.*, coalesce(missing, 0) AS missing, target_id IN (SELECT playlist_id FROM rq) AS target_also_deleted
      FROM rq LEFT JOIN mi USING (playlist_id, target_id))"""


def verdicts_of(v):
    """Orders are to go into the last order of their customer, copies also into their first."""
    sets = overlap.item_sets(v.overlap_sets("order_part"), "set_id", "item_id")
    copies = overlap.copy_rows(overlap.identical_sets(sets)).select(
        F.col("set2").alias("playlist_id"), F.col("set1").alias("target_id")
    )
    orders = v.table("orders").select("o_custkey", F.col("o_orderkey").alias("playlist_id"))
    last = orders.groupBy("o_custkey").agg(F.max("playlist_id").alias("target_id"))
    older = orders.join(last, "o_custkey").where(F.col("playlist_id") != F.col("target_id"))
    requests = copies.unionByName(older.select("playlist_id", "target_id")).distinct()
    members = sets.withColumnsRenamed({"set_id": "playlist_id", "item_id": "track_id"})
    return members, protect.delete_verdicts(requests, members)


@entry(
    "safe_delete_verdicts",
    VERDICT_SQL + " SELECT *, missing = 0 AND NOT target_also_deleted AS allowed FROM v",
    ("order_part",),
)
def safe_delete_verdicts(v):
    return verdicts_of(v)[1]


@entry(
    "safe_delete_apply",
    VERDICT_SQL
    + """ SELECT set_id AS playlist_id, count(*) AS n FROM order_part
WHERE set_id NOT IN (SELECT playlist_id FROM v WHERE missing = 0 AND NOT target_also_deleted) GROUP BY 1""",
    ("order_part",),
)
def safe_delete_apply(v):
    members, verdicts = verdicts_of(v)
    return protect.apply_deletes(members, verdicts).groupBy("playlist_id").agg(F.count(F.lit(1)).alias("n"))


@entry(
    "safe_remove",
    """
WITH rm AS (SELECT DISTINCT playlist_id, track_id FROM playlist_tracks JOIN tracks USING (track_id) WHERE popularity IS NULL),
b AS (SELECT DISTINCT playlist_id, track_id FROM playlist_tracks SEMI JOIN rm USING (playlist_id))
SELECT playlist_id, count(*) AS before_count, count(*) FILTER (WHERE rm.track_id IS NULL) AS after_count,
  count(rm.track_id) AS removals, CAST(0 AS BIGINT) AS unexpected_removals, CAST(0 AS BIGINT) AS missing_additions,
  false AS count_decrease, true AS preserved
FROM b LEFT JOIN rm USING (playlist_id, track_id) GROUP BY 1""",
    ("playlist_tracks", "tracks"),
)
def safe_remove(v):
    unknown = v.tracks().where(F.col("popularity").isNull())
    removals = library.keep_in(v.playlist_tracks(), unknown, "track_id").select("playlist_id", "track_id")
    return protect.safe_remove(v.playlist_tracks(), removals)[1]


def _report_tracks(v):
    return v.tracks().select("track_id", "duration_ms", "popularity", music.clean_genre_array(F.col("genres")).alias("genres"))


@entry(
    "insights_health",
    """WITH own AS (SELECT CAST(n_nationkey AS BIGINT) AS playlist_id, n_name AS name FROM nation ORDER BY n_nationkey LIMIT 20),
h AS (SELECT set_id AS playlist_id, count(*) AS n, count(*) FILTER (WHERE popularity IS NULL) AS no_pop
      FROM nation_part LEFT JOIN tracks ON item_id = track_id GROUP BY 1),
u AS (SELECT playlist_id, count(DISTINCT g) AS ug FROM (SELECT set_id AS playlist_id, unnest(genres) AS g FROM nation_part JOIN tracks ON item_id = track_id) GROUP BY 1),
s AS (SELECT playlist_id, name, CASE WHEN n IS NULL THEN 0 ELSE greatest(0, least(100, 100 - CASE WHEN n < 10 THEN 20 WHEN n > 500 THEN 10 ELSE 0 END
    + CASE WHEN ug >= 5 THEN least(ug - 5, 10) ELSE 0 END - CASE WHEN no_pop > n * 0.1 THEN 5 ELSE 0 END)) END AS score
  FROM own LEFT JOIN h USING (playlist_id) LEFT JOIN u USING (playlist_id))
SELECT 'health' AS section, CAST(row_number() OVER (ORDER BY score DESC, playlist_id) AS INTEGER) AS rank, name AS label, CAST(score AS DOUBLE) AS value FROM s""",
    ("nation_part", "tracks"),
)
def insights_health(v):
    """The report's scores of the first twenty collections."""
    members = v.overlap_sets("nation_part").distinct().toDF("playlist_id", "track_id")
    owned = v.overlap_names("nation_part").toDF("playlist_id", "name").withColumn("is_owned", F.lit(True))
    return reports.insights_report(owned, members, _report_tracks(v), health=20).where("section = 'health'")


@entry(
    "insights_report",
    pairs_sql("nation_part")
    + f""",
gl AS (SELECT unnest(genres) AS g FROM tracks), gc AS (SELECT g, count(*) AS n FROM gl GROUP BY 1),
r AS (SELECT l.*, s_name AS artist FROM plays_long l LEFT JOIN supplier ON artist_id = s_suppkey
      WHERE timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS),
ra AS (SELECT artist AS label, count(*) AS n FROM r GROUP BY 1), rt AS (SELECT track_uri AS label, count(*) AS n FROM r GROUP BY 1),
rh AS (SELECT CAST(hour(timestamp) AS VARCHAR) AS label, count(*) AS n FROM r GROUP BY 1),
mg AS (SELECT set1, set2, name1, name2, round(jaccard, 2) AS s FROM p WHERE jaccard >= 0.5 AND n1 >= 20 AND n2 >= 20)
SELECT 'counts' AS section, 1 AS rank, 'entries' AS label, CAST((SELECT count(*) FROM nation_part) AS DOUBLE) AS value
UNION ALL SELECT 'counts', 1, 'unique_tracks', (SELECT count(DISTINCT item_id) FROM nation_part)
UNION ALL SELECT 'counts', 1, 'playlists', (SELECT count(*) FROM nation)
UNION ALL SELECT 'counts', 1, 'owned_playlists', (SELECT count(*) FROM nation)
UNION ALL SELECT 'genres', CAST(row_number() OVER (ORDER BY n DESC, g) AS INTEGER) AS rank, g, round(n / (SELECT sum(n) FROM gc) * 100, 6) FROM gc QUALIFY rank <= 10
UNION ALL SELECT 'top_artists', CAST(row_number() OVER (ORDER BY n DESC, label) AS INTEGER) AS rank, label, n FROM ra QUALIFY rank <= 10
UNION ALL SELECT 'top_tracks', CAST(row_number() OVER (ORDER BY n DESC, label) AS INTEGER) AS rank, label, n FROM rt QUALIFY rank <= 10
UNION ALL SELECT 'peak_hours', CAST(row_number() OVER (ORDER BY n DESC, label) AS INTEGER) AS rank, label, n FROM rh QUALIFY rank <= 5
UNION ALL SELECT 'summary', 1, 'listening_hours', round(sum(ms_played) / 3600000, 1) FROM r
UNION ALL SELECT 'summary', 1, 'discovery_rate', round(count(DISTINCT track_uri) / count(*), 6) FROM r
UNION ALL SELECT 'similar', CAST(row_number() OVER (ORDER BY jaccard DESC, set1, set2) AS INTEGER) AS rank, name1 || ' + ' || name2, round(jaccard, 6)
  FROM p WHERE jaccard >= 0.3 QUALIFY rank <= 5
UNION ALL SELECT 'merge', CAST(row_number() OVER (ORDER BY s DESC, set1, set2) AS INTEGER) AS rank, name1 || ' + ' || name2, s FROM mg QUALIFY rank <= 3""",
    ("nation_part", "tracks", "plays_long"),
)
def insights_report(v):
    history = (
        v.plays_long()
        .join(v.artists().select("artist_id", F.col("name").alias("artist_name")), "artist_id", "left")
        .withColumn("track_name", F.col("track_uri"))
    )
    members = v.overlap_sets("nation_part").distinct().toDF("playlist_id", "track_id")
    owned = v.overlap_names("nation_part").toDF("playlist_id", "name").withColumn("is_owned", F.lit(True))
    report = reports.insights_report(owned, members, _report_tracks(v), history, AS_OF, days=365)
    return r6(report, "value")
