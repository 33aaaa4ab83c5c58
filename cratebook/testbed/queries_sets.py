"""Selections, merges, mixes and checks on collection contents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook.operators import library, plays, selection
from cratebook.testbed.queries_plays import second, second_sql
from cratebook.testbed.registry import entry
from cratebook.testbed.virtual import OLD_STATE_CUTOFF

# A hash both engines compute alike stands in for the library's own random order.
SHUFFLE_SQL = "(track_id * 2654435761 + 42) % 1000003"


def shuffle_key():
    return F.expr(SHUFFLE_SQL)


MEMBERS = ("playlists", "playlist_tracks")


@entry(
    "dedupe_keep_first",
    """SELECT playlist_id, track_id, position FROM playlist_tracks
QUALIFY row_number() OVER (PARTITION BY playlist_id, track_id ORDER BY position) > 1""",
    ("playlist_tracks",),
)
def dedupe_keep_first(v):
    return selection.positions_to_remove(v.positioned_tracks())


@entry(
    "ordered_distinct",
    f"""SELECT playlist_id, track_id, {second_sql('min(added_at)')} AS added_at, arg_min(position, (added_at, position)) AS position
FROM playlist_tracks GROUP BY 1, 2""",
    ("playlist_tracks",),
)
def ordered_distinct(v):
    return plays.ordered_distinct(
        v.positioned_tracks(), ["playlist_id"], ["added_at", "position"], item="track_id"
    ).withColumn("added_at", second("added_at"))


def _representative(strategy: str, order: str):
    @entry(
        f"representative_item_{strategy}",
        f"""SELECT playlist_id, track_id FROM playlist_tracks LEFT JOIN tracks USING (track_id)
QUALIFY row_number() OVER (PARTITION BY playlist_id ORDER BY {order}, position) = 1""",
        ("playlist_tracks", "tracks"),
    )
    def query(v):
        return selection.representative_item(v.positioned_tracks(), v.tracks(), strategy, order=shuffle_key())


for _strategy, _order in (
    ("most_popular", "coalesce(popularity, -1) DESC"),
    ("most_recent", "added_at DESC"),
    ("first", "position"),
    ("random", f"{SHUFFLE_SQL} DESC"),
):
    _representative(_strategy, _order)


@entry(
    "time_capsule",
    f"""SELECT track_id, release_date FROM tracks
WHERE track_id IN (SELECT track_id FROM playlist_tracks JOIN playlists USING (playlist_id) WHERE is_owned)
  AND CAST(substr(release_date, 1, 4) AS INTEGER) = 1996
ORDER BY {SHUFFLE_SQL}, track_id LIMIT 50""",
    ("playlists", "playlist_tracks", "tracks"),
)
def time_capsule(v):
    saved = library.keep_in(v.playlist_tracks(), library.owned(v.playlists()), "playlist_id")
    return selection.time_capsule(saved, v.tracks(), 1996, order=shuffle_key()).select("track_id", "release_date")


@entry(
    "theme_selection",
    f"""SELECT track_id FROM tracks
WHERE track_id IN (SELECT track_id FROM playlist_tracks JOIN playlists USING (playlist_id) WHERE is_owned)
  AND (list_has_any(genres, ['gear', 'promo']) OR track_id IN
    (SELECT track_id FROM track_artists JOIN artists USING (artist_id) WHERE list_has_any(genres, ['nation_3'])))
ORDER BY {SHUFFLE_SQL}, track_id LIMIT 100""",
    ("playlists", "playlist_tracks", "tracks", "track_artists", "artists"),
)
def theme_selection(v):
    saved = library.keep_in(v.playlist_tracks(), library.owned(v.playlists()), "playlist_id")
    return selection.theme_selection(
        saved, v.tracks(), v.track_artists(), v.artists(), ["GEAR", "promo", "NATION_3"],
        count=100, order=shuffle_key(), case_insensitive=True,
    ).select("track_id")


GENRES = ["Hip-Hop", "Electronic", "Dance", "Rock", "Classical", "Jazz", "Ambient", "R&B/Soul", "Indie", "Folk", "Pop", "Country/Folk", "Metal"]


@entry(
    "theme_selection_named",
    f"""WITH t AS (SELECT p_partkey AS track_id, [{", ".join(f"'{g}'" for g in GENRES)}][p_partkey % {len(GENRES)} + 1] AS genre FROM part),
th(theme, genres) AS (VALUES {", ".join(f"('{name}', {genres})" for name, genres in selection.THEMES.items())}),
mine AS (SELECT DISTINCT track_id FROM playlist_tracks JOIN playlists USING (playlist_id) WHERE is_owned)
SELECT theme, track_id FROM th JOIN t ON list_contains(genres, genre) JOIN mine USING (track_id)
QUALIFY row_number() OVER (PARTITION BY theme ORDER BY {SHUFFLE_SQL}, track_id) <= 40""",
    ("playlists", "playlist_tracks"),
)
def theme_selection_named(v):
    """Every named theme, over tracks that have one of thirteen genres each."""
    saved = library.keep_in(v.playlist_tracks(), library.owned(v.playlists()), "playlist_id")
    listed = F.array(*[F.lit(g) for g in GENRES])
    own = F.get(listed, (F.col("track_id") % len(GENRES)).cast("int"))
    tracks = v.tracks().withColumn("genres", F.array(own))
    chosen = [
        selection.theme_selection(saved, tracks, v.track_artists(), v.artists(), genres, count=40, order=shuffle_key()).select(F.lit(theme).alias("theme"), "track_id")
        for theme, genres in selection.THEMES.items()
    ]
    return reduce(DataFrame.unionByName, chosen)


def _old_and_new(v):
    now = v.playlist_tracks()
    then = now.where(F.col("added_at") <= F.lit(OLD_STATE_CUTOFF).cast("timestamp_ntz"))
    return then, now


@entry(
    "delta_add",
    f"""SELECT DISTINCT playlist_id, track_uri FROM playlist_tracks WHERE added_at > TIMESTAMP '{OLD_STATE_CUTOFF}'
EXCEPT SELECT playlist_id, track_uri FROM playlist_tracks WHERE added_at <= TIMESTAMP '{OLD_STATE_CUTOFF}'""",
    ("playlist_tracks",),
)
def delta_add(v):
    then, now = _old_and_new(v)
    desired = now.select("playlist_id", "track_uri").distinct()
    return selection.delta_add(desired, then, on=["playlist_id", "track_uri"])


GROUPS_SQL = """g AS (SELECT c_nationkey AS group_id, c_custkey AS playlist_id,
  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS ordinal FROM customer)"""


def _groups(v):
    """Collections of one owner form a group; given in id order."""
    return v.table("customer").select(
        F.col("c_nationkey").alias("group_id"), F.col("c_custkey").alias("playlist_id"), F.col("c_custkey").alias("ordinal")
    )


MERGE_SQL = f"""WITH {GROUPS_SQL},
e AS (SELECT group_id, playlist_id, ordinal, min(added_at) AS earliest FROM g LEFT JOIN playlist_tracks USING (playlist_id) GROUP BY ALL),
t AS (SELECT group_id, playlist_id AS target_id FROM e
      QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY earliest NULLS LAST, ordinal) = 1),
m AS (SELECT DISTINCT group_id, target_id, playlist_id, ordinal, track_id
      FROM playlist_tracks JOIN g USING (playlist_id) JOIN t USING (group_id)),
u AS (SELECT group_id, target_id, track_id, playlist_id AS source_id, count(*) OVER (PARTITION BY group_id, track_id) AS copies
      FROM m QUALIFY row_number() OVER (PARTITION BY group_id, track_id ORDER BY playlist_id <> target_id, ordinal) = 1)"""


@entry(
    "merge_collections",
    MERGE_SQL + " SELECT *, CASE WHEN source_id = target_id THEN 'keep' ELSE 'add' END AS action FROM u",
    ("playlist_tracks",),
)
def merge_collections(v):
    return selection.merge_collections(v.playlist_tracks(), _groups(v))


@entry(
    "merge_report",
    MERGE_SQL
    + """ SELECT group_id, target_id, count(*) FILTER (WHERE source_id <> target_id) AS added,
  CAST(sum(copies - 1) AS BIGINT) AS duplicates, count(*) AS final_count FROM u GROUP BY 1, 2""",
    ("playlist_tracks",),
)
def merge_report(v):
    return selection.merge_report(selection.merge_collections(v.playlist_tracks(), _groups(v)))


@entry(
    "preservation_check",
    f"""
WITH n AS (SELECT DISTINCT playlist_id, track_id FROM playlist_tracks),
o AS (SELECT DISTINCT playlist_id, track_id FROM playlist_tracks WHERE added_at <= TIMESTAMP '{OLD_STATE_CUTOFF}'),
b AS (SELECT playlist_id, n.track_id, o.track_id IS NOT NULL AS still FROM n LEFT JOIN o USING (playlist_id, track_id))
SELECT playlist_id, count(*) AS before_count, count(*) FILTER (WHERE still) AS after_count, CAST(0 AS BIGINT) AS removals,
  count(*) FILTER (WHERE NOT still) AS unexpected_removals, CAST(0 AS BIGINT) AS missing_additions,
  count(*) FILTER (WHERE NOT still) > 0 AS count_decrease, count(*) FILTER (WHERE NOT still) = 0 AS preserved
FROM b GROUP BY 1""",
    ("playlist_tracks",),
)
def preservation_check(v):
    then, now = _old_and_new(v)
    return selection.preservation_check(before=now, after=then)


@entry(
    "concat_replace",
    "SELECT playlist_id, count(*) AS n FROM playlist_tracks GROUP BY 1",
    ("playlist_tracks",),
)
def concat_replace(v):
    then, now = _old_and_new(v)
    changed = now.where(F.col("added_at") > F.lit(OLD_STATE_CUTOFF).cast("timestamp_ntz"))
    fresh = library.keep_in(now, changed, "playlist_id")
    merged = selection.concat_replace(then, fresh, changed)
    return merged.groupBy("playlist_id").agg(F.count(F.lit(1)).alias("n"))


MIX_SQL = """WITH ch AS (SELECT playlist_id, playlist_id AS ordinal FROM playlists WHERE NOT is_owned),
f AS (SELECT playlist_id, ordinal, track_id, min(position) AS position, min(added_at) AS added_at
      FROM playlist_tracks JOIN ch USING (playlist_id) GROUP BY 1, 2, 3),
s AS (SELECT playlist_id, count(*) AS size FROM f GROUP BY 1),
u AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY ordinal) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY playlist_id ORDER BY position) AS rank FROM u)"""


def _mix(strategy: str, tail: str):
    @entry(f"mix_collections_{strategy}", MIX_SQL + tail, MEMBERS)
    def query(v):
        chosen = library.followed(v.playlists()).select("playlist_id", F.col("playlist_id").alias("ordinal"))
        mixed = selection.mix_collections(v.positioned_tracks(), chosen, strategy, order=shuffle_key())
        return mixed.withColumn("sort_key", second("sort_key")) if strategy == "chronological" else mixed


_mix(
    "balanced",
    """ SELECT track_id, playlist_id, ordinal, rank FROM r
WHERE rank <= (SELECT count(*) FROM u) // (SELECT count(*) FROM s)""",
)
_mix(
    "weighted",
    """ SELECT track_id, playlist_id, ordinal, rank FROM r JOIN s USING (playlist_id)
WHERE rank <= floor((SELECT count(*) FROM u) * (size / (SELECT sum(size) FROM s)))""",
)
_mix("shuffled", f" SELECT track_id, playlist_id, ordinal, {SHUFFLE_SQL} AS sort_key FROM u")
_mix(
    "chronological",
    f" SELECT track_id, playlist_id, ordinal, {second_sql('added_at')} AS sort_key FROM u",
)
