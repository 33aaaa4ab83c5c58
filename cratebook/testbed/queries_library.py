"""Scope, joins, features and statistics over the virtual library."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratebook.functions import music, names
from cratebook.operators import features, library, profiles, statistics
from cratebook.testbed.registry import entry
from cratebook.testbed.virtual import AS_OF, VirtualLibrary

LIBRARY = ("playlists", "playlist_tracks", "tracks", "track_artists", "artists")
MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
# A deviation of large numbers keeps fewer decimals: engines add in different orders.
STD_PLACES = {"duration_ms": 3}
MONTHLY_RE = rf"(?i)^(({MONTHS})[''\"]?\s?\d{{2,4}}|\d{{4}}[-/]\d{{2}}|\d{{2}}[-/]\d{{4}})$"


def r6(df, *columns):
    places = {f"{stem}_std": n for stem, n in STD_PLACES.items()}
    return df.withColumns({c: F.round(c, places.get(c, 6)) for c in columns})


def wide_of(v: VirtualLibrary):
    return library.library_wide(
        v.playlists(), v.playlist_tracks(), v.tracks(), v.track_artists(), v.artists()
    )


@entry(
    "filter_owned",
    "SELECT playlist_id, name, 'owned' AS kind FROM playlists WHERE is_owned"
    " UNION ALL SELECT playlist_id, name, 'followed' FROM playlists WHERE NOT is_owned",
    ("playlists",),
)
def filter_owned(v):
    parts = [
        part.select("playlist_id", "name", F.lit(kind).alias("kind"))
        for kind, part in (
            ("owned", library.owned(v.playlists())),
            ("followed", library.followed(v.playlists())),
        )
    ]
    return parts[0].unionByName(parts[1])


SCOPE_SQL = f"""
WITH p AS (SELECT * FROM playlists WHERE is_owned AND NOT is_liked_songs
             AND NOT regexp_matches(trim(name), '{MONTHLY_RE}')),
m AS (SELECT * FROM playlist_tracks WHERE playlist_id IN (SELECT playlist_id FROM p)),
t AS (SELECT * FROM tracks WHERE track_id IN (SELECT track_id FROM m)),
ta AS (SELECT * FROM track_artists WHERE track_id IN (SELECT track_id FROM m)),
a AS (SELECT * FROM artists WHERE artist_id IN (SELECT artist_id FROM ta))
"""


def scope_of(v):
    return library.library_scope(
        v.playlists(),
        v.playlist_tracks(),
        v.tracks(),
        v.track_artists(),
        v.artists(),
        exclude_liked=True,
        exclude_monthly=True,
    )


@entry(
    "library_scope",
    SCOPE_SQL
    + """SELECT 'playlists' AS part, CAST(count(*) AS BIGINT) AS n, CAST(sum(playlist_id) AS BIGINT) AS id_sum FROM p
UNION ALL SELECT 'memberships', count(*), CAST(sum(track_id) AS BIGINT) FROM m
UNION ALL SELECT 'tracks', count(*), CAST(sum(track_id) AS BIGINT) FROM t
UNION ALL SELECT 'credits', count(*), CAST(sum(artist_id) AS BIGINT) FROM ta
UNION ALL SELECT 'artists', count(*), CAST(sum(artist_id) AS BIGINT) FROM a""",
    LIBRARY,
)
def library_scope(v):
    s = scope_of(v)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("id_sum")).select(
            F.lit(part).alias("part"), "n", "id_sum"
        )
        for part, df, key in (
            ("playlists", s.playlists, "playlist_id"),
            ("memberships", s.playlist_tracks, "track_id"),
            ("tracks", s.tracks, "track_id"),
            ("credits", s.track_artists, "artist_id"),
            ("artists", s.artists, "artist_id"),
        )
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@entry(
    "detect_monthly_names",
    f"SELECT playlist_id, name FROM playlists WHERE is_owned AND regexp_matches(trim(name), '{MONTHLY_RE}')",
    ("playlists",),
)
def detect_monthly_names(v):
    return library.monthly_playlists(v.playlists()).select("playlist_id", "name")


@entry(
    "parse_auto_names",
    rf"""
WITH x AS (SELECT playlist_id, name,
    regexp_extract(name, '^AJ(Finds|Top|Discovery)({MONTHS})(\d+)$', ['p', 'm', 'y']) AS g FROM playlists)
SELECT playlist_id, name,
  CASE g.p WHEN 'Finds' THEN 'monthly' WHEN 'Top' THEN 'most_played' ELSE 'discovery' END AS type,
  CAST(CASE WHEN length(g.y) = 2 THEN 2000 ELSE 0 END + CAST(g.y AS INTEGER) AS INTEGER) AS year,
  CAST((position(g.m IN 'JanFebMarAprMayJunJulAugSepOctNovDec') + 2) // 3 AS INTEGER) AS month,
  (CASE WHEN length(g.y) = 2 THEN 2000 ELSE 0 END + CAST(g.y AS INTEGER)) || '-' ||
    lpad(CAST((position(g.m IN 'JanFebMarAprMayJunJulAugSepOctNovDec') + 2) // 3 AS VARCHAR), 2, '0') AS period
FROM x WHERE g.p <> ''
  AND (CASE WHEN length(g.y) = 2 THEN 2000 ELSE 0 END + CAST(g.y AS INTEGER)) || '-' ||
    lpad(CAST((position(g.m IN 'JanFebMarAprMayJunJulAugSepOctNovDec') + 2) // 3 AS VARCHAR), 2, '0') <= '2095-06'
""",
    ("playlists",),
)
def parse_auto_names(v):
    parts = names.auto_name_parts(F.col("name"))
    return (
        v.playlists()
        .select("playlist_id", "name", parts.alias("p"))
        .where(F.col("p").isNotNull())
        .select("playlist_id", "name", "p.*")
        .where(F.col("period") <= "2095-06")
    )


@entry(
    "legacy_cleanup_candidates",
    rf"""
SELECT playlist_id, name FROM playlists
WHERE starts_with(name, 'AJ')
  AND name NOT IN (SELECT 'AJ' || k || substr(CAST(y AS VARCHAR), 3, 2)
                   FROM range(2015, 2003) t(y), (VALUES ('Finds'), ('Top'), ('Discovery')) p(k))
  AND (regexp_matches(name, '^AJ(Finds|Top|Discovery)({MONTHS})\d+$')
       OR regexp_matches(substr(name, 3), 'HipHop|Hip Hop|Dance|Other|Am'))
""",
    ("playlists",),
)
def legacy_cleanup_candidates(v):
    return v.playlists().where(names.is_legacy_name(F.col("name"), 2002)).select("playlist_id", "name")


@entry(
    "auto_generated",
    "SELECT starts_with(name, 'AJ') AS auto, count(*) AS n FROM playlists GROUP BY 1",
    ("playlists",),
)
def auto_generated(v):
    return v.playlists().groupBy(names.is_auto_name(F.col("name")).alias("auto")).agg(
        F.count(F.lit(1)).alias("n")
    )


@entry(
    "find_by_name",
    "SELECT playlist_id, name FROM playlists WHERE name = 'New rock 5'",
    ("playlists",),
)
def find_by_name(v):
    return library.find_by_name(v.playlists().select("playlist_id", "name"), "New rock 5")


@entry(
    "item_uri",
    """SELECT track_id, 'spotify:track:' || lpad(CAST(track_id AS VARCHAR), 22, '0') AS from_id,
  CAST(track_id AS VARCHAR) AS from_short, uri AS from_uri, CAST(track_id AS VARCHAR) AS back FROM tracks""",
    ("tracks",),
)
def item_uri(v):
    text = F.col("track_id").cast("string")
    return v.tracks().select(
        "track_id",
        music.item_uri(F.lpad(text, 22, "0")).alias("from_id"),
        music.item_uri(text).alias("from_short"),
        music.item_uri(F.col("uri")).alias("from_uri"),
        music.uri_item(F.col("uri")).alias("back"),
    )


@entry(
    "clean_genres",
    """SELECT track_id, array_to_string(genres, '|') AS from_array,
  array_to_string(genres, '|') AS from_literal, array_to_string(genres, '|') AS from_commas,
  genres[1] AS from_single, 0 AS from_blank FROM tracks""",
    ("tracks",),
)
def clean_genres(v):
    genres = F.col("genres")
    padded = F.transform(F.concat(genres, F.array(F.lit(" "))), lambda g: F.concat(F.lit(" "), g))
    literal = F.concat(F.lit("['"), F.array_join(genres, "', '"), F.lit("']"))
    return v.tracks().select(
        "track_id",
        F.array_join(music.clean_genre_array(padded), "|").alias("from_array"),
        F.array_join(music.clean_genre_text(literal), "|").alias("from_literal"),
        F.array_join(music.clean_genre_text(F.array_join(genres, ", ")), "|").alias("from_commas"),
        F.array_join(music.clean_genre_text(F.get(genres, F.lit(0))), "|").alias("from_single"),
        F.size(music.clean_genre_text(F.concat(F.lit("na"), F.substring(F.col("name"), 1, 0), F.lit("N")))).alias(
            "from_blank"
        ),
    )


@entry(
    "track_scalars",
    """SELECT track_id, genres[1] AS core_genre, CAST(substr(release_date, 1, 4) AS INTEGER) AS release_year,
  CASE WHEN popularity IS NULL THEN 'unknown' WHEN popularity <= 20 THEN 'underground'
       WHEN popularity <= 40 THEN 'niche' WHEN popularity <= 60 THEN 'moderate'
       WHEN popularity <= 80 THEN 'popular' ELSE 'mainstream' END AS tier FROM tracks""",
    ("tracks",),
)
def track_scalars(v):
    return v.tracks().select(
        "track_id",
        music.core_genre(F.col("genres")).alias("core_genre"),
        music.release_year(F.col("release_date")).alias("release_year"),
        music.popularity_tier(F.col("popularity")).alias("tier"),
    )


MOOD_SQL = """CASE WHEN energy >= 0.6 AND valence >= 0.5 THEN 'Energetic' WHEN energy >= 0.6 THEN 'Intense'
  WHEN energy < 0.4 AND valence >= 0.5 THEN 'Chill' WHEN energy < 0.4 THEN 'Melancholic'
  WHEN valence >= 0.6 THEN 'Happy' WHEN energy >= 0.5 THEN 'Upbeat' ELSE 'Mellow' END"""


@entry("mood_quadrant", f"SELECT track_id, {MOOD_SQL} AS mood FROM track_features", ("track_features",))
def mood_quadrant(v):
    return profiles.item_moods(v.track_features()).select("track_id", "mood")


CATEGORY_SQL = """CASE WHEN regexp_matches(lower(name), 'finds|top|discovery|dscvr|fnds') THEN
    CASE WHEN regexp_matches(lower(name), 'jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|[0-9]')
      THEN 'automated' ELSE 'time_based' END
  WHEN regexp_matches(lower(name), 'hiphop|dance|r&b|soul|rock|pop|jazz|country|electronic') THEN 'genre'
  WHEN regexp_matches(lower(name), 'discovery|new|fresh|latest') THEN 'discovery'
  WHEN regexp_matches(lower(name), 'liked|favorite|favourite|best|top') THEN 'favorites'
  ELSE 'manual' END"""


@entry(
    "categorize_collections",
    f"SELECT playlist_id, {CATEGORY_SQL} AS category FROM playlists",
    ("playlists",),
)
def categorize_collections(v):
    return statistics.categorized(v.playlists()).select("playlist_id", "category")


@entry(
    "column_fallback",
    "SELECT track_uri, count(*) AS n, strftime(max(timestamp), '%Y-%m-%d') AS last FROM plays_long GROUP BY 1",
    ("plays_long",),
)
def column_fallback(v):
    raw = v.plays_long().withColumnsRenamed({"track_uri": "spotify_track_uri", "timestamp": "endTime"})
    return (
        library.canonical_columns(raw)
        .groupBy("track_uri")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.date_format(F.max("timestamp"), "yyyy-MM-dd").alias("last"),
        )
    )


@entry(
    "item_set",
    "SELECT DISTINCT playlist_id, track_uri FROM playlist_tracks",
    ("playlist_tracks",),
)
def item_set(v):
    return library.item_set(v.playlist_tracks())


@entry(
    "liked_items",
    "SELECT track_uri, position FROM playlist_tracks SEMI JOIN (SELECT playlist_id FROM playlists WHERE is_liked_songs) USING (playlist_id)",
    ("playlists", "playlist_tracks"),
)
def liked_items(v):
    return library.liked_items(v.positioned_tracks(), v.playlists()).select("track_uri", "position")


@entry(
    "library_wide",
    """SELECT playlist_id, track_id, strftime(added_at, '%Y-%m-%d') AS added_day, position, name, track_count,
  name_track, duration_ms, popularity, release_date, primary_artist_id, primary_artist,
  primary_artist_popularity, primary_artist_followers FROM wide""",
    ("wide",),
)
def library_wide(v):
    wide = library.library_wide(
        v.playlists(), v.positioned_tracks(), v.tracks(), v.track_artists(), v.artists()
    )
    return wide.select(
        "playlist_id",
        "track_id",
        F.date_format("added_at", "yyyy-MM-dd").alias("added_day"),
        "position",
        "name",
        "track_count",
        "name_track",
        "duration_ms",
        "popularity",
        "release_date",
        "primary_artist_id",
        "primary_artist",
        "primary_artist_popularity",
        "primary_artist_followers",
    )


@entry(
    "primary_creator",
    """SELECT track_id, arg_min(ta.artist_id, ta.position) AS primary_artist_id,
  arg_min(a.name, ta.position) AS primary_artist, arg_min(a.followers, ta.position) AS primary_artist_followers
FROM track_artists ta LEFT JOIN artists a USING (artist_id) GROUP BY track_id""",
    ("track_artists", "artists"),
)
def primary_creator(v):
    return library.primary_artist(v.track_artists(), v.artists(), fallback=True).select(
        "track_id", "primary_artist_id", "primary_artist", "primary_artist_followers"
    )


@entry(
    "scope_semi",
    """SELECT track_id, release_date FROM tracks
WHERE track_id IN (SELECT track_id FROM playlist_tracks JOIN playlists USING (playlist_id) WHERE NOT is_owned)""",
    LIBRARY,
)
def scope_semi(v):
    theirs = library.keep_in(v.playlist_tracks(), library.followed(v.playlists()), "playlist_id")
    return library.keep_in(v.tracks(), theirs, "track_id").select("track_id", "release_date")


@entry(
    "scope_anti",
    """SELECT playlist_id, track_id, count(*) AS n FROM playlist_tracks
WHERE playlist_id NOT IN (SELECT playlist_id FROM playlists WHERE is_owned) GROUP BY 1, 2""",
    ("playlists", "playlist_tracks"),
)
def scope_anti(v):
    rest = library.keep_not_in(v.playlist_tracks(), library.owned(v.playlists()), "playlist_id")
    return rest.groupBy("playlist_id", "track_id").agg(F.count(F.lit(1)).alias("n"))


@entry(
    "item_genres",
    """
WITH g AS (SELECT track_id, position, unnest(genres) AS genre FROM track_artists JOIN artists USING (artist_id)),
f AS (SELECT track_id, genre, min(position) AS first FROM g GROUP BY 1, 2)
SELECT track_id, string_agg(genre, '|' ORDER BY first) AS genres FROM f GROUP BY 1""",
    ("track_artists", "artists"),
)
def item_genres(v):
    return library.item_genres(v.track_artists(), v.artists()).select(
        "track_id", F.array_join("genres", "|").alias("genres")
    )


@entry(
    "enrich_membership",
    """SELECT playlist_id, count(*) AS n, count(popularity) AS with_popularity,
  CAST(sum(duration_ms) AS BIGINT) AS duration_ms
FROM playlist_tracks LEFT JOIN tracks USING (track_id) GROUP BY 1""",
    ("playlist_tracks", "tracks"),
)
def enrich_membership(v):
    return (
        library.enriched_members(v.playlist_tracks(), v.tracks())
        .groupBy("playlist_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("popularity").alias("with_popularity"),
            F.sum("duration_ms").alias("duration_ms"),
        )
    )


def _moments_sql(column: str, stem: str, stats: str) -> str:
    calls = {"mean": "avg", "std": "stddev_samp", "median": "median", "min": "min", "max": "max"}
    parts = []
    for s in stats.split():
        call = f"{calls[s]}({column})"
        places = STD_PLACES.get(stem, 6) if s == "std" else 6
        parts.append(f"{call if s in ('min', 'max') else f'round({call}, {places})'} AS {stem}_{s}")
    return ", ".join(parts)


PROFILE_SQL = f"""{_moments_sql('popularity', 'popularity', 'mean std median min max')},
  {_moments_sql('duration_ms', 'duration_ms', 'mean std median min max')}"""
AGE_SQL = f"epoch(TIMESTAMP '{AS_OF}' - added_at) / 86400.0"
AGES_SQL = ", ".join(
    f"round({call}({AGE_SQL}), 6) AS added_age_days_{name}"
    for name, call in (("mean", "avg"), ("median", "median"), ("min", "min"), ("max", "max"))
)
YEARS_SQL = _moments_sql("CAST(substr(release_date, 1, 4) AS INTEGER)", "release_year", "mean median min max std")
PROFILE_ROUND = [f"{c}_{s}" for c in ("popularity", "duration_ms") for s in ("mean", "std", "median")]
AGE_ROUND = [f"added_age_days_{s}" for s in ("mean", "median", "min", "max")]
YEAR_ROUND = [f"release_year_{s}" for s in ("mean", "median", "std")]
TIERS = ("underground", "niche", "moderate", "popular", "mainstream", "unknown")
TIER_EXPR = """CASE WHEN popularity IS NULL THEN 'unknown' WHEN popularity <= 20 THEN 'underground'
  WHEN popularity <= 40 THEN 'niche' WHEN popularity <= 60 THEN 'moderate'
  WHEN popularity <= 80 THEN 'popular' ELSE 'mainstream' END"""
TIERS_SQL = ", ".join(
    f"round(count(*) FILTER (WHERE {TIER_EXPR} = '{t}') / count(*), 6) AS pct_{t}" for t in TIERS
)
CONCENTRATION_SQL = """
n AS (SELECT playlist_id, primary_artist_id, count(DISTINCT track_id) AS n FROM wide
      WHERE primary_artist_id IS NOT NULL GROUP BY 1, 2),
p AS (SELECT playlist_id, n, n / sum(n) OVER (PARTITION BY playlist_id) AS p FROM n),
c AS (SELECT playlist_id, round(sum(n * n) / (CAST(sum(n) AS DOUBLE) * sum(n)), 6) AS artist_hhi,
        round(-sum(p * ln(p + 1e-12)), 6) + 0.0 AS artist_entropy
      FROM p GROUP BY 1)"""


@entry("profile_features", f"SELECT playlist_id, {PROFILE_SQL} FROM wide GROUP BY 1", ("wide",))
def profile_features(v):
    return r6(features.profile_features(wide_of(v)), *PROFILE_ROUND)


@entry("creator_concentration", f"WITH {CONCENTRATION_SQL} SELECT * FROM c", ("wide",))
def creator_concentration(v):
    return r6(features.artist_concentration(wide_of(v)), "artist_hhi", "artist_entropy")


@entry("added_age_features", f"SELECT playlist_id, {AGES_SQL} FROM wide GROUP BY 1", ("wide",))
def added_age_features(v):
    return r6(features.added_age_features(wide_of(v), AS_OF), *AGE_ROUND)


@entry("release_year_features", f"SELECT playlist_id, {YEARS_SQL} FROM wide GROUP BY 1", ("wide",))
def release_year_features(v):
    return r6(features.release_year_features(wide_of(v)), *YEAR_ROUND)


@entry("popularity_tier_features", f"SELECT playlist_id, {TIERS_SQL} FROM wide GROUP BY 1", ("wide",))
def popularity_tier_features(v):
    return r6(features.popularity_tiers(wide_of(v)), *[f"pct_{t}" for t in TIERS])


@entry(
    "all_features",
    f"""WITH {CONCENTRATION_SQL},
f AS (SELECT playlist_id, {PROFILE_SQL}, {AGES_SQL}, {YEARS_SQL}, {TIERS_SQL} FROM wide GROUP BY 1)
SELECT * FROM f FULL JOIN c USING (playlist_id)""",
    ("wide",),
)
def all_features(v):
    rounded = PROFILE_ROUND + AGE_ROUND + YEAR_ROUND + [f"pct_{t}" for t in TIERS]
    return r6(features.all_features(wide_of(v), AS_OF), *rounded, "artist_hhi", "artist_entropy")


PROFILES_SQL = """
g AS (SELECT playlist_id, unnest(a.genres) AS genre FROM playlist_tracks pt
      JOIN track_artists ta ON pt.track_id = ta.track_id AND ta.position = 0
      JOIN artists a ON ta.artist_id = a.artist_id),
gp AS (SELECT playlist_id, genre, count(*) AS n FROM g GROUP BY 1, 2)"""


def profiles_of(v):
    return profiles.genre_profiles(v.playlist_tracks(), v.track_artists(), v.artists())


@entry("genre_profiles", f"WITH {PROFILES_SQL} SELECT * FROM gp", LIBRARY)
def genre_profiles(v):
    return profiles_of(v)


@entry(
    "top_genres",
    f"""WITH {PROFILES_SQL} SELECT playlist_id, genre, n,
  CAST(row_number() OVER (PARTITION BY playlist_id ORDER BY n DESC, genre) AS INTEGER) AS rank
FROM gp QUALIFY rank <= 10""",
    LIBRARY,
)
def top_genres(v):
    return profiles.top_genres(profiles_of(v))


@entry(
    "genre_cosine",
    f"""WITH {PROFILES_SQL},
s AS (SELECT genre, n AS sn FROM gp WHERE playlist_id = 0),
d AS (SELECT playlist_id, sum(n * coalesce(sn, 0)) / (sqrt(sum(n * n)) * (SELECT sqrt(sum(sn * sn)) FROM s)) AS sim
      FROM gp LEFT JOIN s USING (genre) GROUP BY 1)
SELECT playlist_id, name, round(coalesce(sim, 0.0), 6) AS similarity, is_owned, track_count
FROM playlists LEFT JOIN d USING (playlist_id) WHERE playlist_id <> 0
ORDER BY round(coalesce(sim, 0.0), 9) DESC, playlist_id LIMIT 25""",
    LIBRARY,
)
def genre_cosine(v):
    return r6(profiles.similar_by_genre(profiles_of(v), v.playlists(), 0, top_n=25), "similarity")


@entry(
    "genre_cosine_followed",
    f"""WITH {PROFILES_SQL},
s AS (SELECT genre, n AS sn FROM gp WHERE playlist_id = 1),
d AS (SELECT playlist_id, sum(n * coalesce(sn, 0)) / (sqrt(sum(n * n)) * (SELECT sqrt(sum(sn * sn)) FROM s)) AS sim
      FROM gp LEFT JOIN s USING (genre) GROUP BY 1)
SELECT playlist_id, name, round(coalesce(sim, 0.0), 6) AS similarity, is_owned, track_count
FROM playlists LEFT JOIN d USING (playlist_id) WHERE playlist_id <> 1 AND NOT is_owned
ORDER BY round(coalesce(sim, 0.0), 9) DESC, playlist_id LIMIT 10""",
    LIBRARY,
)
def genre_cosine_followed(v):
    return r6(
        profiles.similar_by_genre(profiles_of(v), v.playlists(), 1, only_followed=True), "similarity"
    )


@entry(
    "genre_distribution",
    """WITH g AS (SELECT unnest(genres) AS genre FROM tracks), c AS (SELECT genre, count(*) AS n FROM g GROUP BY 1)
SELECT genre, n, round(n / (SELECT sum(n) FROM c) * 100, 6) AS percentage FROM c ORDER BY n DESC, genre LIMIT 10""",
    ("tracks",),
)
def genre_distribution(v):
    return r6(profiles.genre_distribution(v.tracks()), "percentage")


@entry(
    "mood_tags",
    f"""
WITH m AS (SELECT playlist_id, {MOOD_SQL} AS mood, count(*) AS n
           FROM playlist_tracks JOIN track_features USING (track_id) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY playlist_id ORDER BY n DESC, mood) AS k FROM m)
SELECT playlist_id, string_agg(mood, '|' ORDER BY k) FILTER (WHERE k <= 5) AS moods
FROM r WHERE n >= 2 AND k <= 10 GROUP BY 1""",
    ("playlist_tracks", "track_features"),
)
def mood_tags(v):
    counts = profiles.mood_counts(v.playlist_tracks(), profiles.item_moods(v.track_features()))
    return profiles.mood_tag_lists(counts, min_count=2).select(
        "playlist_id", F.array_join("moods", "|").alias("moods")
    )


@entry(
    "library_stats",
    SCOPE_SQL
    + """SELECT (SELECT count(*) FROM t) AS total_tracks, (SELECT count(*) FROM a) AS total_artists,
  (SELECT count(*) FROM p) AS total_playlists,
  (SELECT round(sum(duration_ms) / 3600000, 6) FROM t) AS total_hours,
  (SELECT round(avg(popularity), 6) FROM t) AS avg_popularity""",
    LIBRARY,
)
def library_stats(v):
    return r6(statistics.library_stats(scope_of(v)), "total_hours", "avg_popularity")


@entry(
    "size_stats",
    """SELECT round(avg(track_count), 6) AS mean_size, median(track_count) AS median_size,
  min(track_count) AS min_size, max(track_count) AS max_size,
  (SELECT count(DISTINCT track_id) FROM playlist_tracks) AS unique_tracks FROM playlists""",
    ("playlists", "playlist_tracks"),
)
def size_stats(v):
    return r6(statistics.size_stats(v.playlists(), v.playlist_tracks()), "mean_size")


@entry(
    "collection_stats",
    """
WITH m AS (SELECT pt.playlist_id, t.duration_ms, t.popularity, CAST(substr(t.release_date, 1, 4) AS INTEGER) AS y,
             t.genres, a.name AS artist
           FROM playlist_tracks pt LEFT JOIN tracks t USING (track_id)
           LEFT JOIN track_artists ta ON ta.track_id = pt.track_id AND ta.position = 0
           LEFT JOIN artists a ON a.artist_id = ta.artist_id),
s AS (SELECT playlist_id, count(*) AS n, sum(duration_ms) AS ms, avg(popularity) AS pop, min(y) AS y1, max(y) AS y2
      FROM m GROUP BY 1),
ac AS (SELECT playlist_id, artist, row_number() OVER (PARTITION BY playlist_id ORDER BY count(*) DESC, artist) AS k
       FROM m WHERE artist IS NOT NULL GROUP BY 1, 2),
al AS (SELECT playlist_id, string_agg(artist, '|' ORDER BY k) AS top_artists FROM ac WHERE k <= 5 GROUP BY 1),
ge AS (SELECT playlist_id, unnest(genres) AS g FROM m),
gc AS (SELECT playlist_id, g, row_number() OVER (PARTITION BY playlist_id ORDER BY count(*) DESC, g) AS k
       FROM ge GROUP BY 1, 2),
gl AS (SELECT playlist_id, string_agg(g, '|' ORDER BY k) AS top_genres FROM gc WHERE k <= 10 GROUP BY 1)
SELECT playlist_id, name, coalesce(n, 0) AS total_tracks, CAST(coalesce(ms, 0) AS BIGINT) AS total_duration_ms,
  round(coalesce(ms, 0) / 3600000, 1) AS total_duration_hours, round(coalesce(pop, 0.0), 1) AS avg_popularity,
  coalesce(top_artists, '') AS top_artists, y1 AS first_year, y2 AS last_year, coalesce(top_genres, '') AS top_genres
FROM playlists LEFT JOIN s USING (playlist_id) LEFT JOIN al USING (playlist_id) LEFT JOIN gl USING (playlist_id)""",
    LIBRARY,
)
def collection_stats(v):
    return stats_of(v).withColumns(
        {c: F.array_join(c, "|") for c in ("top_artists", "top_genres")}
    )


def stats_of(v):
    primary = library.primary_artist(v.track_artists(), v.artists())
    return statistics.collection_stats(v.playlists(), v.playlist_tracks(), v.tracks(), primary)


@entry(
    "top_creators",
    """SELECT artist_id, count(*) AS n_tracks, a.name, a.followers FROM track_artists LEFT JOIN artists a USING (artist_id)
WHERE position = 0 GROUP BY 1, 3, 4 ORDER BY n_tracks DESC, artist_id LIMIT 15""",
    ("track_artists", "artists"),
)
def top_creators(v):
    return statistics.top_artists(v.track_artists(), v.artists()).select(
        "artist_id", "n_tracks", "name", "followers"
    )


@entry(
    "duplicate_items",
    "SELECT playlist_id, track_id, count(*) AS n FROM playlist_tracks GROUP BY 1, 2 HAVING count(*) > 1",
    ("playlist_tracks",),
)
def duplicate_items(v):
    return statistics.duplicate_items(v.playlist_tracks())


def order_members(v):
    return v.overlap_sets("order_part").withColumnsRenamed({"set_id": "playlist_id", "item_id": "track_id"})


@entry(
    "empty_collections",
    """SELECT o_orderkey AS playlist_id, 'Order ' || o_orderkey AS name FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def empty_collections(v):
    return statistics.empty_collections(v.order_playlists(), order_members(v))


STALE_SQL = f"""SELECT playlist_id, any_value(name) AS name,
  CAST(floor(epoch(TIMESTAMP '{AS_OF}' - max(added_at)) / 86400) AS BIGINT) AS days_since_update
FROM playlists JOIN playlist_tracks USING (playlist_id) GROUP BY 1
HAVING max(added_at) < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS"""


def tracks_and_names(table: str) -> str:
    return f"""WITH pn AS (SELECT playlist_id, name, is_owned FROM playlists),
d AS (SELECT playlist_id, count(*) AS n FROM (SELECT playlist_id, track_id FROM playlist_tracks
      GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1),
st AS (SELECT playlist_id, pn.name, CAST(floor(epoch(TIMESTAMP '{AS_OF}' - max(added_at)) / 86400) AS BIGINT) AS days
  FROM pn JOIN playlist_tracks USING (playlist_id) GROUP BY 1, 2
  HAVING max(added_at) < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS),
e AS (SELECT playlist_id, name FROM pn WHERE playlist_id NOT IN (SELECT playlist_id FROM playlist_tracks)),
{table}"""


@entry(
    "stale_collections",
    f"""SELECT playlist_id, p.name,
  CAST(floor(epoch(TIMESTAMP '{AS_OF}' - max(added_at)) / 86400) AS BIGINT) AS days_since_update
FROM playlists p JOIN playlist_tracks USING (playlist_id) GROUP BY 1, 2
HAVING max(added_at) < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS""",
    ("playlists", "playlist_tracks"),
)
def stale_collections(v):
    return statistics.stale_collections(v.playlists(), v.playlist_tracks(), AS_OF)


def _sample_sql(table: str) -> str:
    return f"(SELECT string_agg(name, ',' ORDER BY playlist_id) FROM (SELECT * FROM {table} ORDER BY playlist_id LIMIT 10))"


@entry(
    "organization_report",
    tracks_and_names("dn AS (SELECT playlist_id, name FROM d JOIN pn USING (playlist_id))")
    + f""" SELECT (SELECT count(*) FROM pn) AS total_playlists, (SELECT count(*) FROM playlist_tracks) AS total_tracks,
  round((SELECT count(*) FROM playlist_tracks) / (SELECT count(*) FROM pn), 1) AS avg_tracks_per_playlist,
  (SELECT count(*) FROM e) AS empty_playlists, coalesce({_sample_sql('e')}, '') AS empty_names,
  (SELECT count(*) FROM st) AS stale_playlists, {_sample_sql('st')} AS stale_names,
  CAST((SELECT sum(n) FROM d) AS BIGINT) AS total_duplicates,
  (SELECT count(*) FROM dn) AS playlists_with_duplicates, {_sample_sql('dn')} AS duplicate_names,
  """
    + ", ".join(
        f"(SELECT count(*) FROM pn WHERE {CATEGORY_SQL} = '{c}') AS n_{c}" for c in statistics.CATEGORIES
    ),
    ("playlists", "playlist_tracks"),
)
def organization_report(v):
    return statistics.organization_report(v.playlists(), v.playlist_tracks(), AS_OF)


HEALTH_SQL = """
h AS (SELECT playlist_id, count(*) AS n_rows, count(DISTINCT track_id) AS n_items,
        count(*) FILTER (WHERE popularity IS NULL) AS no_pop, count(*) FILTER (WHERE duration_ms IS NULL) AS no_dur
      FROM playlist_tracks LEFT JOIN tracks USING (track_id) GROUP BY 1),
d AS (SELECT playlist_id, count(*) AS n_rep FROM (SELECT playlist_id, track_id FROM playlist_tracks
      GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1)"""


@entry(
    "health_check",
    f"""WITH {HEALTH_SQL}
SELECT playlist_id, name, CASE WHEN n_rows IS NULL THEN 'empty' ELSE '' END AS issues, n_rows IS NOT NULL AS healthy,
  concat_ws('|', CASE WHEN n_rep > 0 THEN n_rep || ' duplicate track(s)' END,
    CASE WHEN no_pop > n_rows * 0.1 THEN no_pop || ' tracks missing popularity data' END,
    CASE WHEN no_dur > n_rows * 0.1 THEN no_dur || ' tracks missing duration data' END) AS warnings
FROM playlists LEFT JOIN h USING (playlist_id) LEFT JOIN d USING (playlist_id)""",
    LIBRARY,
)
def health_check(v):
    return statistics.health_check(v.playlists(), v.playlist_tracks(), v.tracks()).withColumns(
        {c: F.array_join(c, "|") for c in ("issues", "warnings")}
    )


@entry(
    "health_score",
    f"""WITH {HEALTH_SQL},
g AS (SELECT playlist_id, unnest(genres) AS g FROM playlist_tracks JOIN tracks USING (track_id)),
u AS (SELECT playlist_id, count(DISTINCT g) AS ug FROM g GROUP BY 1)
SELECT playlist_id, coalesce(n_rows, 0) AS track_count, coalesce(n_rows - n_items, 0) AS duplicates,
  coalesce(ug, 0) AS unique_genres,
  CAST(CASE WHEN n_rows IS NULL THEN 0 ELSE greatest(0, least(100, 100
    - CASE WHEN n_rows < 10 THEN 20 WHEN n_rows > 500 THEN 10 ELSE 0 END
    - least(2 * (n_rows - n_items), 20)
    + CASE WHEN ug >= 5 THEN least(ug - 5, 10) ELSE 0 END
    - CASE WHEN no_pop > n_rows * 0.1 THEN 5 ELSE 0 END)) END AS BIGINT) AS score
FROM playlists LEFT JOIN h USING (playlist_id) LEFT JOIN u USING (playlist_id)""",
    LIBRARY,
)
def health_score(v):
    return statistics.health_score(v.playlists(), v.playlist_tracks(), v.tracks())


@entry(
    "earliest_added",
    "SELECT playlist_id, strftime(min(added_at), '%Y-%m-%d %H:%M:%S') AS earliest FROM playlist_tracks GROUP BY 1",
    ("playlist_tracks",),
)
def earliest_added(v):
    return statistics.earliest_added(v.playlist_tracks()).withColumn(
        "earliest", F.date_format("earliest", "yyyy-MM-dd HH:mm:ss")
    )


@entry(
    "error_patterns",
    """SELECT 'summary' AS section, 'total' AS label, count(*) AS n FROM error_log
UNION ALL SELECT 'summary', 'fatal', count(*) FILTER (WHERE fatal) FROM error_log
UNION ALL SELECT 'code', message_error_code, count(*) FROM error_log GROUP BY 2""",
    ("error_log",),
)
def error_patterns(v):
    return statistics.error_summary(v.error_log())


@entry(
    "catalog_status",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in LIBRARY),
    LIBRARY,
)
def catalog_status(v):
    return statistics.catalog_status({t: getattr(v, t)() for t in LIBRARY})


@entry(
    "library_status",
    """SELECT 'last_sync' AS key, strftime((SELECT max(o_orderdate) FROM orders), '%Y-%m-%dT%H:%M:%SZ') AS value
UNION ALL SELECT 'user_id', (SELECT c_name FROM customer ORDER BY c_custkey LIMIT 1)
UNION ALL """
    + " UNION ALL ".join(f"SELECT '{t}_count', CAST(count(*) AS VARCHAR) FROM {t}" for t in (*LIBRARY, "wide")),
    (*LIBRARY, "wide"),
)
def library_status(v):
    """The last order is the last sync, the first customer the user."""
    synced = v.table("orders").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("value"))
    user = v.table("customer").agg(F.min_by("c_name", "c_custkey").alias("value"))
    meta = synced.select(F.lit("last_sync_utc").alias("key"), "value").unionByName(user.select(F.lit("me_id").alias("key"), "value"))
    return statistics.library_status({t: getattr(v, t)() for t in LIBRARY} | {"wide": wide_of(v)}, meta)


@entry(
    "popularity_histogram",
    """
WITH k AS (SELECT popularity AS p, (SELECT min(popularity) FROM tracks) AS lo, (SELECT max(popularity) FROM tracks) AS hi
           FROM tracks WHERE popularity IS NOT NULL),
b AS (SELECT least(CAST(floor((p - lo) * 20 / (hi - lo)) AS BIGINT), 19) AS bin, count(*) AS n FROM k GROUP BY 1)
SELECT r.bin, coalesce(n, 0) AS n FROM range(20) r(bin) LEFT JOIN b USING (bin)""",
    ("tracks",),
)
def popularity_histogram(v):
    return statistics.popularity_histogram(v.tracks())


@entry(
    "release_year_histogram",
    """
WITH y AS (SELECT CAST(substr(release_date, 1, 4) AS BIGINT) AS y FROM tracks),
b AS (SELECT least(y, 2028) AS year, count(*) AS n FROM y WHERE y BETWEEN 1960 AND 2029 GROUP BY 1)
SELECT r.year, coalesce(n, 0) AS n FROM range(1960, 2029) r(year) LEFT JOIN b USING (year)""",
    ("tracks",),
)
def release_year_histogram(v):
    return statistics.release_year_histogram(v.tracks())


@entry(
    "wide_distinct",
    """SELECT count(*) AS n_rows, count(DISTINCT playlist_id) AS n_playlists, count(DISTINCT track_id) AS n_tracks,
  CAST((SELECT sum(track_count) FROM playlists WHERE is_owned) AS BIGINT) AS expected_rows,
  count(*) >= 0.9 * (SELECT sum(track_count) FROM playlists WHERE is_owned) AS complete FROM playlist_tracks""",
    ("playlists", "playlist_tracks"),
)
def wide_distinct(v):
    return library.completeness(v.playlist_tracks(), v.playlists())


@entry(
    "name_collisions",
    """SELECT name, count(*) AS n, max(playlist_id) AS last_playlist_id FROM playlists
GROUP BY 1 HAVING count(*) > 1""",
    ("playlists",),
)
def name_collisions(v):
    return library.name_collisions(v.playlists())


@entry(
    "library_health_run",
    tracks_and_names("o AS (SELECT playlist_id FROM pn WHERE is_owned)")
    + """ SELECT 'empty' AS "check", playlist_id, 0 AS detail FROM e SEMI JOIN o USING (playlist_id)
UNION ALL SELECT 'stale', playlist_id, days FROM st SEMI JOIN o USING (playlist_id)
UNION ALL SELECT 'duplicates', playlist_id, n FROM d SEMI JOIN o USING (playlist_id)""",
    ("playlists", "playlist_tracks"),
)
def library_health_run(v):
    return statistics.library_health(v.playlists(), v.playlist_tracks(), AS_OF)
