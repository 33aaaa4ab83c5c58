"""Statistics of the library and of each collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.functions import music, names, times
from cratebook.operators.grouping import exact_medians, split_by_size, top_per_group
from cratebook.operators.library import keep_not_in
from cratebook.session import cut_lineage


def library_stats(scope) -> DataFrame:
    """One row; each table is aggregated once and the numbers meet as scalars."""
    items = scope.tracks.agg(
        F.count(F.lit(1)).alias("total_tracks"),
        F.coalesce(F.sum("duration_ms") / 3_600_000, F.lit(0.0)).alias("total_hours"),
        F.avg("popularity").alias("avg_popularity"),
    )
    return items.withColumns(
        {
            "total_artists": scope.artists.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "total_playlists": scope.playlists.agg(F.count(F.lit(1)).alias("n")).scalar(),
        }
    )


def size_stats(playlists: DataFrame, playlist_tracks: DataFrame) -> DataFrame:
    one = playlists.withColumn("everything", F.lit(1))
    median = exact_medians(one, ["everything"], {"m": F.col("track_count")}).select("m")
    unique = playlist_tracks.agg(F.countDistinct("track_id").alias("n"))
    return playlists.agg(
        F.avg("track_count").alias("mean_size"),
        F.min("track_count").alias("min_size"),
        F.max("track_count").alias("max_size"),
    ).withColumns({"median_size": median.scalar(), "unique_tracks": unique.scalar()})


def collection_stats(
    playlists: DataFrame,
    playlist_tracks: DataFrame,
    tracks: DataFrame,
    primary: DataFrame,
    top_artists: int = 5,
    top_genres: int = 10,
) -> DataFrame:
    """One row per collection, empty ones included. ``primary`` is (track_id, primary_artist).

    Memberships are read once and written as pairs of ids. The rows of a collection that fits a
    task are brought together with what is known of their tracks, and summed and ranked there.
    Of a larger one (``split_by_size``) each row gives one for its figures and one for every
    label that is counted; these are summed per label first, where the rows lie.
    """
    year = music.release_year(F.col("release_date"))
    details = tracks.select(
        "track_id",
        F.col("duration_ms").cast("bigint").alias("duration"),
        F.col("popularity").cast("bigint").alias("popularity"),
        year.cast("int").alias("year"),
        "genres",
    )
    pairs = playlist_tracks.where(F.col("playlist_id").isNotNull()).select("playlist_id", "track_id")
    few, many = split_by_size(cut_lineage(pairs), "playlist_id")

    # Track and artist are joined first, and a membership of an unknown track may have an artist.
    known = details.join(primary.select("track_id", "primary_artist"), "track_id", "full")
    shown = max(top_artists, top_genres, 1)
    together = few.join(known, "track_id", "left").repartition("playlist_id")
    per_collection = _best_labels(together, shown).unionByName(_best_labels(many.join(known, "track_id", "left"), shown))

    def names(kind: str, limit: int) -> Column:
        listed = F.filter("labels", lambda p: (p["kind"] == kind) & (p["rank"] <= limit))
        return F.transform(F.array_sort(F.transform(listed, lambda p: F.struct(p["rank"], p["label"]))), lambda p: p["label"])

    zero, none = F.lit(0), F.array().cast("array<string>")
    return (
        playlists.select("playlist_id", "name")
        .join(per_collection, "playlist_id", "left")
        .select(
            "playlist_id",
            "name",
            F.coalesce("total_tracks", zero).cast("bigint").alias("total_tracks"),
            F.coalesce("total_duration_ms", zero).cast("bigint").alias("total_duration_ms"),
            F.round(F.coalesce("total_duration_ms", zero) / 3_600_000, 1).alias("total_duration_hours"),
            F.round(F.coalesce("mean_popularity", F.lit(0.0)), 1).alias("avg_popularity"),
            F.coalesce(names("artist", top_artists), none).alias("top_artists"),
            "first_year",
            "last_year",
            F.coalesce(names("genre", top_genres), none).alias("top_genres"),
        )
    )


def _labels() -> Column:
    """(kind, label) of a row: its artist and its genres."""
    genres = F.transform(F.coalesce("genres", F.array().cast("array<string>")), lambda g: F.struct(F.lit("genre").alias("kind"), g.alias("label")))
    return F.concat(F.array(F.struct(F.lit("artist").alias("kind"), F.col("primary_artist").alias("label"))), genres)


def _best_labels(rows: DataFrame, shown: int) -> DataFrame:
    """Figures and best labels per collection; no exchange where its rows lie together."""
    whole = F.struct(F.lit("all").alias("kind"), F.lit("").alias("label"))
    cells = F.concat(F.array(whole), _labels())
    figures = ("duration", "popularity", "year")
    sums_of = {
        "total_tracks": F.count(F.lit(1)),
        "total_duration_ms": F.sum("duration"),
        "mean_popularity": F.avg("popularity"),
        "first_year": F.min("year"),
        "last_year": F.max("year"),
    }
    sums = (
        rows.select("playlist_id", *figures, F.explode(cells).alias("c"))
        .select("playlist_id", "c.*", *[F.when(F.col("c.kind") == "all", F.col(f)).alias(f) for f in figures])
        .where(F.col("label").isNotNull())
        .groupBy("playlist_id", "kind", "label")
        .agg(*[c.alias(n) for n, c in sums_of.items()])
    )
    best = top_per_group(sums, ["playlist_id", "kind"], [F.desc("total_tracks"), "label"], shown)

    def of(name: str) -> Column:
        return F.max(F.when(F.col("kind") == "all", F.col(name))).alias(name)

    listed = F.collect_list(F.when(F.col("kind") != "all", F.struct("kind", "rank", "label")))
    return best.groupBy("playlist_id").agg(*[of(name) for name in sums_of], listed.alias("labels"))


def top_artists(track_artists: DataFrame, artists: DataFrame, top_n: int = 15) -> DataFrame:
    """Artists with most tracks as primary artist; attributes join after the cut."""
    best = (
        track_artists.where(F.col("position") == 0)
        .groupBy("artist_id")
        .agg(F.count(F.lit(1)).alias("n_tracks"))
        .orderBy(F.desc("n_tracks"), "artist_id")
        .limit(top_n)
    )
    return best.join(artists, "artist_id", "left")


def duplicate_items(playlist_tracks: DataFrame) -> DataFrame:
    return (
        playlist_tracks.groupBy("playlist_id", "track_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def empty_collections(playlists: DataFrame, playlist_tracks: DataFrame) -> DataFrame:
    return keep_not_in(playlists, playlist_tracks, "playlist_id").select("playlist_id", "name")


def stale_collections(
    playlists: DataFrame, playlist_tracks: DataFrame, as_of: str, days_threshold: int = 365
) -> DataFrame:
    latest = playlist_tracks.groupBy("playlist_id").agg(
        F.max(F.col("added_at").cast("timestamp")).alias("latest")
    )
    return (
        playlists.join(latest, "playlist_id")
        .where(F.col("latest") < times.days_before(as_of, days_threshold))
        .select(
            "playlist_id",
            "name",
            F.floor(times.age_days(as_of, F.col("latest"))).cast("bigint").alias("days_since_update"),
        )
    )


def earliest_added(playlist_tracks: DataFrame) -> DataFrame:
    """Collections without any usable time come last."""
    added = F.col("added_at").cast("string").try_cast("timestamp")
    return playlist_tracks.groupBy("playlist_id").agg(F.min(added).alias("earliest"))


def categorized(playlists: DataFrame) -> DataFrame:
    return playlists.withColumn("category", names.category(F.col("name")))


# Categories in report order.
CATEGORIES = ["automated", "manual", "favorites", "discovery", "genre", "time_based"]


def organization_report(
    playlists: DataFrame, playlist_tracks: DataFrame, as_of: str, sample: int = 10
) -> DataFrame:
    """One row of totals; name samples are the first by id, as comma lists."""

    def count_of(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    def first_names(df: DataFrame) -> Column:
        head = df.select("playlist_id", "name").orderBy("playlist_id").limit(sample)
        listed = F.array_sort(F.collect_list(F.struct("playlist_id", "name")))
        return head.agg(F.array_join(F.transform(listed, lambda p: p["name"]), ",").alias("x")).scalar()

    empty = empty_collections(playlists, playlist_tracks)
    stale = stale_collections(playlists, playlist_tracks, as_of)
    doubled = duplicate_items(playlist_tracks).join(playlists, "playlist_id", "left_semi")
    with_double = doubled.groupBy("playlist_id").agg(F.count(F.lit(1)).alias("n")).join(
        playlists.select("playlist_id", "name"), "playlist_id"
    )
    label = names.category(F.col("name"))
    totals = playlists.agg(
        F.count(F.lit(1)).alias("total_playlists"),
        *[F.count_if(label == c).alias(f"n_{c}") for c in CATEGORIES],
    )
    return totals.withColumns(
        {
            "total_tracks": count_of(playlist_tracks),
            "empty_playlists": count_of(empty),
            "empty_names": first_names(empty),
            "stale_playlists": count_of(stale),
            "stale_names": first_names(stale),
            "total_duplicates": count_of(doubled),
            "playlists_with_duplicates": count_of(with_double),
            "duplicate_names": first_names(with_double),
        }
    ).withColumn(
        "avg_tracks_per_playlist",
        F.round(F.coalesce(F.try_divide(F.col("total_tracks"), F.col("total_playlists")), F.lit(0.0)), 1),
    )


def _health_counts(playlist_tracks: DataFrame, tracks: DataFrame) -> DataFrame:
    """Counts per collection. Equal (collection, track) rows are counted together
    before the track join, so repeats of a hot track travel as one row."""
    repeats = playlist_tracks.groupBy("playlist_id", "track_id").agg(F.count(F.lit(1)).alias("n"))
    merged = repeats.join(tracks.select("track_id", "popularity", "duration_ms"), "track_id", "left")
    times_n = F.col("n")
    return merged.groupBy("playlist_id").agg(
        F.sum(times_n).alias("n_rows"),
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(times_n > 1).alias("n_repeated"),
        F.sum(F.when(F.col("popularity").isNull(), times_n).otherwise(0)).alias("no_popularity"),
        F.sum(F.when(F.col("duration_ms").isNull(), times_n).otherwise(0)).alias("no_duration"),
    )


def health_check(playlists: DataFrame, playlist_tracks: DataFrame, tracks: DataFrame) -> DataFrame:
    counts = _health_counts(playlist_tracks, tracks)
    empty = F.col("n_rows").isNull()

    def said(number: str, text: str, condition: Column) -> Column:
        return F.when(condition, F.concat(F.col(number).cast("string"), F.lit(text)))

    limit = F.col("n_rows") * 0.1
    warnings = F.array(
        said("n_repeated", " duplicate track(s)", F.col("n_repeated") > 0),
        said("no_popularity", " tracks missing popularity data", F.col("no_popularity") > limit),
        said("no_duration", " tracks missing duration data", F.col("no_duration") > limit),
    )
    return playlists.join(counts, "playlist_id", "left").select(
        "playlist_id",
        "name",
        F.when(empty, F.array(F.lit("empty"))).otherwise(F.array().cast("array<string>")).alias("issues"),
        F.filter(warnings, lambda w: w.isNotNull()).alias("warnings"),
        (~empty).alias("healthy"),
    )


def health_score(
    playlists: DataFrame, playlist_tracks: DataFrame, tracks: DataFrame
) -> DataFrame:
    """Score 0..100: size, repeats, genre variety, missing popularity."""
    counts = _health_counts(playlist_tracks, tracks)
    variety = (
        playlist_tracks.select("playlist_id", "track_id")
        .distinct()
        .join(tracks.select("track_id", F.explode("genres").alias("genre")), "track_id")
        .groupBy("playlist_id")
        .agg(F.countDistinct("genre").alias("n_genres"))
    )
    rows, repeats = F.col("n_rows"), F.col("n_rows") - F.col("n_items")
    genres = F.coalesce("n_genres", F.lit(0))
    score = (
        F.lit(100)
        - F.when(rows < 10, 20).when(rows > 500, 10).otherwise(0)
        - F.least(repeats * 2, F.lit(20))
        + F.when(genres >= 5, F.least(genres - 5, F.lit(10))).otherwise(0)
        - F.when(F.col("no_popularity") > rows * 0.1, 5).otherwise(0)
    )
    # least and greatest skip nulls, so empty collections are told apart first.
    clamped = F.when(rows.isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), score)))
    return (
        playlists.select("playlist_id")
        .join(counts, "playlist_id", "left")
        .join(variety, "playlist_id", "left")
        .select(
            "playlist_id",
            F.coalesce(rows, F.lit(0)).cast("bigint").alias("track_count"),
            F.coalesce(repeats, F.lit(0)).cast("bigint").alias("duplicates"),
            genres.cast("bigint").alias("unique_genres"),
            clamped.cast("bigint").alias("score"),
        )
    )


def popularity_histogram(tracks: DataFrame, bins: int = 20) -> DataFrame:
    """Equal bins between the smallest and largest value; the last one is closed."""
    known = tracks.where(F.col("popularity").isNotNull())
    low = known.agg(F.min("popularity").alias("v")).scalar()
    high = known.agg(F.max("popularity").alias("v")).scalar()
    slot = F.floor((F.col("popularity") - low) * bins / F.greatest(high - low, F.lit(1)))
    counts = known.groupBy(F.least(slot, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return _all_bins(tracks, counts, "bin", 0, bins - 1)


def release_year_histogram(tracks: DataFrame, first: int = 1960, last: int = 2028) -> DataFrame:
    """One bin per year; the last bin also takes the year after it."""
    year = music.release_year(F.col("release_date"))
    counts = (
        tracks.select(year.alias("year"))
        .where(F.col("year").between(first, last + 1))
        .groupBy(F.least("year", F.lit(last)).alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _all_bins(tracks, counts, "year", first, last)


def _all_bins(df: DataFrame, counts: DataFrame, key: str, first: int, last: int) -> DataFrame:
    every = df.sparkSession.range(first, last + 1).withColumnRenamed("id", key)
    return every.join(counts, key, "left").select(
        key, F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def catalog_status(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def library_status(tables: dict[str, DataFrame], meta: DataFrame | None = None) -> DataFrame:
    """(key, value): when the library was last synced and whose it is, then the rows of each table.

    ``meta`` is (key, value) with ``last_sync_utc`` and ``me_id``; what it does not say is
    "Never" and "Unknown".
    """
    spark = next(iter(tables.values())).sparkSession
    known = meta if meta is not None else spark.createDataFrame([], "key string, value string")
    named = spark.createDataFrame([("last_sync", "last_sync_utc", "Never"), ("user_id", "me_id", "Unknown")], "key string, field string, missing string")
    said = named.join(known.select(F.col("key").alias("field"), "value"), "field", "left").select("key", F.coalesce("value", "missing").alias("value"))
    counts = catalog_status(tables).select(F.concat("table", F.lit("_count")).alias("key"), F.col("rows").cast("string").alias("value"))
    return said.unionByName(counts)


def error_summary(errors: DataFrame) -> DataFrame:
    """Total, fatal count, and one row per error code, as (section, label, n)."""
    totals = errors.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("fatal").alias("fatal")
    ).select(F.explode(F.create_map(F.lit("total"), "total", F.lit("fatal"), "fatal")).alias("label", "n"))
    codes = (
        errors.where(F.col("message_error_code").isNotNull())
        .groupBy(F.col("message_error_code").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return totals.select(F.lit("summary").alias("section"), "label", "n").unionByName(
        codes.select(F.lit("code").alias("section"), "label", "n")
    )


def library_health(
    playlists: DataFrame, playlist_tracks: DataFrame, as_of: str
) -> DataFrame:
    """Findings over all owned collections as (check, playlist_id, detail)."""
    mine = playlists.where(F.col("is_owned"))
    empty = empty_collections(mine, playlist_tracks).select(
        F.lit("empty").alias("check"), "playlist_id", F.lit(0).cast("bigint").alias("detail")
    )
    stale = stale_collections(mine, playlist_tracks, as_of).select(
        F.lit("stale").alias("check"), "playlist_id", F.col("days_since_update").alias("detail")
    )
    doubled = (
        duplicate_items(playlist_tracks)
        .groupBy("playlist_id")
        .agg(F.count(F.lit(1)).alias("detail"))
        .join(mine, "playlist_id", "left_semi")
        .select(F.lit("duplicates").alias("check"), "playlist_id", "detail")
    )
    return empty.unionByName(stale).unionByName(doubled)
