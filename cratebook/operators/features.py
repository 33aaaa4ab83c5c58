"""Per-collection features of the wide table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratebook.functions import music, times
from cratebook.operators.grouping import metric_figures, split_unwritten, value_counts

# Legacy audio columns, summarised when present.
AUDIO_COLUMNS = [
    "danceability", "energy", "key", "loudness", "mode", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
]


@dataclass(frozen=True)
class _Metric:
    """A number of each row, the name its figures begin with, and the wanted ones."""

    value: Column
    stem: str
    wanted: str
    type: str = "double"


def _figures(
    wide: DataFrame, key: str, metrics: list[_Metric], tiers: Column | None = None, artists: tuple[str, str] | None = None
) -> DataFrame:
    """One row per key with all wanted figures of the metrics, shares of ``tiers`` (their numbers)
    and the concentration of ``artists`` (artist and track column). ``wide`` is read once."""
    values = {m.stem: m.value for m in metrics}
    if tiers is not None:
        values["tier"] = tiers
    labels = {} if artists is None else {"artist": (F.col(artists[0]), F.col(artists[1]))}
    counts = value_counts(wide, [key], values, labels)

    def share(k: int) -> Column:
        in_tier = (F.col("metric") == "tier") & (F.col("value") == k)
        return (F.sum(F.when(in_tier, F.col("n")).otherwise(0)) / F.sum("n")).alias(f"tier_{k}")

    shares = [share(k) for k in range(len(music.TIER_NAMES))] if tiers is not None else []
    rows = metric_figures(counts, [key], *shares)
    if artists is not None:
        concentration = _concentration(counts, key).withColumn("metric", F.lit("artist"))
        rows = rows.unionByName(concentration, allowMissingColumns=True)

    def of(metric: str, figure: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(figure)))

    source = {"mean": "mean", "std": "std", "min": "lo", "max": "hi", "median": "median"}
    columns = []
    for m in metrics:
        for figure in m.wanted.split():
            kind = m.type if figure in ("min", "max") else "double"
            columns.append(of(m.stem, source[figure]).cast(kind).alias(f"{m.stem}_{figure}"))
    columns += [of("tier", f"tier_{k}").alias(f"pct_{name}") for k, name in enumerate(music.TIER_NAMES) if tiers is not None]
    columns += [of("artist", c).alias(c) for c in ("artist_hhi", "artist_entropy") if artists is not None]
    return rows.groupBy(key).agg(*columns) if columns else rows.select(key).distinct()


def _whole_figures(rows: DataFrame, key: str, metrics: list[_Metric], tiers: str | None, artists: tuple[str, str] | None) -> DataFrame:
    """The columns of ``_figures`` for keys that fit a task: their rows are brought together once,
    and every figure is found there. Metrics lie in columns of their stem."""
    source = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "median": F.collect_list}
    sums, columns, medians = {}, [], []
    for m in metrics:
        for figure in m.wanted.split():
            name = f"{m.stem}_{figure}"
            sums[name] = source[figure](m.stem)
            kind = m.type if figure in ("min", "max") else "double"
            columns.append(_middle(name).alias(name) if figure == "median" else F.col(name).cast(kind).alias(name))
            medians += [name] if figure == "median" else []
    if tiers is not None:
        shares = {f"pct_{name}": F.try_divide(F.count_if(F.col(tiers) == k), F.count(tiers)) for k, name in enumerate(music.TIER_NAMES)}
        sums |= shares
        columns += shares
    if artists is not None:
        label, item = F.col(artists[0]), F.col(artists[1])
        tracks = F.when(label.isNotNull() & item.isNotNull(), F.struct(label.alias("label"), item.alias("item")))
        sums["_tracks"] = F.collect_set(tracks)
        columns += ["artist_hhi", "artist_entropy"]
    if not sums:
        return rows.select(key).distinct()
    found = rows.repartition(key).groupBy(key).agg(*[c.alias(n) for n, c in sums.items()])
    found = found.withColumns({c: F.sort_array(c) for c in medians})
    return (found if artists is None else _whole_concentration(found)).select(key, *columns)


def _middle(ordered: str) -> Column:
    """Median of an array of ordered numbers, interpolated; null where it is empty."""
    n = F.size(ordered)
    return (F.get(ordered, F.shiftright(n - 1, 1)) + F.get(ordered, F.shiftright(n, 1))) / 2


def _whole_concentration(found: DataFrame) -> DataFrame:
    """Adds artist_hhi and artist_entropy from the array ``_tracks`` of different (label, item)."""
    tracks, starts, total = F.col("_tracks"), F.col("_starts"), F.col("_total")
    begins = F.transform(tracks, lambda t, i: F.when((i == 0) | (t["label"] != F.get(tracks, i - 1)["label"]), i))
    lengths = F.transform(starts, lambda s, i: (F.coalesce(F.get(starts, i + 1), total) - s).cast("double"))

    def summed(summand) -> Column:
        return F.when(total > 0, F.aggregate("_lengths", F.lit(0.0), lambda done, n: done + summand(n)))

    def information(n: Column) -> Column:
        # The summand is a fixed value of the definition.
        return n / total * F.log(n / total + 1e-12)

    return (
        found.withColumn("_tracks", F.sort_array("_tracks"))
        .withColumns({"_starts": F.array_compact(begins), "_total": F.size("_tracks")})
        .withColumn("_lengths", lengths)
        .withColumn("artist_hhi", summed(lambda n: n * n) / (total.cast("double") * total))
        .withColumn("artist_entropy", -summed(information))
    )


def _profile(wide: DataFrame) -> list[_Metric]:
    types = dict(wide.dtypes)
    found = [_Metric(F.col(c), c, "mean std min max median", types[c]) for c in ("popularity", "duration_ms") if c in types]
    return found + [_Metric(F.col(c), c, "mean std median") for c in AUDIO_COLUMNS if c in types]


def profile_features(wide: DataFrame, playlist_col: str = "playlist_id") -> DataFrame:
    metrics = _profile(wide)
    return _figures(wide, playlist_col, metrics) if metrics else wide.select(playlist_col).distinct()


def _concentration(counts: DataFrame, key: str) -> DataFrame:
    """(key, artist_hhi, artist_entropy) from counts of (artist, track) labels.

    A share depends only on an artist's track count, so artists are grouped by
    that count first. A collection of N tracks has at most sqrt(2N) different
    counts: the last step is small even for a collection with millions of artists.
    """
    tracks = F.count_if((F.col("metric") == "artist") & (F.col("n") > 0))
    per_artist = counts.groupBy(key, "label").agg(tracks.alias("n")).where(F.col("n") > 0)
    by_count = per_artist.groupBy(key, "n").agg(F.count(F.lit(1)).alias("artists"))
    total = F.sum(F.col("n") * F.col("artists")).over(Window.partitionBy(key))
    n, share = F.col("n"), F.col("n") / F.col("total")
    squares = F.sum((F.col("artists") * n * n).cast("double"))
    return (
        by_count.withColumn("total", total)
        .groupBy(key)
        .agg(
            (squares / F.max(F.col("total").cast("double") * F.col("total"))).alias("artist_hhi"),
            # The summand is a fixed value of the definition.
            (-F.sum(F.col("artists") * share * F.log(share + 1e-12))).alias("artist_entropy"),
        )
    )


def artist_concentration(
    wide: DataFrame,
    playlist_col: str = "playlist_id",
    artist_col: str = "primary_artist_id",
    item_col: str = "track_id",
) -> DataFrame:
    """Herfindahl index and entropy of the artists' shares of distinct tracks."""
    pairs = {"artist": (F.col(artist_col), F.col(item_col))}
    return _concentration(value_counts(wide, [playlist_col], {}, pairs), playlist_col)


def _age(as_of: str, added_at_col: str) -> _Metric:
    added = F.col(added_at_col).cast("string").try_cast("timestamp")
    return _Metric(times.age_days(as_of, added), "added_age_days", "mean min max median")


def added_age_features(
    wide: DataFrame, as_of: str, added_at_col: str = "added_at", playlist_col: str = "playlist_id"
) -> DataFrame:
    if added_at_col not in wide.columns:
        return wide.select(playlist_col).dropna().distinct()
    return _figures(wide, playlist_col, [_age(as_of, added_at_col)])


def _year(release_date_col: str) -> _Metric:
    return _Metric(music.release_year(F.col(release_date_col)), "release_year", "mean min max std median", "int")


def release_year_features(
    wide: DataFrame, release_date_col: str = "release_date", playlist_col: str = "playlist_id"
) -> DataFrame:
    if release_date_col not in wide.columns:
        return wide.select(playlist_col).dropna().distinct()
    return _figures(wide, playlist_col, [_year(release_date_col)])


def _tier(popularity_col: str, item_col: str) -> Column:
    """The number of a row's tier; null where there is no item."""
    tier = music.popularity_tier(F.col(popularity_col))
    numbers = [F.when(tier == name, F.lit(k).cast("double")) for k, name in enumerate(music.TIER_NAMES)]
    return F.when(F.col(item_col).isNotNull(), F.coalesce(*numbers))


def popularity_tiers(
    wide: DataFrame,
    popularity_col: str = "popularity",
    playlist_col: str = "playlist_id",
    item_col: str = "track_id",
) -> DataFrame:
    """Share of rows per tier; all six columns always exist, absent tiers are 0."""
    if popularity_col not in wide.columns:
        return wide.select(playlist_col).dropna().distinct()
    return _figures(wide, playlist_col, [], _tier(popularity_col, item_col))


def all_features(wide: DataFrame, as_of: str, playlist_col: str = "playlist_id") -> DataFrame:
    """Every feature family, from one reading of ``wide``.

    Only what the features need goes on, one narrow row each. Collections of few rows are brought
    together and summed where they meet; those of many (``split_unwritten``) are counted value by
    value first, so that no task holds one.
    """
    present = set(wide.columns)
    metrics = _profile(wide)
    if "added_at" in present:
        metrics.append(_age(as_of, "added_at"))
    if "release_date" in present:
        metrics.append(_year("release_date"))
    columns = [m.value.cast("double").alias(m.stem) for m in metrics]
    tiers = artists = None
    if "popularity" in present:
        tiers = "_tier"
        columns.append(_tier("popularity", "track_id").alias(tiers))
    if "primary_artist_id" in present:
        artists = ("_label", "_item")
        columns += [_plain(wide, c).alias(n) for c, n in zip(("primary_artist_id", "track_id"), artists, strict=True)]
    few, many = split_unwritten(wide.select(playlist_col, *columns), playlist_col)
    counted = [replace(m, value=F.col(m.stem)) for m in metrics]
    large = _figures(many, playlist_col, counted, None if tiers is None else F.col(tiers), artists)
    return _whole_figures(few, playlist_col, metrics, tiers, artists).unionByName(large)


def _plain(wide: DataFrame, column: str) -> Column:
    """A label as it is counted: as text, or as the whole number that the text would show."""
    whole = dict(wide.dtypes)[column] in ("tinyint", "smallint", "int", "bigint")
    return F.col(column) if whole else F.col(column).cast("string")
