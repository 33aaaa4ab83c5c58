"""Column expressions on tracks: ids, genres, years, tiers, moods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URI_PREFIX = "spotify:track:"  # fixed value: track URI format
MIN_BARE_ID = 20  # fixed value: shorter strings are not taken for bare ids

# Tier name and its upper popularity bound (inclusive).
POPULARITY_TIERS = [("underground", 20), ("niche", 40), ("moderate", 60), ("popular", 80)]
TIER_NAMES = ["underground", "niche", "moderate", "popular", "mainstream", "unknown"]


def item_uri(value: Column) -> Column:
    bare = (F.length(value) >= MIN_BARE_ID) & ~F.contains(value, F.lit(":"))
    return F.when(bare, F.concat(F.lit(URI_PREFIX), value)).otherwise(value)


def uri_item(value: Column) -> Column:
    return F.regexp_replace(value, f"^{URI_PREFIX}", "")


def clean_genre_array(genres: Column) -> Column:
    """Array input: trimmed, without empty entries; null becomes empty."""
    trimmed = F.transform(genres, lambda g: F.trim(g))
    return F.coalesce(F.filter(trimmed, lambda g: g != ""), F.array().cast("array<string>"))


def clean_genre_text(genres: Column) -> Column:
    """Text input: a list literal, a comma list, or a single genre."""
    blank = genres.isNull() | (genres == "") | (genres == "[]") | (F.lower(genres) == "nan")
    as_json = F.translate(genres, "'", '"')
    listed = F.from_json(as_json, "array<string>")
    parts = clean_genre_array(F.split(genres, ","))
    return (
        F.when(blank, F.array().cast("array<string>"))
        .when(genres.rlike(r"^\s*\["), F.coalesce(listed, parts))
        .when(F.contains(genres, F.lit(",")), parts)
        .otherwise(F.array(genres))
    )


def core_genre(genres: Column) -> Column:
    return F.get(genres, F.lit(0))


def release_year(release_date: Column) -> Column:
    return F.substring(release_date, 1, 4).try_cast("int")


def popularity_tier(popularity: Column) -> Column:
    chain = F.when(popularity.isNull(), "unknown")
    for name, bound in POPULARITY_TIERS:
        chain = chain.when(popularity <= bound, name)
    return chain.otherwise("mainstream")


def mood(valence: Column, energy: Column) -> Column:
    """Label by energy band, then by valence; null when either is unusable."""
    v, e = valence.try_cast("double"), energy.try_cast("double")
    bright = v >= 0.5
    return (
        F.when(v.isNull() | e.isNull(), F.lit(None).cast("string"))
        .when(e >= 0.6, F.when(bright, "Energetic").otherwise("Intense"))
        .when(e < 0.4, F.when(bright, "Chill").otherwise("Melancholic"))
        .when(v >= 0.6, "Happy")
        .when(e >= 0.5, "Upbeat")
        .otherwise("Mellow")
    )
