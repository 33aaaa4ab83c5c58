"""Column expressions on collection descriptions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cratebook.functions.names import MONTHS_SHORT, OWNER, PREFIXES, fill_template

# Length limits of a description and of its mood line.
MAX_LENGTH = 300
MOOD_LENGTH = 120
BULLET = " • "

CONTROL = r"[\x00-\x08\x0B-\x0C\x0E-\x1F\x7F]"
# Characters dropped before publishing - control, format, private and
# unassigned characters, variation selectors, pictographs and skin tones.
UNSAFE = r"[\p{C}\x{FE00}-\x{FE0F}\x{1F3FB}-\x{1F3FF}]|[\p{So}&&[\x{1F300}-\x{10FFFF}]]"


def archive_description(
    description: Column,
    period: Column,
    template: str = "{description} from {period}",
    date: Column | None = None,
    kind: Column | None = None,
    genre: Column | None = None,
) -> Column:
    values = {"description": description, "period": period, "date": date, "type": kind, "genre": genre}
    filled = {
        "{" + mark + "}": F.lit("") if value is None else F.coalesce(value, F.lit(""))
        for mark, value in values.items()
    }
    return fill_template(template, filled)


def base_line(name: Column, owner: str = OWNER, prefixes: dict[str, str] | None = None) -> Column:
    """First description line told by an automated name; null for other names."""
    words = prefixes or PREFIXES
    text = F.trim(name)
    months = "|".join(MONTHS_SHORT)
    rules = [
        ("monthly", "Liked songs from "),
        ("most_played", "Most played from "),
        ("discovery", "Discovery from "),
    ]
    options = []
    for kind, lead in rules:
        shape = rf"(?i)^\Q{owner}{words[kind]}\E({months})(\d{{2}})$"
        said = F.concat(
            F.lit(lead), F.regexp_extract(text, shape, 1), F.lit(" "), F.regexp_extract(text, shape, 2)
        )
        options.append(F.when(text.rlike(shape), said))
    yearly = rf"(?i)^\Q{owner}{words['yearly']}\E(\d{{4}}|\d{{2}})$"
    digits = F.regexp_extract(text, yearly, 1)
    full = F.when(F.length(digits) == 2, F.concat(F.lit("20"), digits)).otherwise(digits)
    options.append(F.when(text.rlike(yearly), F.concat(F.lit("Liked songs from "), full)))
    return F.coalesce(*options)


# White space of any script.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def strip_parens(text: Column) -> Column:
    """Without round and square bracketed parts; white space collapsed."""
    for shape in (r"\([^)]*\)", r"\[[^\]]*\]"):
        text = F.regexp_replace(text, f"{SPACE}*{shape}{SPACE}*", " ")
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def simple_description(line: Column) -> Column:
    return F.coalesce(strip_parens(line), F.lit(""))


def _ellipsis(text: Column, limit: int) -> Column:
    return F.concat(F.substring(text, 1, limit - 3), F.lit("..."))


def clean_description(text: Column, limit: int = MAX_LENGTH) -> Column:
    """Control characters removed, cut at ``limit``; null becomes empty.

    When cut, the first line stays whole if it leaves room for more.
    """
    cleaned = F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, "")
    first = F.substring_index(cleaned, "\n", 1)
    size = F.length(first)
    several = (size < F.length(cleaned)) & (size <= limit - 10)
    # First line, line break and as much of the rest as fits.
    two_lines = F.concat(F.substring(cleaned, 1, limit - 4), F.lit("..."))
    return (
        F.when(F.length(cleaned) <= limit, cleaned)
        .when(several, two_lines)
        .otherwise(_ellipsis(cleaned, limit))
    )


def nfc(text: Column) -> Column:
    """Canonical composition; the one text step without a built-in expression."""

    # Defined here so that workers receive the function itself and need no package.
    def compose(values: pd.Series) -> pd.Series:
        return values.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")

    return F.pandas_udf(compose, StringType())(text)


def publishable_description(text: Column, limit: int = MAX_LENGTH, compose: bool = True) -> Column:
    """Composed, stripped of characters that a service may refuse, cut at ``limit``.

    Line breaks are control characters, so one line is left.
    """
    value = F.coalesce(text, F.lit(""))
    if compose:
        # ASCII is composed as it is: only other texts go to Python.
        other = F.when(value.rlike(r"[^\x00-\x7F]"), value)
        value = F.coalesce(nfc(other), value)
    value = F.regexp_replace(value, UNSAFE, "")
    return F.when(F.length(value) <= limit, value).otherwise(_ellipsis(value, limit))


def mood_tags(moods: Column, max_tags: int = 5, limit: int = MOOD_LENGTH) -> Column:
    joined = F.coalesce(F.array_join(F.slice(moods, 1, max_tags), BULLET), F.lit(""))
    cut = F.concat(F.substring(joined, 1, limit - 10), F.lit("..."))
    return F.when(F.length(joined) > limit, cut).otherwise(joined)


def with_mood_line(description: Column, moods: Column, max_tags: int = 5) -> Column:
    """Set the ``Moods:`` line: replace a present one together with the lines that
    follow it up to the next blank line, else append."""
    tags = mood_tags(moods, max_tags)
    line = F.concat(F.lit("Moods: "), tags)
    # The old section runs from its line to the next blank line or the end.
    section = r"(?m)^[^\n]*Moods:[^\n]*(?:\n(?!\s*$|[^\n]*Moods:)[^\n]*)*"
    quoted = F.replace(F.replace(line, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    body = F.coalesce(description, F.lit(""))
    return (
        F.when(tags == "", body)
        .when(F.contains(body, F.lit("Moods:")), F.regexp_replace(body, F.lit(section), quoted))
        .when(body != "", F.concat(body, F.lit("\n"), line))
        .otherwise(line)
    )


def rich_description(
    base: Column,
    tracks: Column,
    hours: Column,
    popularity: Column,
    first_year: Column,
    last_year: Column,
    top_artists: Column,
    tags: Column | None = None,
    limit: int = MAX_LENGTH,
) -> Column:
    """Base line, statistics line, up to three artists, tags; cut at ``limit``."""
    tags = F.lit(None).cast("string") if tags is None else F.when(tags != "", tags)
    some = tracks > 0
    length = F.when(hours < 1, F.concat(F.floor(hours * 60).cast("string"), F.lit(" min"))).otherwise(
        F.concat(hours.cast("string"), F.lit(" hr"))
    )
    years = F.when(first_year == last_year, first_year.cast("string")).otherwise(
        F.concat(first_year.cast("string"), F.lit("-"), last_year.cast("string"))
    )
    stats = F.concat_ws(
        " | ",
        F.when(some, F.concat(F.lit("📊 "), tracks.cast("string"), F.lit(" tracks"))),
        F.when(some & (hours > 0), F.concat(F.lit("⏱️ "), length)),
        F.when(some & (popularity > 0), F.concat(F.lit("⭐ "), popularity.cast("string"), F.lit("/100"))),
        F.when(some & (first_year > 0) & (last_year > 0), F.concat(F.lit("📅 "), years)),
    )
    artists = F.array_join(F.slice(top_artists, 1, 3), ", ")
    artist_line = F.when((artists != "") & (F.length(artists) <= 50), F.concat(F.lit("🎤 "), artists))
    head = F.concat_ws("\n", F.when(base != "", base), F.when(stats != "", stats), artist_line)
    full = F.regexp_replace(F.concat_ws("\n", F.when(head != "", head), tags), CONTROL, "")
    room = F.lit(limit - 10) - F.length(head)
    cut_tags = F.when(
        room > 20,
        F.concat(head, F.lit("\n"), F.substring(tags, F.lit(1), room), F.lit("...")),
    ).otherwise(head)
    shortened = F.when(F.length(tags) > 50, cut_tags).otherwise(_ellipsis(full, limit))
    return F.substring(F.when(F.length(full) <= limit, full).otherwise(shortened), 1, limit)
