"""Column expressions against values worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cratebook.functions import music, names, texts, times
from cratebook.functions.names import NameStyle


def values(spark, inputs, build, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.select(build(F.col("x")).alias("v"), "i").orderBy("i").select("v").collect()]


def test_popularity_tier_boundaries(spark):
    got = values(spark, [0, 20, 21, 40, 41, 60, 61, 80, 81, 100, None], music.popularity_tier, "int")
    assert got == ["underground"] * 2 + ["niche"] * 2 + ["moderate"] * 2 + ["popular"] * 2 + ["mainstream"] * 2 + ["unknown"]


def test_release_year(spark):
    assert values(spark, ["1999", "1999-05", "1999-05-02", "bad", None, ""], music.release_year) == [1999, 1999, 1999, None, None, None]


def test_uri_and_id(spark):
    long_id = "a" * 22
    assert values(spark, ["spotify:track:x", long_id, "short", "a" * 19, "x:" + long_id, None], music.item_uri) == [
        "spotify:track:x", f"spotify:track:{long_id}", "short", "a" * 19, "x:" + long_id, None,
    ]
    assert values(spark, ["spotify:track:x", "y"], music.uri_item) == ["x", "y"]


def test_genre_texts(spark):
    got = values(spark, ["['rock', 'pop']", "rock, pop ,", "rock", "[]", "", "NaN", None], music.clean_genre_text)
    assert got == [["rock", "pop"], ["rock", "pop"], ["rock"], [], [], [], []]
    assert values(spark, [[" a ", ""], [], None], music.clean_genre_array, "array<string>") == [["a"], [], []]
    assert values(spark, [["a", "b"], [], None], music.core_genre, "array<string>") == ["a", None, None]


@pytest.mark.parametrize(
    "valence, energy, label",
    [
        (0.5, 0.6, "Energetic"), (0.49, 0.6, "Intense"), (0.5, 0.39, "Chill"), (0.49, 0.39, "Melancholic"),
        (0.6, 0.4, "Happy"), (0.59, 0.5, "Upbeat"), (0.59, 0.49, "Mellow"), (None, 0.5, None), (0.5, None, None),
    ],
)
def test_moods(spark, valence, energy, label):
    df = spark.createDataFrame([(valence, energy)], "v double, e double")
    assert df.select(music.mood(F.col("v"), F.col("e"))).first()[0] == label


def test_dayparts(spark):
    stamps = [f"2024-01-0{d} {h:02d}:00:00" for d, h in [(1, 0), (1, 5), (1, 6), (1, 11), (1, 12), (1, 17), (1, 18), (6, 23)]]
    parts = values(spark, stamps, lambda x: times.daypart(x.cast("timestamp")))
    assert parts == ["night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening"]
    weekend = values(spark, stamps, lambda x: times.in_daypart(x.cast("timestamp"), "weekend"))
    assert weekend == [False] * 7 + [True]


def test_period_end(spark):
    df = spark.createDataFrame(
        [(0, "month", "2024-02"), (1, "year", "2023"), (2, "month", "oops"), (3, "year", "x")], "i int, t string, v string"
    )
    shown = F.date_format(times.period_end(F.col("t"), F.col("v")), "yyyy-MM-dd HH:mm:ss")
    got = [r[0] for r in df.orderBy("i").select(shown).collect()]
    assert got == ["2024-02-29 23:59:59", "2023-12-31 23:59:59", None, None]


def test_monthly_names(spark):
    yes = ["Jan'25", "jan 25", "Dec2024", " January 2024 ", "2024-01", "2024/01", "01/2024"]
    no = ["Janus", "January", "2024-1", "My Jan'25", "", None, "Jan'25 mix"]
    assert values(spark, yes + no, names.is_monthly_name) == [True] * len(yes) + [False] * len(no)


def test_categories_take_the_first_rule(spark):
    cases = {
        "AJFindsJan25": "automated", "Top 2024": "automated", "Top hits": "time_based", "discovery": "time_based",
        "New rock": "genre", "Fresh finds": "time_based", "New stuff": "discovery", "Liked": "favorites",
        "Best of": "favorites", "Road": "manual", "R&B Jan": "genre", "": "manual",
    }
    assert values(spark, list(cases), names.category) == list(cases.values())


def test_auto_name_parts(spark):
    got = values(
        spark, ["AJFindsJan25", "AJTopDec2023", "AJDiscoveryMay07", "AJFinds25", "XJFindsJan25", "AJFindsJan", None],
        lambda x: names.auto_name_parts(x),
    )
    assert [tuple(g) if g else None for g in got] == [
        ("monthly", 2025, 1, "2025-01"), ("most_played", 2023, 12, "2023-12"), ("discovery", 2007, 5, "2007-05"),
        None, None, None, None,
    ]


def test_legacy_names(spark):
    got = values(
        spark, ["AJFindsJan25", "AJFinds25", "AJTop24", "AJHipHop24", "AJAmHipHop", "AJMine", "Dance", "AJDiscovery99"],
        lambda x: names.is_legacy_name(x, 2026),
    )
    assert got == [True, False, False, True, True, False, False, False]


def test_archive_names(spark):
    month = F.lit("2025-01")
    one = spark.range(1)

    def made(*args, **kwargs):
        return one.select(names.archive_name(*args, **kwargs)).first()[0]

    assert made("monthly", month=month) == "AJFindsJan25"
    assert made("most_played", year=F.lit(2025)) == "AJTop25"
    assert made("yearly", year=F.lit("25")) == "AJFinds25"
    medium = NameStyle(date_format="medium", month_separator="space")
    assert made("monthly", month=month, style=medium) == "AJFindsJanuary 2025"
    dashed = NameStyle(prefix_separator="dash", month_separator="underscore", capitalization="title")
    assert made("discovery", month=month, style=dashed) == "Aj-DiscoveryJan_25"
    assert made("monthly", month=month, style=NameStyle(date_format="numeric")) == "AJFinds012025"
    assert made("monthly", month=month, genre="Rock", template="{genre} {mon}") == "Rock Jan25"


def test_renamed_carries_the_case(spark):
    changes = {"Auto": "Finds", "auto": "finds", "AUTO": "FINDS"}
    got = values(spark, ["AJAutoJan25", "ajautojan25", "AJAUTO25", "Other"], lambda x: names.renamed(x, changes))
    assert got == ["AJFindsJan25", "ajfindsjan25", "AJFINDS25", None]


def test_base_lines(spark):
    cases = {
        "AJFindsJan26": "Liked songs from Jan 26", "ajtopfeb25": "Most played from feb 25",
        "AJDiscoveryDec24": "Discovery from Dec 24", "AJFinds26": "Liked songs from 2026",
        "AJFinds2026": "Liked songs from 2026", "AJTop26": None, "Mine": None, "": None,
    }
    assert values(spark, list(cases), texts.base_line) == list(cases.values())


def test_strip_parens(spark):
    assert values(spark, ["a (b) c [d]  e", "(x)", "no\tchange", None], texts.strip_parens) == ["a c e", "", "no change", None]


def test_publishable_description(spark):
    decomposed, family, zero_width = "é", "ok \U0001f600️\U0001f3fd!", "a​b\r\nc\x00"
    got = values(spark, [decomposed, family, zero_width, "x" * 301, "★ kept", None], texts.publishable_description)
    assert got == ["é", "ok !", "abc", "x" * 297 + "...", "★ kept", ""]


def test_clean_description_keeps_the_first_line(spark):
    long_rest = "first\n" + "y" * 400
    long_first = "z" * 295 + "\nrest of it"
    got = values(spark, ["a\x01b", long_rest, long_first, "w" * 400], texts.clean_description)
    assert got == ["ab", "first\n" + "y" * 290 + "...", long_first[:297] + "...", "w" * 297 + "..."]
    assert all(len(g) <= 300 for g in got)


def test_mood_line(spark):
    df = spark.createDataFrame(
        [
            (0, "base", ["Chill", "Happy"]), (1, "", ["Chill"]), (2, "base\nMoods: old\nstale\n\ntail", ["Happy"]),
            (3, "base", []), (4, "a\nMoods: x\nMoods: y\nz", ["Happy"]), (5, None, ["Chill"]),
        ],
        "i int, d string, m array<string>",
    )
    got = [r[0] for r in df.orderBy("i").select(texts.with_mood_line(F.col("d"), F.col("m"))).collect()]
    assert got == [
        "base\nMoods: Chill • Happy", "Moods: Chill", "base\nMoods: Happy\n\ntail", "base",
        "a\nMoods: Happy\nMoods: Happy", "Moods: Chill",
    ]
    long = df.limit(1).select(texts.mood_tags(F.array(*[F.lit("m" * 30)] * 5))).first()[0]
    assert long == (" • ".join(["m" * 30] * 5))[:110] + "..."


def rich(spark, **given):
    base = dict(base="Mine", tracks=3, hours=0.5, popularity=10.0, y1=1999, y2=2001, artists=["A", "B"], tags=None)
    row = {**base, **given}
    df = spark.createDataFrame(
        [tuple(row.values())],
        "base string, tracks bigint, hours double, popularity double, y1 int, y2 int, artists array<string>, tags string",
    )
    columns = [F.col(c) for c in ("base", "tracks", "hours", "popularity", "y1", "y2", "artists", "tags")]
    return df.select(texts.rich_description(*columns)).first()[0]


def test_rich_description(spark):
    assert rich(spark) == "Mine\n📊 3 tracks | ⏱️ 30 min | ⭐ 10.0/100 | 📅 1999-2001\n🎤 A, B"
    assert rich(spark, hours=2.5, y2=1999, popularity=0.0, artists=["x" * 51], tags="t") == "Mine\n📊 3 tracks | ⏱️ 2.5 hr | 📅 1999\nt"
    assert rich(spark, tracks=0, artists=[], base="") == ""
    cut = rich(spark, tags="g" * 400)
    assert len(cut) <= 300 and cut.startswith("Mine\n") and cut.endswith("g...")
    no_room = rich(spark, base="b" * 280, tags="g" * 60)
    assert "g" not in no_room
    assert rich(spark, base="b" * 400).endswith("...") and len(rich(spark, base="b" * 400)) == 300
