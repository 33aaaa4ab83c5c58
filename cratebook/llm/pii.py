"""Personal data: patterns propose spans, checksums confirm them, nearby words move their score.

Everything is SQL expressions. A text split by a pattern and the list of its matches come from
the same scan rule, so the lengths of the parts in turn give the position of every match, in
code points. The patterns are written so that no start inside a run is tried twice and nothing
is given back: the time is linear in the text whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import col, fresh, keyed_text

LOCAL = "A-Za-z0-9._%+-"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

# Possessive and anchored forms of the plain patterns; they match the same spans. A start within
# a run fails like the run's first, unless a match ended there (\G). A card's run must have 14 to
# 19 digits, and an address's parts are judged after the match.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this character has no match.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
#: Score of a bare match, and what a passed checksum adds.
SCORES = {"email": (0.8, 0.0), "ip": (0.6, 0.0), "card": (0.5, 0.4), "phone": (0.6, 0.0), "iban": (0.2, 0.5), "ssn": (0.3, 0.0)}
#: Words that raise the score when they stand near.
CONTEXT = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|server|host|address",
    "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|konto",
    "ssn": r"\bssn\b|social|security",
}
NEAR = 40
CONTEXT_BONUS = 0.3
THRESHOLD = 0.5


def luhn(number: Column) -> Column:
    """Whether the digits of ``number`` (up to 20) pass Luhn's check."""
    digits = F.lpad(F.regexp_replace(number, "[^0-9]", ""), 20, "0")
    total = F.lit(0)
    for place in range(20):
        digit = F.substring(digits, 20 - place, 1).cast("int")
        total = total + (digit if place % 2 == 0 else 2 * digit - F.when(digit > 4, 9).otherwise(0))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number has remainder 1: its first four characters moved behind, letters as 10 to 35."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _valid(kind: str, found: Column) -> Column:
    """Checks that a match must pass to be a span at all."""
    digits = F.length(F.regexp_replace(found, "[^0-9]", ""))
    if kind == "ip":
        return found.rlike(rf"^(?:{PART}\.){{3}}{PART}$")
    if kind == "card":
        return luhn(found)
    if kind == "phone":
        return digits.between(10, 15)
    if kind == "iban":
        return mod97(found)
    return F.lit(True)


_SPAN = "struct<start:int,rank:int,kind:string,end:int,score:double>"


def _matches(text: Column, kind: str) -> Column:
    """Spans of one kind in a text, in order."""
    parts = F.split(text, PATTERNS[kind], -1)
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    steps = F.zip_with(
        F.slice(parts, F.lit(1), F.size(found)),
        found,
        lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("n"), m.alias("m")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,m:string>>").alias("out"))

    def walk(state: Column, step: Column) -> Column:
        begin = state["at"] + step["gap"]
        end = begin + step["n"]
        span = F.struct(begin.alias("start"), end.alias("end"), step["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    placed = F.filter(F.aggregate(steps, start, walk)["out"], lambda x: _valid(kind, x["m"]))
    bare, checked = SCORES[kind]

    def scored(x: Column) -> Column:
        before = F.greatest(x["start"] - NEAR, F.lit(0))
        around = F.concat_ws(
            " ", F.substr(text, before + 1, x["start"] - before), F.substr(text, x["end"] + 1, F.lit(NEAR))
        )
        bonus = F.when(F.lower(around).rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            x["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            x["end"].alias("end"),
            F.least(F.lit(bare + checked) + bonus, F.lit(1.0)).alias("score"),
        )

    spans = F.filter(F.transform(placed, scored), lambda x: x["score"] >= THRESHOLD)
    likely = F.lit(True) if kind not in NEEDS else F.contains(text, F.lit(NEEDS[kind]))
    return F.when(likely, spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def spans(text: Column) -> Column:
    """All spans of a text as structs (start, rank, kind, end, score), by start and kind.

    Offsets count code points from 0, ``end`` is behind the last. Kinds with a checksum (card:
    Luhn, iban: mod 97) are confirmed by it; addresses and phones by their numbers; an ssn needs
    a word of its context within 40 code points. Spans of different kinds may overlap. A null
    text is empty and has none.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.sort_array(F.concat(*[_matches(text, k) for k in KINDS]))


def _written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(<id_col>, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans): one row per document.

    Null and empty texts have no spans; repeated rows stay; other columns are ignored.
    """
    own = keyed_text(docs, id_col, text_col)
    found = own.select("id", spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda x: x["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias(id_col),
        *[count(kind) for kind in BASE],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("found")).alias("spans"),
        F.size("found").cast("long").alias("n_spans"),
    )


def masked(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first one's."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def walk(state: Column, x: Column) -> Column:
        tag = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
        gap = F.substr(text, state["at"] + 1, x["start"] - state["at"])
        out = F.when(x["start"] >= state["at"], F.concat(state["out"], F.array(gap, tag))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(found, start, walk)
    return F.concat(F.array_join(done["out"], ""), F.substr(text, done["at"] + 1, F.length(text)))


def mask_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data in its texts masked; all rows and columns stay, and
    ``length_col`` follows the text where it changes. Null texts stay null."""
    name = fresh(docs, "found")
    found = docs.withColumn(name, spans(col(text_col)))
    some = F.size(col(name)) > 0
    new = {text_col: F.when(some, masked(col(text_col), col(name))).otherwise(col(text_col))}
    if length_col:
        new[length_col] = F.when(some, F.length(masked(col(text_col), col(name))).cast(docs.schema[length_col].dataType)).otherwise(col(length_col))
    return found.select(*[new[c].alias(c) if c in new else col(c) for c in docs.columns])
