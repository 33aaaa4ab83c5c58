"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many places of a ring of 2^32 points, every row at the hash of its key. A
row goes to the next place clockwise; if that shard is full, on to the next place whose shard
has room. Rows between two neighbouring places (an arc) all meet the shards in the same order,
so that the number of rows on each arc decides how many of them each shard takes: the walk is
done once over arc counts, whatever the number of rows, and every row then finds its shard by
its rank within its arc.

With room for all rows exactly (counts at most one apart) balance is perfect; a shard more moves
only what it takes over and what the smaller bounds push on.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import col, keyed_text
from cratebook.operators.grouping import counted_row_number

SHARDS = 24
#: Places of each shard on the ring.
VIRTUAL = 64
#: Rows are counted by stretches of 2^STRETCH points of the ring's 2^32.
STRETCH = 16


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(point, shard) of all places, ascending; a configuration, no data."""
    places = [(int(hashlib.md5(f"{s}/{v}".encode()).hexdigest()[:8], 16), s) for s in range(shards) for v in range(virtual)]
    return sorted(places)


def _constants(values: list[int], kind: str) -> Column:
    """A list of numbers as one literal (a long list of single literals is slow to plan)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def point(key: Column) -> Column:
    """Where a key stands on the ring."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def arc(at: Column, places: list[tuple[int, int]]) -> Column:
    """Number of the first place at or after a point; behind the last place, the first."""
    points = _constants([p for p, _ in places], "bigint")
    steps = [1 << k for k in reversed(range(len(places).bit_length()))]

    def narrow(low: Column, step: Column) -> Column:
        inside = (low + step <= len(places)) & (F.get(points, low + step - 1) < at)
        return F.when(inside, low + step).otherwise(low)

    found = F.aggregate(_constants(steps, "int"), F.lit(0), narrow)
    return F.when(found == len(places), 0).otherwise(found)


def _walks(places: list[tuple[int, int]]) -> list[list[int]]:
    """For every arc the shards in clockwise order, each once."""
    out = []
    for k in range(len(places)):
        turn = [s for _, s in places[k:] + places[:k]]
        out.append(list(dict.fromkeys(turn)))
    return out


def quotas(counts: DataFrame, shards: int, places: list[tuple[int, int]]) -> DataFrame:
    """(arc, shard, first, last, base): rows number first to last - 1 of an arc go to the shard,
    whose slots they fill from ``base`` on.

    ``counts`` (arc, n) has at most one row per place, a constant of the configuration; arcs
    fill their shards in ring order, as if rows came in ring order. The first shards get the one
    row more if the rows can't be divided.
    """
    spark = counts.sparkSession
    walks = _walks(places)
    arcs = spark.range(len(places)).select(F.col("id").cast("int").alias("arc"))
    filled = arcs.join(counts, "arc", "left").select("arc", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    # One row: as many entries as the ring has places.
    whole = filled.agg(F.sort_array(F.collect_list(F.struct("arc", "n"))).alias("arcs"), F.sum("n").alias("total"))
    room = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.floor(F.col("total") / shards).cast("long") + F.when(s < F.col("total") % shards, 1).otherwise(0),
    )
    takes = "array<struct<arc:int,shard:int,first:bigint,last:bigint,base:bigint>>"
    start = F.struct(room.alias("room"), F.array_repeat(F.lit(0).cast("long"), shards).alias("used"), F.array().cast(takes).alias("takes"))
    order = _constants([w for walk in walks for w in walk], "int")

    def fill(state: Column, x: Column) -> Column:
        none = F.struct(state["room"].alias("room"), state["used"].alias("used"), F.lit(0).cast("long").alias("done"), F.array().cast(takes).alias("takes"))

        def offer(s: Column, k: Column) -> Column:
            shard = F.get(order, x["arc"] * shards + k)
            n = F.least(F.get(s["room"], shard), x["n"] - s["done"])
            used = F.get(s["used"], shard)
            take = F.struct(x["arc"].alias("arc"), shard.alias("shard"), s["done"].alias("first"), (s["done"] + n).alias("last"), used.alias("base"))
            return F.when(n <= 0, s).otherwise(
                F.struct(
                    F.transform(s["room"], lambda r, i: F.when(i == shard, r - n).otherwise(r)).alias("room"),
                    F.transform(s["used"], lambda r, i: F.when(i == shard, r + n).otherwise(r)).alias("used"),
                    (s["done"] + n).alias("done"),
                    F.concat(s["takes"], F.array(take)).alias("takes"),
                )
            )

        after = F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), none, offer)
        return F.struct(after["room"].alias("room"), after["used"].alias("used"), F.concat(state["takes"], after["takes"]).alias("takes"))

    return whole.select(F.inline(F.aggregate("arcs", start, fill)["takes"]))


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, virtual: int = VIRTUAL) -> DataFrame:
    """(<id_col>, size, text_crc32, shard, slot): every row has a place in exactly one shard.

    Shards differ by one row at most; slots of a shard run from 0 without gaps. The key is the id
    as a decimal string (null ids share one key, rows with equal keys are ordered by size and
    checksum). ``size`` is the text's length in UTF-8 plus 8, null texts are empty. An empty table
    gives none.
    """
    places = ring(shards, virtual)
    rows = keyed_text(docs, id_col, text_col).select(
        "id",
        (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        point(F.coalesce(F.col("id").cast("string"), F.lit("null"))).alias("point"),
    )
    rows = rows.withColumn("arc", arc(F.col("point"), places))
    counts = rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n"))
    # Rows are ranked by short stretches of the ring, and by checksum within one, so that neither
    # a wide arc nor a hot key is sorted in one task.
    step = F.shiftright("point", STRETCH) * 16 + F.col("text_crc32") % 16
    ranked = counted_row_number(rows, ["arc"], step, ["point", "id", "size", "text_crc32"], "rank")
    takes = F.broadcast(quotas(counts, shards, places))  # at most places + shards rows, whatever the data
    own = ranked.join(takes, "arc").where((F.col("rank") > F.col("first")) & (F.col("rank") <= F.col("last")))
    slot = F.col("base") + F.col("rank") - 1 - F.col("first")
    return own.select(col("id").alias(id_col), "size", "text_crc32", "shard", slot.alias("slot"))
