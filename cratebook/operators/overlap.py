"""Set-similarity joins between collections.

Three things keep the work near the size of the result, whatever the skew:

* Identical sets are found by signature and stand for each other. A group of
  copies is listed as (first, copy) rows, never as all pairs, and only its first
  set goes on; ``copies`` says how many collections it stands for.
* Items are ordered rarest first and only sets that share an item inside a short
  prefix are compared (prefix filtering). The prefix lengths are exact bounds: no
  pair above the threshold is missed, and very common items hardly ever lie in a
  prefix.
* Short sets are rows of arrays from the start, and equal ones are grouped as such. While no
  item is common, its rank tells nothing, and the arrays are compared in their own order.
* Where prefixes tell nothing, they are not used. Many sets of a few items (hours of a
  day) are bit masks, compared block by block; few sets of many items are counted item by
  item. Both are exact.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType, StringType

from cratebook.operators import bitmasks
from cratebook.operators.grouping import GROUP_LIMIT, WHOLE, counted_row_number
from cratebook.session import cut_lineage

# Relative slack, a few units in the last place, for bounds computed in floating point.
SLACK = 2e-15
ROWS_PER_TILE = 50_000
# Sets up to this size travel as one array through the join.
SHORT_SET = 64
# Sets of so many items in all are compared as bit masks, if there are so many sets.
MASK_ITEMS = 128
MASK_SETS = 256
# Sets in one block of masks.
BLOCK = 16_384
# Up to so many sets are counted item by item, if they have so many rows.
FEW_SETS = 128
FEW_ROWS = 20_000
# Items are not ranked by their number of sets while a set meets so few others at one of them,
# and none is in more sets than this.
EVEN_MEAN = 128
EVEN_MOST = 4_096
# Arrays have at most so many items, and an item's array in the mean no more than ``SHORT_SET``.
LONGEST = 1_024
# Parts in which rows are counted before a part may be brought together.
PARTS = 65_536
# Items that are equal exactly where an array of them says so.
PLAIN = (ByteType(), ShortType(), IntegerType(), LongType(), DateType(), StringType())


def item_sets(members: DataFrame, set_col: str = "playlist_id", item_col: str = "track_id") -> DataFrame:
    return (
        members.select(F.col(set_col).alias("set_id"), F.col(item_col).alias("item_id"))
        .where(F.col("set_id").isNotNull() & F.col("item_id").isNotNull())
        .distinct()
    )


@dataclass(frozen=True)
class ShortSets:
    """Sets as rows (set_id, items in ascending order, bits), most of them short."""

    rows: DataFrame

    def spread(self) -> DataFrame:
        """One row per item."""
        return self.rows.select("set_id", F.explode("items").alias("item_id"))


def written_sets(
    members: DataFrame, set_col: str = "playlist_id", item_col: str = "track_id", only: DataFrame | None = None, stored: bool = False
) -> DataFrame | ShortSets:
    """Item sets as a written table, of those in ``only`` (set_id) if given: ``ShortSets`` if
    nearly all are short and their items many, else rows.

    ``stored``: members are a table that is cheap to read again. Its rows are then counted
    where they lie, and sets brought together without being spread by item before.
    """
    rows = members.select(F.col(set_col).alias("set_id"), F.col(item_col).alias("item_id"))
    found = _arrays(rows.where(F.col("set_id").isNotNull() & F.col("item_id").isNotNull()), only) if stored else None
    if found is None:
        sets = item_sets(members, set_col, item_col)
        sets = cut_lineage(sets if only is None else sets.join(only, "set_id", "left_semi"))
        found = _arrays(sets) or sets
    return found


def _arrays(rows: DataFrame, only: DataFrame | None = None) -> DataFrame | ShortSets | None:
    """Sets, whose rows may repeat, as arrays; every item also sets one bit of 64. None, if items
    are so few that bit masks serve better, or sets too long; rows, if only the arrays tell that."""
    if rows.schema["item_id"].dataType not in PLAIN:
        return None
    distinct = (F.approx_count_distinct(c).alias(c) for c in ("set_id", "item_id"))
    about = rows.agg(*distinct, F.count(F.lit(1)).alias("rows")).first()
    if about["item_id"] <= 2 * MASK_ITEMS or about["rows"] > SHORT_SET * about["set_id"]:
        return None
    # No part, and so no set, has more rows than a task may hold at once.
    parts = rows.groupBy(F.pmod(F.xxhash64("set_id"), F.lit(PARTS)).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    if parts.agg(F.max("n")).first()[0] > WHOLE:
        return None
    # Brought together first: a set's rows may lie in any task, and arrays are costly to merge.
    together = rows.repartition("set_id").groupBy("set_id")
    arrays = together.agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.bit_or(_bit("item_id")).alias("bits"))
    arrays = cut_lineage(arrays if only is None else arrays.join(only, "set_id", "left_semi"))
    n = F.size("items").cast("double")
    size = arrays.agg(F.max(n).alias("most"), F.sum(n).alias("rows"), F.sum(n * n).alias("travel")).first()
    fits = size["rows"] is None or (size["most"] <= LONGEST and size["travel"] <= SHORT_SET * size["rows"])
    return ShortSets(arrays) if fits else cut_lineage(ShortSets(arrays).spread())


def _bit(item: str) -> Column:
    return F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({item}), 64) AS INT))")


SIGNATURE = ["n_items", "sig_a", "sig_b", "sig_c"]


def signatures(sets: DataFrame) -> DataFrame:
    """Size and three independent order-free digests of each set (about 150 bits in all).

    Digests are plain aggregates: they combine on the map side and never hold the
    set itself, so one huge collection costs no more memory than a small one.
    """
    item = F.col("item_id")
    return sets.groupBy("set_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.bit_xor(F.xxhash64(item)).alias("sig_a"),
        F.bit_xor(F.xxhash64(F.lit("second"), item)).alias("sig_b"),
        F.sum(F.shiftrightunsigned(F.xxhash64(F.lit("third"), item), 40)).alias("sig_c"),
    )


def _matched(sets: DataFrame, alike: DataFrame) -> DataFrame:
    """Rows of ``alike`` (set_id, first_id, n_items) whose sets are equal item by item: as
    many of a set's items lie in the first set as it has. One lookup per item of a copy;
    first sets that many others are held against are split by their items."""
    others = alike.where(F.col("set_id") != F.col("first_id"))
    firsts = others.select(F.col("first_id").alias("set_id")).distinct()
    theirs = sets.join(firsts, "set_id", "left_semi").select(F.col("set_id").alias("first_id"), "item_id")
    found = sets.join(others, "set_id").join(theirs, ["first_id", "item_id"])
    counted = found.groupBy("set_id", "first_id", "n_items").agg(F.count(F.lit(1)).alias("matched"))
    return counted.where(F.col("matched") == F.col("n_items")).select("set_id", "first_id", "n_items")


def _identical_arrays(sets: ShortSets, first_by: DataFrame | None) -> DataFrame:
    """As ``identical_sets``, by the items themselves; first sets keep ``items`` and ``bits``."""
    alike = sets.rows.groupBy("items", "bits").agg(F.min("set_id").alias("set_id"), F.count(F.lit(1)).alias("copies"))
    alike = cut_lineage(alike)
    several = cut_lineage(alike.where(F.col("copies") > 1).select("items", "bits", "copies"))
    found = sets.rows.select("set_id", "items").join(several, "items")
    if first_by is not None:
        found = found.join(first_by.select("set_id", "preference"), "set_id", "left")
        first = F.min(F.struct("preference", "set_id"))["set_id"]
    else:
        first = F.min("set_id")
    found = cut_lineage(found.drop("preference", "bits") if first_by is None else found.drop("bits"))
    firsts = cut_lineage(several.join(found.groupBy("items").agg(first.alias("first_id")), "items"))
    copies = found.join(firsts.select("items", "first_id"), "items").where(F.col("set_id") != F.col("first_id"))
    columns = ["set_id", "first_id", F.size("items").cast("bigint").alias("n_items"), "copies"]
    no_set = [F.lit(None).cast(sets.rows.schema[c].dataType).alias(c) for c in ("items", "bits")]
    single = alike.where(F.col("copies") == 1).withColumn("first_id", F.col("set_id"))
    kept = single.select(*columns, "items", "bits").unionByName(firsts.withColumn("set_id", F.col("first_id")).select(*columns, "items", "bits"))
    return kept.unionByName(cut_lineage(copies.select(*columns)).select("*", *no_set))


def _repeats(names: DataFrame) -> bool:
    rows = names.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.count(F.lit(1)).alias("n"))
    return (rows.agg(F.max("n")).first()[0] or 0) > 1


def written_groups(sets: DataFrame | ShortSets, first_by: DataFrame | None = None) -> DataFrame:
    """``identical_sets`` as a written table; of short sets it is made of written ones."""
    groups = identical_sets(sets, first_by)
    return groups if "items" in groups.columns else cut_lineage(groups)


def identical_sets(sets: DataFrame | ShortSets, first_by: DataFrame | None = None) -> DataFrame:
    """(set_id, first_id, n_items, copies): every set with the first of its group.

    ``first_by`` (set_id, preference) decides who is first; default is the lowest id.
    Equal digests only propose: a set is called a copy when its items are counted in the
    first set. Sets that share a digest with a first set and differ from it are grouped
    again among themselves, until none is left.

    Short sets are grouped by their items instead, unless ``first_by`` names a set twice.
    """
    if isinstance(sets, ShortSets):
        if first_by is None or not _repeats(first_by):
            return _identical_arrays(sets, first_by)
        sets = cut_lineage(sets.spread())
    signed = signatures(sets)
    if first_by is None:
        signed = signed.withColumn("preference", F.lit(0))
    else:
        signed = signed.join(first_by.select("set_id", "preference"), "set_id", "left")
    parts, columns = [], ["set_id", "first_id", "n_items"]
    while True:
        firsts = signed.groupBy(*SIGNATURE).agg(F.min(F.struct("preference", "set_id")).alias("first"))
        alike = cut_lineage(signed.join(firsts, SIGNATURE).withColumn("first_id", F.col("first.set_id")).drop("first"))
        copies = cut_lineage(_matched(sets, alike.select(*columns)))
        parts += [alike.where(F.col("set_id") == F.col("first_id")).select(*columns), copies]
        # Only where digests collide is anything left: no round beyond the first otherwise.
        signed = alike.where(F.col("set_id") != F.col("first_id")).join(copies.select("set_id"), "set_id", "left_anti").drop("first_id")
        if signed.isEmpty():
            break
    rows = reduce(DataFrame.unionByName, parts)
    sizes = rows.groupBy("first_id").agg(F.count(F.lit(1)).alias("copies"))
    return rows.join(sizes, "first_id").select("set_id", "first_id", "n_items", "copies")


def place_items(sets: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Adds set size ``n``, document frequency ``df`` and rarest-first position ``pos``.

    Written once, as every later step reads it.
    """
    if "n" not in sets.columns:
        sets = sets.join(sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("n")), "set_id")
    frequency = sets.groupBy("item_id").agg(F.count(F.lit(1)).alias("df"))
    # Frequency first; a hash bucket splits the many items of equal frequency, so
    # that no counting step of a huge set grows with the set.
    rarity = F.col("df") * 1024 + F.pmod(F.xxhash64("item_id"), F.lit(1024))
    rare_first = sets.join(frequency, "item_id").withColumn("rarity", rarity)
    usual = rare_first.where(F.col("n") <= group_limit).withColumn(
        "pos",
        F.row_number().over(Window.partitionBy("set_id").orderBy("rarity", "item_id")).cast("bigint"),
    )
    huge = counted_row_number(
        rare_first.where(F.col("n") > group_limit), ["set_id"], F.col("rarity"), ["item_id"], name="pos"
    )
    return cut_lineage(usual.unionByName(huge).drop("rarity"))


@dataclass(frozen=True)
class Bounds:
    """Which pairs are wanted. A pair is wanted when any given bound holds.

    * ``jaccard``: overlap / union at least this.
    * ``subsets``: the smaller set lies inside the larger.
    * ``containment``: overlap / smaller at least this, larger >= size_ratio x smaller.

    ``strict`` asks for more than the bound instead of at least; it shortens the
    prefixes of sets that can meet a bound exactly.
    """

    jaccard: float | None = None
    subsets: bool = False
    containment: float | None = None
    size_ratio: float = 1.0
    strict: bool = False

    def __post_init__(self) -> None:
        if self.jaccard is None and not self.subsets and self.containment is None:
            raise ValueError("name a bound: without one the result is every pair")
        if any(b is not None and b <= 0 for b in (self.jaccard, self.containment)):
            raise ValueError("bounds must be positive")

    def needed(self, share: float, n: Column) -> Column:
        """Smallest number of items that is at least (or more than) ``share * n``."""
        if self.strict:
            return F.floor(F.lit(share * (1 + SLACK)) * n) + 1
        return F.ceil(F.lit(share * (1 - SLACK)) * n)

    def small_prefix(self, n: Column) -> Column:
        """Items of the smaller set, rarest first, one of which a wanted pair shares."""
        options = [F.lit(1)]
        if self.jaccard is not None:
            options.append(n - self.needed(2 * self.jaccard / (1 + self.jaccard), n) + 1)
        if self.containment is not None:
            options.append(n - self.needed(self.containment, n) + 1)
        return F.greatest(*options, F.lit(1))

    def large_prefix(self, n: Column) -> Column:
        if self.subsets or self.containment is not None:
            return n
        return n - self.needed(self.jaccard, n) + 1

    def possible(self, n1: Column, n2: Column, p1: Column, p2: Column) -> Column:
        """Can a pair still be wanted whose first shared item lies at p1 and p2?"""
        # Items behind the first shared one bound what can still be shared.
        reachable = 1 + F.least(n1 - p1, n2 - p2)
        ways: list[Column] = []
        if self.jaccard is not None:
            t = self.jaccard
            ways.append(
                (p1 <= n1 - self.needed(2 * t / (1 + t), n1) + 1)
                & (p2 <= n2 - self.needed(t, n2) + 1)
                & (n1 >= t * (1 - SLACK) * n2)
                & (reachable >= self.needed(t / (1 + t), n1 + n2))
            )
        if self.subsets:
            ways.append((p1 == 1) & (n2 - p2 >= n1 - 1))
        if self.containment is not None:
            ways.append(
                (p1 <= n1 - self.needed(self.containment, n1) + 1)
                & (n2 >= self.size_ratio * (1 - SLACK) * n1)
                & (reachable >= self.needed(self.containment, n1))
            )
        return reduce(or_, ways)

    def holds(self, n1: Column, n2: Column, overlap: Column) -> Column:
        ways: list[Column] = []
        if self.jaccard is not None:
            ways.append(overlap >= self.jaccard * (1 - SLACK) * (n1 + n2 - overlap))
        if self.subsets:
            ways.append(overlap == n1)
        if self.containment is not None:
            ways.append(
                (overlap >= self.containment * (1 - SLACK) * n1) & (n2 >= self.size_ratio * (1 - SLACK) * n1)
            )
        return reduce(or_, ways)


def _sides(placed: DataFrame, bounds: Bounds, rows_per_tile: int, *carried: str):
    """Both sides of the prefix join. A common item is split over tiles: one side
    takes one tile, the other, which rarely holds common items, visits all."""
    tiles = F.ceil(F.col("df") / F.lit(rows_per_tile)).cast("int")

    def named(side: str) -> list[Column]:
        columns = [F.col("set_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("pos").alias(f"pos_{side}")]
        return columns + [F.col(c).alias(f"{c}_{side}") for c in carried]

    small = placed.where(F.col("pos") <= bounds.small_prefix(F.col("n"))).select(
        "item_id", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("tile"), *named("small")
    )
    large = placed.where(F.col("pos") <= bounds.large_prefix(F.col("n"))).select(
        "item_id", F.pmod(F.xxhash64("set_id"), tiles).cast("int").alias("tile"), *named("large")
    )
    return small, large


def _meet(small: DataFrame, large: DataFrame, bounds: Bounds) -> DataFrame:
    n1, n2 = F.col("n_small"), F.col("n_large")
    ordered = (n1 < n2) | ((n1 == n2) & (F.col("small") < F.col("large")))
    possible = bounds.possible(n1, n2, F.col("pos_small"), F.col("pos_large"))
    return small.join(large, ["item_id", "tile"]).where(ordered & possible)


def _short_pairs(placed: DataFrame, bounds: Bounds, rows_per_tile: int) -> DataFrame:
    """Both sets short: their items travel along, the overlap is known at the join,
    and a pair is emitted only at its first shared item - no second shuffle."""
    cells = F.array_sort(F.collect_list(F.struct("pos", "item_id", "df")))
    short = (
        placed.where(F.col("n") <= SHORT_SET)
        .groupBy("set_id", "n")
        .agg(cells.alias("cells"), F.bit_or(_bit("item_id")).alias("bits"))
        .withColumn("items", F.transform("cells", lambda c: c["item_id"]))
        .select("set_id", "n", "bits", "items", F.inline("cells"))
    )
    return _verified(_meet(*_sides(short, bounds, rows_per_tile, "items", "bits"), bounds), bounds)


def _even_pairs(arrays: DataFrame, bounds: Bounds) -> DataFrame:
    """As ``_short_pairs``, where no item is common: the items' own order serves as well as any,
    and the few sets of an item are brought together once and compared where they meet."""
    n = F.size("items").cast("bigint").alias("n")
    placed = arrays.select("set_id", n, "bits", "items", F.posexplode("items").alias("at", "item_id"))
    pos = F.col("at").cast("bigint") + 1
    first = (pos <= bounds.small_prefix(F.col("n"))).alias("first")
    cell = F.struct("set_id", "n", "bits", "items", first).alias("cell")
    cells = placed.where(pos <= bounds.large_prefix(F.col("n"))).select("item_id", cell).repartition("item_id")
    cells = cells.groupBy("item_id").agg(F.collect_list("cell").alias("cells")).where(F.size("cells") > 1)
    small = ["small", "n_small", "bits_small", "items_small"]
    ours = cells.select("item_id", "cells", F.inline("cells")).where("first").drop("first").toDF("item_id", "cells", *small)
    met = ours.select("item_id", *small, F.inline("cells")).drop("first")
    met = met.toDF("item_id", *small, "large", "n_large", "bits_large", "items_large")
    n1, n2 = F.col("n_small"), F.col("n_large")
    return _verified(met.where((n1 < n2) | ((n1 == n2) & (F.col("small") < F.col("large")))), bounds)


def _verified(met: DataFrame, bounds: Bounds) -> DataFrame:
    """Wanted pairs among those whose sets, with their arrays, meet at an item."""
    # Each bit that only one side has is an item that the other lacks: most pairs that share
    # a single item are out before their items are compared.
    both = F.col("bits_small").bitwiseAND(F.col("bits_large"))
    most = F.least(*[F.col(f"n_{side}") - F.bit_count(F.col(f"bits_{side}").bitwiseXOR(both)) for side in ("small", "large")])
    met = met.where(bounds.holds(F.col("n_small"), F.col("n_large"), most))
    # A one-element explode keeps the optimizer from repeating the intersection in
    # every condition that uses it.
    shared = F.explode(F.array(F.struct(F.array_intersect("items_small", "items_large").alias("items"))))
    n1, n2, overlap = F.col("n_small"), F.col("n_large"), F.size("shared.items")
    return (
        met.select("item_id", "small", "large", "n_small", "n_large", shared.alias("shared"))
        .where(F.element_at("shared.items", 1) == F.col("item_id"))
        .where(bounds.holds(n1, n2, overlap))
        .select("small", "large", "n_small", "n_large", overlap.cast("bigint").alias("overlap"))
    )


def _long_pairs(placed: DataFrame, bounds: Bounds, rows_per_tile: int) -> DataFrame:
    """The larger set is long: candidates first, then the items of the smaller set
    are looked up in the larger. The work is the sum of the smaller sizes."""
    small, large = _sides(placed, bounds, rows_per_tile)
    pairs = (
        _meet(small, large.where(F.col("n_large") > SHORT_SET), bounds)
        .select("small", "large", "n_small", "n_large")
        .distinct()
    )
    ours = placed.select(F.col("set_id").alias("small"), "item_id")
    theirs = placed.where(F.col("n") > SHORT_SET).select(F.col("set_id").alias("large"), "item_id")
    return (
        pairs.join(ours, "small")
        .join(theirs, ["large", "item_id"])
        .groupBy("small", "large", "n_small", "n_large")
        .agg(F.count(F.lit(1)).alias("overlap"))
        .where(bounds.holds(F.col("n_small"), F.col("n_large"), F.col("overlap")))
    )


@dataclass(frozen=True)
class Prepared:
    """Sets in the form in which pairs are sought: ``masks`` (set_id, n, mask_0, ..), ``counted``
    (small, large, n_small, n_large, overlap of all pairs of a few sets), ``even`` (arrays whose
    items are none of them common) or ``placed``, with sets longer than ``SHORT_SET`` or without."""

    rows: DataFrame
    form: str = "placed"
    long: bool = True


def _prepare_arrays(sets: ShortSets) -> Prepared:
    """Ranks items only where that spares more than it costs: where a set meets many others."""
    rows, df = sets.spread(), F.col("df").cast("double")
    frequency = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("df"))
    about = frequency.agg(F.sum("df").alias("rows"), F.sum(df * df).alias("met"), F.max("df").alias("most")).first()
    if about["rows"] is not None and about["met"] <= EVEN_MEAN * about["rows"] and about["most"] <= EVEN_MOST:
        return Prepared(sets.rows, "even")
    n = F.size("items").cast("bigint").alias("n")
    long = sets.rows.agg(F.max(n)).first()[0] or 0
    return Prepared(place_items(sets.rows.select("set_id", n, F.explode("items").alias("item_id"))), long=long > SHORT_SET)


def prepare(sets: DataFrame | ShortSets) -> Prepared:
    """Chooses the form by the number of sets and items, which are counted first."""
    if isinstance(sets, ShortSets):
        return _prepare_arrays(sets)
    sets = cut_lineage(sets if "n" in sets.columns else sets.join(sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("n")), "set_id"))
    # No exchange of ids: about so many, and exactly only where that is near a limit.
    about = sets.agg(
        F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("set_id").alias("sets"), F.approx_count_distinct("item_id").alias("items")
    ).first()
    few_items = about["items"] <= 2 * MASK_ITEMS and about["sets"] * 2 >= MASK_SETS
    few_sets = about["sets"] <= 2 * FEW_SETS and about["rows"] >= FEW_ROWS
    if few_items or few_sets:
        known = sets.select("set_id", "n").distinct().agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("rows")).first()
        # Rows that repeat, as those of a set with several names do, keep their places.
        single = known["rows"] == about["rows"]
        if few_items and single and known["sets"] >= MASK_SETS:
            items = sets.select("item_id").distinct()
            n_items = items.count()
            if n_items <= MASK_ITEMS:
                return Prepared(_masks(sets, items, n_items), "masks")
        if few_sets and single and known["sets"] <= FEW_SETS:
            return Prepared(_counted_by_item(sets), "counted")
    return Prepared(place_items(sets))


def _masks(sets: DataFrame, items: DataFrame, n_items: int) -> DataFrame:
    """(set_id, n, mask_0, ..): a set as bits, one for each of the few items."""
    numbered = items.select("item_id", (F.row_number().over(Window.orderBy("item_id")) - 1).alias("bit"))
    words = [
        F.bit_or(F.expr(f"CASE WHEN bit div 64 = {w} THEN shiftleft(1L, bit % 64) ELSE 0L END")).alias(f"mask_{w}")
        for w in range(-(-n_items // 64))
    ]
    return cut_lineage(sets.join(F.broadcast(numbered), "item_id").groupBy("set_id", "n").agg(*words))


def _counted_by_item(sets: DataFrame) -> DataFrame:
    """Overlap of all pairs of a few sets. An item lists the sets that have it, and names each
    pair of them; pairs are counted where they are named, so that little but the rows
    themselves, once, is shuffled."""
    here = sets.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("n", "set_id"))).alias("sets"))
    left = here.where(F.size("sets") > 1).select("sets", F.posexplode("sets").alias("at", "a"))
    rest = F.slice("sets", F.col("at") + 2, F.size("sets"))
    named = left.select(F.col("a.set_id").alias("small"), F.col("a.n").alias("n_small"), F.explode(rest).alias("b"))
    return cut_lineage(
        named.groupBy("small", F.col("b.set_id").alias("large"), "n_small", F.col("b.n").alias("n_large")).agg(F.count(F.lit(1)).alias("overlap"))
    )


def pair_overlap(sets: DataFrame | ShortSets, rows_per_tile: int = ROWS_PER_TILE, **wanted) -> DataFrame:
    """Pairs of distinct sets with overlap, union, Jaccard and both containments.

    ``wanted`` are the fields of ``Bounds``; every pair that meets one of them is
    found. Columns ``set1 < set2``.
    """
    return placed_pairs(prepare(sets), rows_per_tile, **wanted)


def _counted(sets: DataFrame | Prepared, bounds: Bounds, rows_per_tile: int, only: Column | None = None) -> DataFrame:
    prepared = sets if isinstance(sets, Prepared) else Prepared(sets)
    placed = prepared.rows
    if prepared.form == "masks":
        return bitmasks.pairs(placed, _wanted(bounds, only), BLOCK)
    if prepared.form == "even":
        found = _even_pairs(placed, bounds)
    elif prepared.form == "counted":
        found = placed.where(bounds.holds(F.col("n_small"), F.col("n_large"), F.col("overlap")))
    else:
        found = _short_pairs(placed, bounds, rows_per_tile)
        if prepared.long:
            found = found.unionByName(_long_pairs(placed, bounds, rows_per_tile))
    return found if only is None else found.where(only)


def _wanted(bounds: Bounds, only: Column | None = None) -> Column:
    holds = bounds.holds(F.col("n_small"), F.col("n_large"), F.col("overlap"))
    return holds if only is None else holds & only


def first_pairs(placed: DataFrame | Prepared, kinds: Mapping[str, Column], rows_per_tile: int = ROWS_PER_TILE, **wanted) -> DataFrame:
    """(kind, loser, set1, set2, keeper, n1, n2, overlap, jaccard): for each set and kind the
    first of the wanted pairs, by (set1, set2), in which it is the smaller.

    ``kinds`` are conditions on n_small, n_large and overlap. The least pair is taken where pairs
    are found, task by task, so that at most one row per set and task is shuffled: the list of
    pairs, which may be quadratic in the sets that share a rare item, is never written or moved.
    """
    ends = [F.least("small", "large").alias("set1"), F.greatest("small", "large").alias("set2"), "large", "n_small", "n_large", "overlap"]
    if isinstance(placed, Prepared) and placed.form == "masks":
        # Among the pairs of one smaller set the first by (set1, set2) is that of the least larger one.
        named = {kind: _wanted(Bounds(**wanted), condition) for kind, condition in kinds.items()}
        rows = bitmasks.firsts(placed.rows, named, BLOCK).select("small", "kind", *ends)
    else:
        pairs, detail = _counted(placed, Bounds(**wanted), rows_per_tile), F.struct(*ends)
        best = pairs.groupBy("small").agg(*[F.min(F.when(condition, detail)).alias(kind) for kind, condition in kinds.items()])
        named = [F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("d")) for kind in kinds]
        rows = best.select("small", F.explode(F.array(*named)).alias("k")).where("k.d IS NOT NULL").select("small", "k.kind", "k.d.*")
    is_first = F.col("small") == F.col("set1")
    return rows.select(
        "kind",
        F.col("small").alias("loser"),
        "set1",
        "set2",
        F.col("large").alias("keeper"),
        F.when(is_first, F.col("n_small")).otherwise(F.col("n_large")).alias("n1"),
        F.when(is_first, F.col("n_large")).otherwise(F.col("n_small")).alias("n2"),
        "overlap",
        (F.col("overlap") / (F.col("n_small") + F.col("n_large") - F.col("overlap"))).alias("jaccard"),
    )


def placed_pairs(
    placed: DataFrame | Prepared, rows_per_tile: int = ROWS_PER_TILE, only: Column | None = None, **wanted
) -> DataFrame:
    """As ``pair_overlap``, for sets that ``place_items`` or ``prepare`` has already been given.

    ``only`` is a further condition on n_small, n_large and overlap, which stays true where the
    overlap grows. If the sets carry the number of their copies, so do the pairs."""
    counted = _counted(placed, Bounds(**wanted), rows_per_tile, only)
    swap = F.col("small") > F.col("large")
    x = F.col("overlap")
    n1 = F.when(swap, F.col("n_large")).otherwise(F.col("n_small"))
    n2 = F.when(swap, F.col("n_small")).otherwise(F.col("n_large"))
    copies = []
    if "copies_small" in counted.columns:
        small, large = F.col("copies_small"), F.col("copies_large")
        copies = [F.when(swap, large).otherwise(small).alias("copies1"), F.when(swap, small).otherwise(large).alias("copies2")]
    return counted.select(
        F.least("small", "large").alias("set1"),
        F.greatest("small", "large").alias("set2"),
        n1.alias("n1"),
        n2.alias("n2"),
        x.alias("overlap"),
        (n1 + n2 - x).alias("union_size"),
        (x / (n1 + n2 - x)).alias("jaccard"),
        (x / n1).alias("containment1"),
        (x / n2).alias("containment2"),
        *copies,
    )


def carry_copies(prepared: Prepared, groups: DataFrame) -> Prepared:
    """Masks with the number of copies of their sets: their pairs, which may be nearly all, then
    have it without a join. Other forms, whose rows travel, stay as they are."""
    if prepared.form != "masks":
        return prepared
    firsts = groups.where(F.col("set_id") == F.col("first_id")).select("set_id", "copies")
    return replace(prepared, rows=cut_lineage(prepared.rows.join(firsts, "set_id")))


def without_sets(prepared: Prepared, gone: DataFrame) -> Prepared:
    """Masks of the sets that are not in ``gone`` (set_id): those are compared with all others.
    Other forms stay as they are, and their pairs are to be filtered."""
    if prepared.form != "masks":
        return prepared
    return replace(prepared, rows=cut_lineage(prepared.rows.join(gone.select("set_id"), "set_id", "left_anti")))


def first_sets(sets: DataFrame | ShortSets, groups: DataFrame) -> DataFrame | ShortSets:
    """Rows of the first set of each group, with the set size ``n``; or its array, if short."""
    firsts = groups.where(F.col("set_id") == F.col("first_id"))
    if isinstance(sets, ShortSets):
        if "items" in groups.columns:
            return ShortSets(firsts.select("set_id", "items", "bits"))
        sets = sets.spread()
    return sets.join(firsts.select("set_id", F.col("n_items").alias("n")), "set_id")


def with_copies(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    if "copies1" in pairs.columns:
        return pairs
    firsts = groups.where(F.col("set_id") == F.col("first_id"))
    for side in ("1", "2"):
        pairs = pairs.join(
            firsts.select(F.col("set_id").alias(f"set{side}"), F.col("copies").alias(f"copies{side}")),
            f"set{side}",
        )
    return pairs


def _with_names(pairs: DataFrame, names: DataFrame) -> DataFrame:
    for side in ("1", "2"):
        pairs = pairs.join(
            names.select(F.col("set_id").alias(f"set{side}"), F.col("name").alias(f"name{side}")),
            f"set{side}",
            "left",
        )
    return pairs


def _grouped_similarity(
    sets: DataFrame | ShortSets, bound: float, first_by: DataFrame | None = None, **more
) -> tuple[DataFrame, DataFrame]:
    groups = written_groups(sets, first_by)
    pairs = pair_overlap(first_sets(sets, groups), jaccard=bound, **more)
    return groups, with_copies(pairs, groups)


def copy_rows(groups: DataFrame) -> DataFrame:
    """(set1, set2, n_items): each copy against the first of its group."""
    return groups.where(F.col("set_id") != F.col("first_id")).select(
        F.col("first_id").alias("set1"), F.col("set_id").alias("set2"), "n_items"
    )


def _best_first(df: DataFrame, limit: int | None) -> DataFrame:
    """With a limit the best rows in order; a full result is left unsorted, since
    sorting it is one more shuffle that the reader may not need."""
    if limit is None:
        return df
    return df.orderBy(F.desc("similarity"), "set1", "set2").limit(limit)


def similar_collections(
    members: DataFrame, names: DataFrame, threshold: float = 0.3, limit: int | None = None, stored: bool = False
) -> DataFrame:
    """Pairs with Jaccard of at least ``threshold``; with ``limit`` the best of them.
    ``stored`` as in ``written_sets``.

    ``pairs`` is the number of collection pairs a row stands for. Copies appear
    with similarity 1 against the first of their group.
    """
    sets = written_sets(members, "set_id", "item_id", stored=stored)
    groups, pairs = _grouped_similarity(sets, threshold)
    close = pairs.where(F.col("jaccard") >= threshold).select(
        "set1", "set2", F.col("jaccard").alias("similarity"), (F.col("copies1") * F.col("copies2")).alias("pairs")
    )
    same = copy_rows(groups).select(
        "set1", "set2", F.lit(1.0).alias("similarity"), F.lit(1).cast("bigint").alias("pairs")
    )
    return _with_names(_best_first(close.unionByName(same), limit), names)


def neighbours(members: DataFrame, names: DataFrame, set_id, threshold: float = 0.3) -> DataFrame:
    """(set_id, name, overlap, n_items, similarity): the collections at least ``threshold`` like
    the one asked for, without joining any others.

    Its items are looked up among all memberships; what does not share one is never counted.
    A collection without items, or one that does not exist, has no neighbours.
    """
    sets = item_sets(members, "set_id", "item_id")
    own = sets.where(F.col("set_id") == F.lit(set_id)).select("item_id")
    shared = sets.join(own, "item_id", "left_semi").groupBy("set_id").agg(F.count(F.lit(1)).alias("overlap"))
    mine = own.agg(F.count(F.lit(1)).alias("n")).scalar()
    others = shared.where(F.col("set_id") != F.lit(set_id))
    counted = sets.join(others, "set_id", "left_semi").groupBy("set_id").agg(F.count(F.lit(1)).alias("n_items")).join(others, "set_id")
    similarity = F.col("overlap") / (F.col("n_items") + mine - F.col("overlap"))
    near = counted.withColumn("similarity", similarity).where(F.col("similarity") >= threshold)
    return near.join(names.select("set_id", "name"), "set_id", "left").select("set_id", "name", "overlap", "n_items", "similarity")


def merge_candidates(
    members: DataFrame,
    names: DataFrame,
    similarity_threshold: float = 0.5,
    size_threshold: int = 20,
    limit: int | None = None,
) -> DataFrame:
    """Similar pairs of collections with at least ``size_threshold`` items; with
    ``limit`` the best of them by rounded similarity."""
    sets = item_sets(members, "set_id", "item_id")
    large = sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= size_threshold)
    sets = cut_lineage(sets.join(large, "set_id", "left_semi"))
    groups, pairs = _grouped_similarity(sets, similarity_threshold)
    columns = ["set1", "set2", "similarity", "overlap", "unique_tracks", "size1", "size2"]
    close = pairs.where(F.col("jaccard") >= similarity_threshold).select(
        "set1",
        "set2",
        F.col("jaccard").alias("similarity"),
        "overlap",
        F.col("union_size").alias("unique_tracks"),
        F.col("n1").alias("size1"),
        F.col("n2").alias("size2"),
    )
    n = F.col("n_items")
    same = copy_rows(groups).select(
        "set1", "set2", F.lit(1.0), n, n, n, n
    ).toDF(*columns)
    benefit = F.format_string(
        "Would combine %d + %d = %d unique tracks", "size1", "size2", "unique_tracks"
    )
    rounded = close.unionByName(same).withColumn("similarity", F.round("similarity", 2))
    return _with_names(_best_first(rounded, limit), names).withColumn("merge_benefit", benefit)


def duplicate_collections(members: DataFrame, names: DataFrame) -> DataFrame:
    """Non-empty collections with equal item sets; the alphabetically first is kept."""
    sets = item_sets(members, "set_id", "item_id")
    groups = identical_sets(sets, names.withColumnRenamed("name", "preference"))
    return (
        groups.where(F.col("copies") > 1)
        .join(names, "set_id", "left")
        .select(
            "set_id",
            "name",
            F.col("first_id").alias("kept_id"),
            "n_items",
            "copies",
            (F.col("set_id") == F.col("first_id")).alias("keep"),
        )
    )


