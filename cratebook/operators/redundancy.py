"""Redundancy bands between collections and the consolidation plan built on them."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.functions.names import is_auto_name
from cratebook.operators import overlap
from cratebook.session import cut_lineage

# Band limits and size ratios.
HIGH, NEAR, SIMILAR = 0.7, 0.5, 0.4
CANDIDATE_RATIO, CANDIDATE_SHARE = 3.0, 0.5
MAX_PARTS = 32
# Default of the order in which pairs are visited.
SEED = 42


@dataclass(frozen=True)
class Redundancy:
    """``copies``: (set1 kept, set2 copy, n_items). ``groups``: every set with the first of its
    group. ``placed``: the first sets in the form in which pairs are sought."""

    names: DataFrame
    copies: DataFrame
    groups: DataFrame
    placed: overlap.Prepared

    def similar(self, above: float = SIMILAR, only: Column | None = None) -> DataFrame:
        """Pairs in a band and more than ``above`` alike, which bounds their number; ``only`` those
        that meet a condition on n_small, n_large and overlap."""
        return self._classified(jaccard=above, strict=True, only=only).where(F.col("jaccard") > above)

    def without(self, gone: DataFrame) -> Redundancy:
        """The same, where nothing with an end in ``gone`` (set_id) is wanted."""
        return replace(self, placed=overlap.without_sets(self.placed, gone))

    @property
    def pairs(self) -> DataFrame:
        """Pairs in a band, of a set and one it lies in, and of a small set mostly inside one
        three times its size. For reports: small sets of common items make this list quadratic.
        Nothing else reads it."""
        pairs = self._classified(jaccard=SIMILAR, subsets=True, containment=CANDIDATE_SHARE, size_ratio=CANDIDATE_RATIO, strict=True)
        # The lowest band says all: the bands' own cases would make the loop over pairs too long to be compiled.
        return pairs.where((F.col("jaccard") > SIMILAR) | F.col("is_subset") | F.col("is_candidate"))

    @property
    def targets(self) -> DataFrame:
        """One row per kind and set: ``subset``, its first pair with a larger set that it lies in;
        ``candidate``, with one of three times its size that holds most of it."""
        kinds = {
            "subset": F.col("overlap") == F.col("n_small"),
            "candidate": (F.col("n_large") >= CANDIDATE_RATIO * F.col("n_small")) & (F.col("overlap") / F.col("n_small") > CANDIDATE_SHARE),
        }
        return overlap.first_pairs(self.placed, kinds, subsets=True, containment=CANDIDATE_SHARE, size_ratio=CANDIDATE_RATIO, strict=True)

    def _classified(self, **bounds) -> DataFrame:
        low, high, jaccard = F.least("n1", "n2"), F.greatest("n1", "n2"), F.col("jaccard")
        band = F.when(jaccard > HIGH, "high").when(jaccard > NEAR, "near").when(jaccard > SIMILAR, "similar")
        pairs = overlap.placed_pairs(self.placed, **bounds).withColumns(
            {
                "band": band,
                "is_subset": F.col("overlap") == low,
                "is_candidate": (high >= CANDIDATE_RATIO * low) & (F.col("overlap") / low > CANDIDATE_SHARE),
            }
        )
        return overlap.with_copies(pairs, self.groups)


def comparable(playlists: DataFrame, exclude_auto: bool = True, tag: str = "AJ") -> DataFrame:
    """Owned collections that are neither the liked one nor automatically named."""
    kept = playlists.where(F.col("is_owned") & ~F.col("is_liked_songs"))
    return kept.where(~is_auto_name(F.col("name"), tag)) if exclude_auto else kept


def find_redundancy(members: DataFrame, names: DataFrame, stored: bool = False) -> Redundancy:
    """``members`` (set_id, item_id) of the collections in ``names`` (set_id, name).

    Among identical collections the longest name stays, then the lowest id. ``stored`` as in
    ``overlap.written_sets``.
    """
    sets = overlap.written_sets(members, "set_id", "item_id", only=names, stored=stored)
    longest = names.select("set_id", (-F.length("name")).alias("preference"))
    groups = overlap.written_groups(sets, longest)
    placed = overlap.carry_copies(overlap.prepare(overlap.first_sets(sets, groups)), groups)
    return Redundancy(names, overlap.copy_rows(groups), groups, placed)


def _smaller_first(pairs: DataFrame) -> DataFrame:
    """Adds ``loser`` (the smaller set) and ``keeper``."""
    first_smaller = F.col("n1") < F.col("n2")
    return pairs.withColumns(
        {
            "loser": F.when(first_smaller, F.col("set1")).otherwise(F.col("set2")),
            "keeper": F.when(first_smaller, F.col("set2")).otherwise(F.col("set1")),
        }
    )


def pair_order(seed: int) -> Column:
    """The order in which pairs are visited: a seeded digest of both ids, in hex."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("set1").cast("string"), F.col("set2").cast("string")))


def greedy_removals(pairs: DataFrame, seed: int = SEED) -> DataFrame:
    """Pairs that fire when all are visited in the order of ``pair_order`` and a pair with
    an already removed end is skipped. ``pairs`` carries ``loser`` and ``keeper``.

    Rounds, each a written table: a pair fires as soon as no earlier live pair could remove
    one of its ends. What a pair waits for is a path of ever earlier pairs; in a random order
    such paths are short (their number falls with the factorial of their length), so that
    the rounds grow with the logarithm of the pairs, whatever the pairs look like. A hub that
    keeps many small sets lets all of them go in one round. The first live pair always fires,
    so the loop ends.
    """
    order, columns = "_order", pairs.columns
    pairs = pairs.withColumn(order, pair_order(seed))
    place = F.struct(order, "set1", "set2")
    live = pairs
    fired_parts: list[DataFrame] = []
    while True:
        threat = live.groupBy("loser").agg(F.min(place).alias("first_threat"))
        to_loser = threat.withColumnRenamed("first_threat", "loser_threat")
        to_keeper = threat.select(
            F.col("loser").alias("keeper"), F.col("first_threat").alias("keeper_threat")
        )
        marked = (
            live.join(to_loser, "loser")
            .join(to_keeper, "keeper", "left")
            .withColumn(
                "fires",
                (place == F.col("loser_threat"))
                & (F.col("keeper_threat").isNull() | (place < F.col("keeper_threat"))),
            )
            .select(*pairs.columns, "fires")
        )
        marked = cut_lineage(marked)
        if marked.isEmpty():
            break
        fired = marked.where("fires").drop("fires")
        fired_parts.append(fired)
        if len(fired_parts) == MAX_PARTS:
            # A long chain of rounds must not become one plan of as many branches.
            fired_parts = [cut_lineage(reduce(DataFrame.unionByName, fired_parts))]
        # A removed set is out of all later pairs. Pairs before its removal that would
        # keep it are still open; before its removal it was never threatened.
        gone = fired.select("loser")
        left_at = fired.select(F.col("loser").alias("keeper"), place.alias("removed_at"))
        rest = marked.where(~F.col("fires")).drop("fires")
        live = (
            rest.join(gone, "loser", "left_anti")
            .join(left_at, "keeper", "left")
            .where(F.col("removed_at").isNull() | (place < F.col("removed_at")))
            .select(*pairs.columns)
        )
    return (reduce(DataFrame.unionByName, fired_parts) if fired_parts else marked).select(*columns)


def _one_place(value: Column) -> Column:
    """Text with one decimal; a tie goes to the even digit."""
    return F.format_string("%.1f", F.bround(value, 1))


def _without(pairs: DataFrame, removed: DataFrame, *ends: str) -> DataFrame:
    for end in ends:
        pairs = pairs.join(removed.select(F.col("loser").alias(end)), end, "left_anti")
    return pairs


def consolidation_suggestions(found: Redundancy, seed: int = SEED) -> DataFrame:
    """(phase, action, set_id, name, target_id, target_name, reason, tracks_lost).

    Phases in order: exact copies, subsets, high overlap, near duplicates, small
    collections mostly inside a larger one. A collection is suggested once. Pairs of the
    phases that walk (high overlap, near duplicates) are visited in a seeded order.

    Subsets and small collections name one target each, which is chosen where their pairs are
    found. Only those pairs are written that one of the phases that walk may visit: subsets are
    out of both, high overlap asks for more than ``HIGH``, near duplicates for twice the size.
    """
    copies = found.copies
    columns = ["loser", "set1", "set2", "keeper", "n1", "n2", "overlap", "jaccard"]

    targets = cut_lineage(found.targets)
    subsets = targets.where(F.col("kind") == "subset").select(*columns)
    n1, n2, x = F.col("n_small"), F.col("n_large"), F.col("overlap")
    visited = (x / (n1 + n2 - x) > HIGH) | (n2 >= 2 * n1)
    pairs = cut_lineage(found.without(subsets.select(F.col("loser").alias("set_id"))).similar(NEAR, visited))
    smaller = _smaller_first(pairs)

    tie_removes_first = pairs.where(F.col("band") == "high").withColumns(
        {
            "loser": F.when(F.col("n1") > F.col("n2"), F.col("set2")).otherwise(F.col("set1")),
            "keeper": F.when(F.col("n1") > F.col("n2"), F.col("set1")).otherwise(F.col("set2")),
        }
    )
    high = greedy_removals(
        _without(tie_removes_first, subsets, "set1", "set2").select(*columns), seed
    )
    gone = subsets.unionByName(high)

    share = F.col("overlap") / F.least("n1", "n2")
    lopsided = (F.greatest("n1", "n2") >= 2 * F.least("n1", "n2")) & (share > 0.5)
    near_pairs = _without(smaller.where((F.col("band") == "near") & lopsided), gone, "set1", "set2")
    near = greedy_removals(near_pairs.select(*columns), seed)
    gone = gone.unionByName(near)
    small = _without(targets.where(F.col("kind") == "candidate"), gone, "loser").select(*columns)

    def phase(df: DataFrame, number: int, action: str, reason: Column, lost: Column) -> DataFrame:
        return df.select(
            F.lit(number).alias("phase"),
            F.lit(action).alias("action"),
            F.col("loser").alias("set_id"),
            F.col("keeper").alias("target_id"),
            reason.alias("reason_head"),
            lost.cast("bigint").alias("tracks_lost"),
            F.greatest("n1", "n2").alias("larger"),
        )

    loser_n = F.when(F.col("loser") == F.col("set1"), F.col("n1")).otherwise(F.col("n2"))
    missing = loser_n - F.col("overlap")
    percent = _one_place(F.col("overlap") / loser_n * 100)
    alike = _one_place(F.col("jaccard") * 100)
    exact = copies.select(
        F.lit(1).alias("phase"),
        F.lit("delete").alias("action"),
        F.col("set2").alias("set_id"),
        F.col("set1").alias("target_id"),
        F.lit("Exact duplicate of ").alias("reason_head"),
        F.lit(0).cast("bigint").alias("tracks_lost"),
        F.col("n_items").alias("larger"),
    )
    parts = [
        phase(subsets, 2, "delete", F.concat(F.lit("All "), loser_n.cast("string"), F.lit(" tracks are in ")), F.lit(0)),
        phase(high, 3, "merge", F.concat(alike, F.lit("% similar, "), percent, F.lit("% of tracks already in ")), missing),
        phase(near, 4, "merge", F.concat(alike, F.lit("% similar, "), percent, F.lit("% overlap with larger ")), missing),
        phase(
            small,
            5,
            "merge",
            F.concat(
                F.lit("Small playlist ("), loser_n.cast("string"), F.lit(" tracks) with "), percent,
                F.lit("% overlap in larger "),
            ),
            missing,
        ),
    ]
    result = exact
    for part in parts:
        result = result.unionByName(part)
    named = result.join(found.names.select("set_id", "name"), "set_id", "left").join(
        found.names.select(F.col("set_id").alias("target_id"), F.col("name").alias("target_name")),
        "target_id",
        "left",
    )
    tail = F.when(
        F.col("phase").isin(2, 5), F.concat(F.lit(" ("), F.col("larger").cast("string"), F.lit(" tracks)"))
    ).otherwise("")
    reason = F.concat(F.col("reason_head"), F.lit('"'), F.col("target_name"), F.lit('"'), tail)
    also = named.select(F.col("set_id").alias("target_id")).distinct().withColumn("hit", F.lit(True))
    return named.join(also, "target_id", "left").select(
        "phase",
        "action",
        "set_id",
        "name",
        "target_id",
        "target_name",
        reason.alias("reason"),
        "tracks_lost",
        F.coalesce("hit", F.lit(False)).alias("target_also_removed"),
    )


def consolidation_strategies(found: Redundancy, suggestions: DataFrame) -> DataFrame:
    """What to do with similar pairs whose ends are both still there."""
    gone = suggestions.select(F.col("set_id").alias("loser")).distinct()
    pairs = _without(found.similar().where(F.col("band") == "similar"), gone, "set1", "set2")
    for side in ("1", "2"):
        pairs = pairs.join(
            found.names.select(F.col("set_id").alias(f"set{side}"), F.col("name").alias(f"name{side}")),
            f"set{side}",
            "left",
        )
    n1, n2, x = F.col("n1"), F.col("n2"), F.col("overlap")
    c1, c2 = F.col("containment1"), F.col("containment2")
    into_second = (n2 >= 2 * n1) & (c1 > 0.6)
    into_first = (n1 >= 2 * n2) & (c2 > 0.6)
    combine = (F.abs(n1 - n2) / F.greatest(n1, n2) < 0.3) & (F.col("jaccard") > 0.45)

    def by_case(second, first, both, other) -> Column:
        return F.when(into_second, second).when(into_first, first).when(combine, both).otherwise(other)

    def sure(share: Column) -> Column:
        return F.when(share > 0.7, "High").otherwise("Medium")

    def said(text: str, a: str, b: str) -> Column:
        return F.format_string(text, a, b)

    merge_text = "Merge '%s' into '%s'"
    return pairs.select(
        "set1",
        "set2",
        "name1",
        "name2",
        "n1",
        "n2",
        "jaccard",
        (n1 - x).alias("missing_1_to_2"),
        (n2 - x).alias("missing_2_to_1"),
        by_case(F.lit("merge_into_larger"), F.lit("merge_into_larger"), F.lit("combine"), F.lit("review")).alias(
            "strategy"
        ),
        by_case(
            said(merge_text, "name1", "name2"),
            said(merge_text, "name2", "name1"),
            said("Create combined playlist with tracks from both '%s' and '%s'", "name1", "name2"),
            said("Review for potential consolidation: '%s' and '%s'", "name1", "name2"),
        ).alias("recommended_action"),
        by_case(n1 - x, n2 - x, n1 + n2 - 2 * x, F.least(n1 - x, n2 - x)).alias("tracks_to_add"),
        by_case(F.lit(None), F.lit(None), n1 + n2 - x, F.lit(None)).cast("bigint").alias("unique_combined"),
        by_case(sure(c1), sure(c2), F.lit("Medium"), F.lit("Low")).alias("confidence"),
    )
