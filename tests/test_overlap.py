"""The set-similarity join against brute force over all pairs."""

from __future__ import annotations

import hashlib
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cratebook.operators import overlap, redundancy


def make_sets(seed: int, count: int = 60) -> dict[int, frozenset[int]]:
    rng = random.Random(seed)
    sets = {}
    for i in range(count):
        kind = rng.random()
        if kind < 0.2 and sets:
            sets[i] = rng.choice(list(sets.values()))  # an exact copy
        elif kind < 0.5 and sets:
            base = set(rng.choice(list(sets.values())))
            base ^= set(rng.sample(range(40), rng.randrange(1, 4)))
            sets[i] = frozenset(base) or frozenset([0])
        else:
            # Item 0 is in most sets.
            size = rng.choice([1, 2, 3, 5, 9, 15, 30])
            sets[i] = frozenset(rng.sample(range(40), size)) | (frozenset([0]) if rng.random() < 0.7 else frozenset())
    return sets


def frame(spark, sets):
    rows = [(s, x) for s, items in sets.items() for x in items]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "set_id bigint, item_id bigint").repartition(5)


def naming(spark, sets):
    return spark.createDataFrame([(i, "n" * (1 + i * 7 % 5)) for i in sets], "set_id bigint, name string")


def brute(sets, wanted):
    found = {}
    for a, b in combinations(sorted(sets), 2):
        x = len(sets[a] & sets[b])
        if x and wanted(len(sets[a]), len(sets[b]), x):
            found[(a, b)] = x
    return found


def distinct_sets(sets):
    firsts = {}
    for i in sorted(sets):
        firsts.setdefault(sets[i], i)
    return {i: s for s, i in firsts.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("bound", [0.2, 0.4, 0.5, 0.7, 1.0])
def test_jaccard_pairs_are_complete(spark, seed, bound):
    sets = distinct_sets(make_sets(seed))
    got = overlap.pair_overlap(frame(spark, sets), jaccard=bound).where(F.col("jaccard") >= bound)
    assert {(r["set1"], r["set2"]): r["overlap"] for r in got.collect()} == brute(
        sets, lambda n, m, x: x / (n + m - x) >= bound
    )


@pytest.mark.parametrize("short", [0, 4, 64])
@pytest.mark.parametrize("tile", [1, 3, 1000])
def test_all_bounds_with_any_tiling(spark, monkeypatch, short, tile):
    monkeypatch.setattr(overlap, "SHORT_SET", short)
    sets = distinct_sets(make_sets(9, 80))
    got = overlap.pair_overlap(
        frame(spark, sets), rows_per_tile=tile, jaccard=0.4, subsets=True, containment=0.5, size_ratio=3.0
    )
    rows = got.collect()
    assert len({(r["set1"], r["set2"]) for r in rows}) == len(rows)
    assert {(r["set1"], r["set2"]): r["overlap"] for r in rows} == brute(
        sets,
        lambda n, m, x: x / (n + m - x) >= 0.4
        or x == min(n, m)
        or (max(n, m) >= 3 * min(n, m) and x / min(n, m) >= 0.5),
    )


@pytest.mark.parametrize("limit", [1, 5, 1000])
def test_positions_do_not_depend_on_the_group_limit(spark, limit):
    sets = make_sets(4)
    placed = overlap.place_items(frame(spark, sets), group_limit=limit).collect()
    by_set = {}
    for r in placed:
        by_set.setdefault(r["set_id"], []).append(r)
    for i, rows in by_set.items():
        assert sorted(r["pos"] for r in rows) == list(range(1, len(sets[i]) + 1))
        by_pos = [r["df"] for r in sorted(rows, key=lambda r: r["pos"])]
        assert by_pos == sorted(by_pos)


def test_identical_sets(spark):
    sets = make_sets(5)
    got = overlap.identical_sets(frame(spark, sets)).collect()
    for r in got:
        same = [i for i in sets if sets[i] == sets[r["set_id"]]]
        assert (r["first_id"], r["copies"], r["n_items"]) == (min(same), len(same), len(sets[r["set_id"]]))


def test_copies_are_listed_once(spark):
    """A group of equal collections gives one row per copy, not one per pair."""
    sets = {i: frozenset([1, 2, 3]) for i in range(50)} | {99: frozenset([1, 2, 3, 4])}
    rows = overlap.similar_collections(frame(spark, sets), naming(spark, sets), 0.5).collect()
    assert len(rows) == 49 + 1
    assert sum(r["pairs"] for r in rows if r["similarity"] < 1) == 50


def test_a_bound_is_required(spark):
    with pytest.raises(ValueError):
        overlap.Bounds()
    with pytest.raises(ValueError):
        overlap.Bounds(jaccard=0.0)


def test_thresholds_are_inclusive_or_strict(spark):
    # Jaccard exactly 0.4, 0.5 and 0.7; size ratio exactly 3.
    sets = {
        1: frozenset(range(7)), 2: frozenset([0, 1, 2, 3, 20, 21, 22]),
        3: frozenset(range(100, 106)), 4: frozenset([100, 101, 102, 103, 120, 121]),
        5: frozenset(range(200, 217)), 6: frozenset(list(range(200, 214)) + [230, 231, 232]),
        7: frozenset([300, 301, 302]), 8: frozenset([300, 301] + list(range(310, 317))),
    }
    found = redundancy.find_redundancy(frame(spark, sets), naming(spark, sets)).pairs.collect()
    assert {(r["set1"], r["set2"]): (r["band"], r["is_candidate"]) for r in found} == {
        (3, 4): ("similar", False),
        (5, 6): ("near", False),
        (7, 8): (None, True),
    }
    close = overlap.similar_collections(frame(spark, sets), naming(spark, sets), 0.5).collect()
    assert {(r["set1"], r["set2"]) for r in close} == {(3, 4), (5, 6)}


def visited(pairs, seed=redundancy.SEED):
    """Pairs (set1, set2, ...) in the order of the greedy pass."""
    return sorted(pairs, key=lambda p: hashlib.md5(f"{seed}:{p[0]}:{p[1]}".encode()).hexdigest())


def sequential_plan(sets, names):
    """The removals of the ordered pass over all pairs, in plain Python."""
    groups = {}
    for i in sorted(sets):
        groups.setdefault(sets[i], []).append(i)
    gone, plan = set(), {}
    for same in groups.values():
        keep = min(same, key=lambda i: (-len(names[i]), i))
        for i in same:
            if i != keep:
                gone.add(i)
                plan[i] = (1, keep)
    kept = [i for i in sorted(sets) if i not in gone]
    pairs = []
    for a, b in combinations(kept, 2):
        x = len(sets[a] & sets[b])
        if x:
            pairs.append((a, b, len(sets[a]), len(sets[b]), x))
    for a, b, n, m, x in pairs:
        small, large = (a, b) if n < m else (b, a)
        if x == min(n, m) and small not in gone:
            gone.add(small)
            plan[small] = (2, large)
    for a, b, n, m, x in visited(pairs):
        if x / (n + m - x) > 0.7 and a not in gone and b not in gone:
            keep, drop = (a, b) if n > m else (b, a)
            gone.add(drop)
            plan[drop] = (3, keep)
    for a, b, n, m, x in pairs:
        small, large = (a, b) if n < m else (b, a)
        if max(n, m) >= 3 * min(n, m) and x / min(n, m) > 0.5 and small not in gone:
            gone.add(small)
            plan[small] = (5, large)
    return plan


@pytest.mark.parametrize("seed", range(4))
def test_consolidation_equals_the_sequential_pass(spark, seed):
    sets = make_sets(20 + seed, 70)
    names = {r["set_id"]: r["name"] for r in naming(spark, sets).collect()}
    found = redundancy.find_redundancy(frame(spark, sets), naming(spark, sets))
    rows = redundancy.consolidation_suggestions(found).collect()
    assert {r["set_id"]: (r["phase"], r["target_id"]) for r in rows} == sequential_plan(sets, names)
    assert len(rows) == len({r["set_id"] for r in rows})
    removed = {r["set_id"] for r in rows}
    assert all(r["target_also_removed"] == (r["target_id"] in removed) for r in rows)
    lost = {r["set_id"]: len(sets[r["set_id"]] - sets[r["target_id"]]) for r in rows}
    assert {r["set_id"]: r["tracks_lost"] for r in rows} == lost


@pytest.mark.parametrize("seed", range(6))
def test_greedy_rounds_equal_the_ordered_walk(spark, seed):
    rng = random.Random(seed)
    edges = sorted({tuple(sorted(rng.sample(range(25), 2))) for _ in range(60)})
    rows = [(a, b, *((a, b) if rng.random() < 0.5 else (b, a))) for a, b in edges]
    gone, expected = set(), set()
    for a, b, loser, _ in visited(rows):
        if a not in gone and b not in gone:
            gone.add(loser)
            expected.add((a, b, loser))
    df = spark.createDataFrame(rows, "set1 bigint, set2 bigint, loser bigint, keeper bigint")
    got = redundancy.greedy_removals(df).collect()
    assert {(r["set1"], r["set2"], r["loser"]) for r in got} == expected


def test_a_hub_is_cleared_in_one_round(spark, monkeypatch):
    rounds = []
    cut = redundancy.cut_lineage
    monkeypatch.setattr(redundancy, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    rows = [(0, i, i, 0) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "set1 bigint, set2 bigint, loser bigint, keeper bigint")
    assert redundancy.greedy_removals(df).count() == 199
    assert len(rounds) == 2


def test_strategies(spark):
    def run(lo, hi):
        return frozenset(range(lo, hi))

    sets = {
        1: run(0, 9), 2: run(0, 8) | run(50, 60),  # 8 of 9 in a set of 18: into the larger
        3: run(100, 110), 4: run(104, 114) | run(200, 201),  # 6 / 15 is too little
        5: run(300, 311), 6: run(304, 315),  # 7 / 15: combine
        7: run(400, 410), 8: run(404, 413) | run(450, 451),  # 6 / 14: review
    }
    found = redundancy.find_redundancy(frame(spark, sets), naming(spark, sets))
    got = redundancy.consolidation_strategies(found, redundancy.consolidation_suggestions(found)).collect()
    assert {(r["set1"], r["set2"]): (r["strategy"], r["tracks_to_add"], r["unique_combined"], r["confidence"]) for r in got} == {
        (1, 2): ("merge_into_larger", 1, None, "High"),
        (5, 6): ("combine", 8, 15, "Medium"),
        (7, 8): ("review", 4, None, "Low"),
    }


def test_no_cartesian_product(spark):
    sets = distinct_sets(make_sets(1))
    plan = overlap.pair_overlap(frame(spark, sets), jaccard=0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("bound", [1 / 3, 0.333333, 0.4, 0.5, 2 / 3])
@pytest.mark.parametrize("strict", [False, True])
def test_bounds_that_are_met_exactly(spark, bound, strict):
    sets = distinct_sets(make_sets(11, 90))
    got = overlap.pair_overlap(frame(spark, sets), jaccard=bound, strict=strict)
    got = got.where(F.col("jaccard") > bound) if strict else got.where(F.col("jaccard") >= bound)
    assert {(r["set1"], r["set2"]): r["overlap"] for r in got.collect()} == brute(
        sets, lambda n, m, x: x / (n + m - x) > bound if strict else x / (n + m - x) >= bound
    )


def test_a_common_item_stays_out_of_the_prefix(spark):
    """Sets that share only one very common item are never compared."""
    sets = {i: frozenset([0, 1000 + i]) for i in range(1, 300)}
    placed = overlap.place_items(frame(spark, sets))
    bounds = overlap.Bounds(jaccard=0.4, subsets=True, containment=0.5, size_ratio=3.0, strict=True)
    small, large = overlap._sides(placed, bounds, 50)
    assert small.where("item_id = 0").count() == 0
    assert overlap._meet(small, large, bounds).count() == 0


def test_rounds_are_compacted(spark, monkeypatch):
    monkeypatch.setattr(redundancy, "MAX_PARTS", 2)
    rows = [(i, i + 1, i + 1, i) for i in range(60)]
    gone, expected = set(), set()
    for a, b, loser, _ in visited(rows):
        if a not in gone and b not in gone:
            gone.add(loser)
            expected.add((a, b))
    df = spark.createDataFrame(rows, "set1 bigint, set2 bigint, loser bigint, keeper bigint")
    assert {(r["set1"], r["set2"]) for r in redundancy.greedy_removals(df).collect()} == expected


@pytest.mark.parametrize("seed", [42, 7])
@pytest.mark.parametrize("rising", [True, False], ids=["rising", "falling"])
def test_a_long_chain_takes_few_rounds(spark, monkeypatch, rising, seed):
    """2,000 pairs, each sharing an end with the next: rounds follow the logarithm."""
    rounds = []
    cut = redundancy.cut_lineage
    monkeypatch.setattr(redundancy, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    rows = [(i, i + 1, *((i + 1, i) if rising else (i, i + 1))) for i in range(2000)]
    gone, expected = set(), set()
    for a, b, loser, _ in visited(rows, seed):
        if a not in gone and b not in gone:
            gone.add(loser)
            expected.add((a, b))
    df = spark.createDataFrame(rows, "set1 bigint, set2 bigint, loser bigint, keeper bigint")
    got = redundancy.greedy_removals(df, seed)
    assert {(r["set1"], r["set2"]) for r in got.collect()} == expected
    assert len(rounds) < 40


@pytest.mark.parametrize("short", [0, 64])
def test_first_pair_of_each_smaller_set(spark, monkeypatch, short):
    monkeypatch.setattr(overlap, "SHORT_SET", short)
    sets = distinct_sets(make_sets(13, 90))
    placed = overlap.place_items(frame(spark, sets))
    got = overlap.first_pairs(placed, {"subset": F.col("overlap") == F.col("n_small")}, subsets=True).collect()
    want = {}
    for (a, b), x in sorted(brute(sets, lambda n, m, x: x == min(n, m)).items()):
        small, large = (a, b) if len(sets[a]) < len(sets[b]) else (b, a)
        want.setdefault(small, (a, b, large, len(sets[a]), len(sets[b]), x))
    assert {r["loser"]: (r["set1"], r["set2"], r["keeper"], r["n1"], r["n2"], r["overlap"]) for r in got} == want


def test_the_first_pair_is_taken_before_the_shuffle(spark):
    """Between the join that finds pairs and the first exchange above it stands an aggregate."""
    placed = overlap.place_items(frame(spark, distinct_sets(make_sets(2))))
    plan = overlap.first_pairs(placed, {"any": F.lit(True)}, subsets=True)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Join")[0]
    assert above.count("partial_min") == 1 and above.index("Exchange") < above.index("partial_min")
    assert "Exchange" not in above[above.index("partial_min") :]


def test_suggestions_do_not_read_the_list_of_all_pairs(spark, monkeypatch):
    sets = make_sets(3)
    found = redundancy.find_redundancy(frame(spark, sets), naming(spark, sets))
    monkeypatch.setattr(redundancy.Redundancy, "pairs", property(lambda self: pytest.fail("list of all pairs read")))
    assert redundancy.consolidation_suggestions(found).count() > 0


@pytest.mark.parametrize("seed", [5, 6])
def test_equal_digests_do_not_make_copies(spark, monkeypatch, seed):
    """With digests that tell nothing but the size, copies are still the equal sets only."""
    signatures = overlap.signatures
    blind = {c: F.lit(0).cast("bigint") for c in overlap.SIGNATURE[1:]}
    monkeypatch.setattr(overlap, "signatures", lambda sets: signatures(sets).withColumns(blind))
    sets = {i: s for i, s in make_sets(seed, 30).items()}
    for r in overlap.identical_sets(frame(spark, sets)).collect():
        same = [i for i in sets if sets[i] == sets[r["set_id"]]]
        assert (r["first_id"], r["copies"]) == (min(same), len(same))
    different = {1: frozenset([1, 2]), 2: frozenset([3, 4])}
    assert overlap.duplicate_collections(frame(spark, different), naming(spark, different)).count() == 0


def test_neighbours_equal_brute_force(spark):
    sets = make_sets(21, 60)
    for one in (0, 7, 59):
        got = overlap.neighbours(frame(spark, sets), naming(spark, sets), one, 0.25).collect()
        want = {i: len(s & sets[one]) / len(s | sets[one]) for i, s in sets.items() if i != one}
        assert {r["set_id"]: r["similarity"] for r in got} == pytest.approx({i: x for i, x in want.items() if x >= 0.25})
    assert overlap.neighbours(frame(spark, sets), naming(spark, sets), 1000).count() == 0


@pytest.fixture(params=["masks", "counted"])
def form(request, monkeypatch):
    """Forms that are otherwise chosen for many rows, with blocks of a few sets."""
    monkeypatch.setattr(overlap, "BLOCK", 4)
    monkeypatch.setattr(overlap, "MASK_SETS", 1 if request.param == "masks" else 10**9)
    monkeypatch.setattr(overlap, "FEW_ROWS", 1)
    return request.param


@pytest.mark.parametrize("spread", [1, 3])
def test_masks_and_counted_items_find_the_same_pairs(spark, form, spread):
    """Items on both sides of a word's end, also the one whose bit is the sign."""
    sets = {i: frozenset(x * spread for x in s) for i, s in distinct_sets(make_sets(9, 80)).items()}
    sets[-5] = frozenset(range(128 if spread == 3 else 64))
    prepared = overlap.prepare(frame(spark, sets))
    assert prepared.form == form
    rows = overlap.placed_pairs(prepared, jaccard=0.4, subsets=True, containment=0.5, size_ratio=3.0).collect()
    assert len({(r["set1"], r["set2"]) for r in rows}) == len(rows)
    want = brute(sets, lambda n, m, x: x / (n + m - x) >= 0.4 or x == min(n, m) or (max(n, m) >= 3 * min(n, m) and x / min(n, m) >= 0.5))
    assert {(r["set1"], r["set2"]): r["overlap"] for r in rows} == want
    assert {(r["set1"], r["set2"]): (r["n1"], r["n2"]) for r in rows} == {p: (len(sets[p[0]]), len(sets[p[1]])) for p in want}


@pytest.mark.parametrize("strict", [False, True])
def test_forms_meet_bounds_exactly(spark, form, strict):
    sets = distinct_sets(make_sets(11, 90))
    got = overlap.pair_overlap(frame(spark, sets), jaccard=0.4, strict=strict)
    got = got.where(F.col("jaccard") > 0.4) if strict else got
    want = brute(sets, lambda n, m, x: x / (n + m - x) > 0.4 if strict else x / (n + m - x) >= 0.4)
    assert {(r["set1"], r["set2"]): r["overlap"] for r in got.collect()} == want


def test_forms_make_the_same_plan(spark, form):
    sets = make_sets(22, 70)
    names = {r["set_id"]: r["name"] for r in naming(spark, sets).collect()}
    found = redundancy.find_redundancy(frame(spark, sets), naming(spark, sets))
    assert found.placed.form == form
    rows = redundancy.consolidation_suggestions(found).collect()
    assert {r["set_id"]: (r["phase"], r["target_id"]) for r in rows} == sequential_plan(sets, names)
    lost = {r["set_id"]: len(sets[r["set_id"]] - sets[r["target_id"]]) for r in rows}
    assert {r["set_id"]: r["tracks_lost"] for r in rows} == lost


def test_many_sets_of_few_items_are_compared_in_many_tasks(spark):
    """Sets that all share the hours of a day: the pairs of an item were once one task's."""
    rng = random.Random(3)
    sets = distinct_sets({i: frozenset(rng.sample(range(24), rng.randrange(16, 24))) for i in range(400)})
    prepared = overlap.prepare(frame(spark, sets))
    assert prepared.form == "masks"
    pairs = overlap.placed_pairs(prepared, jaccard=0.5)
    assert len(set(r["p"] for r in pairs.select(F.spark_partition_id().alias("p")).distinct().collect())) > 4
    assert pairs.count() == len(brute(sets, lambda n, m, x: x / (n + m - x) >= 0.5))


def test_rows_that_repeat_keep_their_places(spark, form):
    sets = frame(spark, distinct_sets(make_sets(9, 20)))
    assert overlap.prepare(sets).form == form
    sized = sets.join(sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("n")), "set_id")
    assert overlap.prepare(sized.unionByName(sized.where("set_id = 0"))).form == "placed"


def blocks_of_sets(seed, blocks=10, count=40):
    """Many items, each in the sets of one block only."""
    sets = {}
    for b in range(blocks):
        sets |= {b * count + i: frozenset(b * 1000 + x for x in s) for i, s in make_sets(seed + b, count).items()}
    return sets


def even(spark, sets, **more):
    written = overlap.written_sets(frame(spark, sets), "set_id", "item_id", **more)
    return overlap.first_sets(written, overlap.identical_sets(written))


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_short_sets_without_common_items_meet_once(spark, stored, strict):
    sets = blocks_of_sets(40)
    rows = frame(spark, sets).unionByName(frame(spark, {i: s for i, s in sets.items() if i % 3 == 0}))
    written = overlap.written_sets(rows, "set_id", "item_id", stored=stored)
    prepared = overlap.prepare(overlap.first_sets(written, overlap.identical_sets(written)))
    assert prepared.form == "even"
    pairs = overlap.placed_pairs(prepared, jaccard=0.4, strict=strict)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    firsts = distinct_sets(sets)
    want = brute(firsts, lambda n, m, x: x / (n + m - x) > 0.4 if strict else x / (n + m - x) >= 0.4)
    pairs = pairs.where(F.col("jaccard") > 0.4) if strict else pairs
    assert sorted((r["set1"], r["set2"], r["overlap"]) for r in pairs.collect()) == sorted((a, b, x) for (a, b), x in want.items())


@pytest.mark.parametrize("wanted", [{"subsets": True}, {"containment": 0.5, "size_ratio": 3.0}, {"jaccard": 0.4, "subsets": True, "containment": 0.5, "size_ratio": 3.0}])
def test_even_sets_meet_every_bound(spark, wanted):
    sets = blocks_of_sets(60)
    sets[-1] = frozenset(range(300))  # longer than the bits tell apart
    rows = overlap.pair_overlap(even(spark, sets, stored=True), **wanted).collect()

    def holds(n, m, x):
        low, high = min(n, m), max(n, m)
        ways = ["jaccard" in wanted and x / (n + m - x) >= 0.4, "subsets" in wanted and x == low]
        return any(ways) or ("containment" in wanted and high >= 3 * low and x / low >= 0.5)

    assert sorted((r["set1"], r["set2"], r["overlap"]) for r in rows) == sorted((a, b, x) for (a, b), x in brute(distinct_sets(sets), holds).items())


def test_copies_of_short_sets(spark):
    sets = blocks_of_sets(80)
    written = overlap.written_sets(frame(spark, sets), "set_id", "item_id", stored=True)
    names = naming(spark, sets).withColumn("preference", -F.length("name"))
    for first_by in (None, names, names.where("set_id % 5 > 0"), names.unionByName(names.where("set_id = 3"))):
        columns = ["set_id", "first_id", "n_items", "copies"]
        got = overlap.written_groups(written, first_by).select(*columns)
        want = overlap.identical_sets(frame(spark, sets), first_by).select(*columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_short_sets_make_the_same_plan(spark):
    sets = blocks_of_sets(100, blocks=8)
    names = {r["set_id"]: r["name"] for r in naming(spark, sets).collect()}
    found = redundancy.find_redundancy(frame(spark, sets), naming(spark, sets), stored=True)
    assert found.placed.form == "even"
    rows = redundancy.consolidation_suggestions(found).collect()
    assert {r["set_id"]: (r["phase"], r["target_id"]) for r in rows} == sequential_plan(sets, names)
    known = naming(spark, {i: s for i, s in sets.items() if i % 2})
    assert overlap.written_sets(frame(spark, sets), "set_id", "item_id", only=known, stored=True).rows.where("set_id % 2 = 0").isEmpty()


def test_common_items_and_long_sets_keep_their_form(spark, monkeypatch):
    monkeypatch.setattr(overlap, "EVEN_MOST", 128)
    sets = blocks_of_sets(120)
    common = {i: s | {-1} for i, s in sets.items()}
    written = overlap.written_sets(frame(spark, common), "set_id", "item_id")
    prepared = overlap.prepare(overlap.first_sets(written, overlap.identical_sets(written)))
    assert isinstance(written, overlap.ShortSets) and prepared.form == "placed" and not prepared.long
    want = brute(distinct_sets(common), lambda n, m, x: x / (n + m - x) >= 0.5)
    got = overlap.placed_pairs(prepared, jaccard=0.5).collect()
    assert sorted((r["set1"], r["set2"], r["overlap"]) for r in got) == sorted((a, b, x) for (a, b), x in want.items())
    longer = {**sets, -1: frozenset(range(1100))}
    for stored in (False, True):
        written = overlap.written_sets(frame(spark, longer), "set_id", "item_id", stored=stored)
        assert sorted(map(tuple, written.select("set_id", "item_id").collect())) == sorted((i, x) for i, s in longer.items() for x in s)
