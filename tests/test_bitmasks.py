"""Sets of few items as bit masks: what is carried, left out and found first."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cratebook.functions.numbers import rounded
from cratebook.operators import bitmasks, overlap, redundancy


def some_sets(seed, count=300, items=31):
    rng = random.Random(seed)
    return {i: frozenset(rng.sample(range(items), rng.randrange(1, 12))) for i in range(count)}


def found_in(spark, sets):
    rows = [(s, x) for s, items in sets.items() for x in items]
    names = spark.createDataFrame([(i, f"n{i}") for i in sets], "set_id bigint, name string")
    return redundancy.find_redundancy(spark.createDataFrame(rows, "set_id bigint, item_id bigint"), names)


def test_pairs_have_their_copies_without_a_join(spark):
    """The list of pairs may be quadratic: nothing that is made of it is joined or shuffled."""
    sets = some_sets(1)
    sets |= {1000 + i: sets[i] for i in range(0, 300, 3)}
    found = found_in(spark, sets)
    assert found.placed.form == "masks"
    plan = found.pairs._jdf.queryExecution().executedPlan().toString()
    above = plan.split("MapInArrow")[0]
    assert "Join" not in above and "Exchange" not in above
    copies = {}
    for s in sets.values():
        copies[s] = copies.get(s, 0) + 1
    rows = found.pairs.collect()
    assert rows and max(r["copies1"] for r in rows) > 1
    assert all((r["copies1"], r["copies2"]) == (copies[sets[r["set1"]]], copies[sets[r["set2"]]]) for r in rows)


def test_phases_that_walk_do_not_compare_subsets(spark, monkeypatch):
    """Sets that lie in another one are out before high overlap is sought."""
    found, compared = found_in(spark, some_sets(2)), []
    pairs = bitmasks.pairs
    monkeypatch.setattr(bitmasks, "pairs", lambda masks, *more: compared.append(masks.count()) or pairs(masks, *more))
    subsets = redundancy.consolidation_suggestions(found).where("phase = 2").count()
    assert subsets and compared == [found.placed.rows.count() - subsets]


def block(large, number, masks):
    def one_list(values, kind):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))

    n = [int(m).bit_count() for m in masks]
    ids = [number * 100 + i for i in range(len(masks))]
    columns = {"part": pa.array([0]), "large": pa.array([large]), "block": pa.array([number]), "set_id": one_list(ids, pa.int64())}
    columns |= {"n": one_list(n, pa.int16()), "mask_0": one_list(masks, pa.int64())}
    return pa.RecordBatch.from_pydict(columns)


def test_a_set_is_compared_until_it_is_found(monkeypatch):
    counted, shared = [], bitmasks._shared
    monkeypatch.setattr(bitmasks, "_shared", lambda own, ours, words: counted.append(len(ours)) or shared(own, ours, words))
    least = np.full((6, 6), bitmasks.NEVER, np.uint8)
    least[2, 4] = 2
    rows = [block(False, 9, [0b11, 0b101, 0b11000]), block(True, 0, [0b1111]), block(True, 1, [0b1111, 0b11110]), block(True, 2, [0b11110])]
    got = [r for b in bitmasks._finder({"subset": least}, True)(iter(rows)) for r in b.to_pylist()]
    assert [(r["small"], r["large"], r["overlap"]) for r in got] == [(900, 0, 2), (901, 0, 2), (902, 101, 2)]
    assert counted == [3, 1]


def test_a_kind_that_a_larger_overlap_ends_is_refused(spark):
    masks = spark.createDataFrame([(1, 1, 1), (2, 2, 3)], "set_id bigint, n bigint, mask_0 bigint")
    with pytest.raises(ValueError, match="larger overlap"):
        bitmasks.pairs(masks, F.col("overlap") == 1, 10)


def test_no_sets_have_no_pairs(spark):
    masks = spark.createDataFrame([], "set_id bigint, n bigint, mask_0 bigint")
    assert bitmasks.pairs(masks, F.col("overlap") >= 1, 10).count() == 0


def test_rounding_equals_the_exact_one(spark):
    rng = random.Random(4)
    shares = [(x / n,) for n in range(1, 200) for x in range(n + 1)]
    odd = [0.5e-6, 1.5e-6, 1 / 640, 3 / 128, 2.5000005, -1.5e-6, -0.2e-6, 1e300, float("inf"), float("-inf"), 123456789.1234565, None]
    df = spark.createDataFrame(shares + [(x,) for x in odd] + [(rng.random() * 10 ** rng.randrange(-7, 9),) for _ in range(2000)], "v double")
    assert df.where(~rounded("v", 6).eqNullSafe(F.round("v", 6))).collect() == []
