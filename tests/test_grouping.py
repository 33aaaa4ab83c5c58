from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from cratebook.operators import grouping
from cratebook.operators.grouping import counted_row_number, exact_medians, numbered, top_per_group, top_rows


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(7)
    # One key holds a third of all rows.
    data = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(20)}", rng.choice([None, rng.randrange(-500, 500)]), rng.random() * 10) for _ in range(3000)]
    return data, spark.createDataFrame(data, "k string, a int, b double").repartition(5).cache()


def expected(data):
    groups = {}
    for k, a, b in data:
        groups.setdefault(k, ([], []))
        if a is not None:
            groups[k][0].append(a)
        groups[k][1].append(b)
    return {k: (statistics.median(a), statistics.median(b)) for k, (a, b) in groups.items()}


def same_medians(rows, data):
    wanted = expected(data)
    assert {r["k"]: r["ma"] for r in rows} == {k: v[0] for k, v in wanted.items()}
    assert {r["k"]: r["mb"] for r in rows} == pytest.approx({k: v[1] for k, v in wanted.items()})


def metrics():
    return {"ma": F.col("a"), "mb": F.col("b")}


@pytest.mark.parametrize(("limit", "bins", "rounds"), [(4096, 65_536, 1), (10, 4, 2), (1, 2, 3), (50, 1000, 1)])
def test_medians_do_not_depend_on_the_steps(numbers, monkeypatch, limit, bins, rounds):
    data, df = numbers
    for name, value in (("SORTED", limit), ("MOST_BINS", bins), ("ROUNDS", rounds)):
        monkeypatch.setattr(grouping, name, value)
    same_medians(exact_medians(df, ["k"], metrics()).collect(), data)


def test_medians_of_extreme_values(spark, monkeypatch):
    monkeypatch.setattr(grouping, "SORTED", 3)
    values = [-1.7e308, 1.7e308, 0.0, 1e-300, -1e-300, 5.0, 5.0, 5.0, 1e100, float("inf"), 2.0]
    rows = [("all", v) for v in values] + [("one", 4.0)] * 9 + [("none", None)]
    got = {r["k"]: r["m"] for r in exact_medians(spark.createDataFrame(rows, "k string, v double"), ["k"], {"m": F.col("v")}).collect()}
    assert got == {"all": statistics.median(values), "one": 4.0, "none": None}


def test_a_hot_group_of_continuous_values_is_narrowed_before_sorting(spark):
    """Of 200,000 different values a bin is sorted; no job runs before the result is asked for."""
    spark.sparkContext.setJobGroup("medians", "planning")
    df = spark.range(200_000, numPartitions=8).select(F.lit("hot").alias("k"), F.rand(3).alias("v"))
    df = df.unionByName(spark.range(100).select(F.lit("small").alias("k"), F.col("id").cast("double").alias("v")))
    counts = grouping.value_counts(df, ["k"], {"v": F.col("v")})
    medians = grouping.metric_figures(counts, ["k"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("medians")
    spark.sparkContext.setJobGroup("medians run", "running")
    sought = grouping._narrowed(counts, ["k"], []).where("metric = 'v' AND k = 'hot'").collect()
    assert len(sought) in (1, 2) and all(r["inside"] <= grouping.SORTED for r in sought)
    values = sorted(r["v"] for r in df.where("k = 'hot'").collect())
    got = {r["k"]: r["median"] for r in medians.collect() if r["metric"] == "v"}
    assert got == {"hot": (values[99_999] + values[100_000]) / 2, "small": 49.5}


def test_top_rows(spark):
    got = top_rows(spark.range(100).selectExpr("id", "id % 7 AS k"), ["k", F.desc("id")], 3).collect()
    assert [(r["id"], r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(98, 1), (91, 2), (84, 3)]


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_counted_row_number_equals_a_sort(numbers, partitions):
    data, df = numbers
    keyed = df.withColumn("id", F.monotonically_increasing_id()).cache()
    got = counted_row_number(
        keyed.repartition(partitions), ["k"], F.floor("b"), ["b", "id"], name="nr"
    ).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r["k"], []).append(r)
    for group in by_key.values():
        ordered = sorted(group, key=lambda r: (r["b"], r["id"]))
        assert [r["nr"] for r in ordered] == list(range(1, len(ordered) + 1))


def test_top_per_group_prunes_before_the_shuffle(numbers):
    _, df = numbers
    plan = top_per_group(df, ["k"], [F.desc("b")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def scans(df, table):
    """How often a table is read in the plan that ran; what is reused is not read again."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return final.count(f"{table}.parquet"), final.count("ReusedExchange")


def test_counted_row_number_reads_its_input_once(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet").select("l_suppkey", "l_partkey", "l_quantity", "l_shipdate")
    got = counted_row_number(lines, ["l_suppkey"], F.floor(F.col("l_partkey") / 10), ["l_partkey", "l_shipdate"], "nr")
    assert scans(got.select("l_suppkey", "l_partkey", "nr"), "lineitem") == (1, 1)


def test_library_reads_order_lines_three_times_at_most(spark, small):
    from cratebook.testbed.queries import QUERIES

    assert scans(QUERIES["library_wide"](spark, small), "lineitem")[0] <= 3
    assert scans(QUERIES["collection_stats"](spark, small), "lineitem")[0] <= 3


@pytest.mark.parametrize("keys", [["k"], []])
def test_numbered_equals_a_sort(numbers, keys):
    data, df = numbers
    got = numbered(df, keys, ["a", "b"]).collect()
    groups = {}
    for r in got:
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    assert len(got) == len(data)
    for rows in groups.values():
        ordered = sorted(rows, key=lambda r: (r["a"] is not None, r["a"] or 0, r["b"]))
        assert [r["position"] for r in ordered] == list(range(len(rows)))
        assert {r["total"] for r in rows} == {len(rows)}


def test_numbered_spreads_equal_rows(spark):
    """One group of equal rows is numbered in several partitions."""
    rows = spark.range(20_000, numPartitions=8).selectExpr("1 AS k", "'x' AS v")
    got = numbered(rows, ["k"], ["v"])
    assert sorted(r[0] for r in got.select("position").collect()) == list(range(20_000))


def test_features_read_the_wide_table_once(spark, small):
    from cratebook.operators import features
    from cratebook.testbed.queries_library import wide_of
    from cratebook.testbed.virtual import AS_OF, VirtualLibrary

    wide = wide_of(VirtualLibrary(spark, small))
    spark.sparkContext.setJobGroup("features", "planning")
    df = features.all_features(wide, AS_OF)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("features")
    spark.sparkContext.setJobGroup("features run", "running")
    # Collections, memberships and credits read order lines once each.
    assert scans(df, "lineitem")[0] <= 3


def test_split_by_size(spark, monkeypatch):
    monkeypatch.setattr(grouping, "WHOLE", 2)
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", 1), ("c", 2), ("c", 3)], "k string, v int")
    few, many = grouping.split_by_size(rows, "k")
    assert sorted(r["k"] for r in few.collect()) == ["a", "b", "b"]
    assert [r["k"] for r in many.collect()] == ["c", "c", "c"]


def test_positions_shuffle_only_what_orders_them(spark, small):
    from cratebook.testbed.virtual import VirtualLibrary

    plan = VirtualLibrary(spark, small).positioned_tracks()._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "l_extendedprice" not in plan.split("Relation")[0]
