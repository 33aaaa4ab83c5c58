"""Ranks, medians and shares inside a group that may hold a third of all rows.

A plain window sorts a whole group in one task. These helpers first count rows
per *step* (a coarse bucket of the sort key with a bounded number of values per
group), turn the counts into offsets, and sort only inside a step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from cratebook.session import cut_lineage


def counted_row_number(
    df: DataFrame,
    keys: Sequence[str],
    step: Column,
    order: Sequence[str | Column],
    name: str = "row_number",
) -> DataFrame:
    """1-based row number per ``keys`` in the order (``step``, *``order``).

    ``step`` must be non-null and must not disagree with the wanted order:
    sorting by (step, *order) is the ranking. Keys must be non-null. Rows that are
    equal in ``order`` are ranked by the remaining columns.

    The input is evaluated once: rows and counts per step come from one exchange by
    keys and step. Both read all columns of it (the remaining columns end the order),
    so that Spark finds the exchange equal and reuses it.
    """
    named = [c for c in order if isinstance(c, str)]
    rest = [f.name for f in df.schema if f.name not in {*keys, *named} and not isinstance(f.dataType, MapType)]
    inside = Window.partitionBy(*keys, "_step").orderBy(*order, *rest)
    # The join would filter nulls on one side only, and make the exchanges differ.
    there = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*keys, "_step"]])
    placed = df.withColumn("_step", step).where(there).withColumn("_inside", F.row_number().over(inside))
    per_step = placed.groupBy(*keys, "_step").agg(F.max("_inside").cast("bigint").alias("_rows"))
    running = Window.partitionBy(*keys).orderBy("_step")
    offsets = per_step.select(
        *keys, "_step", (F.sum("_rows").over(running) - F.col("_rows")).alias("_before")
    )
    return (
        placed.join(offsets, [*keys, "_step"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_step", "_before", "_inside")
    )


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    total: str = "total",
) -> DataFrame:
    """0-based position per ``keys`` in the order of columns ``order``, and the group's size.

    One range exchange sorts the rows, wherever groups begin and end; the sorted rows are
    written once, numbered by where they lie. Counts per group and partition (no more rows
    than groups and partitions together) then give each piece of a group its offset. No
    task holds a group, and rows that are equal in all of ``keys`` and ``order`` are spread
    by a number of their own. Keys must be non-null, order columns may be null (first).
    """
    tie, place, piece = "_tie", "_place", "_piece"
    tied = cut_lineage(df.withColumn(tie, F.monotonically_increasing_id()))
    ordered = tied.repartitionByRange(*keys, *order, tie).sortWithinPartitions(*keys, *order, tie)
    # The upper 31 bits of the number are the partition's, the lower 33 count its rows.
    rows = cut_lineage(ordered.drop(tie).withColumn(place, F.monotonically_increasing_id()))
    rows = rows.withColumn(piece, F.shiftright(place, 33))
    pieces = rows.groupBy(*keys, piece).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.sum("_rows").over(group.orderBy(piece)) - F.col("_rows")
    offsets = pieces.select(
        *keys, piece, (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(group).alias(total)
    )
    return rows.join(offsets, [*keys, piece]).withColumn(name, F.col(place) + F.col("_shift")).drop(place, piece, "_shift")


# A group's values are sorted in one task up to this number; more are first narrowed down to
# the bin of a histogram with at most so many bins, so many times.
SORTED = 4096
MOST_BINS = 65_536
ROUNDS = 1


def value_counts(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, Column],
    labels: Mapping[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """(*keys, metric, value, label, item, n): how often each value of each metric occurs.

    ``metrics`` name numbers, ``labels`` pairs (label, item) that are counted as text. Null
    values, labels and items do not occur; every key has the metric "" with its number of rows.

    This is the one exchange that all figures of a group come from: equal values are counted
    where they lie, and the rest is dealt by value, however large a group is. No column is
    nullable and no reader filters it, so that Spark finds the exchange equal each time and
    evaluates ``df`` once.
    """

    def cell(metric: str, value: Column | None, label: Column | None = None, item: Column | None = None) -> Column:
        there = [c.isNotNull() for c in (value, label, item) if c is not None]
        return F.struct(
            F.lit(metric).alias("metric"),
            F.coalesce(F.lit(0.0) if value is None else value.cast("double"), F.lit(0.0)).alias("value"),
            *[F.coalesce(F.lit("") if c is None else c.cast("string"), F.lit("")).alias(n) for c, n in ((label, "label"), (item, "item"))],
            (reduce(Column.__and__, there) if there else F.lit(True)).alias("there"),
        )

    cells = [cell("", None)]
    cells += [cell(name, value) for name, value in metrics.items()]
    cells += [cell(name, None, *pair) for name, pair in (labels or {}).items()]
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return (
        df.where(known)
        .select(*keys, F.explode(F.array(*cells)).alias("c"))
        .select(*keys, "c.*")
        .where("there")
        .groupBy(*keys, "metric", "value", "label", "item")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _holds_a_middle_rank() -> Column:
    """Is one of the ranks ``low`` and ``high`` among the last ``inside`` rows up to ``upto``?"""
    first = F.col("upto") - F.col("inside")
    return reduce(Column.__or__, [(F.col("upto") >= F.col(r)) & (first < F.col(r)) for r in ("low", "high")])


def _narrowed(counts: DataFrame, keys: Sequence[str], more: Sequence[Column]) -> DataFrame:
    """(*keys, metric, figures, squares, low, high, lo, hi, inside, before): the two middle ranks
    of each metric of numbers, and the values lo..hi between which they lie (two rows where they
    lie apart).

    A histogram between the least and the greatest value, with bins by the number of values,
    tells the bin that holds a rank; that bin's own least and greatest value bound the next one.
    Where there are few values, or one, a single bin holds them all.
    """
    by, value, n = [*keys, "metric"], F.col("value"), F.col("n")
    sums = counts.groupBy(*by).agg(
        F.sum("n").alias("total"),
        (F.sum(value * n) / F.sum("n")).alias("mean"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        *more,
        F.max("label").alias("texts"),
    )
    figures = F.struct(*[c for c in sums.columns if c not in [*by, "texts"]]).alias("figures")
    middle = [F.expr("(total + 1) div 2").alias("low"), F.expr("(total + 2) div 2").alias("high")]
    sought = sums.where("texts = ''").select(*by, figures, *middle, "lo", "hi", F.col("total").alias("inside"), F.lit(0).cast("bigint").alias("before"))
    sought = sought.withColumn("squares", F.lit(0.0))
    for step in range(ROUNDS):
        large = (F.col("inside") > SORTED) & (F.col("lo") < F.col("hi"))
        bins = F.least(F.lit(MOST_BINS), F.ceil(F.col("inside") / SORTED) * 2)
        # Halves, since the distance of two doubles may not be one.
        place = (value / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bin_ = F.when(large, F.least(bins - 1, F.floor(place * bins))).otherwise(0)
        found = counts.join(sought.hint("shuffle_hash"), by).where((value >= F.col("lo")) & (value <= F.col("hi"))).withColumn("bin", bin_)
        # The first round meets all values, with their mean.
        about = n * F.pow(value - F.col("figures.mean"), 2) if step == 0 else F.lit(0.0)
        histogram = found.groupBy(*by, "low", "high", "before", "bin").agg(
            F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("n").alias("inside"),
            F.first("figures").alias("figures"), F.sum(about).alias("part"), F.first("squares").alias("known"),
        )
        all_bins = Window.partitionBy(*by, "before")
        histogram = histogram.withColumns(
            {
                "upto": F.col("before") + F.sum("inside").over(all_bins.orderBy("bin")),
                "squares": F.col("known") + F.sum("part").over(all_bins),
            }
        )
        before = (F.col("upto") - F.col("inside")).alias("before")
        sought = histogram.where(_holds_a_middle_rank()).select(*by, "figures", "squares", "low", "high", "lo", "hi", "inside", before)
    return sought


def metric_figures(counts: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """(*keys, metric, total, mean, lo, hi, *more, std, median) of the numbers in ``value_counts``.

    ``more`` are aggregates over its rows. The deviation is the sample's, about the known mean;
    the median is exact and interpolated. Only values in the bin of a middle rank are sorted.
    After the two exchanges by value and by metric every step works on what it already has.
    """
    by, value = [*keys, "metric"], F.col("value")
    sought = _narrowed(counts, keys, more).drop("inside").hint("shuffle_hash")
    inside = counts.join(sought, by).where((value >= F.col("lo")) & (value <= F.col("hi"))).withColumnRenamed("n", "inside")
    upto = F.col("before") + F.sum("inside").over(Window.partitionBy(*by, "before").orderBy("value"))
    found = inside.withColumn("upto", upto).where(_holds_a_middle_rank())
    found = found.groupBy(*by).agg(
        F.first("figures").alias("figures"),
        F.max("squares").alias("squares"),
        ((F.min("value") + F.max("value")) / 2).alias("median"),
    )
    std = F.when(F.col("figures.total") > 1, F.sqrt(F.col("squares") / (F.col("figures.total") - 1)))
    return found.select(*by, "figures.*", std.alias("std"), "median")


def exact_medians(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """Interpolated medians, one output column per metric; null where a key has no value."""
    medians = metric_figures(value_counts(df, keys, metrics), keys)
    return medians.groupBy(*keys).agg(*[F.max(F.when(F.col("metric") == m, F.col("median"))).alias(m) for m in metrics])


# Groups up to this size are sorted or counted whole; larger ones take the step-wise
# way.
GROUP_LIMIT = 1_000_000


# Rows of a group that one task may bring together.
WHOLE = 100_000


def split_by_size(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of keys with at most ``WHOLE`` rows, rows of the other keys). ``rows`` is a written
    table, since it is read for the counts first; keys above the limit are at most one in
    ``WHOLE`` rows and are written too, so that joins know their size. Keys must be non-null."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    large = cut_lineage(sizes.where(F.col("_rows") > WHOLE).select(key).coalesce(1))
    return rows.join(large, key, "left_anti"), rows.join(large, key, "left_semi")


# Pieces that rows of a group are dealt to before it is known whether it is large.
PIECES = 16


def split_unwritten(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of keys with few rows, rows of the other keys), without a job while the plan is built.

    ``rows`` is evaluated once: pieces of a key, by all its columns, lie in one exchange that the
    sizes and both tables read. A key is large if one of its pieces has more than ``SORTED`` rows
    by ``PIECES``; so is every key of more than ``SORTED`` rows. Large keys are few, and are
    broadcast, so that their rows part from the others where they lie. Rows without a key are
    dropped: the joins would filter them for some readers only, and make the exchanges differ.
    """
    columns = rows.columns
    mark = F.xxhash64(*columns)
    dealt = rows.where(F.col(key).isNotNull()).withColumn("_piece", F.pmod(mark, F.lit(PIECES))).repartition(key, "_piece")
    # All readers use all columns, or the exchanges would differ.
    pieces = dealt.groupBy(key, "_piece").agg(F.count(F.lit(1)).alias("_rows"), F.bit_xor(mark).alias("_mark"))
    large = pieces.where((F.col("_rows") > SORTED // PIECES) & F.col("_mark").isNotNull()).select(key).distinct()
    # A semi or anti join would be moved below the exchange.
    told = dealt.join(F.broadcast(large.withColumn("_large", F.lit(True))), key, "left")
    return told.where(F.col("_large").isNull()).select(*columns), told.where("_large").select(*columns)


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    limit: int,
    rank: str = "rank",
) -> DataFrame:
    """First ``limit`` rows per group. Spark prunes to ``limit`` rows per task
    and group before the shuffle, so a hot group is cut down where it lies; the
    setting up to which it does so is raised with the limit."""
    conf, threshold = df.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(conf.get(threshold)) < limit:
        conf.set(threshold, str(limit))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= limit)


def top_rows(df: DataFrame, order: Sequence[str | Column], limit: int, rank: str = "rank") -> DataFrame:
    """First ``limit`` rows of all: every task keeps its best, and only ``limit`` rows are numbered."""
    return df.orderBy(*order).limit(limit).withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def ordered_list(value: str | Column, rank: str = "rank") -> Column:
    """Aggregate: values of an already limited group, in rank order."""
    value = F.col(value) if isinstance(value, str) else value
    pairs = F.collect_list(F.struct(F.col(rank).alias("r"), value.alias("v")))
    return F.transform(F.array_sort(pairs), lambda p: p["v"])
