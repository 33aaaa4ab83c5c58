"""Continuous history: ingestion, play counts, first plays per listener.

Each job takes all data present and stops. State and sinks live below the shared checkpoint folder, so a
restarted job goes on where it was.
"""

from __future__ import annotations

import zlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cratebook.functions import times


def read_stream(
    spark: SparkSession,
    folder: str,
    schema: str,
    fmt: str = "parquet",
    pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "json":
        reader = reader.option("multiLine", True)
    return reader.format(fmt).load(folder)


def event_time(column: str | Column) -> Column:
    """Watermarks need a TIMESTAMP; a time without zone is taken as UTC."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp")


def _present(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a Parquet folder, none if it is not there yet."""
    try:
        found = spark.read.schema(schema).parquet(path)
        # Partition columns that were not asked for come along otherwise.
        return found.select(*[f"`{name}`" for name in StructType.fromDDL(schema).names])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def meaningful_plays(plays: DataFrame, minimum: int = 30_000) -> DataFrame:
    """Plays that count, with their time parts."""
    skipped = F.col("skipped") if "skipped" in plays.columns else None
    kept = plays.where(times.meaningful_play(F.col("ms_played"), skipped, minimum))
    return times.with_time_parts(kept.withColumn("timestamp", event_time("timestamp")))


def ingest_available(plays: DataFrame, sink: str, checkpoint: str, keys: list[str], minimum: int = 30_000) -> None:
    """Add the meaningful plays of everything present to ``sink``, each once, however late.

    A repeat is the same play (``keys``, of the same month) arriving again, in the same file or any
    later one. What was seen is the sink itself, dealt by month and batch: a batch reads the keys
    of its own months only, and no other state is held. A batch that is run again after a
    failure overwrites its own folders.
    """

    def add(batch: DataFrame, number: int) -> None:
        # Numbers begin anew with another checkpoint folder.
        spark, label = batch.sparkSession, f"{zlib.crc32(checkpoint.encode()):08x}-{number}"
        kept = meaningful_plays(batch, minimum).dropDuplicates(keys)
        # One row per month that the batch has plays of.
        months = [r["month"] for r in kept.select("month").distinct().collect()]
        # Nullable and without the partition columns, as they come back from the sink.
        known = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in keys)
        seen = _present(spark, sink, f"{known}, month string, batch string")
        seen = seen.where((F.col("batch") != label) & F.col("month").isin([m for m in months if m is not None]))
        new = kept.join(seen.select(*keys), keys, "left_anti").withColumn("batch", F.lit(label))
        writer = new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch")
        writer.parquet(sink)

    plays.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_plays(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """The plays that ``ingest_available`` has kept; none before its first batch. ``schema``
    names the columns that are wanted."""
    return _present(spark, sink, schema)


# Batches that share a folder and are folded together.
GENERATION = 100


def _counts_schema(item: str, kind: str) -> str:
    return f"start timestamp, `{item}` {kind}, play_count bigint, total_ms bigint"


def _folded_upto(spark: SparkSession, sink: str) -> list[int]:
    """Generations up to which counts were folded, by the manifest, latest last."""
    return sorted(r["upto"] for r in _present(spark, f"{sink}/manifest", "upto bigint").collect())


def count_available(plays: DataFrame, sink: str, checkpoint: str, item: str = "track_uri", size: str = "1 day") -> None:
    """Add the plays of everything present to the counts in ``sink``; none is lost, however late.

    Every micro-batch writes its own counts into a folder of its number. A batch that is run
    again after a failure overwrites that folder, so each play counts once. No state is held.
    """

    def add(batch: DataFrame, number: int) -> None:
        counts = (
            batch.groupBy(F.window(event_time("timestamp"), size).alias("w"), item)
            .agg(F.count("ms_played").alias("play_count"), F.sum("ms_played").alias("total_ms"))
            .select(F.col("w.start").alias("start"), item, "play_count", "total_ms")
        )
        counts.write.mode("overwrite").parquet(f"{sink}/batches/gen={number // GENERATION}/batch={number}")

    plays.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _summed(rows: DataFrame, item: str) -> DataFrame:
    return rows.groupBy("start", item).agg(F.sum("play_count").alias("play_count"), F.sum("total_ms").alias("total_ms"))


def _parts(spark: SparkSession, sink: str, upto: int | None, item: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """(folded counts, batches that are not folded yet)."""
    schema = _counts_schema(item, kind)
    batches = _present(spark, f"{sink}/batches", f"{schema}, gen bigint, batch bigint")
    if upto is None:
        return spark.createDataFrame([], schema), batches
    return spark.read.schema(schema).parquet(f"{sink}/folded/upto={upto}"), batches.where(F.col("gen") > upto)


def read_counts(spark: SparkSession, sink: str, item: str = "track_uri", item_type: str = "string") -> DataFrame:
    """Plays and length per item and window so far; none before the first batch.

    Folded generations are read from one table, the batches after them from their folders: the
    manifest says where one ends and the other begins, so that each batch is read once.
    """
    done = _folded_upto(spark, sink)
    folded, rest = _parts(spark, sink, done[-1] if done else None, item, item_type)
    return _summed(folded.unionByName(rest.select(folded.columns)), item)


def fold_counts(spark: SparkSession, sink: str, item: str = "track_uri", item_type: str = "string") -> int | None:
    """Fold all complete generations of batches into one table; the last one folded, if any.

    The folded table is written first, then a row of the manifest, which is the moment from
    which readers use it: a fold that fails before leaves everything as it was, and is written
    anew. Folders that an earlier fold has taken up are emptied, so that readers that began
    before this fold still find theirs.
    """
    done = _folded_upto(spark, sink)
    upto = done[-1] if done else None
    folded, rest = _parts(spark, sink, upto, item, item_type)
    newest = rest.agg(F.max("gen")).first()[0]
    if newest is None or newest - 1 <= (-1 if upto is None else upto):
        return upto
    complete = rest.where(F.col("gen") < newest).select(folded.columns)
    _summed(folded.unionByName(complete), item).write.mode("overwrite").parquet(f"{sink}/folded/upto={newest - 1}")
    spark.createDataFrame([(newest - 1,)], "upto bigint").coalesce(1).write.mode("append").parquet(f"{sink}/manifest")
    if upto is not None:
        empty = spark.createDataFrame([], f"{_counts_schema(item, item_type)}, batch bigint")
        for gen in range(done[-2] + 1 if len(done) > 1 else 0, upto + 1):
            empty.write.mode("overwrite").partitionBy("batch").parquet(f"{sink}/batches/gen={gen}")
    return newest - 1


def first_plays(plays: DataFrame, listener: str = "listener", item: str = "track_uri") -> DataFrame:
    """A (listener, item) pair the first time it arrives.

    The state holds every pair ever seen: a play is new only once, however late the
    next one is. Its size is the number of distinct pairs, spread over all tasks, on disk
    (``session.py`` sets that state store).
    """
    return plays.dropDuplicates([listener, item]).select(listener, item)


def run_available(stream: DataFrame, sink: str, checkpoint: str, partition_by: str | None = None) -> None:
    """Append everything present to a parquet folder and stop; exactly once per input file."""
    writer = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.start(sink).awaitTermination()
