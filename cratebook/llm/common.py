"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratebook.session import scratch_path

#: Most entries of a per-process memo of words; beyond that it starts anew.
MEMO_WORDS = 300_000
#: Arrow batches are cut so that one holds about so many bytes of text.
BATCH_BYTES = 4 << 20
#: And Spark sends at most about so many bytes to a Python worker at once.
SENT_BYTES = 8 << 20


def col(name: str) -> Column:
    """A column by its literal name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    # Spark sends rows to Python workers in batches of up to 64 MB, held several times over.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SENT_BYTES))
    return spark.read.parquet(f"{folder}/{table}.parquet")


def written(df: DataFrame, label: str) -> str:
    """The path of a new table in the shared folder that holds the rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: survives lost executors, ends the
    lineage, and gives the optimizer true sizes."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, label))


def keyed_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id`` and ``text`` only; a null text counts as empty."""
    return docs.select(
        col(id_col).cast("long").alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text")
    )


def slices(batch: pa.RecordBatch, column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``most`` bytes of text (one row at least)."""
    sizes = pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + (size or 0) > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < len(sizes):
        yield batch.slice(start)
