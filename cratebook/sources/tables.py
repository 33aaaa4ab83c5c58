"""Reading and writing the tidy tables, exports, and the sync of an export folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratebook import schemas
from cratebook.operators.plays import DAY_OF_YEAR, day_of_year, history_union
from cratebook.sources import exports

FORMATS = ("parquet", "csv")


def table_path(folder: str, key: str, fmt: str = "parquet") -> str:
    return f"{folder.rstrip('/')}/{key}.{fmt}"


def exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system the path belongs to; no file is read."""
    try:
        spark.read.format("binaryFile").load(path).schema  # noqa: B018  Connect resolves only now
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def load_table(spark: SparkSession, folder: str, key: str, fmt: str = "parquet") -> DataFrame:
    """A table by key; a missing one is empty with its declared schema."""
    path = table_path(folder, key, fmt)
    schema = schemas.TABLES.get(key)
    if not exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    return spark.read.parquet(path)


def save_table(df: DataFrame, folder: str, key: str, fmt: str = "parquet") -> str:
    """Overwrite a table. The input must not read the same path: refreshes go to a new
    version folder first."""
    path = table_path(folder, key, fmt)
    _write(df, path, fmt)
    return path


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def export_table(df: DataFrame, path: str) -> str:
    """Format from the suffix; without one ``.parquet`` is appended, other suffixes
    get parquet content. The result is a folder, as Spark writes it."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if "." not in name:
        path = f"{path}.parquet"
    _write(df, path, "csv" if path.lower().endswith(".csv") else "parquet")
    return path


def save_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_history(history: DataFrame, path: str) -> str:
    """History partitioned by month: later month filters read only their folders."""
    history.write.mode("overwrite").partitionBy("month").parquet(path)
    return path


def write_history_by_day(history: DataFrame, path: str) -> str:
    """History partitioned by the day of the year, for looking back on one day: such a query
    reads that day's folder only. A day that holds much of all rows is split into files."""
    dealt = history.withColumn(DAY_OF_YEAR, day_of_year(F.col("timestamp"))).hint("rebalance", DAY_OF_YEAR)
    dealt.write.mode("overwrite").partitionBy(DAY_OF_YEAR).parquet(path)
    return path


def load_history(
    spark: SparkSession, account: str, extended: str, patterns: Mapping[str, str] = exports.FILES
) -> DataFrame:
    return history_union(
        exports.load_basic(spark, account, patterns["basic"]),
        exports.load_extended(spark, extended, patterns["extended"]),
    )


def _loaders(
    spark: SparkSession, account: str, extended: str, tech: str, patterns: Mapping[str, str]
) -> Mapping[str, Callable[[], DataFrame]]:
    loaders: dict[str, Callable[[], DataFrame]] = {
        "streaming_history": lambda: load_history(spark, account, extended, patterns),
        "search_queries": lambda: exports.load_search(spark, account, patterns["search"]),
        "wrapped_data": lambda: exports.load_wrapped(spark, account, pattern=patterns["wrapped"]),
        "follow_data": lambda: exports.load_follow(spark, account, patterns["follow"]),
        "library_snapshot": lambda: exports.load_library(spark, account, patterns["library"]),
    }
    for table in exports.TECH_TABLES:
        loaders[table] = lambda table=table: exports.load_tech_log(spark, tech, patterns[table])
    return loaders


def sync_exports(
    spark: SparkSession,
    account: str,
    extended: str,
    tech: str,
    folder: str,
    force: bool = False,
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Load and save every export table that is not there yet; (table, status, rows).

    ``patterns`` replaces file name patterns of the export.
    """
    patterns = {**exports.FILES, **(patterns or {})}
    status = []
    for table, load in _loaders(spark, account, extended, tech, patterns).items():
        path = table_path(folder, table)
        if force or not exists(spark, path):
            save_table(load(), folder, table)
            word = "written"
        else:
            word = "present"
        counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
        status.append(counted.select(F.lit(table).alias("table"), F.lit(word).alias("status"), "rows"))
    result = status[0]
    for part in status[1:]:
        result = result.unionByName(part)
    return result
