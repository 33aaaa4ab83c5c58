"""Query entries: a Spark job and, where SQL can say it, its independent twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cratebook.session import apply_runtime_conf
from cratebook.testbed.virtual import VirtualLibrary, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def entry(name: str, sql: str | None = None, tables: tuple[str, ...] = ()):
    """Register a function ``VirtualLibrary -> DataFrame`` under ``name``."""

    def register(build: Callable[[VirtualLibrary], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(VirtualLibrary(apply_runtime_conf(spark), folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(*tables, body=sql) if tables else sql.strip()
        return build

    return register
