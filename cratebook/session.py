"""Session defaults and the shared folder used for checkpoints and stream state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Results depend on these: all time arithmetic is in UTC, and bad casts raise
# unless an expression asks for try_*.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Hot keys are split at run time; joins followed by an aggregate count too.
SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# State of streams lies on the executors' disks and in the checkpoint folder, not in the heap.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Checkpoints are compressed, and removed once nothing refers to them.
STORAGE_CONF = {
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app_name: str = "cratebook", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **SKEW_CONF, **STREAM_CONF, **STORAGE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the run-time settings on a session that somebody else created."""
    for key, value in {**SEMANTIC_CONF, **SKEW_CONF, **STREAM_CONF}.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster a
    folder of one machine would be lost with that machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="cratebook-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read again.

    Survives executor loss, ends the plan here, and gives later joins the true size: a
    checkpoint would keep the size estimate of the plan it replaces, which multiplies from
    round to round. Being columnar, later reads take only the columns they need.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
