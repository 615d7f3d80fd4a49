"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where a later join or aggregate on it needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Percentile sketches use object hash aggregation; the default of 128 groups
    # sends every real fleet straight to the sort-based path.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    # Streaming state off the heap, with only changes uploaded per batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "telemetra", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_settings(spark: SparkSession) -> SparkSession:
    """Give the caller's session the SQL settings that results and plans here rely on.

    Epoch and calendar arithmetic is defined in UTC; hot keys are split by adaptive execution.
    Settings that only a new session can take are left as they are.
    """
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    already = context.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="telemetra-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/telemetra/{label}-{uuid.uuid4().hex}"


def mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path of a shared folder that every process reaches as files, if it is one."""
    parts = urlsplit(path)
    kind = parts.scheme or urlsplit(
        spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///").scheme
    return unquote(parts.path) if kind == "file" else None


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage through a table in the shared folder.

    The copy survives lost executors, is column-pruned on re-reads and carries
    real sizes, so join strategies downstream are chosen from facts.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan to all cores before expensive per-row work, if it has few splits.

    Inputs of many files or row groups pass through untouched, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
