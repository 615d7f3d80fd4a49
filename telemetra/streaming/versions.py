"""One folder per micro-batch: results of a stream that stay exact after a failure."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def write_versions(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str,
    every: str | None = None,
    shape: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Store each micro-batch, after ``shape``, in a folder named by run and batch number.

    A repeated batch overwrites its own folder and nothing else. Batch numbers are those of
    the checkpoint, so a target that another checkpoint has written to is refused.
    """
    run = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()
    if _runs(stream.sparkSession, path) - {run}:
        raise ValueError(f"{path} holds versions of another checkpoint")

    def store(batch: DataFrame, number: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/run={run}/batch={number}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.foreachBatch(store).start()


def _runs(spark: SparkSession, path: str) -> set[str]:
    """Checkpoints that have written to the path."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        return set()  # nothing there yet
    if "run" not in stored.columns:
        return {""}
    return {r["run"] for r in stored.select("run").distinct().collect()}


def sum_versions(spark: SparkSession, path: str) -> DataFrame:
    """Every stored column summed over all versions, as rows of counter and value."""
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    names = [c for c in stored.columns if c not in ("run", "batch")]
    totals = stored.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    rows = [F.struct(F.lit(c).alias("counter"), F.col(c).alias("value")) for c in names]
    return totals.select(F.explode(F.array(*rows)).alias("c")).select("c.*")
