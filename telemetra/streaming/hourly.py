"""Windowed statistics over a stream, with bounded lateness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetra.operators.latest import latest_per_key
from telemetra.operators.stats import channel_stats
from telemetra.streaming.versions import write_versions

LATENESS = "3 hours"


def windowed_stats(
    stream: DataFrame,
    measure: str,
    channels: Sequence[str],
    width: str = "1 hour",
    lateness: str = LATENESS,
    percentiles: Sequence[float] = (),
) -> DataFrame:
    """Statistics per asset and tumbling window; state is dropped once a window is too old."""
    return (
        stream.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", width).alias("_window"), "asset_id")
        .agg(
            F.count(F.lit(1)).alias("reading_count"),
            *channel_stats(measure, channels, percentiles=percentiles),
        )
        .withColumn("bucket", F.col("_window.start"))
        .drop("_window")
    )


def append_closed(stats: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each window once, when no more of its rows can arrive."""
    return (
        stats.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def upsert_changed(
    stats: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write the windows each micro-batch changed as one version folder.

    Nothing already written is rewritten. :func:`read_upserts` shows the newest version of
    every window.
    """
    return write_versions(stats, path, checkpoint, "update", every)


def read_upserts(
    spark: SparkSession, path: str, keys: Sequence[str] = ("asset_id", "bucket")
) -> DataFrame:
    return latest_per_key(spark.read.parquet(path), list(keys), "batch").drop("batch", "run")


def compact_upserts(spark: SparkSession, path: str, target: str) -> None:
    """Fold all versions into one folder at ``target``; later batches keep their numbers."""
    newest = spark.read.parquet(path).agg(F.max("batch"), F.max("run")).first()
    read_upserts(spark, path).write.mode("overwrite").parquet(
        f"{target}/run={newest[1]}/batch={newest[0]}")
