"""Maintenance queue: build, view, counters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from telemetra.functions.columns import contains_any, severity_band, severity_md5
from telemetra.operators.latest import latest_per_key

STATUSES = ("Pending", "In Progress", "Resolved")


def build_queue(
    status: DataFrame, now: dt.datetime | None = None, severity: Column | None = None,
    time: str = "bucket",
) -> DataFrame:
    """Faulty assets, one row each from their latest state, all pending.

    They are flagged at ``now``, which is the moment the query runs unless it is given.
    """
    score = severity_md5("asset_id") if severity is None else severity
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return latest_per_key(
        status.where(F.col("prediction") != "ok"), ["asset_id"], time, ["prediction"]
    ).select(
        "asset_id",
        "location",
        F.col("prediction").alias("predicted_failure_type"),
        score.alias("severity_score"),
        F.lit("Pending").alias("status"),
        stamp.alias("flagged_at"),
        F.lit(None).cast("string").alias("technician_notes"),
        stamp.alias("last_updated"),
    )


def sorted_queue(queue: DataFrame) -> DataFrame:
    return queue.orderBy(F.col("severity_score").desc(), "asset_id")


def banded(queue: DataFrame) -> DataFrame:
    return queue.withColumn("severity_level", severity_band("severity_score"))


def filtered(queue: DataFrame, statuses: Sequence[str] = STATUSES, term: str = "") -> DataFrame:
    kept = queue.where(F.col("status").isin(list(statuses)))
    if not term:
        return kept
    text_id = kept.withColumn("_id", F.col("asset_id").cast("string"))
    return text_id.where(contains_any(["_id", "location"], term)).drop("_id")


def counts_on(queue: DataFrame, day: dt.date) -> DataFrame:
    """Entries per status flagged on the day."""
    today = F.to_date("flagged_at") == F.lit(day)
    return queue.agg(
        F.count_if(today & (F.col("status") == "Pending")).alias("pending"),
        F.count_if(today & (F.col("status") == "In Progress")).alias("in_progress"),
        F.count_if(today & (F.col("status") == "Resolved")).alias("resolved"),
    )


def shown_counts(queue: DataFrame, statuses: Sequence[str], term: str) -> DataFrame:
    """Rows the filter shows and rows in all, counted in one pass."""
    text_id = queue.withColumn("_id", F.col("asset_id").cast("string"))
    shown = F.col("status").isin(list(statuses)) & contains_any(["_id", "location"], term)
    return text_id.agg(
        F.count_if(shown).alias("shown"), F.count(F.lit(1)).alias("total")
    )
