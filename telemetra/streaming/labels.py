"""Readings labelled by status intervals while both still arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemetra.streaming.hourly import LATENESS

DAY = 86_400


def interval_pieces(intervals: DataFrame) -> DataFrame:
    """Intervals cut at midnight, one row per day they touch, with the day's start as event time.

    A piece can only meet readings of its own day, so state of either side can be dropped a
    bounded time later, however long the interval is.
    """
    days = F.sequence(F.floor(F.col("start_time") / DAY), F.floor(F.col("end_time") / DAY))
    return (
        intervals.where(F.col("start_time") < F.col("end_time"))
        .withColumn("_day", F.explode(days))
        .withColumn("_piece_time", F.timestamp_seconds(F.col("_day") * DAY))
    )


def label_stream(
    readings: DataFrame, intervals: DataFrame, key: str = "asset_id", time: str = "event_time",
    lateness: str = LATENESS,
) -> DataFrame:
    """Readings joined with every interval of the asset that strictly contains their time.

    Both inputs are streams. Rows later than the lateness are dropped; what may still find a
    partner is kept as state, and dropped when the watermark has passed the end of its day.
    """
    left = readings.withWatermark(time, lateness).withColumn(
        "_reading_day", F.floor(F.unix_seconds(time) / DAY))
    right = interval_pieces(intervals).withColumnRenamed(key, "_key").withWatermark(
        "_piece_time", lateness)
    at = F.unix_micros(time)
    met = (
        (F.col(key) == F.col("_key")) & (F.col("_reading_day") == F.col("_day"))
        & (F.col(time) >= F.col("_piece_time"))
        & (F.col(time) < F.col("_piece_time") + F.expr("INTERVAL 1 DAY"))
        & (F.col("start_time") * 1_000_000 < at) & (F.col("end_time") * 1_000_000 > at)
    )
    return left.join(right, met).drop("_key", "_day", "_reading_day", "_piece_time")
