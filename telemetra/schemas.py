"""Declared schemas of the landing inputs, with column comments."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*columns: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True, {"comment": c}) for n, t, c in columns])


READING = _struct(
    ("event_id", T.LongType(), "reading number, unique"),
    ("asset_id", T.LongType(), "asset that sent the reading"),
    ("epoch_s", T.LongType(), "seconds since 1970-01-01 UTC"),
    ("event_time", T.TimestampType(), "time of the reading"),
    ("event_type", T.StringType(), "kind of reading"),
    ("energy", T.DoubleType(), "energy produced"),
    ("channel_k", T.DoubleType(), "auxiliary channel"),
)

ASSET = _struct(
    ("asset_id", T.LongType(), "asset key"),
    ("model", T.StringType(), "equipment model"),
    ("lat", T.StringType(), "latitude as delivered, may be unreadable"),
    ("lon", T.StringType(), "longitude as delivered, may be unreadable"),
    ("location", T.StringType(), "place name"),
    ("country", T.StringType(), "country or region"),
    ("site_id", T.IntegerType(), "depot serving the asset"),
)

STATUS_INTERVAL = _struct(
    ("asset_id", T.LongType(), "asset key"),
    ("abnormal_channel", T.StringType(), "failing channel or ok"),
    ("start_time", T.LongType(), "epoch seconds, exclusive"),
    ("end_time", T.LongType(), "epoch seconds, exclusive"),
)

PART = _struct(
    ("ean", T.StringType(), "article number, may be missing"),
    ("part_id", T.LongType(), "part key"),
    ("type", T.StringType(), "part category"),
    ("stock_available", T.IntegerType(), "pieces in stock"),
    ("stock_location", T.IntegerType(), "depot"),
    ("lead_days", T.IntegerType(), "days until restocked"),
)

QUEUE = _struct(
    ("asset_id", T.LongType(), "asset key"),
    ("location", T.StringType(), "place name"),
    ("predicted_failure_type", T.StringType(), "failing channel"),
    ("severity_score", T.DoubleType(), "0 to 1"),
    ("status", T.StringType(), "Pending, In Progress or Resolved"),
    ("flagged_at", T.TimestampType(), "when the asset entered the queue"),
    ("technician_notes", T.StringType(), "free text"),
    ("last_updated", T.TimestampType(), "last change"),
)
