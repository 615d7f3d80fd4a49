"""Domain roles over the given tables.

Every role is a lazy projection: filters and column pruning reach the Parquet
scan below it. ``timestamp_ntz`` columns become ``timestamp`` here, because
event-time watermarks only accept the latter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.session import pin_settings


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return pin_settings(spark).read.parquet(f"{folder}/{name}.parquet")


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with one energy value and one auxiliary channel."""
    at = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("asset_id"),
        F.unix_seconds(at).alias("epoch_s"),
        at.alias("event_time"),
        "event_type",
        F.col("value").alias("energy"),
        F.get_json_object("props", "$.k").cast("double").alias("channel_k"),
    )


def telemetry_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with several channels, addressed by column-name pattern."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("asset_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        F.col("l_extendedprice").alias("energy"),
        F.col("l_quantity").alias("channel_a"),
        F.col("l_discount").alias("channel_b"),
        F.col("l_tax").alias("channel_c"),
    )


def assets(spark: SparkSession, folder: str) -> DataFrame:
    """Asset metadata; unreadable coordinates are kept as text."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    supplier = table(spark, folder, "supplier")
    broken = F.col("s_acctbal") < 0
    model = (
        F.when(F.col("s_acctbal") >= 5000, "large")
        .when(F.col("s_acctbal") >= 2000, "standard")
        .otherwise("small")
    )
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("s_suppkey").alias("asset_id"),
            model.alias("model"),
            F.when(broken, "ERROR").otherwise(F.col("s_acctbal").cast("string")).alias("lat"),
            F.when(broken, "ERROR").otherwise(F.col("s_nationkey").cast("string")).alias("lon"),
            F.col("n_name").alias("location"),
            F.col("r_name").alias("country"),
            F.col("n_nationkey").alias("site_id"),
        )
    )


def status_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """One labelled interval per asset, spanning its error readings."""
    mean = F.avg("energy")
    return (
        telemetry(spark, folder)
        .where(F.col("event_type") == "error")
        .groupBy("asset_id")
        .agg(
            F.when(mean > 60, "channel_b").when(mean < 40, "channel_d").otherwise("ok")
            .alias("abnormal_channel"),
            F.min("epoch_s").alias("start_time"),
            F.max("epoch_s").alias("end_time"),
        )
    )


def incidents(spark: SparkSession, folder: str, hours: int = 6) -> DataFrame:
    """One interval per error reading; intervals of an asset may overlap."""
    return (
        telemetry(spark, folder)
        .where(F.col("event_type") == "error")
        .select(
            "asset_id",
            F.when(F.col("channel_k") > 50, "channel_b").otherwise("channel_d")
            .alias("abnormal_channel"),
            F.col("epoch_s").alias("start_time"),
            (F.col("epoch_s") + hours * 3600).alias("end_time"),
        )
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Spare parts with their stock at one depot each."""
    return table(spark, folder, "part").select(
        F.when(F.col("p_size") < 50, F.col("p_partkey").cast("string")).alias("ean"),
        F.col("p_partkey").alias("part_id"),
        F.col("p_type").alias("type"),
        (F.col("p_size") % 6).alias("stock_available"),
        (F.col("p_partkey") % 25).cast("int").alias("stock_location"),
        (F.lit(30) + F.col("p_size") * 6).alias("lead_days"),
    )


# The same roles for the SQL checks.
ROLE_SQL = {
    "telemetry": """
        SELECT event_id, user_id AS asset_id,
               CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, ts AS event_time, event_type,
               value AS energy, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS channel_k
        FROM events""",
    "telemetry_wide": """
        SELECT l_suppkey AS asset_id, l_shipdate AS event_time, l_extendedprice AS energy,
               l_quantity AS channel_a, l_discount AS channel_b, l_tax AS channel_c
        FROM lineitem""",
    "assets": """
        SELECT s_suppkey AS asset_id,
               CASE WHEN s_acctbal >= 5000 THEN 'large' WHEN s_acctbal >= 2000 THEN 'standard'
                    ELSE 'small' END AS model,
               CASE WHEN s_acctbal < 0 THEN 'ERROR' ELSE CAST(s_acctbal AS VARCHAR) END AS lat,
               CASE WHEN s_acctbal < 0 THEN 'ERROR' ELSE CAST(s_nationkey AS VARCHAR) END AS lon,
               n_name AS location, r_name AS country, n_nationkey AS site_id
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "status_intervals": """
        SELECT user_id AS asset_id,
               CASE WHEN avg(value) > 60 THEN 'channel_b' WHEN avg(value) < 40 THEN 'channel_d'
                    ELSE 'ok' END AS abnormal_channel,
               CAST(floor(epoch(min(ts))) AS BIGINT) AS start_time,
               CAST(floor(epoch(max(ts))) AS BIGINT) AS end_time
        FROM events WHERE event_type = 'error' GROUP BY user_id""",
    "incidents": """
        SELECT user_id AS asset_id,
               CASE WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) > 50
                    THEN 'channel_b' ELSE 'channel_d' END AS abnormal_channel,
               CAST(floor(epoch(ts)) AS BIGINT) AS start_time,
               CAST(floor(epoch(ts)) AS BIGINT) + 21600 AS end_time
        FROM events WHERE event_type = 'error'""",
    "parts": """
        SELECT CASE WHEN p_size < 50 THEN CAST(p_partkey AS VARCHAR) END AS ean,
               p_partkey AS part_id, p_type AS type, p_size % 6 AS stock_available,
               CAST(p_partkey % 25 AS INTEGER) AS stock_location, 30 + p_size * 6 AS lead_days
        FROM part""",
}
