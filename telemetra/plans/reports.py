"""Fleet reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from telemetra.functions.columns import status_label

REVENUE_FACTOR = 110  # fixed value: revenue per unit of energy


def faulty(status: DataFrame) -> DataFrame:
    return status.where(F.col("prediction") != "ok")


def first_faulty(status: DataFrame, count: int) -> DataFrame:
    """The short list of faulty assets, in key order."""
    return faulty(status).orderBy("asset_id").limit(count)


def _shortages(broken: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Missing parts times the faulty assets their depot serves.

    Both sides are counted before they meet: a depot serving many assets and holding many
    parts would otherwise produce every pair of them just to be counted.
    """
    waiting = broken.groupBy("site_id").agg(F.count(F.lit(1)).alias("_assets"))
    missing = (
        parts.where(F.col("stock_available") == 0)
        .groupBy("stock_location", *[k for k in keys if k != "site_id"])
        .agg(F.count(F.lit(1)).alias("_parts"))
        .withColumnRenamed("stock_location", "site_id")
    )
    return (
        missing.join(waiting, "site_id")
        .groupBy(*keys)
        .agg(F.sum(F.col("_assets") * F.col("_parts")).alias("faulty_equipment_count"))
    )


def faulty_parts_count(broken: DataFrame, parts: DataFrame) -> DataFrame:
    """Part categories out of stock where faulty assets stand, most wanted first.

    A left join from assets to parts that then demands zero stock keeps only matches, so this
    is an inner join.
    """
    return _shortages(broken, parts, ["type"]).orderBy(
        F.col("faulty_equipment_count").desc(), "type"
    )


def faulty_parts_detail(broken: DataFrame, parts: DataFrame) -> DataFrame:
    keys = ["ean", "type", "lead_days", "site_id"]
    return _shortages(broken, parts, keys).orderBy(
        F.col("faulty_equipment_count").desc(), *keys
    )


def fleet_revenue(status: DataFrame) -> DataFrame:
    return status.agg(
        F.sum("avg_energy").alias("energy_produced"),
        (F.sum("avg_energy") * REVENUE_FACTOR).alias("revenue_per_hour"),
    )


def status_totals(status: DataFrame) -> DataFrame:
    group = F.when(F.col("prediction") == "ok", "ok").otherwise("faulty")
    return status.groupBy(group.alias("status")).agg(
        F.sum("avg_energy").alias("energy_produced"),
        F.avg("avg_energy").alias("avg_energy"),
        (F.count(F.lit(1)) / 10).alias("asset_count"),
    )


def efficiency_loss(status: DataFrame) -> DataFrame:
    """Ratio to the next status; the window sees the two status rows only."""
    following = F.lead("avg_energy", 1).over(Window.orderBy("status"))
    return (
        status_totals(status)
        .withColumn("other_status_avg_energy", following)
        .withColumn("efficiency_loss", F.col("avg_energy") / F.col("other_status_avg_energy") * 10)
    )


def efficiency_loss_total(status: DataFrame) -> DataFrame:
    return efficiency_loss(status).agg(F.sum("efficiency_loss").alias("efficiency_loss_total"))


def labelled_status(status: DataFrame) -> DataFrame:
    return status.withColumn("status", status_label("prediction"))


def selector_counts(df: DataFrame, selector: str, predicate: str) -> DataFrame:
    """Every selectable value with the number of its rows that meet the condition."""
    return df.groupBy(selector).agg(F.count_if(F.expr(predicate)).alias("matching_rows"))


def asset_slice(df: DataFrame, asset_id: int) -> DataFrame:
    """All rows of the chosen asset; the equality is pushed to the scan."""
    return df.where(F.col("asset_id") == asset_id)


def example_asset(df: DataFrame, condition: str) -> DataFrame:
    """The smallest asset id that meets a condition, as a one-row frame."""
    return df.where(condition).agg(F.min("asset_id").alias("asset_id")).where("asset_id IS NOT NULL")


def forecast_hourly(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.date_trunc("hour", "time").alias("hourly_time")).agg(
        F.sum("low").alias("sum_low"),
        F.sum("high").alias("sum_high"),
        F.sum("prediction").alias("sum_prediction"),
    )
