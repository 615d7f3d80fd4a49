"""Fleet reports and their selectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.catalog.columns import NOW
from telemetra.catalog.registry import query, rounded, sql
from telemetra.functions.columns import hours_ahead, numeric_coordinates
from telemetra.operators import stats
from telemetra.plans import gold, reports
from telemetra.sources import roles

SHORT_LIST = 18  # fixed value: length of the dashboard's list of faulty assets


def status_of(spark, folder):
    return gold.current_status(roles.telemetry(spark, folder), roles.assets(spark, folder))


_COUNT = """
    SELECT type, CAST(count(*) AS BIGINT) AS faulty_equipment_count
    FROM {faulty} t LEFT JOIN parts p ON t.site_id = p.stock_location
    WHERE stock_available = 0 GROUP BY type"""
_DETAIL = """
    SELECT ean, type, lead_days, site_id, CAST(count(*) AS BIGINT) AS faulty_equipment_count
    FROM {faulty} t LEFT JOIN parts p ON t.site_id = p.stock_location
    WHERE stock_available = 0 GROUP BY ean, type, lead_days, site_id"""
_FAULTY = "SELECT * FROM status WHERE prediction <> 'ok'"
_SHORT = f"SELECT * FROM status WHERE prediction <> 'ok' ORDER BY asset_id LIMIT {SHORT_LIST}"


@query("faulty_parts_count", sql(_COUNT.format(faulty="broken"), "status", "parts", broken=_FAULTY))
def faulty_parts_count(spark, folder):
    broken = reports.faulty(status_of(spark, folder))
    return reports.faulty_parts_count(broken, roles.parts(spark, folder))


@query("faulty_parts_detail", sql(_DETAIL.format(faulty="broken"), "status", "parts", broken=_FAULTY))
def faulty_parts_detail(spark, folder):
    broken = reports.faulty(status_of(spark, folder))
    return reports.faulty_parts_detail(broken, roles.parts(spark, folder))


@query(
    "faulty_parts_short_list",
    sql(_COUNT.format(faulty="broken"), "status", "parts", broken=_SHORT),
)
def faulty_parts_short_list(spark, folder):
    """The dashboard's form: shortages for the short list of faulty assets only."""
    broken = reports.first_faulty(status_of(spark, folder), SHORT_LIST)
    return reports.faulty_parts_count(broken, roles.parts(spark, folder))


@query(
    "first_n_faulty",
    sql(
        "SELECT asset_id, prediction AS fault, model, location, lat, lon, country FROM broken",
        "status", broken=_SHORT,
    ),
)
def first_n_faulty(spark, folder):
    return reports.first_faulty(status_of(spark, folder), SHORT_LIST).select(
        "asset_id", F.col("prediction").alias("fault"), "model", "location", "lat", "lon", "country"
    )


@query(
    "fleet_revenue",
    sql(
        "SELECT round(sum(avg_energy), 4) AS energy_produced, "
        "round(sum(avg_energy) * 110, 4) AS revenue_per_hour FROM status",
        "status",
    ),
)
def fleet_revenue(spark, folder):
    return rounded(reports.fleet_revenue(status_of(spark, folder)), 4)


_TOTALS = """
    SELECT CASE WHEN prediction = 'ok' THEN 'ok' ELSE 'faulty' END AS status,
           sum(avg_energy) AS energy_produced, avg(avg_energy) AS avg_energy,
           count(*) / 10 AS asset_count FROM status GROUP BY 1"""
_LOSS = """
    SELECT *, avg_energy / other_status_avg_energy * 10 AS efficiency_loss
    FROM (SELECT *, lead(avg_energy) OVER (ORDER BY status) AS other_status_avg_energy FROM totals)"""


@query(
    "status_totals",
    sql(
        "SELECT status, round(energy_produced, 4) AS energy_produced, "
        "round(avg_energy, 4) AS avg_energy, round(asset_count, 4) AS asset_count FROM totals",
        "status", totals=_TOTALS,
    ),
)
def status_totals(spark, folder):
    return rounded(reports.status_totals(status_of(spark, folder)), 4)


@query(
    "efficiency_loss",
    sql(
        "SELECT status, round(energy_produced, 4) AS energy_produced, "
        "round(avg_energy, 4) AS avg_energy, round(asset_count, 4) AS asset_count, "
        "round(other_status_avg_energy, 4) AS other_status_avg_energy, "
        "round(efficiency_loss, 4) AS efficiency_loss FROM loss",
        "status", totals=_TOTALS, loss=_LOSS,
    ),
)
def efficiency_loss(spark, folder):
    return rounded(reports.efficiency_loss(status_of(spark, folder)), 4)


@query(
    "efficiency_loss_total",
    sql(
        "SELECT round(sum(efficiency_loss), 4) AS efficiency_loss_total FROM loss",
        "status", totals=_TOTALS, loss=_LOSS,
    ),
)
def efficiency_loss_total(spark, folder):
    return rounded(reports.efficiency_loss_total(status_of(spark, folder)), 4)


@query(
    "status_label",
    sql(
        "SELECT asset_id, CASE WHEN prediction = 'ok' THEN 'Healthy' "
        "ELSE 'Faulty (' || prediction || ')' END AS status, "
        "TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon FROM status",
        "status",
    ),
)
def status_label(spark, folder):
    labelled = reports.labelled_status(status_of(spark, folder))
    return numeric_coordinates(labelled).select("asset_id", "status", "lat", "lon")


def _histogram_check(table: str, column: str, width: str) -> str:
    return sql(
        f"SELECT CAST(floor({column} / {width}) * {width} AS DOUBLE) AS bin_floor, "
        f"count(*) AS row_count FROM {table} GROUP BY 1",
        table,
    )


@query("histogram", _histogram_check("telemetry", "energy", "1"))
def histogram(spark, folder):
    return stats.histogram(roles.telemetry(spark, folder), "energy", 1)


@query("histogram_channel", _histogram_check("telemetry_wide", "channel_a", "5"))
def histogram_channel(spark, folder):
    return stats.histogram(roles.telemetry_wide(spark, folder), "channel_a", 5)


@query(
    "series_sum",
    sql(
        "SELECT event_time, round(sum(energy), 2) AS sum_energy, "
        "round(sum(channel_a), 2) AS sum_channel_a, round(sum(channel_b), 2) AS sum_channel_b, "
        "round(sum(channel_c), 2) AS sum_channel_c FROM telemetry_wide GROUP BY event_time",
        "telemetry_wide",
    ),
)
def series_sum(spark, folder):
    readings = roles.telemetry_wide(spark, folder)
    measures = ["energy", *stats.channels_like(readings, "channel")]
    return rounded(stats.series_sum(readings, measures), 2)


@query(
    "selector_counts",
    sql(
        "SELECT asset_id, count(*) FILTER (energy > 100) AS matching_rows FROM telemetry "
        "GROUP BY asset_id",
        "telemetry",
    ),
)
def selector_counts(spark, folder):
    return reports.selector_counts(roles.telemetry(spark, folder), "asset_id", "energy > 100")


CHOSEN = 7  # the asset picked in the dashboard selector


@query(
    "asset_slice",
    sql(f"SELECT event_id, event_time, energy FROM telemetry WHERE asset_id = {CHOSEN}", "telemetry"),
)
def asset_slice(spark, folder):
    return reports.asset_slice(roles.telemetry(spark, folder), CHOSEN).select(
        "event_id", "event_time", "energy"
    )


@query(
    "asset_head",
    sql(
        f"SELECT event_id, event_time, energy FROM telemetry WHERE asset_id = {CHOSEN} "
        "ORDER BY event_time, event_id LIMIT 500",
        "telemetry",
    ),
)
def asset_head(spark, folder):
    """The chosen asset's first 500 readings."""
    return (
        reports.asset_slice(roles.telemetry(spark, folder), CHOSEN)
        .orderBy("event_time", "event_id").limit(500)
        .select("event_id", "event_time", "energy")
    )


@query(
    "example_asset",
    sql(
        "SELECT event_id, asset_id, energy FROM telemetry WHERE asset_id = "
        "(SELECT min(asset_id) FROM status_intervals WHERE abnormal_channel = 'channel_b')",
        "telemetry", "status_intervals",
    ),
)
def example_asset(spark, folder):
    """Readings of one example asset with a given label, found without leaving the plan."""
    example = reports.example_asset(
        roles.status_intervals(spark, folder), "abnormal_channel = 'channel_b'"
    )
    readings = roles.telemetry(spark, folder).select("event_id", "asset_id", "energy")
    return readings.join(example, "asset_id", "left_semi")


@query(
    "asset_counters",
    sql(
        f"""
        SELECT asset_id, model, CASE WHEN prediction = 'ok' THEN 'Healthy'
               ELSE 'Faulty (' || prediction || ')' END AS status,
               round(avg_energy, 6) AS avg_energy FROM status WHERE asset_id = {CHOSEN}""",
        "status",
    ),
)
def asset_counters(spark, folder):
    """Model, status and energy of the chosen asset; the filter moves below the aggregate."""
    chosen = reports.asset_slice(status_of(spark, folder), CHOSEN)
    latest = chosen.orderBy(F.col("bucket").desc()).limit(1)
    return rounded(
        reports.labelled_status(latest).select("asset_id", "model", "status", "avg_energy")
    )


@query(
    "forecast_times",
    "SELECT event_id, TIMESTAMP '2024-01-31 12:00:00' + INTERVAL 1 HOUR * "
    "CAST(json_extract_string(props, '$.k') AS BIGINT) AS due_time FROM events",
)
def forecast_times(spark, folder):
    """A fixed start plus as many hours as the auxiliary channel says."""
    readings = roles.telemetry(spark, folder).withColumn("hours", F.col("channel_k").cast("bigint"))
    return readings.select("event_id", hours_ahead(NOW, "hours").alias("due_time"))


@query(
    "forecast_hourly",
    """
    SELECT TIMESTAMP '2024-01-31 12:00:00' + INTERVAL 1 HOUR * hour(ts) AS hourly_time,
           round(sum(value * 0.9), 2) AS sum_low, round(sum(value * 1.1), 2) AS sum_high,
           round(sum(value), 2) AS sum_prediction
    FROM events GROUP BY 1""",
)
def forecast_hourly(spark, folder):
    """Next-day forecast by hour, its band derived from the hour's past energy."""
    readings = roles.telemetry(spark, folder).withColumn("hour", F.hour("event_time"))
    rows = readings.select(
        hours_ahead(NOW, "hour").alias("time"),
        (F.col("energy") * 0.9).alias("low"),
        (F.col("energy") * 1.1).alias("high"),
        F.col("energy").alias("prediction"),
    )
    return rounded(reports.forecast_hourly(rows), 2)


@query(
    "class_profile",
    sql(
        """
        SELECT abnormal_channel, count(*) AS row_count, round(avg(avg_energy), 6) AS avg_avg_energy,
               round(stddev_pop(avg_energy), 6) AS std_avg_energy,
               round(avg(std_energy), 6) AS avg_std_energy,
               round(stddev_pop(std_energy), 6) AS std_std_energy,
               round(corr(avg_energy, std_energy), 6) AS correlation
        FROM labelled GROUP BY abnormal_channel""",
        "labelled",
    ),
)
def class_profile(spark, folder):
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    training = gold.training_set(
        daily, roles.assets(spark, folder), roles.status_intervals(spark, folder)
    )
    return rounded(stats.class_profile(training, "abnormal_channel", "avg_energy", "std_energy"))
