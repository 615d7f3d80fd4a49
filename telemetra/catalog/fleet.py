"""Statistics, latest state, joins and quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.catalog.registry import query, rounded, sql
from telemetra.operators import joins, latest, quality, stats
from telemetra.plans import gold
from telemetra.sources import roles

CHANNELS = gold.CHANNELS


def _quantiles(column: str) -> str:
    points = ("0.1", "0.3", "0.6", "0.8", "0.95")
    return ", ".join(
        f"quantile_disc({column}, {p}) AS p{int(round(float(p) * 100))}_{column}" for p in points
    )


def _bucketed_check(grain: str) -> str:
    return sql(
        f"""
        SELECT asset_id, CAST(date_trunc('{grain}', event_time) AS TIMESTAMP) AS bucket,
               round(avg(energy), 6) AS avg_energy,
               round(stddev_pop(energy), 6) AS std_energy,
               round(stddev_pop(channel_k), 6) AS std_channel_k,
               {_quantiles('energy')}, {_quantiles('channel_k')}
        FROM clean GROUP BY ALL""",
        "clean",
    )


@query("hourly_stats", _bucketed_check("hour"))
def hourly_stats(spark, folder):
    hourly = gold.bucketed(roles.telemetry(spark, folder), "hour")
    return rounded(stats.spread_percentiles(hourly, CHANNELS))


@query("daily_stats", _bucketed_check("day"))
def daily_stats(spark, folder):
    daily = gold.bucketed(roles.telemetry(spark, folder), "day")
    return rounded(stats.spread_percentiles(daily, CHANNELS))


@query(
    "hourly_percentiles",
    sql(
        f"SELECT asset_id, {_quantiles('energy')} FROM clean GROUP BY asset_id", "clean"
    ),
)
def hourly_percentiles(spark, folder):
    """Percentiles over each asset's whole history."""
    clean = gold.clean_readings(roles.telemetry(spark, folder))
    whole = clean.groupBy("asset_id").agg(
        F.percentile_approx("energy", list(stats.PERCENTILES)).alias("percentiles_energy")
    )
    return stats.spread_percentiles(whole, ["energy"])


_WIDE = ("channel_a", "channel_b", "channel_c")


@query(
    "wide_stats",
    sql(
        "SELECT asset_id, CAST(date_trunc('month', event_time) AS TIMESTAMP) AS bucket, "
        "round(avg(energy), 6) AS avg_energy, "
        + ", ".join(f"round(stddev_pop({c}), 6) AS std_{c}" for c in _WIDE)
        + ", " + ", ".join(_quantiles(c) for c in _WIDE)
        + " FROM telemetry_wide GROUP BY ALL",
        "telemetry_wide",
    ),
)
def wide_stats(spark, folder):
    """Channels picked by name pattern, one set of aggregates generated for each."""
    readings = roles.telemetry_wide(spark, folder)
    channels = stats.channels_like(readings, "channel")
    monthly = stats.bucket_stats(readings, "energy", channels, "month")
    return rounded(stats.spread_percentiles(monthly, channels))


@query(
    "latest_per_asset",
    sql(
        "SELECT asset_id, bucket, round(avg_energy, 6) AS avg_energy, round(std_energy, 6) AS "
        "std_energy FROM latest",
        "latest",
    ),
)
def latest_per_asset(spark, folder):
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    return rounded(
        latest.latest_per_key(daily, ["asset_id"], "bucket").drop("std_channel_k")
    )


@query(
    "first_per_asset_hour",
    sql(
        "SELECT asset_id, bucket, round(avg_energy, 6) AS avg_energy, model, location "
        "FROM hourly JOIN assets USING (asset_id)",
        "hourly", "assets",
    ),
)
def first_per_asset_hour(spark, folder):
    hourly = gold.bucketed(roles.telemetry(spark, folder), "hour", percentiles=())
    current = gold.current_features_every_bucket(hourly, roles.assets(spark, folder))
    return rounded(current.select("asset_id", "bucket", "avg_energy", "model", "location"))


@query(
    "snapshot_by_key",
    "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1",
)
def snapshot_by_key(spark, folder):
    """Primary key and time key as parameters: each customer's latest order."""
    orders = roles.table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return latest.latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query(
    "dedupe_by_key",
    "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice FROM lineitem "
    "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey "
    "ORDER BY l_quantity, l_extendedprice) = 1",
)
def dedupe_by_key(spark, folder):
    lines = roles.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return latest.dedupe_by_key(lines, ["l_orderkey", "l_partkey"])


@query(
    "distinct_assets",
    "SELECT DISTINCT user_id AS asset_id, event_type FROM events",
)
def distinct_assets(spark, folder):
    return roles.telemetry(spark, folder).select("asset_id", "event_type").dropDuplicates()


@query(
    "enrich_assets",
    sql(
        "SELECT event_id, asset_id, energy, model, location, country FROM telemetry "
        "JOIN assets USING (asset_id)",
        "telemetry", "assets",
    ),
)
def enrich_assets(spark, folder):
    readings = roles.telemetry(spark, folder).select("event_id", "asset_id", "energy")
    assets = roles.assets(spark, folder).select("asset_id", "model", "location", "country")
    return joins.enrich(readings, assets)


_INTERVAL = """
    SELECT asset_id || '-' || start_time AS composite_key, asset_id, bucket,
           round(std_energy, 6) AS std_energy, abnormal_channel, start_time, end_time
    FROM labelled"""


@query("label_by_interval", sql(_INTERVAL, "labelled"))
def label_by_interval(spark, folder):
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    training = gold.training_set(
        daily, roles.assets(spark, folder), roles.status_intervals(spark, folder)
    )
    return rounded(
        training.select(
            "composite_key", "asset_id", "bucket", "std_energy", "abnormal_channel",
            "start_time", "end_time",
        )
    )


@query(
    "label_by_incident",
    sql(
        """
        SELECT h.asset_id, h.bucket, i.abnormal_channel, i.start_time, i.end_time
        FROM hourly h JOIN incidents i ON h.asset_id = i.asset_id
             AND i.start_time < epoch(h.bucket) AND i.end_time > epoch(h.bucket)""",
        "hourly", "incidents",
    ),
)
def label_by_incident(spark, folder):
    """Overlapping intervals: an hour inside two of them appears twice."""
    hourly = gold.bucketed(roles.telemetry(spark, folder), "hour", percentiles=())
    return joins.label_by_interval(
        hourly.select("asset_id", "bucket"), roles.incidents(spark, folder)
    ).select("asset_id", "bucket", "abnormal_channel", "start_time", "end_time")


@query(
    "label_by_key",
    sql(
        "SELECT asset_id, bucket, round(avg_energy, 6) AS avg_energy, model, abnormal_channel "
        "FROM daily JOIN assets USING (asset_id) JOIN status_intervals USING (asset_id)",
        "daily", "assets", "status_intervals",
    ),
)
def label_by_key(spark, folder):
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    labelled = joins.label_by_key(
        daily, roles.assets(spark, folder), roles.status_intervals(spark, folder)
    )
    return rounded(labelled.select("asset_id", "bucket", "avg_energy", "model", "abnormal_channel"))


@query(
    "feature_vector",
    sql(
        "SELECT asset_id, bucket, 2 AS vector_size, round(std_energy, 6) AS v0, "
        "round(std_channel_k, 6) AS v1 FROM labelled",
        "labelled",
    ),
)
def feature_vector(spark, folder):
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    training = gold.training_set(
        daily, roles.assets(spark, folder), roles.status_intervals(spark, folder)
    )
    vector = F.col("feature_vector")
    return rounded(
        training.select(
            "asset_id", "bucket", F.size(vector).alias("vector_size"),
            vector[0].alias("v0"), vector[1].alias("v1"),
        )
    )


@query(
    "asset_spec_lookup",
    sql(
        "SELECT t.asset_id, a.model, a.location, a.asset_id IS NOT NULL AS known "
        "FROM (SELECT DISTINCT asset_id FROM telemetry) t LEFT JOIN assets a USING (asset_id)",
        "telemetry", "assets",
    ),
)
def asset_spec_lookup(spark, folder):
    seen = roles.telemetry(spark, folder).select("asset_id").distinct()
    specs = roles.assets(spark, folder).select("asset_id", "model", "location")
    return joins.spec_lookup(seen, specs).select(
        "asset_id", "spec.model", "spec.location", F.col("spec").isNotNull().alias("known")
    )


@query(
    "rule_score",
    sql(
        "SELECT asset_id, bucket, round(avg_energy, 6) AS avg_energy, "
        "round(std_energy, 6) AS std_energy, model, location, country, prediction FROM status",
        "status",
    ),
)
def fleet_status(spark, folder):
    """Latest state of every known asset with its predicted fault."""
    status = gold.current_status(roles.telemetry(spark, folder), roles.assets(spark, folder))
    return rounded(
        status.select(
            "asset_id", "bucket", "avg_energy", "std_energy", "model", "location", "country",
            "prediction",
        )
    )


# --- quality ----------------------------------------------------------------------------

RULES = [
    quality.Expectation("has_asset", "asset_id IS NOT NULL"),
    quality.Expectation("positive_energy", "energy IS NOT NULL AND energy > 0", drop=True),
    quality.Expectation("strong_energy", "energy > 100"),
]

_CORRUPT = """
    SELECT event_id, CASE WHEN event_type = 'view' AND energy < 5 THEN NULL ELSE asset_id END AS asset_id,
           event_time, event_type, CASE WHEN energy < 3 THEN NULL ELSE energy END AS energy
    FROM telemetry"""


def corrupted(spark, folder):
    """Readings with seeded faults: weak energies and some asset ids go missing."""
    readings = roles.telemetry(spark, folder).drop("epoch_s", "channel_k")
    no_id = (F.col("event_type") == "view") & (F.col("energy") < 5)
    lost = quality.corrupt(readings, no_id, asset_id=F.lit(None).cast("bigint"))
    return quality.corrupt(lost, F.col("energy") < 3, energy=F.lit(None).cast("double")).select(
        "event_id", "asset_id", "event_time", "event_type", "energy"
    )


@query("corrupt_view", sql(_CORRUPT, "telemetry"))
def corrupt_view(spark, folder):
    return corrupted(spark, folder)


@query(
    "expect_drop",
    sql(
        "SELECT event_id, energy FROM bad WHERE energy IS NOT NULL AND energy > 0",
        "telemetry", bad=_CORRUPT,
    ),
)
def expect_drop(spark, folder):
    return quality.expect(corrupted(spark, folder), RULES).select("event_id", "energy")


@query(
    "expect_metrics",
    sql(
        """
        SELECT 'has_asset' AS rule, 'warn' AS action, count(*) AS total_rows,
               count(*) FILTER (asset_id IS NULL) AS failed_rows FROM bad
        UNION ALL SELECT 'positive_energy', 'drop', count(*),
               count(*) FILTER (energy IS NULL OR energy <= 0) FROM bad
        UNION ALL SELECT 'strong_energy', 'warn', count(*),
               count(*) FILTER (energy IS NULL OR energy <= 100) FROM bad""",
        "telemetry", bad=_CORRUPT,
    ),
)
def expect_metrics(spark, folder):
    return quality.expectation_metrics(corrupted(spark, folder), RULES)


@query(
    "pk_violations",
    sql(
        "SELECT asset_id, count(*) AS row_count FROM hourly GROUP BY asset_id HAVING count(*) > 1",
        "hourly",
    ),
)
def pk_violations(spark, folder):
    """The key declared for the hourly features does not hold: hours repeat the asset."""
    hourly = gold.bucketed(roles.telemetry(spark, folder), "hour", percentiles=())
    return quality.key_violations(hourly, ["asset_id"])
