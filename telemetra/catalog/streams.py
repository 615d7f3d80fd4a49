"""Streaming jobs, drained so that their result can be compared with a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.catalog.fleet import RULES
from telemetra.catalog.landing import READING_COLUMNS, landing_copy, plain_readings
from telemetra.catalog.registry import query, rounded, sql
from telemetra.plans import gold, refresh
from telemetra.schemas import READING
from telemetra.session import scratch_path
from telemetra.sources import roles
from telemetra.sources.rescue import RESCUED
from telemetra.streaming import hourly, ingest

UNTIMED = type(READING)([f for f in READING if f.name != "event_time"])


@query(
    "ingest_json_stream",
    sql(f"SELECT {READING_COLUMNS}, CAST(NULL AS VARCHAR) AS rescued FROM telemetry", "telemetry"),
)
def ingest_json_stream(spark, folder):
    """JSON lines as a stream, with what does not fit kept aside (here: nothing)."""
    landing = landing_copy(spark, plain_readings(spark, folder), "json-landing")
    target = scratch_path(spark, "json-bronze")
    ingest.finish(
        ingest.ingest_folder(
            spark, landing, "json", scratch_path(spark, "json-checkpoint"), path=target,
            schema=UNTIMED, rescue=True,
        )
    )
    return spark.read.parquet(target).select(
        *READING_COLUMNS.split(", "), F.col(RESCUED).alias("rescued")
    )


@query(
    "ingest_parquet_stream",
    sql(f"SELECT {READING_COLUMNS} FROM telemetry WHERE energy > 0", "telemetry"),
)
def ingest_parquet_stream(spark, folder):
    landing = landing_copy(spark, plain_readings(spark, folder), "parquet-landing", "parquet")
    target = scratch_path(spark, "parquet-bronze")
    ingest.finish(
        ingest.ingest_folder(
            spark, landing, "parquet", scratch_path(spark, "parquet-checkpoint"), path=target,
            schema=UNTIMED, rules=gold.READING_RULES,
        )
    )
    return spark.read.parquet(target).select(*READING_COLUMNS.split(", "))


@query(
    "continuous_ingest",
    sql(f"SELECT {READING_COLUMNS} FROM telemetry WHERE energy > 0", "telemetry"),
)
def continuous_ingest(spark, folder):
    """A job that keeps running, stopped once everything landed so far is stored."""
    landing = landing_copy(spark, plain_readings(spark, folder), "continuous-landing", "parquet")
    target = scratch_path(spark, "continuous-bronze")
    job = ingest.ingest_folder(
        spark, landing, "parquet", scratch_path(spark, "continuous-checkpoint"), path=target,
        schema=UNTIMED, rules=gold.READING_RULES, every="1 second",
    )
    try:
        job.processAllAvailable()
    finally:
        job.stop()
    return spark.read.parquet(target).select(*READING_COLUMNS.split(", "))


@query(
    "ingest_folder",
    sql("SELECT asset_id, model, lat, lon, location, country, CAST(site_id AS BIGINT) AS site_id "
        "FROM assets", "assets"),
)
def ingest_folder(spark, folder):
    """Schema inferred and stored, files drained into a table."""
    landing = landing_copy(spark, roles.assets(spark, folder), "asset-landing")
    table = "telemetra_bronze_" + scratch_path(spark, "x")[-12:]
    spark.sql(
        f"CREATE TABLE {table} (asset_id BIGINT, country STRING, lat STRING, location STRING, "
        f"lon STRING, model STRING, site_id BIGINT, {RESCUED} STRING) USING parquet "
        f"LOCATION '{scratch_path(spark, 'asset-bronze')}'"
    )
    ingest.finish(
        ingest.ingest_folder(
            spark, landing, "json", scratch_path(spark, "asset-checkpoint"), table=table,
            schema_store=scratch_path(spark, "asset-schema"),
        )
    )
    return spark.table(table).select(
        "asset_id", "model", "lat", "lon", "location", "country", "site_id"
    )


@query(
    "restart_idempotent",
    "SELECT 1 AS run, count(*) AS row_count FROM events UNION ALL SELECT 2, count(*) FROM events",
)
def restart_idempotent(spark, folder):
    """A second run on the same checkpoint adds nothing."""
    landing = landing_copy(spark, plain_readings(spark, folder), "restart-landing", "parquet")
    target = scratch_path(spark, "restart-bronze")
    checkpoint = scratch_path(spark, "restart-checkpoint")
    counts = []
    for run in (1, 2):
        ingest.finish(
            ingest.ingest_folder(
                spark, landing, "parquet", checkpoint, path=target, schema=UNTIMED
            )
        )
        counts.append((run, spark.read.parquet(target).count()))
    return spark.createDataFrame(counts, "run int, row_count bigint")


@query(
    "evolve_schema",
    sql(
        """
        SELECT event_id, energy, CASE WHEN event_type = 'error' THEN channel_k END AS channel_k,
               CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS units,
               CASE WHEN event_type = 'error' THEN '{"units":"' || event_id || '.5"}' END AS rescued
        FROM telemetry""",
        "telemetry",
    ),
)
def evolve_schema(spark, folder):
    """Errors arrive later and bring a new column, by which the stored schema grows, and
    fractions in a column stored as whole numbers, which are rescued."""
    readings = roles.telemetry(spark, folder)
    late = F.col("event_type") == "error"
    landing = landing_copy(spark, readings.where(~late).select(
        "event_id", "energy", F.col("event_id").alias("units")), "evolving")
    target = scratch_path(spark, "evolving-bronze")
    checkpoint = scratch_path(spark, "evolving-checkpoint")
    store = scratch_path(spark, "evolving-schema")

    def drain():
        ingest.finish(
            ingest.ingest_folder(
                spark, landing, "json", checkpoint, path=target, schema_store=store
            )
        )

    drain()
    half = F.concat("event_id", F.lit(".5")).cast("decimal(22,1)").alias("units")
    readings.where(late).select("event_id", "energy", "channel_k", half).write.mode(
        "append").json(landing)
    drain()
    return (
        spark.read.option("mergeSchema", "true").parquet(target)
        .select("event_id", "energy", "channel_k", "units", F.col(RESCUED).alias("rescued"))
    )


TIMED = type(READING)([f for f in READING if f.name != "epoch_s"])


def timed_stream(spark, landing):
    return ingest.read_folder(spark, landing, "parquet", schema=TIMED)


_HOURLY = """
    SELECT asset_id, CAST(date_trunc('hour', event_time) AS TIMESTAMP) AS bucket,
           count(*) AS reading_count, round(avg(energy), 6) AS avg_energy,
           round(stddev_pop(channel_k), 6) AS std_channel_k FROM {rows} GROUP BY ALL"""


def _stats(stream):
    return hourly.windowed_stats(stream, "energy", ["channel_k"])


def _shape(df):
    return rounded(df.select("asset_id", "bucket", "reading_count", "avg_energy", "std_channel_k"))


@query("stream_hourly", sql(_HOURLY.format(rows="telemetry"), "telemetry"))
def stream_hourly(spark, folder):
    """Changed windows are upserted; the newest versions equal the batch result."""
    readings = roles.telemetry(spark, folder).drop("epoch_s")
    landing = landing_copy(spark, readings, "hourly-landing", "parquet")
    target = scratch_path(spark, "hourly-upserts")
    ingest.finish(
        hourly.upsert_changed(
            _stats(timed_stream(spark, landing)), target, scratch_path(spark, "hourly-checkpoint")
        )
    )
    return _shape(hourly.read_upserts(spark, target))


@query(
    "stream_hourly_append",
    sql(
        "SELECT * FROM windows WHERE bucket + INTERVAL 1 HOUR <= "
        "(SELECT max(event_time) FROM telemetry) - INTERVAL 3 HOUR",
        "telemetry", windows=_HOURLY.format(rows="telemetry"),
    ),
)
def stream_hourly_append(spark, folder):
    """Only windows older than the permitted lateness are written, each once."""
    readings = roles.telemetry(spark, folder).drop("epoch_s")
    landing = landing_copy(spark, readings, "append-landing", "parquet")
    target = scratch_path(spark, "append-windows")
    ingest.finish(
        hourly.append_closed(
            _stats(timed_stream(spark, landing)), target, scratch_path(spark, "append-checkpoint")
        )
    )
    return _shape(spark.read.parquet(target))


@query(
    "late_rows",
    sql(
        _HOURLY.format(rows="accepted"),
        "telemetry",
        accepted="""
        SELECT * FROM telemetry WHERE event_type <> 'signup'
            OR date_trunc('hour', event_time) + INTERVAL 1 HOUR > (
                SELECT max(event_time) FROM telemetry WHERE event_type <> 'signup')
                - INTERVAL 3 HOUR""",
    ),
)
def late_rows(spark, folder):
    """Signups arrive after everything else; those behind the watermark are left out."""
    readings = roles.telemetry(spark, folder).drop("epoch_s")
    tardy = F.col("event_type") == "signup"
    landing = landing_copy(spark, readings.where(~tardy), "late-landing", "parquet")
    target = scratch_path(spark, "late-upserts")
    checkpoint = scratch_path(spark, "late-checkpoint")
    ingest.finish(hourly.upsert_changed(_stats(timed_stream(spark, landing)), target, checkpoint))
    readings.where(tardy).write.mode("append").parquet(landing)
    ingest.finish(hourly.upsert_changed(_stats(timed_stream(spark, landing)), target, checkpoint))
    return _shape(hourly.read_upserts(spark, target))


@query(
    "stream_expect",
    """
    SELECT 'rows' AS counter, count(*) AS value FROM events
    UNION ALL SELECT 'failed_has_asset', count(*) FILTER (user_id IS NULL) FROM events
    UNION ALL SELECT 'failed_positive_energy', count(*) FILTER (value IS NULL OR value <= 0) FROM events
    UNION ALL SELECT 'failed_strong_energy', count(*) FILTER (value IS NULL OR value <= 100) FROM events""",
)
def stream_expect(spark, folder):
    """Rule counters kept beside the stream, one file per micro-batch."""
    landing = landing_copy(spark, plain_readings(spark, folder), "expect-landing", "parquet")
    kept = scratch_path(spark, "expect-counters")
    ingest.finish(
        ingest.count_rules(
            ingest.read_folder(spark, landing, "parquet", schema=UNTIMED, files_per_trigger=1),
            RULES, kept, scratch_path(spark, "expect-checkpoint"),
        )
    )
    return ingest.rule_totals(spark, kept)


def landed(spark, folder):
    return refresh.Landing(
        readings=landing_copy(spark, roles.telemetry(spark, folder), "raw-readings", "parquet"),
        assets=landing_copy(spark, roles.assets(spark, folder), "raw-assets"),
        intervals=landing_copy(spark, roles.status_intervals(spark, folder), "raw-intervals"),
    )


@query(
    "end_to_end_status",
    sql(
        "SELECT asset_id, bucket, round(avg_energy, 6) AS avg_energy, model, location, prediction "
        "FROM status",
        "status",
    ),
)
def end_to_end_status(spark, folder):
    """Raw files through streams and stored tables to scored assets."""
    tables = refresh.run_all(
        spark, landed(spark, folder), scratch_path(spark, "end-to-end"), grain="day"
    )
    return rounded(
        tables["status"].select(
            "asset_id", "bucket", "avg_energy", "model", "location", "prediction"
        )
    )


@query(
    "end_to_end_training",
    sql(
        "SELECT asset_id || '-' || start_time AS composite_key, bucket, "
        "round(std_energy, 6) AS v0, abnormal_channel FROM labelled",
        "labelled",
    ),
)
def end_to_end_training(spark, folder):
    """The labelled training table of the same run."""
    tables = refresh.run_all(
        spark, landed(spark, folder), scratch_path(spark, "end-to-end"), grain="day"
    )
    return rounded(
        tables["training"].select(
            "composite_key", "bucket", F.col("feature_vector")[0].alias("v0"), "abnormal_channel"
        )
    )


@query(
    "refresh_metrics",
    sql(
        """
        SELECT 'readings' AS source, 'rows' AS counter, count(*) AS value FROM telemetry
        UNION ALL SELECT 'readings', 'failed_has_asset', count(*) FILTER (asset_id IS NULL) FROM telemetry
        UNION ALL SELECT 'readings', 'failed_positive_energy',
                         count(*) FILTER (energy IS NULL OR energy <= 0) FROM telemetry
        UNION ALL SELECT 'readings', 'failed_correct_schema', 0 * count(*) FROM telemetry
        UNION ALL SELECT 'assets', 'rows', count(*) FROM assets
        UNION ALL SELECT 'assets', 'failed_correct_schema', 0 * count(*) FROM assets
        UNION ALL SELECT 'intervals', 'rows', count(*) FROM status_intervals
        UNION ALL SELECT 'intervals', 'failed_correct_schema', 0 * count(*) FROM status_intervals""",
        "telemetry", "assets", "status_intervals",
    ),
)
def refresh_metrics(spark, folder):
    """The rule counters that a refresh leaves behind."""
    root = scratch_path(spark, "refresh")
    refresh.refresh_bronze(spark, landed(spark, folder), root)
    return refresh.rule_metrics(spark, root)
