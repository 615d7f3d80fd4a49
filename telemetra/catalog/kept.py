"""Stored tables that change, incremental refresh, stored sketches, streams with state."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.catalog.landing import landing_copy
from telemetra.catalog.registry import query, rounded, sql
from telemetra.catalog.streams import TIMED, timed_stream
from telemetra.catalog.upkeep import _CHANGED, _NEWEST, queue_of, work_reports
from telemetra.operators import stats
from telemetra.operators.stored import StoredTable, daily, hashed
from telemetra.plans import gold, refresh
from telemetra.schemas import STATUS_INTERVAL
from telemetra.session import scratch_path
from telemetra.sources import roles
from telemetra.sources.files import list_files
from telemetra.streaming import ingest, labels

NOTED = ["status", "technician_notes", "last_updated"]


def stored_queue(spark, folder):
    table = StoredTable(spark, scratch_path(spark, "stored-queue"))
    table.create(queue_of(spark, folder), ["asset_id"], hashed(["asset_id"], 16))
    return table


@query("stored_update", sql(_CHANGED, "queue", "telemetry", newest=_NEWEST))
def stored_update(spark, folder):
    """Work reports written into the stored queue."""
    table = stored_queue(spark, folder)
    table.update(work_reports(spark, folder), NOTED, "last_updated")
    return table.read()


@query("stored_update_before", sql("SELECT * FROM queue", "queue"))
def stored_update_before(spark, folder):
    """The version before the update is still there."""
    table = stored_queue(spark, folder)
    table.update(work_reports(spark, folder), NOTED, "last_updated")
    return table.read(version=1)


def stored_orders(spark, folder):
    table = StoredTable(spark, scratch_path(spark, "stored-orders"))
    table.create(roles.table(spark, folder, "orders"), ["o_orderkey"], hashed(["o_orderkey"], 32))
    return table


@query(
    "stored_delete",
    "SELECT o_orderkey, o_totalprice FROM orders "
    "WHERE (o_orderstatus = 'F' AND o_totalprice < 100000) IS NOT TRUE",
)
def stored_delete(spark, folder):
    table = stored_orders(spark, folder)
    table.delete((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000))
    return table.read().select("o_orderkey", "o_totalprice")


@query(
    "stored_upsert",
    "SELECT o_orderkey, o_totalprice + CASE WHEN o_orderstatus = 'O' THEN 5 ELSE 0 END AS o_totalprice "
    "FROM orders UNION ALL SELECT -1 - o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'",
)
def stored_upsert(spark, folder):
    """Open orders repriced and part orders added under new keys, in one change."""
    table = stored_orders(spark, folder)
    orders = roles.table(spark, folder, "orders")
    dearer = orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 5)
    added = orders.where("o_orderstatus = 'P'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    table.upsert(dearer.unionByName(added))
    return table.read().select("o_orderkey", "o_totalprice")


@query(
    "stored_untouched",
    "SELECT count(*) - 1 AS row_count, true AS one_folder_written, true AS old_files_unchanged FROM orders",
)
def stored_untouched(spark, folder):
    """Deleting the smallest key writes one of 32 folders; all earlier files stay as they were."""
    table = stored_orders(spark, folder)

    def files():
        return {(r["path"], r["size"], r["modified"])
                for r in list_files(spark, f"{table.path}/data", "*.parquet").collect()}

    before = files()
    smallest = table.read().agg(F.min("o_orderkey")).first()[0]
    table.delete(F.col("o_orderkey") == smallest)
    written = table.log().where("version = 2").first()["folders_written"]
    folders = {p for p, *_ in files() - before}
    return table.read().agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(written == 1 and len({f.rsplit("/", 1)[0] for f in folders}) == 1).alias("one_folder_written"),
        F.lit(before <= files()).alias("old_files_unchanged"))


# --- incremental refresh ----------------------------------------------------------------


def two_landings(spark, folder, grain):
    """Readings land in two parts that share buckets, metadata and intervals too."""
    readings = roles.telemetry(spark, folder)
    assets, intervals = roles.assets(spark, folder), roles.status_intervals(spark, folder)
    late = F.col("event_type").isin("click", "error") | (F.col("asset_id") % 7 == 3)
    paths = [scratch_path(spark, n) for n in ("two-readings", "two-assets", "two-intervals")]
    landing, root = refresh.Landing(*paths), scratch_path(spark, "two-landings")
    for part in (0, 1):
        now = late if part else ~late
        readings.where(now).write.mode("append").parquet(landing.readings)
        chosen = F.col("asset_id") % 2 == part
        assets.where(chosen).write.mode("append").json(landing.assets)
        intervals.where(chosen).write.mode("append").json(landing.intervals)
        tables = refresh.run_all(spark, landing, root, grain)
    return tables, root


@query(
    "incremental_status",
    sql("SELECT asset_id, bucket, round(avg_energy, 6) AS avg_energy, round(std_energy, 6) AS std_energy, "
        "model, location, prediction FROM status", "status"),
)
def incremental_status(spark, folder):
    """Two landings, each merged into what was stored, give the rows of one full run."""
    tables, _ = two_landings(spark, folder, "day")
    return rounded(tables["status"].select(
        "asset_id", "bucket", "avg_energy", "std_energy", "model", "location", "prediction"))


@query(
    "incremental_training",
    sql("SELECT asset_id || '-' || start_time AS composite_key, bucket, round(std_energy, 6) AS v0, "
        "abnormal_channel FROM labelled", "labelled"),
)
def incremental_training(spark, folder):
    tables, _ = two_landings(spark, folder, "day")
    return rounded(tables["training"].select(
        "composite_key", "bucket", F.col("feature_vector")[0].alias("v0"), "abnormal_channel"))


@query(
    "incremental_reads",
    """
    SELECT CAST(0 AS BIGINT) AS batch, count(*) AS reading_count FROM events
    WHERE value > 0 AND NOT (event_type IN ('click', 'error') OR user_id % 7 = 3)
    UNION ALL SELECT 1, count(*) FROM events
    WHERE value > 0 AND (event_type IN ('click', 'error') OR user_id % 7 = 3)""",
)
def incremental_reads(spark, folder):
    """Readings behind the states of each run: the second run took in the second landing only."""
    _, root = two_landings(spark, folder, "day")
    return spark.read.parquet(f"{root}/states/readings").groupBy(
        F.col("batch").cast("bigint").alias("batch")).agg(F.sum("n_energy").alias("reading_count"))


# --- stored sketches --------------------------------------------------------------------

SHARES = list(stats.PERCENTILES)


def hourly_sketches(spark, folder):
    states = stats.channel_states(
        gold.clean_readings(roles.telemetry(spark, folder)), gold.CHANNELS, "hour")
    table = StoredTable(spark, scratch_path(spark, "sketches"))
    table.create(states, ["asset_id", "bucket"], daily("bucket"))
    return table.read()


@query(
    "sketch_day_ranks",
    sql(
        """
        SELECT asset_id, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS day, count(*) AS reading_count,
               true AS within_one_percent FROM clean GROUP BY ALL""",
        "clean",
    ),
)
def sketch_day_ranks(spark, folder):
    """Hourly sketches merged to days: every quantile's true rank is within 1 % of the wish.

    Raw readings are read for the comparison only; a quantile is right if the share of readings
    below it and the share up to it enclose the wish within the margin.
    """
    by_day = hourly_sketches(spark, folder).withColumn("day", F.date_trunc("day", "bucket"))
    merged = stats.merged_states(by_day, gold.CHANNELS, "asset_id", "day")
    found = merged.select(
        "asset_id", "day", stats.sketch_quantiles("sketch_energy", "n_energy", SHARES).alias("q"))
    raw = gold.clean_readings(roles.telemetry(spark, folder)).select(
        "asset_id", F.date_trunc("day", "event_time").alias("day"), "energy")
    return _judged(raw.join(found, ["asset_id", "day"]), "asset_id", "day")


@query(
    "sketch_fleet_ranks",
    sql("SELECT count(*) AS reading_count, true AS within_one_percent FROM clean", "clean"),
)
def sketch_fleet_ranks(spark, folder):
    """All sketches merged to one for the fleet; one row, so it is broadcast as a literal."""
    merged = stats.merged_states(hourly_sketches(spark, folder), gold.CHANNELS)
    cuts = merged.select(stats.sketch_quantiles("sketch_energy", "n_energy", SHARES).alias("q")).first()["q"]
    raw = gold.clean_readings(roles.telemetry(spark, folder)).select("energy")
    return _judged(raw.withColumn("q", F.array(*[F.lit(float(c)) for c in cuts or SHARES])))


def _judged(rows, *by):
    n = F.count(F.lit(1))
    good = F.lit(True)
    for i, share in enumerate(SHARES):
        below = F.count_if(F.col("energy") < F.col("q")[i]) / n
        upto = F.count_if(F.col("energy") <= F.col("q")[i]) / n
        # one reading more or less is no error of the sketch
        margin = 0.01 + 1 / n
        good = good & (below <= share + margin) & (upto >= share - margin)
    return rows.groupBy(*by).agg(n.alias("reading_count"), good.alias("within_one_percent"))


# --- streams with state -----------------------------------------------------------------


@query(
    "stream_label_by_interval",
    sql(
        """
        SELECT t.event_id, t.asset_id, i.abnormal_channel, i.start_time, i.end_time
        FROM telemetry t JOIN incidents i ON t.asset_id = i.asset_id
             AND i.start_time * 1000000 < epoch_us(t.event_time)
             AND i.end_time * 1000000 > epoch_us(t.event_time)""",
        "telemetry", "incidents",
    ),
)
def stream_label_by_interval(spark, folder):
    """Readings and intervals both arrive in order of time, in three parts each."""
    readings = roles.telemetry(spark, folder).drop("epoch_s")
    incidents = roles.incidents(spark, folder)
    cuts = readings.agg(F.percentile_approx(F.unix_seconds("event_time"), [0.33, 0.66]).alias("c")).first()["c"]
    days = [c // labels.DAY * labels.DAY for c in cuts or [0, 0]]
    landed, spans, target = (scratch_path(spark, n) for n in ("label-readings", "label-spans", "label-out"))
    checkpoint = scratch_path(spark, "label-checkpoint")
    for low, high in zip([None, *days], [*days, None]):
        for df, path, at in ((readings, landed, F.unix_seconds("event_time")), (incidents, spans, F.col("start_time"))):
            part = df if low is None else df.where(at >= low)
            part = part if high is None else part.where(at < high)
            part.write.mode("append").parquet(path)
        stream = labels.label_stream(
            timed_stream(spark, landed).select("event_id", "asset_id", "event_time"),
            ingest.read_folder(spark, spans, "parquet", schema=STATUS_INTERVAL))
        ingest.finish(ingest.write_stream(stream, checkpoint, target))
    return spark.read.parquet(target).select(
        "event_id", "asset_id", "abnormal_channel", "start_time", "end_time")


@query(
    "stream_without_copies",
    sql("SELECT event_id, asset_id, energy FROM telemetry", "telemetry"),
)
def stream_without_copies(spark, folder):
    """Every reading lands twice in one file, again in the next, and again after a restart."""
    readings = roles.telemetry(spark, folder).drop("epoch_s")
    landing = landing_copy(spark, readings.unionByName(readings), "copies-landing", "parquet")
    target, checkpoint = scratch_path(spark, "copies-bronze"), scratch_path(spark, "copies-checkpoint")
    for _ in range(2):
        readings.write.mode("append").parquet(landing)
        ingest.finish(ingest.ingest_folder(
            spark, landing, "parquet", checkpoint, path=target, schema=TIMED,
            unique=["event_id"], lateness="30 days"))
    return spark.read.parquet(target).select("event_id", "asset_id", "energy")
