"""Maintenance queue, table changes, snapshots and secured parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from telemetra.catalog.columns import NOW, TODAY
from telemetra.catalog.registry import query, sql
from telemetra.catalog.reports import status_of
from telemetra.operators import access, changes
from telemetra.plans import gold, queue as queues
from telemetra.session import scratch_path
from telemetra.sources import roles


def queue_of(spark, folder):
    return queues.build_queue(status_of(spark, folder), NOW)


@query("queue_build", sql("SELECT * FROM queue", "queue"))
def queue_build(spark, folder):
    return queue_of(spark, folder)


@query(
    "queue_build_repeats",
    sql(
        """
        SELECT asset_id, location, prediction AS predicted_failure_type, 'Pending' AS status
        FROM (SELECT d.*, location, CASE WHEN std_energy > 60 THEN 'channel_b'
                     WHEN avg_energy < 25 THEN 'channel_d' WHEN avg_energy > 120 THEN 'channel_f'
                     ELSE 'ok' END AS prediction
              FROM daily d JOIN assets a USING (asset_id))
        WHERE prediction <> 'ok'
        QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY bucket DESC) = 1""",
        "daily", "assets",
    ),
)
def queue_build_repeats(spark, folder):
    """From a status table that holds every bucket: the latest faulty one per asset."""
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    scored = gold.score(gold.current_features_every_bucket(daily, roles.assets(spark, folder)))
    return queues.build_queue(scored, NOW).select(
        "asset_id", "location", "predicted_failure_type", "status"
    )


@query(
    "queue_flagged_now",
    sql("SELECT asset_id, status, true AS just_flagged FROM queue", "queue"),
)
def queue_flagged_now(spark, folder):
    """Without a given moment, entries carry the time at which the query runs."""
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("flagged_at")
    return queues.build_queue(status_of(spark, folder)).select(
        "asset_id", "status",
        (age.between(0, 86_400) & (F.col("flagged_at") == F.col("last_updated"))).alias("just_flagged"),
    )


@query("queue_sorted", sql("SELECT * FROM queue ORDER BY severity_score DESC, asset_id", "queue"))
def queue_sorted(spark, folder):
    return queues.sorted_queue(queue_of(spark, folder))


@query(
    "severity_band",
    sql(
        "SELECT asset_id, severity_score, CASE WHEN severity_score > 0.7 THEN 'High' "
        "WHEN severity_score >= 0.4 THEN 'Medium' ELSE 'Low' END AS severity_level FROM queue",
        "queue",
    ),
)
def severity_band(spark, folder):
    return queues.banded(queue_of(spark, folder)).select(
        "asset_id", "severity_score", "severity_level"
    )


SEARCH_TERM = "nation_1"


@query(
    "search_queue",
    sql(
        f"SELECT asset_id, location, status FROM queue WHERE status IN ('Pending', 'In Progress') "
        f"AND (CAST(asset_id AS VARCHAR) ILIKE '%{SEARCH_TERM.replace('_', '!_')}%' ESCAPE '!' "
        f"OR location ILIKE '%{SEARCH_TERM.replace('_', '!_')}%' ESCAPE '!')",
        "queue",
    ),
)
def search_queue(spark, folder):
    found = queues.filtered(queue_of(spark, folder), ["Pending", "In Progress"], SEARCH_TERM)
    return found.select("asset_id", "location", "status")


@query(
    "queue_shown_counts",
    sql(
        f"SELECT count(*) FILTER (contains(lower(location), '{SEARCH_TERM}') "
        f"OR contains(CAST(asset_id AS VARCHAR), '{SEARCH_TERM}')) AS shown, "
        "count(*) AS total FROM queue",
        "queue",
    ),
)
def queue_shown_counts(spark, folder):
    return queues.shown_counts(queue_of(spark, folder), queues.STATUSES, SEARCH_TERM)


# Updates: error readings report work on their asset; the newest per asset counts.
_CHANGED = """
    SELECT q.asset_id, location, predicted_failure_type, severity_score,
           coalesce(u.status, q.status) AS status, flagged_at,
           CASE WHEN u.asset_id IS NULL THEN q.technician_notes ELSE u.note END AS technician_notes,
           coalesce(u.event_time, q.last_updated) AS last_updated
    FROM queue q LEFT JOIN newest u ON q.asset_id = u.asset_id"""
_NEWEST = """
    SELECT asset_id, event_time, CASE WHEN energy > 50 THEN 'Resolved' ELSE 'In Progress' END AS status,
           CASE WHEN channel_k > 20 THEN 'k ''' || CAST(CAST(channel_k AS BIGINT) AS VARCHAR) || ''''
                END AS note
    FROM telemetry WHERE event_type = 'error'
    QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY event_time DESC, event_id) = 1"""


def work_reports(spark, folder):
    number = F.col("channel_k").cast("bigint").cast("string")
    note = F.when(F.col("channel_k") > 20, F.concat(F.lit("k '"), number, F.lit("'")))
    return (
        roles.telemetry(spark, folder).where(F.col("event_type") == "error")
        .select(
            "asset_id",
            F.when(F.col("energy") > 50, "Resolved").otherwise("In Progress").alias("status"),
            note.alias("technician_notes"),
            F.col("event_time").alias("last_updated"),
        )
    )


def updated_queue(spark, folder):
    return changes.apply_updates(
        queue_of(spark, folder), work_reports(spark, folder), "asset_id",
        ["status", "technician_notes", "last_updated"], "last_updated",
    )


@query("apply_updates", sql(_CHANGED, "queue", "telemetry", newest=_NEWEST))
def apply_updates(spark, folder):
    return updated_queue(spark, folder)


@query(
    "queue_today_counts",
    sql(
        "SELECT count(*) FILTER (status = 'Pending') AS pending, "
        "count(*) FILTER (status = 'In Progress') AS in_progress, "
        "count(*) FILTER (status = 'Resolved') AS resolved "
        "FROM changed WHERE CAST(flagged_at AS DATE) = DATE '2024-01-31'",
        "queue", "telemetry", newest=_NEWEST, changed=_CHANGED,
    ),
)
def queue_today_counts(spark, folder):
    return queues.counts_on(updated_queue(spark, folder), TODAY)


@query(
    "delete_where",
    "SELECT o_orderkey, o_totalprice FROM orders "
    "WHERE (o_orderstatus = 'F' AND o_totalprice < 100000) IS NOT TRUE",
)
def delete_where(spark, folder):
    bad = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000)
    return changes.delete_where(roles.table(spark, folder, "orders"), bad).select(
        "o_orderkey", "o_totalprice"
    )


# --- snapshots --------------------------------------------------------------------------


def order_versions(spark, folder):
    """Open orders first; later cheap finished ones leave, urgent ones are repriced, the rest come."""
    orders = roles.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    first = orders.where(F.col("o_orderstatus") != "O")
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000)
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(
        F.col("o_totalprice")
    )
    second = orders.where(~gone).withColumn("o_totalprice", price)
    return first, second


_FIRST = (
    "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders "
    "WHERE o_orderstatus <> 'O'"
)
_SECOND = (
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' "
    "THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders "
    "WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 100000)"
)


def stored_versions(spark, folder, label):
    first, second = order_versions(spark, folder)
    path = scratch_path(spark, label)
    changes.write_snapshot(first, path, 1)
    changes.write_snapshot(second, path, 2)
    return path


@query(
    "snapshot_diff",
    sql(
        """
        SELECT o_orderkey, 'insert' AS change_type, n.* EXCLUDE (o_orderkey) FROM n_only n
        UNION ALL SELECT o_orderkey, 'delete', o.* EXCLUDE (o_orderkey) FROM o_only o
        UNION ALL SELECT a.o_orderkey, 'update_before', a.* EXCLUDE (o_orderkey)
            FROM a JOIN b USING (o_orderkey) WHERE a.o_totalprice <> b.o_totalprice
        UNION ALL SELECT b.o_orderkey, 'update_after', b.* EXCLUDE (o_orderkey)
            FROM a JOIN b USING (o_orderkey) WHERE a.o_totalprice <> b.o_totalprice""",
        a=_FIRST, b=_SECOND,
        n_only="SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)",
        o_only="SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)",
    ),
)
def snapshot_diff(spark, folder):
    first, second = order_versions(spark, folder)
    return changes.snapshot_diff(first, second, ["o_orderkey"])


@query("apply_feed", _SECOND)
def apply_feed(spark, folder):
    """The change feed rolled onto the old version gives the new one."""
    first, second = order_versions(spark, folder)
    feed = changes.snapshot_diff(first, second, ["o_orderkey"])
    return changes.apply_feed(first, feed, ["o_orderkey"])


@query("as_of_snapshot", _FIRST)
def as_of_snapshot(spark, folder):
    path = stored_versions(spark, folder, "as-of")
    return changes.as_of(changes.read_snapshots(spark, path), 1)


@query("as_of_time", _FIRST)
def as_of_time(spark, folder):
    """Between the two commits the first version is the newest."""
    path = stored_versions(spark, folder, "as-of-time")
    commits = [(1, dt.datetime(2024, 1, 1, 8)), (2, dt.datetime(2024, 1, 2, 8))]
    history = spark.createDataFrame(commits, "snapshot_id int, committed_at timestamp")
    return changes.as_of_time(
        changes.read_snapshots(spark, path), history, dt.datetime(2024, 1, 2, 7))


@query("clone_snapshot", _SECOND)
def clone_snapshot(spark, folder):
    """The copy keeps the second version when the original's folder is written anew."""
    path, copy = stored_versions(spark, folder, "clone"), scratch_path(spark, "cloned")
    changes.clone_snapshot(spark, path, 2, copy)
    changes.restore_snapshot(spark, path, 1, 2)
    return spark.read.parquet(copy)


@query("restore_snapshot", _FIRST)
def restore_snapshot(spark, folder):
    path = stored_versions(spark, folder, "restore")
    changes.restore_snapshot(spark, path, 1, 3)
    return changes.as_of(changes.read_snapshots(spark, path), 3)


@query(
    "snapshot_history",
    sql(
        "SELECT 1 AS snapshot_id, 'write' AS operation, count(*) AS row_count FROM a "
        "UNION ALL SELECT 2, 'reprice', count(*) FROM b",
        a=_FIRST, b=_SECOND,
    ),
)
def snapshot_history(spark, folder):
    path = stored_versions(spark, folder, "history")
    operations = spark.createDataFrame([(1, "write"), (2, "reprice")], "snapshot_id int, operation string")
    return changes.snapshot_history(changes.read_snapshots(spark, path), operations)


# --- secured parts ----------------------------------------------------------------------

# Who may see which depot.
GRANTS = [("ann@example.com", 3), ("ann@example.com", 11), ("ben@example.com", 11), ("eve@example.com", 20)]
_GRANTS_SQL = (
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{user}', {depot})" for user, depot in GRANTS)
    + ") g(email, depot)"
)


@query(
    "secured_parts",
    sql(
        "SELECT '***' AS ean, p.* EXCLUDE (ean) FROM parts p JOIN grants ON stock_location = depot "
        "AND email = 'ann@example.com'",
        "parts", grants=_GRANTS_SQL,
    ),
)
def secured_parts(spark, folder):
    grants = access.entitlements(spark, GRANTS)
    return access.secured_parts(roles.parts(spark, folder), grants, "ann@example.com")


@query(
    "secured_parts_admin",
    sql("SELECT p.* FROM parts p JOIN grants ON stock_location = depot", "parts", grants=_GRANTS_SQL),
)
def secured_parts_admin(spark, folder):
    grants = access.entitlements(spark, GRANTS)
    return access.secured_parts(roles.parts(spark, folder), grants, "root@example.com", admin=True)


@query(
    "secured_parts_own",
    sql("SELECT '***' AS ean, p.* EXCLUDE (ean) FROM parts p JOIN grants ON stock_location = depot "
        "AND email = 'ann@example.com'", "parts", grants=_GRANTS_SQL),
)
def secured_parts_own(spark, folder):
    """The session's own user, who is granted what one of the listed users is."""
    me = spark.range(1).select(F.current_user()).first()[0]
    own = [(me if user == "ann@example.com" else user, depot) for user, depot in GRANTS]
    return access.secured_parts(roles.parts(spark, folder), access.entitlements(spark, own))
