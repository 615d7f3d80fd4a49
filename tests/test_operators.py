"""Edge cases on small literal frames."""

import datetime as dt
import json
import math
import os
import pathlib
import random

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import Observation, Row, functions as F, types as T

from telemetra.functions import columns, registered, text, tools
from telemetra.operators import (
    access, boosting, changes, joins, latest, ordering, quality, retrieval, sampling, stats, stored,
)
from telemetra.plans import gold, learning, queue as queues, reports
from telemetra.schemas import ASSET, PART, QUEUE, READING, STATUS_INTERVAL
from telemetra.session import materialize, mounted, scratch_path, shared_root
from telemetra.sources import files, rescue, sinks

UTC = dt.timezone.utc


def at(day, hour=0, minute=0, second=0):
    return dt.datetime(2024, 1, day, hour, minute, second, tzinfo=UTC)


def rows(df, *by):
    return [tuple(r) for r in (df.orderBy(*by) if by else df).collect()]


# --- quality and statistics -------------------------------------------------------------


@pytest.fixture()
def readings_edge(spark):
    data = [
        (1, 1, at(1, 9, 59, 59), None), (2, 1, at(1, 10), 0.0), (3, 1, at(1, 10), -1.0),
        (4, 1, at(1, 10, 30), 0.001), (5, None, at(1, 10, 40), 5.0), (6, 2, at(1, 10, 59, 59), 7.0),
        (7, 2, at(1, 11), 9.0),
    ]
    return spark.createDataFrame(data, "event_id long, asset_id long, event_time timestamp, energy double")


def test_null_predicate_fails_the_row(readings_edge):
    rule = quality.Expectation("positive", "energy > 0", drop=True)
    kept = quality.expect(readings_edge, [rule])
    assert rows(kept.select("event_id"), "event_id") == [(4,), (5,), (6,), (7,)]
    (metric,) = quality.expectation_metrics(readings_edge, [rule]).collect()
    assert (metric.total_rows, metric.failed_rows) == (7, 3)


def test_warning_keeps_rows_and_counts(readings_edge):
    seen = Observation("seen")
    rules = [quality.Expectation("id", "asset_id IS NOT NULL")]
    assert quality.expect(readings_edge, rules, seen).count() == 7
    assert seen.get == {"rows": 7, "failed_id": 1}


def test_hour_edges_and_single_reading(readings_edge):
    hourly = stats.bucket_stats(readings_edge, "energy", ["energy"])
    got = {(r.asset_id, r.bucket.hour): r for r in hourly.collect()}
    assert set(got) == {(1, 9), (1, 10), (2, 10), (2, 11)}
    assert got[2, 10].std_energy == 0.0
    assert got[2, 10].percentiles_energy == [7.0] * 5
    assert got[1, 9].avg_energy is None


def test_key_violations(readings_edge):
    bad = quality.key_violations(readings_edge, ["asset_id"])
    assert {(r.asset_id, r.row_count) for r in bad.collect()} == {(1, 4), (2, 2), (None, 1)}


def test_epoch_hour(spark):
    df = spark.createDataFrame([(0,), (3599,), (3600,)], "s long")
    got = df.select(F.unix_seconds(columns.epoch_hour("s"))).collect()
    assert [r[0] for r in got] == [0, 0, 3600]


def test_histogram_below_zero(spark):
    df = spark.createDataFrame([(-0.5,), (0.0,), (0.9,), (1.0,)], "x double")
    assert rows(stats.histogram(df, "x", 1), "bin_floor") == [(-1.0, 1), (0.0, 2), (1.0, 1)]


def test_hot_asset_statistics(spark):
    """One asset holds a third of all rows."""
    generator = random.Random(5)
    data = [(0 if i % 3 == 0 else 1 + i % 40, at(1, i % 24), generator.random()) for i in range(6000)]
    df = spark.createDataFrame(data, "asset_id long, event_time timestamp, energy double")
    got = {(r.asset_id, r.bucket.hour): r for r in stats.bucket_stats(df, "energy", ["energy"]).collect()}
    groups = {}
    for asset, time, energy in data:
        groups.setdefault((asset, time.hour), []).append(energy)
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert math.isclose(got[key].avg_energy, np.mean(values), abs_tol=1e-9)
        assert math.isclose(got[key].std_energy, np.std(values), abs_tol=1e-9)
        ordered = sorted(values)
        exact = [ordered[max(0, math.ceil(p * len(ordered)) - 1)] for p in stats.PERCENTILES]
        assert got[key].percentiles_energy == exact


# --- latest and order -------------------------------------------------------------------


def test_latest_breaks_ties_and_keeps_single_rows(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, 4, "c"), (2, 1, "z")], "asset_id long, t int, tag string"
    )
    assert rows(latest.latest_per_key(df, ["asset_id"], "t", ["tag"]), "asset_id") == [
        (1, 5, "a"), (2, 1, "z"),
    ]


def test_two_meanings_of_current(spark):
    stats_rows = spark.createDataFrame(
        [(1, at(1, 1), 5.0, 0.0), (1, at(1, 2), 6.0, 0.0), (9, at(1, 1), 7.0, 0.0)],
        "asset_id long, bucket timestamp, avg_energy double, std_energy double",
    )
    assets = spark.createDataFrame([(1, "m")], "asset_id long, model string")
    assert gold.current_features(stats_rows, assets).select("avg_energy").collect() == [Row(6.0)]
    assert gold.current_features_every_bucket(stats_rows, assets).count() == 2


def test_global_row_number_is_dense_under_ties_and_skew(spark):
    data = [(0 if i % 3 else i, i) for i in range(5000)]
    df = spark.createDataFrame(data, "k int, id int").repartition(7)
    got = ordering.global_row_number(df, [F.col("k"), F.col("id")])
    want = {pair: n for n, pair in enumerate(sorted(data), start=1)}
    assert {(r.k, r.id): r.row_id for r in got.collect()} == want


def test_running_total_across_slices(spark):
    generator = random.Random(3)
    data = [(("hot" if i % 3 else f"k{i % 5}"), i, generator.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, t int, v int").repartition(5)
    got = ordering.running_total(df, ["k"], ["t"], "v", "before")
    sums, want = {}, {}
    for k, t, v in sorted(data):
        want[k, t] = sums.get(k, 0)
        sums[k] = sums.get(k, 0) + v
    assert {(r.k, r.t): r.before for r in got.collect()} == want


def test_dedupe_is_repeatable(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None)], "k int, v string")
    for parts in (1, 4):
        assert rows(latest.dedupe_by_key(df.repartition(parts), ["k"])) == [(1, "a")]


def test_hash_sample_ignores_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = rows(sampling.sample_by_hash(df, ["k"], 0.25), "k")
    many = rows(sampling.sample_by_hash(df.repartition(9), ["k"], 0.25), "k")
    assert one == many and 150 < len(one) < 350


# --- joins ------------------------------------------------------------------------------


def interval_case(spark):
    base = int(at(1).timestamp())
    stat = spark.createDataFrame(
        [(1, at(1, h)) for h in range(24)] + [(2, at(1, 5))], "asset_id long, bucket timestamp"
    )
    spans = spark.createDataFrame(
        [(1, "a", base + 3600 * 2, base + 3600 * 5), (1, "b", base + 3600 * 4, base + 3600 * 6 + 1),
         (1, "empty", base + 3600 * 9, base + 3600 * 9), (3, "c", base, base + 10)],
        STATUS_INTERVAL,
    )
    return stat, spans


def test_interval_bounds_are_strict_and_overlaps_fan_out(spark):
    stat, spans = interval_case(spark)
    got = joins.label_by_interval(stat, spans).select(
        F.hour("bucket").alias("h"), "abnormal_channel"
    )
    assert rows(got, "h", "abnormal_channel") == [(3, "a"), (4, "a"), (5, "b"), (6, "b")]


@pytest.mark.parametrize("width", [60, 600, 3600, 86_400, 10_000_000])
def test_interval_bins_do_not_change_the_result(spark, width):
    generator = random.Random(width)
    base = int(at(1).timestamp())
    points = [(generator.choice([0, 0, 1, 2]), at(1 + generator.randrange(5), generator.randrange(24)))
              for _ in range(200)]
    spans = []
    for i in range(60):
        start = base + generator.randrange(5 * 86_400)
        spans.append((generator.choice([0, 0, 1, 2]), f"s{i}", start, start + generator.randrange(90_000)))
    stat = spark.createDataFrame(points, "asset_id long, bucket timestamp")
    got = joins.label_by_interval(stat, spark.createDataFrame(spans, STATUS_INTERVAL), bin_seconds=width)
    want = sorted(
        (a, int(t.timestamp()), label)
        for a, t in points for b, label, s, e in spans
        if a == b and s < t.timestamp() < e
    )
    found = got.select("asset_id", F.unix_seconds("bucket"), "abnormal_channel").collect()
    assert sorted(tuple(r) for r in found) == want


def test_open_ended_interval(spark):
    """An interval up to the year 9999 costs at most 65 bins of its level."""
    base = int(at(1).timestamp())
    stat = spark.createDataFrame([(1, at(1)), (1, at(2))], "asset_id long, bucket timestamp")
    spans = spark.createDataFrame([(1, "a", base, 253_402_300_799)], STATUS_INTERVAL)
    got = joins.label_by_interval(stat, spans)
    assert rows(got.select(F.dayofmonth("bucket"))) == [(2,)]
    assert joins.interval_bins(spans, 86_400).count() <= 65


def test_many_open_ended_intervals_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    stat = spark.createDataFrame([(1, at(2))], "asset_id long, bucket timestamp")
    spans = spark.range(200).select(
        F.col("id").alias("asset_id"), F.lit("a").alias("abnormal_channel"),
        F.lit(0).cast("bigint").alias("start_time"), F.lit(253_402_300_799).alias("end_time"))
    got = joins.label_by_interval(stat, spans)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BuildRight" not in plan
    assert got.count() == 1


@pytest.mark.parametrize("days", [1, 64, 65, 4096, 5000, 300_000])
def test_interval_bins_are_bounded_and_complete(spark, days):
    start = int(at(1).timestamp()) + 7
    spans = spark.createDataFrame([(1, "a", start, start + days * 86_400)], STATUS_INTERVAL)
    assert joins.interval_bins(spans, 86_400).count() <= 65
    inside = [start + 1, start + days * 43_200, start + days * 86_400 - 1]
    stat = spark.createDataFrame(
        [(1, s) for s in [start, *inside, start + days * 86_400]], "asset_id long, s long"
    ).select("asset_id", F.timestamp_seconds("s").alias("bucket"), "s")
    assert rows(joins.label_by_interval(stat, spans).select("s"), "s") == [(s,) for s in inside]


def test_hash_sample_of_small_fractions(spark):
    many = spark.range(2_000_000)
    assert 8 <= sampling.sample_by_hash(many, ["id"], 1e-5).count() <= 40


def test_composite_key_with_null_part(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "asset_id long, start_time long, std_a double")
    assert joins.training_rows(df, ["std_a"]).first()["composite_key"] is None
    assert joins.training_rows(df, ["std_a"], skip_nulls=True).first()["composite_key"] == "1"
    assert joins.training_rows(df, ["std_a"]).columns[:2] == ["composite_key", "feature_vector"]


def test_spec_lookup_of_unknown_key(spark):
    wanted = spark.createDataFrame([(1,), (5,)], "asset_id long")
    specs = spark.createDataFrame([(1, "m")], "asset_id long, model string")
    got = {r.asset_id: r.spec for r in joins.spec_lookup(wanted, specs).collect()}
    assert got[5] is None and got[1].model == "m"


# --- reports ----------------------------------------------------------------------------


def test_shortages_equal_the_pairwise_count(spark):
    generator = random.Random(1)
    broken = [(i, 0 if i % 3 else generator.randrange(4)) for i in range(90)]
    stock = [
        (None if i % 7 == 0 else str(i % 11), i, f"t{i % 3}", generator.choice([None, 0, 3]), generator.randrange(6), 30)
        for i in range(200)
    ]
    faulty = spark.createDataFrame(broken, "asset_id long, site_id int")
    parts = spark.createDataFrame(stock, PART)
    counted, detailed = {}, {}
    for _, site in broken:
        for ean, _, kind, have, depot, lead in stock:
            if site == depot and have == 0:
                counted[kind] = counted.get(kind, 0) + 1
                key = (ean, kind, lead, site)
                detailed[key] = detailed.get(key, 0) + 1
    assert {r.type: r.faulty_equipment_count for r in reports.faulty_parts_count(faulty, parts).collect()} == counted
    got = reports.faulty_parts_detail(faulty, parts).collect()
    assert {(r.ean, r.type, r.lead_days, r.site_id): r.faulty_equipment_count for r in got} == detailed


def test_efficiency_loss_last_status_is_null(spark):
    status = spark.createDataFrame(
        [("ok", 10.0), ("channel_b", 4.0), ("channel_d", 6.0)], "prediction string, avg_energy double"
    )
    got = {r.status: r for r in reports.efficiency_loss(status).collect()}
    assert got["faulty"].efficiency_loss == 5.0 and got["faulty"].asset_count == 0.2
    assert got["ok"].efficiency_loss is None


def test_forecast_sums_by_hour(spark):
    rows_ = spark.createDataFrame(
        [(at(3, 7, 30), 1.0, 4.0, 2.0), (at(3, 7, 40), 2.0, 5.0, 3.0), (at(3, 8, 0), 1.0, 1.0, 1.0)],
        "time timestamp, low double, high double, prediction double")
    got = rows(reports.forecast_hourly(rows_), "hourly_time")
    assert [r[1:] for r in got] == [(3.0, 9.0, 5.0), (1.0, 1.0, 1.0)]


def test_unreadable_coordinates(spark):
    df = spark.createDataFrame([("12.5", "ERROR"), (None, "3")], "lat string, lon string")
    assert rows(columns.numeric_coordinates(df)) == [(12.5, None), (None, 3.0)]


# --- queue and changes ------------------------------------------------------------------


@pytest.fixture()
def queue_edge(spark):
    t = at(2, 12)
    data = [
        (1, "North Hill", "channel_b", 0.39, "Pending", t, None, t),
        (2, "south bay", "channel_b", 0.4, "Pending", t, "old", t),
        (3, None, "channel_d", 0.7, "Resolved", at(1), None, t),
        (4, "Northern", "channel_d", 0.71, "In Progress", t, None, t),
    ]
    return spark.createDataFrame(data, QUEUE)


def test_bands(queue_edge):
    got = queues.banded(queue_edge).orderBy("asset_id").select("severity_level").collect()
    assert [r[0] for r in got] == ["Low", "Medium", "Medium", "High"]


def test_search_ignores_case_and_nulls(queue_edge):
    assert rows(queues.filtered(queue_edge, term="NORTH").select("asset_id"), "asset_id") == [(1,), (4,)]
    assert rows(queues.filtered(queue_edge, term="3").select("asset_id")) == [(3,)]
    assert queues.filtered(queue_edge, ["Resolved"]).count() == 1
    assert rows(queues.shown_counts(queue_edge, ["Pending"], "north")) == [(1, 4)]


def test_day_counters(queue_edge):
    assert rows(queues.counts_on(queue_edge, dt.date(2024, 1, 2))) == [(2, 1, 0)]


def test_updates_touch_known_rows_only(spark, queue_edge):
    updates = spark.createDataFrame(
        [(1, "In Progress", "it's loose", at(3)), (1, "Pending", "older", at(2)),
         (2, "Resolved", None, at(3)), (99, "Resolved", "unknown", at(3))],
        "asset_id long, status string, technician_notes string, last_updated timestamp",
    )
    got = changes.apply_updates(
        queue_edge, updates, "asset_id", ["status", "technician_notes", "last_updated"], "last_updated"
    )
    assert got.columns == queue_edge.columns and got.count() == 4
    by_id = {r.asset_id: r for r in got.collect()}
    assert by_id[1].technician_notes == "it's loose" and by_id[1].status == "In Progress"
    assert by_id[2].technician_notes is None and by_id[2].status == "Resolved"
    assert by_id[4].status == "In Progress"


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert rows(changes.delete_where(df, F.col("x") == 1), "x") == [(None,), (2,)]


def test_diff_and_feed(spark):
    old = spark.createDataFrame([(1, "same"), (2, "gone"), (3, "a"), (4, None)], "k int, v string")
    new = spark.createDataFrame([(1, "same"), (3, "b"), (4, "set"), (5, "in")], "k int, v string")
    feed = changes.snapshot_diff(old, new, ["k"])
    assert rows(feed, "k", "change_type") == [
        (2, "delete", "gone"), (3, "update_after", "b"), (3, "update_before", "a"),
        (4, "update_after", "set"), (4, "update_before", None), (5, "insert", "in"),
    ]
    assert rows(changes.apply_feed(old, feed, ["k"]), "k") == rows(new, "k")


def test_snapshots_round_trip(spark):
    path = scratch_path(spark, "snap")
    changes.write_snapshot(spark.createDataFrame([(1,)], "k int"), path, 1)
    changes.write_snapshot(spark.createDataFrame([(1,), (2,)], "k int"), path, 2)
    changes.write_snapshot(spark.createDataFrame([(1,), (2,)], "k int"), path, 2)
    changes.restore_snapshot(spark, path, 1, 3)
    snaps = changes.read_snapshots(spark, path)
    assert rows(snaps.groupBy("snapshot_id").count(), "snapshot_id") == [(1, 1), (2, 2), (3, 1)]
    assert rows(changes.as_of(snaps, 2), "k") == [(1,), (2,)]


def test_version_by_time_and_clone(spark):
    path, copy = scratch_path(spark, "snap"), scratch_path(spark, "clone")
    changes.write_snapshot(spark.createDataFrame([(1,)], "k int"), path, 1)
    changes.write_snapshot(spark.createDataFrame([(2,)], "k int"), path, 2)
    history = spark.createDataFrame(
        [(1, "write", at(1)), (2, "write", at(3))],
        "snapshot_id int, operation string, committed_at timestamp",
    )
    snaps = changes.read_snapshots(spark, path)
    assert rows(changes.as_of_time(snaps, history, at(2))) == [(1,)]
    assert rows(changes.as_of_time(snaps, history, at(3))) == [(2,)]
    assert changes.as_of_time(snaps, history, dt.datetime(2023, 1, 1, tzinfo=UTC)).count() == 0
    changes.clone_snapshot(spark, path, 1, copy)
    assert rows(spark.read.parquet(copy)) == [(1,)]


def test_queue_build_keeps_latest_per_asset(spark):
    status = spark.createDataFrame(
        [(1, at(1), "x", "channel_b"), (1, at(2), "x", "channel_d"), (2, at(2), "y", "ok")],
        "asset_id long, bucket timestamp, location string, prediction string",
    )
    (row,) = queues.build_queue(status, at(5)).collect()
    assert row.predicted_failure_type == "channel_d" and row.status == "Pending"


# --- access -----------------------------------------------------------------------------


def test_secured_parts(spark):
    parts = spark.createDataFrame(
        [("11", 1, "a", 0, 1, 30), ("22", 2, "b", 1, 2, 30), ("33", 3, "c", 1, 9, 30)], PART
    )
    grants = access.entitlements(spark, [("ann", 1), ("ben", 1), ("ben", 2)])
    ann = access.secured_parts(parts, grants, "ann")
    assert rows(ann.select("ean", "part_id")) == [("***", 1)]
    assert access.secured_parts(parts, grants, "nobody").count() == 0
    admin = access.secured_parts(parts, grants, "root", admin=True)
    assert rows(admin.select("ean", "part_id"), "part_id") == [("11", 1), ("11", 1), ("22", 2)]


# --- tools ------------------------------------------------------------------------------


def answer(spark, column):
    return json.loads(spark.range(1).select(column).first()[0])


@pytest.mark.parametrize(
    "actual, rated, want",
    [
        (5.0, 0.0, {"error": "capacity is not positive"}),
        (5.0, -1.0, {"error": "capacity is not positive"}),
        (50.0, 100.0, {"efficiency_pct": 50.0, "status": "degraded"}),
        (80.0, 100.0, {"efficiency_pct": 80.0, "status": "good"}),
        (330.0, 1200.0, {"efficiency_pct": 27.5, "status": "critical"}),
    ],
)
def test_power_efficiency(spark, actual, rated, want):
    assert answer(spark, tools.power_efficiency(F.lit(actual), F.lit(rated))) == want


@pytest.mark.parametrize(
    "days, anomalies, want",
    [(90, 3, "ok"), (91, 3, "monitor"), (90, 4, "monitor"), (91, 4, "urgent")],
)
def test_urgency(spark, days, anomalies, want):
    assert answer(spark, tools.maintenance_urgency(F.lit(days), F.lit(anomalies)))["urgency"] == want


def test_units(spark):
    def convert(value, a, b):
        return answer(spark, tools.unit_conversion(F.lit(value), F.lit(a), F.lit(b)))

    assert math.isclose(convert(212.0, "fahrenheit", "celsius")["value"], 100.0)
    assert math.isclose(convert(100.0, "Celsius", "fahrenheit")["value"], 212.0)
    assert math.isclose(convert(60.0, "rpm", "rad_per_sec")["value"], 2 * math.pi)
    assert math.isclose(convert(1.0, "m/s", "mph")["value"], 1 / 0.44704)
    assert "error" in convert(1.0, "mph", "celsius")


def test_wind_power(spark):
    got = answer(spark, tools.wind_power(F.lit(12.0), F.lit(80.0)))
    want = 0.5 * 1.225 * math.pi * 40**2 * 12**3 / 1000
    assert math.isclose(got["power_kw"], want, abs_tol=0.01) and got["meets_minimum"] is True


def test_sql_tools_agree_with_columns(spark):
    assert len(registered.register_tools(spark)) == 5
    data = [
        (a, b, "mph", "m/s") for a in (0.0, 49.996, 50.0, 91.0) for b in (-1.0, 0.0, 80.0, 100.0)
    ] + [(20.0, 4.0, "Celsius", "fahrenheit"), (20.0, 4.0, "rpm", "mph"), (None, 1.0, "mph", "m/s")]
    df = spark.createDataFrame(data, "a double, b double, u string, v string")
    a, b, u, v = (F.col(c) for c in "abuv")
    forms = [
        (tools.power_efficiency(a, b), "power_efficiency(a, b)"),
        (tools.wind_power(a, b), "wind_power(a, b)"),
        (tools.unit_conversion(a, u, v), "convert_units(a, u, v)"),
        (tools.maintenance_urgency(a, b.cast("int")), "maintenance_urgency(a, int(b))"),
    ]
    for column, text_ in forms:
        for row in df.select("a", "b", "u", column.alias("x"), F.expr(text_).alias("y")).collect():
            assert row.x == row.y, row


def test_rule_forms_agree(spark):
    data = [(m, s) for m in (0.0, 24.99, 25.0, 120.0, 120.1) for s in (0.0, 60.0, 60.1)]
    df = spark.createDataFrame(data, "avg_energy double, std_energy double")
    udf = registered.register_rule_udf(spark, "rule_udf")
    name = registered.register_rule_sql(spark, "rule_sql")
    got = df.select(
        columns.rule_score().alias("a"), udf(*udf.inputs).alias("b"),
        F.expr(f"{name}(avg_energy, std_energy)").alias("c"), F.expr("rule_udf(avg_energy, std_energy)").alias("d"),
    )
    assert all(len(set(r)) == 1 for r in got.collect())


# --- text and vectors -------------------------------------------------------------------


def test_elements_skip_hidden_parts(spark):
    html = (
        "<html><head><title>T</title></head><body><script>var a='<p>no</p>'</script>"
        "<!-- <p>no</p> --><p>One <b>bold</b>\n two</p><div> </div><li>Three</li></body></html>"
    )
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert rows(text.page_elements(df), "position") == [(1, 0, "One bold two"), (1, 1, "Three")]
    assert text.page_text(df).first()["full_text"] == "One bold two\nThree"


def test_variant_elements(spark):
    doc = '{"document":{"elements":[{"content":"a"},{"content":"b","type":"x"}]}}'
    df = spark.createDataFrame([(doc,), ("{}",)], "j string")
    got = df.select(text.join_elements(text.document_elements(F.parse_json("j")))).collect()
    assert [r[0] for r in got] == ["a\nb", None]


def test_nearest_orders_ties_and_skips_zero_vectors(spark):
    data = [(1, [0.0, 0.0]), (2, [0.0, 2.0]), (3, [3.0, 0.0]), (4, [1.0, 0.0]), (5, [1.0, 1.0])]
    index = spark.createDataFrame(data, "vec_id long, v array<float>")
    one = rows(retrieval.nearest(index, "v", "vec_id", [1.0, 0.0], 3))
    assert [r[0] for r in one] == [3, 4, 5]
    many = retrieval.nearest_batch(index, "v", "vec_id", {7: [1.0, 0.0], 8: [0.0, 1.0]}, 2)
    assert rows(many.select("question_id", "vec_id"), "question_id", F.desc("similarity"), "vec_id") == [
        (7, 3), (7, 4), (8, 2), (8, 5),
    ]


def test_question_blocks_answer_everything(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "QUESTION_BLOCK", 3)
    generator = np.random.default_rng(0)
    matrix = generator.normal(size=(200, 8))
    index = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(matrix)], "vec_id long, v array<double>"
    ).repartition(6)
    questions = {i: matrix[i] + 0.1 for i in range(10)}
    got = {}
    for r in retrieval.nearest_batch(index, "v", "vec_id", questions, 4).collect():
        got.setdefault(r.question_id, set()).add(r.vec_id)
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    for i, q in questions.items():
        assert got[i] == set(np.argsort(-(unit @ q))[:4].tolist())


def test_hashed_neighbours_find_the_vector_itself(spark, folder):
    index = spark.read.parquet(f"{folder}/embeddings.parquet")
    row = index.orderBy("vec_id").first()
    got = retrieval.nearest_hashed(index, "embedding", "vec_id", row.embedding, 3).collect()
    assert got[0].vec_id == row.vec_id and math.isclose(got[0].similarity, 1.0, abs_tol=1e-6)


def test_text_question_against_brute_force(spark):
    documents = [
        (1, "Blade crack near the root, replace blade"), (2, "yaw motor noise; yaw drive worn"),
        (3, "the brake disc is worn"), (4, "controller card error, replace card"), (5, ""),
        (6, None), (7, "the brake disc is worn"),
    ]
    df = spark.createDataFrame(documents, "doc_id long, text string")
    got = retrieval.nearest_texts(df, "doc_id", "text", "Replace the worn blade, the", 7).collect()
    words = {i: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
             for i, t in documents}
    n, mean = len(words), sum(map(len, words.values())) / len(words)
    want = dict.fromkeys(words, 0.0)
    for term in ("replace", "the", "worn", "blade"):
        holding = sum(term in ws for ws in words.values())
        weight = math.log(1 + (n - holding + 0.5) / (holding + 0.5))
        for i, ws in words.items():
            c = ws.count(term)
            want[i] += weight * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(ws) / mean))
    assert [r.doc_id for r in got] == sorted(want, key=lambda i: (-round(want[i], 9), i))
    assert all(math.isclose(r.similarity, want[r.doc_id], abs_tol=1e-9) for r in got)


@pytest.mark.parametrize("question", ["", "...", "absent"])
def test_text_question_without_a_hit(spark, question):
    df = spark.createDataFrame([(2, "a"), (1, None)], "doc_id long, text string")
    got = retrieval.nearest_texts(df, "doc_id", "text", question, 5).collect()
    assert [(r.doc_id, r.similarity) for r in got] == [(1, 0.0), (2, 0.0)]
    assert retrieval.nearest_texts(df.limit(0), "doc_id", "text", question, 5).count() == 0


def test_answers_function(spark):
    answers = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "question_id long, position int, guide string"
    )
    name = registered.register_answers(spark, answers, "guides_test")
    df = spark.createDataFrame([(1,), (2,)], "q long").selectExpr("q", f"{name}(q) AS g")
    assert {r.q: r.g for r in df.collect()} == {1: ["a", "b"], 2: ["c"]}


# --- learning ---------------------------------------------------------------------------


def test_split_is_exact(spark):
    data = [(at(1 + i % 3), i) for i in range(101)]
    df = spark.createDataFrame(data, "bucket timestamp, asset_id int")
    got = learning.temporal_split(df, ["bucket", "asset_id"])
    train = {r.asset_id for r in got.where("split = 'train'").collect()}
    assert train == {i for _, i in sorted(data)[:80]}


def test_unknown_values_become_minus_one(spark):
    train = spark.createDataFrame([("b",), ("a",)], "location string")
    other = spark.createDataFrame([("a",), ("c",), (None,)], "location string")
    model = learning.fit_ordinals(train, ["location"])
    got = [r.location_code for r in learning.encode_ordinals(model, other).collect()]
    assert got == [0.0, -1.0, -1.0]


def test_metrics_by_hand(spark):
    data = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    df = spark.createDataFrame(data, "t string, p string")
    row = learning.score_metrics(df, "t", "p").first()
    assert math.isclose(row.accuracy, 0.6)
    f1 = {"a": 2 * 1 / (2 + 2), "b": 2 * 2 / (2 + 3), "c": 0.0}
    assert math.isclose(row.weighted_f1, (2 * f1["a"] + 2 * f1["b"]) / 5)


def test_auc_by_pairs(spark):
    generator = random.Random(9)
    data = [(generator.choice("xy"), float(generator.randrange(12))) for _ in range(500)]
    df = spark.createDataFrame(data, "t string, s double").repartition(6)
    got = {r["class"]: r.auc for r in learning.auc_one_vs_rest(df, "t", {"x": "s", "y": "s"}).collect()}
    for name in "xy":
        pos = [s for t, s in data if t == name]
        neg = [s for t, s in data if t != name]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert math.isclose(got[name], wins / len(pos) / len(neg), abs_tol=1e-12)


def test_trials_are_repeatable():
    assert learning.search_trials() == learning.search_trials()
    assert len(learning.search_trials()) == 10
    assert len({tuple(t.values()) for t in learning.search_trials(count=144)}) == 144


def test_learners_find_an_obvious_rule(spark):
    generator = random.Random(2)
    data = []
    for i in range(240):
        kind = ("ok", "channel_b", "channel_d")[i % 3]
        level = {"ok": 10.0, "channel_b": 50.0, "channel_d": 90.0}[kind]
        data.append((i, at(1 + i % 20), level + generator.random(), 1.0, 2.0, f"loc{i % 40}", "m", "c", kind))
    df = spark.createDataFrame(
        data, "asset_id int, bucket timestamp, avg_energy double, std_energy double, "
        "std_channel_k double, location string, model string, country string, abnormal_channel string",
    )
    timed = learning.with_time_features(df)
    train, test = timed.where("asset_id < 180"), timed.where("asset_id >= 180")
    for model in (
        learning.train_boosted(train, {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3, "subsample": 1.0}),
        learning.train_forest(train, trees=5),
    ):
        scored = learning.score_with(model, test)
        assert learning.score_metrics(scored, "abnormal_channel", "prediction").first().accuracy > 0.95
        path = scratch_path(spark, "model")
        learning.store_model(model, path)
        boosted = isinstance(model, boosting.BoostedModel)
        again = learning.load_boosted(spark, path) if boosted else learning.load_model(path)
        assert set(learning.model_inputs(again)) == {*learning.NUMBER_FEATURES, *learning.TEXT_FEATURES}
        assert rows(learning.score_with(again, test), "asset_id") == rows(scored, "asset_id")


def labelled_rows(spark, n=900):
    """Two numbers, one of them with gaps, and a text that together decide three classes."""
    generator = random.Random(6)
    data = []
    for i in range(n):
        a, b, place = generator.gauss(0, 1), generator.choice([None, 1.0, 2.0, 3.0]), f"p{generator.randrange(9)}"
        kind = "x" if a > 0.4 else "y" if place < "p4" or b == 2.0 else "z"
        data.append((i, a, b, place, kind if generator.random() < 0.9 else generator.choice("xyz")))
    return spark.createDataFrame(data, "id int, a double, b double, place string, label string").repartition(5)


def test_boosting_in_blocks_equals_boosting_in_one_block(spark):
    rows_ = labelled_rows(spark)
    trials = [boosting.Trial(12, 3, 0.2, 0.7), boosting.Trial(3, 2, 0.1, 1.0)]
    one = boosting.fit(rows_, ["a", "b"], ["place"], "label", trials)
    many = boosting.fit(rows_, ["a", "b"], ["place"], "label", trials, block_rows=100)
    for x, y in zip(one, many):
        assert len(x.trees) == len(y.trees) == x.trial.rounds
        for s, t in zip(x.trees, y.trees):
            assert (s.feature == t.feature).all() and (s.cut == t.cut).all()
            assert np.allclose(s.value, t.value)
    assert not np.allclose(one[0].trees[1].value[:, :7], one[1].trees[1].value)  # other rows and rates


def same_trees(one, other):
    return len(one.trees) == len(other.trees) == one.trial.rounds and all(
        (s.feature == t.feature).all() and (s.cut == t.cut).all() and np.allclose(s.value, t.value)
        for s, t in zip(one.trees, other.trees))


def test_boosting_in_blocks_maps_rows_from_files(spark, monkeypatch):
    rows_ = labelled_rows(spark)
    # the last trial's trees see no row of some blocks
    trials = [boosting.Trial(5, 3, 0.2, 0.7), boosting.Trial(2, 2, 0.1, 1.0), boosting.Trial(4, 2, 0.1, 0.01)]
    fit = lambda **named: boosting.fit(rows_, ["a", "b"], ["place"], "label", trials, **named)
    gone, held, rmtree = [], set(), boosting.shutil.rmtree

    def removed(path, *rest, **named):
        held.update(spark.sparkContext._jsc.getPersistentRDDs().keySet().toArray())
        gone.append((pathlib.Path(path), os.path.isdir(path)))
        rmtree(path, *rest, **named)

    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet().toArray())
    monkeypatch.setattr(boosting.shutil, "rmtree", removed)
    files_ = fit(block_rows=100)
    folder = gone[-1][0]
    assert not held - before and not folder.exists() and str(folder).startswith(shared_root(spark))
    assert [(p.name, there) for p, there in gone[1:-1]] == [(str(turn), True) for turn in range(4)]
    gone.clear()
    monkeypatch.setattr(boosting, "mounted", lambda *_: None)
    in_spark = fit(block_rows=100)
    assert not gone
    for one, x, y in zip(fit(), files_, in_spark):
        assert same_trees(one, x) and same_trees(one, y)


def test_folders_that_are_reached_by_path(spark):
    assert mounted(spark, "file:///tmp/a%20b") == "/tmp/a b" and mounted(spark, "/tmp/c") == "/tmp/c"
    assert mounted(spark, "file:/tmp/d") == "/tmp/d" and mounted(spark, "hdfs://host/tmp/e") is None


def test_boosting_in_blocks_takes_one_job_a_level(spark):
    rows_ = labelled_rows(spark)
    context = spark.sparkContext
    context.setJobGroup("boosting-jobs", "levels")
    try:
        boosting.fit(rows_, ["a", "b"], ["place"], "label", [boosting.Trial(12, 3, 0.2, 0.7)], block_rows=100)
    finally:
        context._jsc.clearJobGroup()
    assert len(context.statusTracker().getJobIdsForGroup("boosting-jobs")) <= 12 * 3 + 20


def test_boosting_in_blocks_gives_every_core_a_block(spark):
    rows_ = labelled_rows(spark)
    binning = boosting.learn_binning(rows_, ["a", "b"], ["place"], "label")
    cores = spark.sparkContext.defaultParallelism
    assert boosting.blocks_of(rows_, binning, "label", 899, 1)[1] == cores
    assert boosting.blocks_of(rows_, binning, "label", 899, cores)[1] == 2
    assert boosting.blocks_of(rows_, binning, "label", 900, 1)[1] == 1


def binned_rows(n=4000):
    """Bins, labels and cells of a number, a day, its week and month, and a place with its country."""
    draw = np.random.default_rng(4)
    day, place = draw.integers(0, 90, n), draw.integers(0, 25, n)
    columns = [draw.integers(0, 250, n), day % 7, (day % 7 > 4), day // 31, place, place % 5]
    bins = np.stack([c + 1 for c in columns], axis=1).astype(np.uint8)
    labels = np.digitize(columns[0] / 100 + (place > 11) + draw.normal(size=n), [1, 2.5]).astype(np.int32)
    return bins, labels, np.cumsum([0, 256, 9, 4, 5, 27, 7])


def plain_sums(bins, weights, nodes, kind, node, starts):
    """One row at a time: sums by asked node, feature and bin."""
    found = np.zeros((len(node), starts[-1], 2))
    for i, (k, at) in enumerate(zip(kind, node)):
        for row in np.flatnonzero(nodes[k] == at):
            for f, b in enumerate(bins[row]):
                found[i, starts[f] + b] += weights[k, row].real, weights[k, row].imag
    return found


def test_boosting_folds_features_of_few_combinations():
    bins, _, _ = binned_rows()
    rows_ = boosting.folded(bins)
    assert rows_.codes.shape == (3, 4000)  # the number; week, weekend, month and country; the place
    for f in range(bins.shape[1]):
        assert (rows_.bins[f][rows_.codes[rows_.column[f]]] == bins[:, f]).all()
    apart = np.random.default_rng(5).integers(0, 256, (4000, 3)).astype(np.uint8)
    assert boosting.folded(apart).codes.shape == (3, 4000)
    assert boosting.folded(bins[:1]).codes.shape == (1, 1)


def test_boosting_sums_only_the_lighter_child_of_a_heavy_split():
    bins, labels, starts = binned_rows()
    rows_ = boosting.folded(bins)
    trial = boosting.Trial(1, 4, 0.3, 1.0)
    weights = boosting.gradients(np.zeros((3, len(labels))), labels)
    growth, touched = boosting.Growth(3, trial, starts), []
    while not growth.over:
        parts = list(boosting.routed(growth.tree, growth.level, rows_))
        nodes = np.concatenate([np.stack(found) for _, found in parts], axis=1)
        touched.append(sum(np.isin(nodes[k], growth.node[growth.kind == k]).sum() for k in range(3)))
        sums = boosting.summed(growth, rows_, weights, iter(parts))
        assert np.allclose(sums, plain_sums(bins, weights, nodes, growth.kind, growth.node, starts))
        growth.take(sums)
    assert touched[0] == 3 * len(labels) and touched[1] <= touched[0] / 2 and max(touched[2:]) < 0.75 * touched[0]
    # the tree is the one that sums of all nodes give
    whole = boosting.Tree(3, trial.depth)
    for level in range(trial.depth):
        nodes = np.concatenate([np.stack(f) for _, f in boosting.routed(whole, level, rows_)], axis=1)
        kind, place = np.divmod(np.arange(3 * 2**level), 2**level)
        sums = plain_sums(bins, weights, nodes, kind, place + 2**level - 1, starts)
        whole.grow(level, kind, place, boosting.best_splits(sums, starts), trial.rate)
    assert (whole.feature == growth.tree.feature).all() and (whole.cut == growth.tree.cut).all()
    assert np.allclose(whole.value, growth.tree.value)


def test_boosting_gives_every_trial_of_a_search_a_task(spark, monkeypatch):
    rows_ = labelled_rows(spark, 300)
    binning = boosting.learn_binning(rows_, ["a", "b"], ["place"], "label")
    blocks, count = boosting.blocks_of(rows_, binning, "label", 1000, 10)
    assert count == 1 and boosting.BLOCK_ROWS >= 60 * 18_160
    sizes, whole = [], RDD.mapPartitions

    def watched(rdd, run, *rest, **named):
        sizes.append(whole(rdd, lambda held: [sum(1 for _ in held)]).collect())
        return whole(rdd, run, *rest, **named)

    monkeypatch.setattr(RDD, "mapPartitions", watched)
    trials = [boosting.Trial(1 + i % 3, 2, 0.1, 0.8) for i in range(10)]
    models = boosting._grown_apart(blocks, trials, binning, np.zeros(3))
    assert [len(m.trees) for m in models] == [t.rounds for t in trials]
    assert sizes[-1] == [1] * 10


def test_boosting_against_a_plain_search_of_splits(spark):
    rows_ = labelled_rows(spark, 300)
    model = boosting.fit(rows_, ["a", "b"], ["place"], "label", [boosting.Trial(1, 1, 1.0, 1.0)])[0]
    data = [r.asDict() for r in rows_.collect()]
    for name, feature, edge, gain in boosting.first_splits(model):
        p = sum(r["label"] == name for r in data) / len(data)

        def worth(part):
            g, h = sum(p - (r["label"] == name) for r in part), p * (1 - p) * len(part)
            return g * g / (h + 1)

        options = []
        for f in ("a", "b", "place"):
            for cut in {r[f] for r in data if r[f] is not None}:
                left = [r for r in data if r[f] is None or r[f] <= cut]
                right = [r for r in data if r[f] is not None and r[f] > cut]
                options.append(worth(left) + worth(right) - worth(data))
        # 300 rows of 300 values in 255 cuts: the best cut may be a neighbour of the plain one
        assert gain <= max(options) + 1e-6 and gain > 0.97 * max(options)


def test_boosted_metrics_by_pairs(spark):
    rows_ = labelled_rows(spark).withColumnRenamed("label", "abnormal_channel")
    train, test = rows_.where("id < 700"), rows_.where("id >= 700")
    model = boosting.fit(train, ["a", "b"], ["place"], "abnormal_channel", [boosting.Trial(15, 3, 0.2, 0.8)])[0]
    got = learning.model_metrics(model, test).first()
    scored = model.transform(test).collect()
    names = model.binning.classes
    assert got.row_count == 200 == len(scored)
    assert math.isclose(got.accuracy, sum(r.abnormal_channel == r.predicted for r in scored) / 200)
    assert got.accuracy > 0.75
    total = 0.0
    for i, name in enumerate(names):
        pos = [r.probabilities[i] for r in scored if r.abnormal_channel == name]
        neg = [r.probabilities[i] for r in scored if r.abnormal_channel != name]
        total += sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(neg)
    assert math.isclose(got.weighted_auc, total / 200, abs_tol=1e-9) and got.weighted_auc > 0.85
    cells = {(r.truth, r.guess): r.n for r in boosting.confusion(test, [model], "abnormal_channel").collect()}
    assert sum(n for (t, g), n in cells.items() if t == g) == round(got.accuracy * 200)


def test_boosting_takes_odd_rows(spark):
    few = spark.createDataFrame(
        [(1.0, "u", "x"), (None, None, "x"), (float("inf"), "v", None)], "a double, t string, label string")
    model = boosting.fit(few, ["a"], ["t"], "label", [boosting.Trial(2, 2, 0.1, 1.0)])[0]
    scored = model.transform(few).collect()
    assert [r.predicted for r in scored] == ["x"] * 3 and all(r.probabilities == [1.0] for r in scored)
    with pytest.raises(ValueError):
        boosting.fit(few.where("false"), ["a"], ["t"], "label", [boosting.Trial(1, 1, 0.1, 1.0)])


# --- files ------------------------------------------------------------------------------


def test_rescue(spark):
    lines = [
        '{"event_id": 1, "energy": 2.5, "event_type": "view"}',
        '{"event_id": "x", "energy": 2.5}',
        '{"event_id": 2, "energy": null, "extra": {"a": 1}}',
        "not json", "[1, 2]", None,
    ]
    schema = type(READING)([f for f in READING if f.name in ("event_id", "energy", "event_type")])
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = [tuple(r) for r in rescue.rescue_json(df, schema).collect()]
    assert got[0] == (1, "view", 2.5, None)
    assert got[1][:3] == (None, None, 2.5) and json.loads(got[1][3]) == {"event_id": "x"}
    assert got[2][:3] == (2, None, None) and json.loads(json.loads(got[2][3])["extra"]) == {"a": 1}
    assert got[3] == (None, None, None, "not json")
    assert got[4] == (None, None, None, "[1, 2]")
    assert got[5] == (None, None, None, None)


def test_schema_store_grows(spark):
    folder, store = scratch_path(spark, "grow"), scratch_path(spark, "store")
    assert files.load_schema(spark, store) is None
    spark.createDataFrame([(1,)], "a long").write.json(folder)
    assert files.resolve_schema(spark, folder, "json", store).names == ["a"]
    spark.createDataFrame([(1, "x")], "a long, b string").write.mode("append").json(folder)
    assert files.resolve_schema(spark, folder, "json", store).names == ["a", "b"]
    assert files.load_schema(spark, store).names == ["a", "b"]


def test_schema_is_inferred_from_new_files_only(spark):
    folder, store = scratch_path(spark, "new-only"), scratch_path(spark, "new-only-store")
    spark.createDataFrame([(1,)], "a long").write.json(folder)
    assert files.resolve_schema(spark, folder, "json", store).names == ["a"]
    # an older file that was there before: its column would be found by reading everything
    spark.createDataFrame([(1,)], "old long").coalesce(1).write.mode("append").json(folder)
    for path in pathlib.Path(folder).glob("part-*"):
        if '"old"' in path.read_text():
            os.utime(path, (1_000_000_000, 1_000_000_000))
    assert files.resolve_schema(spark, folder, "json", store).names == ["a"]
    # the landing folder was cleared: the stored schema stands
    empty = pathlib.Path(scratch_path(spark, "emptied"))
    empty.mkdir(parents=True)
    assert files.resolve_schema(spark, str(empty), "json", store).names == ["a"]


def test_typed_files_are_rescued(spark):
    schema = T.StructType().add("id", "integer").add("energy", "double").add("note", "string")
    rows = spark.createDataFrame(
        [(1.0, "2.5", None), (1.5, "x", 7), (None, "NaN", None), (3e12, None, None)],
        "ID double, energy string, extra int")
    got = [tuple(r) for r in rescue.rescue_columns(rows, schema).collect()]
    assert got[0] == (1, 2.5, None, None)
    assert got[1][:3] == (None, None, None)
    assert json.loads(got[1][3]) == {"id": 1.5, "energy": "x", "extra": 7}
    assert got[2][:3] == (None, None, None) and json.loads(got[2][3]) == {"energy": "NaN"}
    assert got[3][0] is None and json.loads(got[3][3]) == {"id": 3e12}
    nothing = rescue.rescue_columns(rows.limit(0), schema)
    assert nothing.count() == 0 and nothing.columns == ["id", "energy", "note", "_rescued_data"]


def test_compaction_and_clustering(spark):
    small, large, clustered = (scratch_path(spark, x) for x in ("small", "large", "clustered"))
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS asset_id", "id AS v")
    sinks.write_files(df, small, 20)
    assert sinks.compact(spark, small, large) == 1
    assert files.list_files(spark, large, "*.parquet").count() == 1
    sinks.cluster_by(df, clustered, "asset_id", files=6)
    per_file = spark.read.parquet(clustered).groupBy(F.input_file_name()).count().collect()
    assert sum(r[1] for r in per_file) == 3000
    # the hot key, a third of the rows, does not end in one file
    hot = spark.read.parquet(clustered).where("asset_id = 0").select(F.input_file_name()).distinct()
    assert hot.count() > 1


def test_table_comment_and_listing(spark):
    df = spark.createDataFrame([], ASSET)
    sinks.overwrite_table(df, "commented_assets", comment="asset's metadata")
    info = spark.sql("DESCRIBE TABLE EXTENDED commented_assets").where("col_name = 'Comment'")
    assert info.first()["data_type"] == "asset's metadata"
    fields = {f.name: f.metadata.get("comment") for f in spark.table("commented_assets").schema}
    assert fields["asset_id"] == "asset key"
    assert files.list_tables(spark).where("tableName = 'commented_assets'").count() == 1


def test_shared_root_is_the_named_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    copy = materialize(spark.range(5), "five")
    assert copy.count() == 5 and copy.inputFiles()[0].startswith(f"file://{shared_root(spark)}")


def test_rescue_of_trailing_text_and_nan(spark):
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("energy", T.DoubleType())])
    lines = ['{"event_id": 5} trailing', '{"event_id": 6, "energy": "NaN"}', '{"event_id": 7, "energy": 1.5}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r[2]: (r[0], r[1]) for r in rescue.rescue_json(df, schema).collect()}
    assert got[lines[0]] == (None, None)
    assert got['{"energy":"NaN"}'] == (6, None)
    assert got[None] == (7, 1.5)


def test_registered_search_runs_every_trial_in_full(spark, folder, monkeypatch):
    from telemetra.catalog import learning as registered_learning

    whole = learning.param_search
    asked = []

    def small(train, test, trials):
        asked.extend(trials)
        few = [{**t, "n_estimators": 1, "max_depth": 1} for t in trials[:2]]
        return whole(train.limit(200), test.limit(200), few)

    monkeypatch.setattr(learning, "param_search", small)
    got = registered_learning.param_search(spark, folder).collect()
    assert asked == learning.search_trials()
    assert min(t["n_estimators"] for t in asked) >= 50 and min(t["max_depth"] for t in asked) >= 3
    assert [r.trial for r in got] == [1, 2]
    assert [(r.learning_rate, r.subsample) for r in got] == [
        (t["learning_rate"], t["subsample"]) for t in asked[:2]]


# --- stored tables ----------------------------------------------------------------------


def stored_numbers(spark, n=60, folders=8):
    table = stored.StoredTable(spark, scratch_path(spark, "numbers"))
    rows_ = spark.createDataFrame([(i, f"v{i}", None, at(1)) for i in range(n)], "k int, v string, note string, at timestamp")
    table.create(rows_, ["k"], stored.hashed(["k"], folders))
    return table


def file_set(spark, table):
    return {(r.path, r.size) for r in files.list_files(spark, f"{table.path}/data", "*.parquet").collect()}


def test_stored_update_takes_the_newest_and_touches_few_folders(spark):
    table = stored_numbers(spark)
    before = file_set(spark, table)
    updates = spark.createDataFrame(
        [(3, "old", "x", at(2)), (3, "new", None, at(3)), (999, "none", "n", at(2)), (None, "null", "n", at(2))],
        "k int, v string, note string, at timestamp")
    assert table.update(updates, ["v", "note", "at"], "at") == 2
    got = {r.k: (r.v, r.note) for r in table.read().collect()}
    assert len(got) == 60 and got[3] == ("new", None) and got[4] == ("v4", None)
    assert before <= file_set(spark, table)
    assert table.log().where("version = 2").first().folders_written == 1
    assert len(table.changed_places(1, 2)) == 1
    assert {r.k: r.v for r in table.read(version=1).collect()}[3] == "v3"


def test_stored_delete_and_upsert(spark):
    table = stored_numbers(spark)
    table.delete(F.col("k") < 0)  # nothing: a version without new files
    assert table.log().where("version = 2").first().folders_written == 0
    table.delete(F.col("k") >= 10)
    assert sorted(r.k for r in table.read().collect()) == list(range(10))
    table.delete(F.lit(True))
    assert table.read().count() == 0 and table.read(version=3).count() == 10
    table.upsert(spark.createDataFrame([(5, "five", None, at(2)), (70, "new", None, at(2))], table.read().schema))
    table.upsert(spark.createDataFrame([(5, "six", None, at(3))], table.read().schema))
    assert {r.k: r.v for r in table.read().collect()} == {5: "six", 70: "new"}
    table.replace(table.read(version=1))
    assert table.read().count() == 60


def test_a_change_that_died_leaves_the_old_table(spark, monkeypatch):
    table = stored_numbers(spark)

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(table, "_commit", dies)
    with pytest.raises(RuntimeError):
        table.delete(F.col("k") < 30)
    assert stored.StoredTable(spark, table.path).read().count() == 60
    monkeypatch.undo()
    table.delete(F.col("k") == 1)  # the next attempt overwrites what was left
    assert sorted(r.k for r in table.read().collect()) == [0, *range(2, 60)]


def test_two_writers_do_not_both_commit(spark):
    table = stored_numbers(spark)
    entry = table.entry()
    table.delete(F.col("k") == 1)
    with pytest.raises(RuntimeError):
        table._rewrite(entry, "late", set(), table.read())
    assert table.read().count() == 59


def test_states_merge_to_the_whole(spark):
    generator = random.Random(4)
    data = [(i % 3, at(1 + i % 2, 5, i % 60), generator.gauss(5, 2) if i % 7 else None) for i in range(900)]
    df = spark.createDataFrame([*data, (9, at(1), None)], "asset_id int, event_time timestamp, energy double")
    parts = [stats.channel_states(df.where(f"hash(event_time, energy) % 3 = {r}"), ["energy"], "day") for r in (-2, -1, 0, 1, 2)]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    merged = stats.merged_states(together, ["energy"], "asset_id", "bucket")
    got = stats.stats_of_states(merged, "energy", ["energy"], ["asset_id", "bucket"])
    want = stats.bucket_stats(df, "energy", ["energy"], "day")
    left, right = (
        {(r.asset_id, r.bucket): r for r in x.collect()} for x in (got, want))
    assert left.keys() == right.keys()
    for key, r in right.items():
        for name in ("avg_energy", "std_energy"):
            assert (left[key][name] is None and r[name] is None) or math.isclose(left[key][name], r[name], rel_tol=1e-9)
        if r.percentiles_energy is None:
            assert left[key].percentiles_energy is None
            continue
        values = sorted(v for a, t, v in data if v is not None and (a, t.day) == (key[0], key[1].day))
        for share, q in zip(stats.PERCENTILES, left[key].percentiles_energy):
            assert abs(sum(v <= q for v in values) / len(values) - share) < 0.02
