"""Streams against their batch result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from telemetra.operators.quality import Expectation
from telemetra.operators.stats import PERCENTILES
from telemetra.operators.stored import StoredTable
from telemetra.plans import refresh
from telemetra.schemas import ASSET, READING, STATUS_INTERVAL
from telemetra.session import scratch_path
from telemetra.streaming import hourly, ingest, labels

UTC = dt.timezone.utc
TIMED = type(READING)([f for f in READING if f.name != "epoch_s"])


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute, tzinfo=UTC)


def land(spark, folder, *readings):
    data = [(i, asset, time, "view", float(value), 0.0) for i, (asset, time, value) in enumerate(readings)]
    spark.createDataFrame(data, TIMED).coalesce(1).write.mode("append").parquet(folder)


def land_ids(spark, folder, *readings):
    data = [(i, 1, time, "view", 1.0, 0.0) for i, time in readings]
    spark.createDataFrame(data, TIMED).coalesce(1).write.mode("append").parquet(folder)


def places(spark, *names):
    return [scratch_path(spark, n) for n in names]


def windows(df):
    return {(r.asset_id, r.bucket.hour): r.reading_count for r in df.collect()}


def run_upserts(spark, folder, target, checkpoint):
    stream = ingest.read_folder(spark, folder, "parquet", schema=TIMED, files_per_trigger=1)
    ingest.finish(hourly.upsert_changed(
        hourly.windowed_stats(stream, "energy", ["channel_k"]), target, checkpoint
    ))


def test_ordered_files_give_the_batch_result(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    for hour in range(0, 12, 2):
        land(spark, folder, (1, at(hour), 1), (1, at(hour, 30), 3), (2, at(hour + 1), 5))
        run_upserts(spark, folder, target, checkpoint)
    got = windows(hourly.read_upserts(spark, target))
    assert got == {**{(1, h): 2 for h in range(0, 12, 2)}, **{(2, h): 1 for h in range(1, 12, 2)}}
    folded = scratch_path(spark, "folded")
    hourly.compact_upserts(spark, target, folded)
    assert windows(hourly.read_upserts(spark, folded)) == got


def test_update_replaces_an_open_window(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    land(spark, folder, (1, at(5), 1))
    run_upserts(spark, folder, target, checkpoint)
    land(spark, folder, (1, at(5, 10), 2))
    run_upserts(spark, folder, target, checkpoint)
    assert windows(hourly.read_upserts(spark, target)) == {(1, 5): 2}


def test_percentiles_on_a_stream(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    land(spark, folder, *[(1, at(5, m), m) for m in range(1, 11)])
    stream = ingest.read_folder(spark, folder, "parquet", schema=TIMED)
    stats = hourly.windowed_stats(stream, "energy", ["energy"], percentiles=PERCENTILES)
    ingest.finish(hourly.upsert_changed(stats, target, checkpoint))
    assert hourly.read_upserts(spark, target).first().percentiles_energy == [1.0, 3.0, 6.0, 8.0, 10.0]


def test_late_rows_are_dropped(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    land(spark, folder, (1, at(1), 1), (1, at(10), 1))
    run_upserts(spark, folder, target, checkpoint)
    land(spark, folder, (1, at(2), 1), (1, at(8), 1))
    run_upserts(spark, folder, target, checkpoint)
    assert windows(hourly.read_upserts(spark, target)) == {(1, 1): 1, (1, 10): 1, (1, 8): 1}


def test_append_waits_for_the_watermark(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    land(spark, folder, (1, at(1), 1), (1, at(6), 1), (1, at(9), 1))
    stream = ingest.read_folder(spark, folder, "parquet", schema=TIMED)
    ingest.finish(hourly.append_closed(
        hourly.windowed_stats(stream, "energy", ["channel_k"]), target, checkpoint
    ))
    assert windows(spark.read.parquet(target)) == {(1, 1): 1}


def test_restart_adds_new_files_only(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    for expected in (1, 2):
        land(spark, folder, (1, at(1), 1))
        for _ in range(2):
            ingest.finish(ingest.ingest_folder(
                spark, folder, "parquet", checkpoint, path=target, schema=TIMED
            ))
            assert spark.read.parquet(target).count() == expected


def test_rules_on_a_stream(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    land(spark, folder, (1, at(1), -1), (1, at(1), 1), (None, at(1), 2))
    rules = [Expectation("id", "asset_id IS NOT NULL"), Expectation("energy", "energy > 0", drop=True)]
    ingest.finish(ingest.ingest_folder(
        spark, folder, "parquet", checkpoint, path=target, schema=TIMED, rules=rules
    ))
    assert spark.read.parquet(target).count() == 2


def totals(spark, path):
    return {r.counter: r.value for r in ingest.rule_totals(spark, path).collect()}


def test_rule_counters_of_many_batches_and_runs(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    rules = [Expectation("id", "asset_id IS NOT NULL"), Expectation("energy", "energy > 0", drop=True)]
    spark.range(0, 110, 1, 110).select(
        F.col("id").alias("event_id"), F.expr("nullif(id, id div 4 * 4)").alias("asset_id"),
        F.lit(at(1)).alias("event_time"), F.lit("view").alias("event_type"),
        (F.col("id") % 3).cast("double").alias("energy"), F.lit(0.0).alias("channel_k"),
    ).write.parquet(folder)

    def run(where):
        ingest.finish(ingest.count_rules(
            ingest.read_folder(spark, folder, "parquet", schema=TIMED, files_per_trigger=1),
            rules, target, where,
        ))

    run(checkpoint)
    seen = {"rows": 110, "failed_id": 28, "failed_energy": 37}
    assert totals(spark, target) == seen
    assert spark.read.parquet(target).count() > 100
    run(checkpoint)
    assert totals(spark, target) == seen
    with pytest.raises(ValueError):
        run(f"{checkpoint}-other")


def test_wider_values_of_an_evolving_folder_are_rescued(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    store = f"{checkpoint}-schema"
    for line in ('{"a": 1}', '{"a": 2.5}', '{"a": "x", "b": true}', '{"a": 4} tail'):
        spark.createDataFrame([(line,)], "value string").write.mode("append").text(folder)
        ingest.finish(ingest.ingest_folder(
            spark, folder, "json", checkpoint, path=target, schema_store=store
        ))
    got = spark.read.option("mergeSchema", "true").parquet(target)
    assert sorted(map(tuple, got.select("a", "b", "_rescued_data").collect()), key=str) == sorted([
        (1, None, None), (None, None, '{"a":"2.5"}'), (None, True, '{"a":"x"}'),
        (None, None, '{"a": 4} tail'),
    ], key=str)


def test_rescue_on_a_stream(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    lines = ['{"event_id": 1, "energy": 2.0}', '{"event_id": 2, "energy": "bad"}', "junk"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    schema = type(READING)([f for f in READING if f.name in ("event_id", "energy")])
    ingest.finish(ingest.ingest_folder(
        spark, folder, "json", checkpoint, path=target, schema=schema, rescue=True
    ))
    got = spark.read.parquet(target)
    assert got.count() == 3 and got.where(F.col("_rescued_data").isNull()).count() == 1


def test_continuous_run(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")
    land(spark, folder, (1, at(1), 1))
    query = ingest.ingest_folder(
        spark, folder, "parquet", checkpoint, path=target, schema=TIMED, every="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert spark.read.parquet(target).count() == 1


def test_reader_needs_a_schema(spark):
    with pytest.raises(ValueError):
        ingest.read_folder(spark, "/tmp", "json")


def test_refresh_takes_new_files_on_the_next_run(spark):
    readings, assets, intervals, root = places(spark, "r", "a", "i", "root")
    base = int(at(0).timestamp())

    def send(*values):
        data = [(i, 1, base, at(3), "view", v, 0.0) for i, v in enumerate(values)]
        spark.createDataFrame(data, READING).write.mode("append").parquet(readings)

    spark.createDataFrame([(1, "m", "1", "2", "x", "y", 3)], ASSET).write.json(assets)
    spark.createDataFrame([(1, "ok", base, base + 86_400)], STATUS_INTERVAL).write.json(intervals)
    landing = refresh.Landing(readings, assets, intervals)
    send(10.0, -5.0, None)
    first = refresh.run_all(spark, landing, root)
    assert first["status"].first().avg_energy == 10.0
    assert first["training"].first().composite_key == f"1-{base}"
    send(20.0)
    second = refresh.run_all(spark, landing, root)
    assert second["status"].first().avg_energy == 15.0
    assert second["stats"].count() == 1


def test_refresh_in_parts_equals_one_run(spark):
    """Late metadata, a new interval and late readings of an old bucket reach every table."""
    readings, assets, intervals, root = places(spark, "r", "a", "i", "root")
    base = int(at(0).timestamp())
    landing = refresh.Landing(readings, assets, intervals)

    def send(rows, owners, spans):
        spark.createDataFrame(
            [(i, a, base, at(h), "view", float(v), k) for i, a, h, v, k in rows], READING
        ).write.mode("append").parquet(readings)
        spark.createDataFrame([(a, "m", "1", "2", f"x{a}", "y", 3) for a in owners], ASSET).write.mode(
            "append").json(assets)
        spark.createDataFrame([(a, kind, base + s, base + e) for a, kind, s, e in spans], STATUS_INTERVAL
                              ).write.mode("append").json(intervals)

    parts = [
        ([(1, 1, 1, 10, 1.0), (2, 1, 2, 20, None), (3, 2, 1, 30, 4.0), (4, 3, 5, 9, 2.0)], [1], [(1, "ok", 0, 7200)]),
        ([(5, 1, 1, 50, 7.0), (6, 2, 3, 70, 8.0)], [2], [(2, "channel_b", 0, 99_000)]),
        ([], [3], [(1, "channel_d", 5000, 9000)]),
    ]
    for part in parts:
        send(*part)
        tables = refresh.run_all(spark, landing, root)
    other, = places(spark, "whole")
    whole = refresh.run_all(spark, landing, other)
    for name in ("stats", "status", "training"):
        left, right = (sorted(map(tuple, t[name].select(*whole[name].columns).collect()), key=str) for t in (tables, whole))
        assert len(left) == len(right) > 0
        for x, y in zip(left, right):
            assert str(x) == str(y) or all(
                a == b or a == pytest.approx(b, rel=1e-9, nan_ok=True) for a, b in zip(x, y))
    assert tables["status"].count() == 3 and tables["training"].where("asset_id = 1").count() == 2
    again = refresh.run_all(spark, landing, root)
    assert [StoredTable(spark, f"{root}/{p}").entry()["version"] for p in (
        "silver/states", "silver/latest", "gold/current_status", "gold/training")] == [2, 2, 3, 3]
    assert again["training"].count() == tables["training"].count()


def test_copies_leave_one_row_across_files_and_restarts(spark):
    folder, target, checkpoint = places(spark, "f", "t", "c")

    def drain():
        ingest.finish(ingest.ingest_folder(
            spark, folder, "parquet", checkpoint, path=target, schema=TIMED, unique=["event_id"]))

    land_ids(spark, folder, (1, at(1)), (1, at(1)), (2, at(2)))
    land_ids(spark, folder, (1, at(1)), (3, at(3)))
    drain()
    land_ids(spark, folder, (3, at(3)), (4, at(4)))
    drain()
    got = sorted(r.event_id for r in spark.read.parquet(target).collect())
    assert got == [1, 2, 3, 4]


def test_draining_runs_store_state_and_not_only_changes(spark, tmp_path):
    """A next run would play back all changes since the first one."""
    setting = ingest.CHANGELOG
    before = spark.conf.get(setting, None)
    landing, checkpoint, target = (str(tmp_path / n) for n in ("in", "check", "out"))
    for day in (1, 2, 3):
        spark.createDataFrame(
            [(i, dt.datetime(2024, 1, day, i)) for i in range(5)], "id int, at timestamp"
        ).write.mode("append").parquet(landing)
        stream = ingest.read_folder(spark, landing, "parquet", schema=spark.read.parquet(landing).schema)
        ingest.finish(ingest.write_stream(
            ingest.without_copies(stream, ["id", "at"], "at", "1 day"), checkpoint, target))
    assert spark.read.parquet(target).count() == 15
    assert spark.conf.get(setting, None) == before
    state = {p.suffix for p in (tmp_path / "check" / "state").rglob("*") if p.is_file()}
    assert ".zip" in state and ".changelog" not in state


def test_label_stream_drops_old_state(spark):
    readings, spans, target, checkpoint = places(spark, "r", "s", "t", "c")
    base = int(at(0).timestamp())
    kept = []
    for day in range(4):
        land_ids(spark, readings, *[
            (10 * day + i, at(i) + dt.timedelta(days=day)) for i in range(1, 5)])
        start = base + 86_400 * day
        spark.createDataFrame([(1, f"d{day}", start, start + 3 * 3600), (1, "long", start, start + 30 * 86_400)][: 2 - (day > 0)],
                              STATUS_INTERVAL).write.mode("append").parquet(spans)
        stream = labels.label_stream(
            ingest.read_folder(spark, readings, "parquet", schema=TIMED),
            ingest.read_folder(spark, spans, "parquet", schema=STATUS_INTERVAL))
        query = ingest.finish(ingest.write_stream(stream, checkpoint, target))
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r.event_id, r.abnormal_channel) for r in spark.read.parquet(target).collect())
    want = [(10 * d + i, f"d{d}") for d in range(4) for i in (1, 2)]
    want += [(10 * d + i, "long") for d in range(4) for i in range(1, 5)]
    assert got == sorted(want)
    # 16 readings and 35 pieces came in; pieces of days to come stay, the past goes
    assert kept[-1] <= 40


def test_versions_of_another_checkpoint_are_refused(spark, tmp_path):
    landing = str(tmp_path / "in")
    spark.createDataFrame([(1, "2024-01-01 00:10:00", 2.0, 1.0)], "asset_id long, t string, energy double, channel_k double").selectExpr(
        "asset_id", "CAST(t AS TIMESTAMP) AS event_time", "energy", "channel_k").write.parquet(landing)
    schema = spark.read.parquet(landing).schema

    def run(checkpoint):
        stats = hourly.windowed_stats(
            spark.readStream.schema(schema).parquet(landing), "energy", ["channel_k"])
        ingest.finish(hourly.upsert_changed(stats, str(tmp_path / "out"), str(tmp_path / checkpoint)))

    run("one")
    run("one")
    with pytest.raises(ValueError):
        run("two")
    assert hourly.read_upserts(spark, str(tmp_path / "out")).count() == 1
