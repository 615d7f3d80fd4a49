"""The whole refresh: landing folders to bronze, silver and gold tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemetra.operators import joins, latest, stats
from telemetra.operators.quality import Expectation
from telemetra.operators.stored import StoredTable, daily, hashed
from telemetra.plans import gold
from telemetra.schemas import ASSET, READING, STATUS_INTERVAL
from telemetra.sources.rescue import RESCUED
from telemetra.session import materialize
from telemetra.streaming import ingest
from telemetra.streaming.versions import write_versions

FITS = Expectation("correct_schema", f"{RESCUED} IS NULL")
BRONZE_RULES = {"assets": [FITS], "intervals": [FITS], "readings": [FITS, *gold.READING_RULES]}


@dataclass(frozen=True)
class Landing:
    """Where raw files arrive: readings as Parquet, the other two as JSON lines."""

    readings: str
    assets: str
    intervals: str


def refresh_bronze(spark: SparkSession, landing: Landing, root: str) -> None:
    """Drain new files of the three folders side by side, rows and rule counters; re-runs take
    only what is new."""

    def drain(name: str, folder: str, data_format: str, schema):
        reading = {"schema": schema, "rescue": True, "schema_store": f"{root}/schemas/{name}"}
        checkpoints = f"{root}/checkpoints"
        return [
            ingest.ingest_folder(
                spark, folder, data_format, f"{checkpoints}/{name}", path=f"{root}/bronze/{name}",
                rules=BRONZE_RULES[name], **reading,
            ),
            ingest.count_rules(
                ingest.read_folder(spark, folder, data_format, **reading), BRONZE_RULES[name],
                f"{root}/metrics/{name}", f"{checkpoints}/{name}-metrics",
            ),
        ]

    running = [
        *drain("assets", landing.assets, "json", ASSET),
        *drain("intervals", landing.intervals, "json", STATUS_INTERVAL),
        *drain("readings", landing.readings, "parquet", READING),
    ]
    for query in running:
        ingest.finish(query)


def rule_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Rule counters of every refresh under ``root`` so far, by bronze table."""
    parts = [
        ingest.rule_totals(spark, f"{root}/metrics/{name}").select(
            F.lit(name).alias("source"), "counter", "value"
        )
        for name in BRONZE_RULES
    ]
    return reduce(DataFrame.unionByName, parts)


SILVER_KEYS = ["asset_id", "bucket"]
FOLDERS = 64  # of tables with one row per asset


def _collect_states(spark: SparkSession, root: str, grain: str) -> None:
    """States of readings that reached bronze since the last run, one folder per micro-batch.

    The stream's checkpoint knows which bronze files have been read; a repeated batch
    overwrites its own folder.
    """
    stored = spark.read.parquet(f"{root}/bronze/readings").schema
    stream = spark.readStream.schema(stored).parquet(f"{root}/bronze/readings")

    def shape(batch: DataFrame) -> DataFrame:
        return stats.channel_states(gold.clean_readings(batch), gold.CHANNELS, grain)

    ingest.finish(write_versions(
        stream, f"{root}/states/readings", f"{root}/checkpoints/states-readings", "append", shape=shape))


def _collect_assets(spark: SparkSession, root: str, name: str) -> None:
    """Assets that new bronze rows of metadata or intervals speak of."""
    stored = spark.read.parquet(f"{root}/bronze/{name}").schema
    stream = spark.readStream.schema(stored).parquet(f"{root}/bronze/{name}")

    def shape(batch: DataFrame) -> DataFrame:
        return batch.select("asset_id").where("asset_id IS NOT NULL").distinct()

    ingest.finish(write_versions(
        stream, f"{root}/states/{name}", f"{root}/checkpoints/states-{name}", "append", shape=shape))


def _since(spark: SparkSession, root: str, name: str, marks: dict[str, int]) -> tuple[DataFrame, int]:
    """Collected rows newer than the mark, and the newest batch; old folders are pruned."""
    rows = spark.read.parquet(f"{root}/states/{name}")
    newest = rows.agg(F.max("batch")).first()[0]
    done = marks.get(name, -1)
    return rows.where(F.col("batch") > done).drop("run", "batch"), done if newest is None else newest


def _put(
    table: StoredTable, keys: list[str], place: str, changed: DataFrame, rows: DataFrame,
    marks: dict[str, int],
) -> None:
    if table.exists():
        table.replace_keys(changed, rows, "refresh", marks)
    else:
        table.create(rows, keys, place, marks)


def refresh_silver(spark: SparkSession, root: str) -> None:
    """Merge new states into the stored ones, folder by folder of the days they belong to."""
    table = StoredTable(spark, f"{root}/silver/states")
    marks = table.marks()
    new, newest = _since(spark, root, "readings", marks)
    if table.exists() and newest == marks.get("readings"):
        return
    keys = new.select(*SILVER_KEYS).distinct()
    old = table.read(places=table.places_of(keys)).join(keys, SILVER_KEYS, "left_semi") if table.exists() else None
    merged = stats.merged_states(new if old is None else old.unionByName(new), gold.CHANNELS, *SILVER_KEYS)
    _put(table, SILVER_KEYS, daily("bucket"), keys, merged, {"readings": newest})


def silver_stats(spark: SparkSession, root: str, places: set[str] | None = None) -> DataFrame:
    """Statistics per asset and bucket, in the columns of :func:`gold.bucketed`."""
    states = StoredTable(spark, f"{root}/silver/states").read(places=places)
    return stats.stats_of_states(states, "energy", gold.CHANNELS, SILVER_KEYS)


def refresh_gold(spark: SparkSession, root: str, assets: DataFrame, intervals: DataFrame) -> None:
    """Bring latest state, scored status and training rows up to date for what changed.

    Changed are the buckets that new readings fell into, and all buckets of an asset whose
    metadata or intervals came in. Rows of other keys are neither read nor written, apart from
    those in the same folders.
    """
    silver = StoredTable(spark, f"{root}/silver/states")
    latest_table = StoredTable(spark, f"{root}/silver/latest")
    status_table = StoredTable(spark, f"{root}/gold/current_status")
    training_table = StoredTable(spark, f"{root}/gold/training")
    by_asset = hashed(["asset_id"], FOLDERS)

    marks = latest_table.marks()
    new, newest = _since(spark, root, "readings", marks)
    if not latest_table.exists() or newest != marks.get("readings"):
        keys = materialize(new.select(*SILVER_KEYS).distinct(), "changed-keys")
        fresh = silver_stats(spark, root, silver.places_of(keys)).join(keys, SILVER_KEYS, "left_semi")
        slim = fresh.drop(*stats.channels_like(fresh, "percentiles_"))
        owners = keys.select("asset_id").distinct()
        if latest_table.exists():
            known = latest_table.read(places=latest_table.places_of(owners)).join(owners, "asset_id", "left_semi")
            # a bucket that changed replaces its former self
            slim = slim.unionByName(known.join(keys, SILVER_KEYS, "left_anti"))
        _put(latest_table, ["asset_id"], by_asset, owners,
             latest.latest_per_key(slim, ["asset_id"], "bucket"), {"readings": newest})

    marks = status_table.marks()
    sources = {name: _since(spark, root, name, marks) for name in ("readings", "assets", "intervals")}
    now = {name: newest for name, (_, newest) in sources.items()}
    if not status_table.exists() or now != marks:
        owners = materialize(
            sources["readings"][0].select("asset_id").unionByName(sources["assets"][0]).distinct(), "changed-assets")
        rows = latest_table.read(places=latest_table.places_of(owners)).join(owners, "asset_id", "left_semi")
        _put(status_table, ["asset_id"], by_asset, owners, gold.score(joins.enrich(rows, assets, measure=False)), now)

    marks = training_table.marks()
    sources = {name: _since(spark, root, name, marks) for name in ("readings", "assets", "intervals")}
    now = {name: newest for name, (_, newest) in sources.items()}
    if not training_table.exists() or now != marks:
        keys = sources["readings"][0].select(*SILVER_KEYS)
        owners = sources["assets"][0].unionByName(sources["intervals"][0]).distinct()
        whole = silver.read().select(*SILVER_KEYS).join(owners, "asset_id", "left_semi")
        keys = materialize(keys.unionByName(whole).distinct(), "changed-keys")
        rows = silver_stats(spark, root, silver.places_of(keys)).join(keys, SILVER_KEYS, "left_semi")
        _put(training_table, SILVER_KEYS, daily("bucket"), keys, gold.training_set(rows, assets, intervals), now)


def run_all(spark: SparkSession, landing: Landing, root: str, grain: str = "hour") -> dict[str, DataFrame]:
    """Refresh every table under ``root`` and return the stored frames by name.

    A run reads only readings that landed since the last one and rewrites only the folders its
    changes fall into. Every table has versions, and a run that dies is taken up by the next:
    bronze and states by their checkpoints, silver and gold by the marks in their logs.
    """
    refresh_bronze(spark, landing, root)
    _collect_states(spark, root, grain)
    for name in ("assets", "intervals"):
        _collect_assets(spark, root, name)
    assets = spark.read.parquet(f"{root}/bronze/assets").drop(RESCUED)
    intervals = spark.read.parquet(f"{root}/bronze/intervals").drop(RESCUED)
    refresh_silver(spark, root)
    refresh_gold(spark, root, assets, intervals)
    status = StoredTable(spark, f"{root}/gold/current_status").read()
    return {
        "stats": silver_stats(spark, root), "features": status.drop("prediction"), "status": status,
        "training": StoredTable(spark, f"{root}/gold/training").read()}
