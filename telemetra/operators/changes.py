"""Changes to tables kept as plain files: updates, deletes, snapshots, change feed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.operators.latest import latest_per_key


def apply_updates(
    target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], version: str
) -> DataFrame:
    """Overwrite ``columns`` on matching keys; unmatched updates are ignored.

    The newest update of a key wins. Once matched, a null in the update is written too, so a
    note can be cleared.
    """
    newest = latest_per_key(updates, [key], version, [c for c in columns if c != version])
    change = newest.select(key, F.struct(*columns).alias("_change"))
    joined = target.join(change, [key], "left")
    hit = F.col("_change").isNotNull()
    renewed = {c: F.when(hit, F.col(f"_change.{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(renewed).select(*target.columns)


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows that stay: the condition is false or null."""
    return target.where(~F.coalesce(condition, F.lit(False)))


# --- snapshots: one folder partition per version -----------------------------------------

SNAPSHOT = "snapshot_id"


def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    """Store a complete version. Writing the same version twice leaves one copy."""
    df.write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}={version}")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def as_of(snapshots: DataFrame, version: int) -> DataFrame:
    """One version; the filter prunes to that folder."""
    return snapshots.where(F.col(SNAPSHOT) == version).drop(SNAPSHOT)


def as_of_time(snapshots: DataFrame, history: DataFrame, moment: dt.datetime) -> DataFrame:
    """The version that was newest at a moment; ``history`` holds version and commit time.

    The wanted version is a one-row aggregate, whose value prunes the version folders.
    """
    wanted = (
        history.where(F.col("committed_at") <= F.lit(moment))
        .agg(F.max(SNAPSHOT).alias(SNAPSHOT))
    )
    # exactly one row, by construction of a global aggregate
    return snapshots.join(F.broadcast(wanted), [SNAPSHOT], "left_semi").drop(SNAPSHOT)


def clone_snapshot(spark: SparkSession, path: str, version: int, target: str) -> None:
    """An independent copy of one version."""
    spark.read.parquet(f"{path}/{SNAPSHOT}={version}").write.mode("overwrite").parquet(target)


def restore_snapshot(spark: SparkSession, path: str, version: int, as_version: int) -> None:
    """Make an old version the newest one by writing it again."""
    write_snapshot(spark.read.parquet(f"{path}/{SNAPSHOT}={version}"), path, as_version)


def snapshot_history(snapshots: DataFrame, operations: DataFrame) -> DataFrame:
    """Version, what made it and how many rows it holds."""
    sizes = snapshots.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count"))
    return operations.join(sizes, [SNAPSHOT], "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0).cast("bigint"))
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed between two versions: insert, delete, update_before, update_after rows."""
    columns = [c for c in new.columns if c not in keys]
    was = old.select(*keys, F.struct(*columns).alias("_old"))
    now = new.select(*keys, F.struct(*columns).alias("_new"))
    joined = was.join(now, list(keys), "full_outer").where(
        ~F.col("_old").eqNullSafe(F.col("_new"))
    )

    def entry(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), F.col(side).alias("row"))

    rows = (
        F.when(F.col("_old").isNull(), F.array(entry("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(entry("delete", "_old")))
        .otherwise(F.array(entry("update_before", "_old"), entry("update_after", "_new")))
    )
    return joined.select(*keys, F.explode(rows).alias("_entry")).select(
        *keys, "_entry.change_type", "_entry.row.*"
    )


def apply_feed(old: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Roll a change feed forward: ``apply_feed(old, snapshot_diff(old, new))`` equals new."""
    gone = feed.where(F.col("change_type").isin("delete", "update_before")).select(*keys)
    come = feed.where(F.col("change_type").isin("insert", "update_after"))
    return old.join(gone, list(keys), "left_anti").unionByName(come.select(*old.columns))
