"""Batch file and table access: scans by path or name, folder listings."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines by path; without a schema the types are inferred from the whole input."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def scan_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def scan_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file with its bytes; the listing is distributed by Spark."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Name and size of every file; the bytes themselves are pruned from the scan."""
    return scan_binary(spark, path, glob).select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views the session can see, as rows."""
    where = f" IN {database}" if database else ""
    return spark.sql(f"SHOW TABLES{where}")


# --- inferred schemas that are kept and grow -------------------------------------------

SLACK_MS = 2_000


def save_schema(
    spark: SparkSession, schema: T.StructType, path: str, newest: int | None = None
) -> None:
    """Keep a schema, with the time (epoch ms) of the newest file it was inferred from."""
    stored = json.dumps({"schema": schema.jsonValue(), "newest": newest})
    spark.createDataFrame([(stored,)], "schema string").coalesce(1).write.mode("overwrite").text(path)


def _stored(spark: SparkSession, path: str) -> dict | None:
    try:
        rows = spark.read.text(path).head(1)
    except Exception as error:  # the folder does not exist before the first run
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return json.loads(rows[0][0]) if rows else None


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    stored = _stored(spark, path)
    return T.StructType.fromJson(stored["schema"]) if stored else None


def union_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns keep their place and type, as the files already stored have them; unseen
    columns are added at the end. Values that no longer fit are the reader's to rescue."""
    known = {f.name.lower() for f in old}
    return T.StructType(list(old) + [f for f in new if f.name.lower() not in known])


def resolve_schema(spark: SparkSession, folder: str, data_format: str, store: str) -> T.StructType:
    """Infer the schema of the folder's new files, merge it with the stored one and store both.

    Only files at least as new as the newest one seen so far are read (less ``SLACK_MS``, for
    files that land while others are listed), so a run costs no more than what came in since
    the last. The listing itself reads no content.
    """
    kept = _stored(spark, store)
    known = T.StructType.fromJson(kept["schema"]) if kept else None
    newest = list_files(spark, folder).agg(F.unix_millis(F.max("modified")).alias("at")).first()["at"]
    reader = spark.read.option("mergeSchema", "true")
    if kept and kept["newest"] is not None:
        after = kept["newest"] - SLACK_MS
        if newest is None or newest <= after:  # landed files may have been cleared away
            return known
        moment = dt.datetime.fromtimestamp(after / 1000, dt.timezone.utc)
        reader = reader.option("modifiedAfter", f"{moment:%Y-%m-%dT%H:%M:%S}Z")
    seen = reader.format(data_format).load(folder).schema
    merged = seen if known is None else union_schema(known, seen)
    if known is None or len(merged) != len(known) or newest != kept["newest"]:
        save_schema(spark, merged, store, newest)
    return merged
