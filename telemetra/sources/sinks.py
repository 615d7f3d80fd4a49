"""Table and folder sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _writer(df: DataFrame, mode: str, path: str | None):
    writer = df.write.mode(mode).format("parquet")
    return writer.option("path", path) if path else writer


def overwrite_table(
    df: DataFrame, name: str, path: str | None = None, comment: str | None = None
) -> None:
    _writer(df, "overwrite", path).saveAsTable(name)
    if comment:
        text = comment.replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{text}'")


def append_folder(df: DataFrame, path: str, data_format: str = "parquet") -> None:
    df.write.mode("append").format(data_format).save(path)


def write_files(df: DataFrame, path: str, files: int, data_format: str = "parquet") -> None:
    """Write about ``files`` equal files: rows are dealt round-robin, so no key can skew one."""
    df.repartition(files).write.mode("overwrite").format(data_format).save(path)


def create_if_absent(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create-table-as-select that leaves an existing table untouched."""
    _writer(df, "ignore", path).saveAsTable(name)


def insert_into(df: DataFrame, name: str, overwrite: bool = False) -> None:
    df.write.insertInto(name, overwrite=overwrite)


def truncate(spark: SparkSession, name: str) -> None:
    """Empty a table but keep its definition."""
    insert_into(spark.createDataFrame([], spark.table(name).schema), name, overwrite=True)


def compact(
    spark: SparkSession, source: str, target: str, target_bytes: int = 256 << 20
) -> int:
    """Rewrite many small files as files of about ``target_bytes`` each; returns the file count.

    The folder size is taken from the file listing. The scan already packs small files into
    splits, and coalescing merges neighbouring splits, so no row is shuffled.
    """
    total = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
        .agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
    )
    files = max(1, -(-int(total) // target_bytes))
    spark.read.parquet(source).coalesce(files).write.mode("overwrite").parquet(target)
    return files


def cluster_by(df: DataFrame, path: str, *keys: str, files: int | None = None) -> None:
    """Range-partition and sort by key, so slices by key prune row groups.

    ``_spread`` orders rows of equal key, letting the range boundaries cut through a hot key
    instead of sending all of it to one file. Without ``files`` small output is merged.
    """
    marked = df.withColumn("_spread", F.xxhash64(*[F.col(c) for c in df.columns]))
    order = [*keys, "_spread"]
    ranged = marked.repartitionByRange(files, *order) if files else marked.repartitionByRange(*order)
    ranged.sortWithinPartitions(*keys).drop("_spread").write.mode("overwrite").parquet(path)
