"""Incremental folder ingestion with checkpoints, rescued data and growing schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from telemetra.operators.quality import Expectation, expect, rule_counts
from telemetra.sources.files import resolve_schema
from telemetra.sources.rescue import rescue_columns, rescue_json
from telemetra.streaming.versions import sum_versions, write_versions

CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def read_folder(
    spark: SparkSession,
    folder: str,
    data_format: str,
    schema: T.StructType | None = None,
    schema_store: str | None = None,
    rescue: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream.

    Without a schema it is inferred, merged with the one in ``schema_store`` and kept there;
    a restart then picks up added columns. ``rescue`` keeps what does not fit in
    ``_rescued_data``: JSON lines are read as text, Parquet files with their own columns, which
    ``schema_store`` remembers. An inferred JSON schema always rescues, because later files may
    hold values wider than the type a column was stored with.
    """
    if schema is None:
        if schema_store is None:
            raise ValueError("give a schema or a place to keep the inferred one")
        schema = resolve_schema(spark, folder, data_format, schema_store)
        rescue = rescue or data_format == "json"
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if rescue and data_format == "json":
        return rescue_json(reader.text(folder), schema)
    if rescue:
        if data_format != "parquet" or schema_store is None:
            raise ValueError("rescue takes JSON lines, or Parquet and a place to keep its schema")
        own = resolve_schema(spark, folder, data_format, schema_store)
        return rescue_columns(reader.schema(own).parquet(folder), schema)
    return reader.schema(schema).format(data_format).load(folder)


def write_stream(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet folder or a table, exactly once per checkpoint.

    The default drains what is there and stops; ``every`` keeps the job running instead. A run
    that stops stores its state as files, as the next one would have to play all changes since
    the first run again; one that goes on uploads only the changes of each batch.
    """
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if not table and path is None:
        raise ValueError("give a path or a table")
    conf = stream.sparkSession.conf
    before = conf.get(CHANGELOG, None)
    conf.set(CHANGELOG, str(bool(every)).lower())  # the query takes a copy of the settings
    try:
        return writer.format("parquet").toTable(table) if table else writer.format("parquet").start(path)
    finally:
        conf.unset(CHANGELOG) if before is None else conf.set(CHANGELOG, before)


def ingest_folder(
    spark: SparkSession,
    folder: str,
    data_format: str,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    rules: Sequence[Expectation] = (),
    every: str | None = None,
    unique: Sequence[str] = (),
    time: str = "event_time",
    lateness: str = "3 hours",
    **reading,
) -> StreamingQuery:
    """Read, check and store a landing folder; :func:`count_rules` keeps the rule counters.

    With ``unique`` only the first row of each such key is stored, within one file, across
    files and across restarts.
    """
    stream = expect(read_folder(spark, folder, data_format, **reading), rules)
    if unique:
        stream = without_copies(stream, unique, time, lateness)
    return write_stream(stream, checkpoint, path, table, every)


def without_copies(
    stream: DataFrame, keys: Sequence[str], time: str, lateness: str
) -> DataFrame:
    """The first row of each key; later ones are dropped while its state is kept.

    The state of a key is dropped when the watermark has passed its time by the lateness, so it
    stays bounded. A copy that arrives later still is itself behind the watermark and does not
    get through, as long as copies carry the time of the first.
    """
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a draining query; a failure is raised here."""
    query.awaitTermination()
    return query


def count_rules(
    stream: DataFrame,
    rules: Sequence[Expectation],
    path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the rule counters of every micro-batch, before any row is dropped.

    A query of its own over the same source, which reads only the columns the rules name;
    :func:`rule_totals` sums what it stored, whatever the number of batches and restarts.
    """
    return write_versions(
        stream, path, checkpoint, "append", every, lambda batch: rule_counts(batch, rules)
    )


def rule_totals(spark: SparkSession, path: str) -> DataFrame:
    return sum_versions(spark, path)
