"""Scans, sinks and table creation."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetra.catalog.registry import query, sql
from telemetra.operators.ordering import global_row_number
from telemetra.schemas import READING
from telemetra.session import scratch_path
from telemetra.sources import files, rescue, roles, sinks

READING_COLUMNS = "event_id, asset_id, epoch_s, event_type, energy, channel_k"


def landing_copy(spark, df, label, data_format="json"):
    """Write a frame as a landing folder and return its path."""
    path = scratch_path(spark, label)
    df.write.format(data_format).save(path)
    return path


def plain_readings(spark, folder):
    return roles.telemetry(spark, folder).drop("event_time")


@query("scan_json", sql(f"SELECT {READING_COLUMNS} FROM telemetry", "telemetry"))
def scan_json(spark, folder):
    path = landing_copy(spark, plain_readings(spark, folder), "scan-json")
    return files.scan_json(spark, path).select(*READING_COLUMNS.split(", "))


@query(
    "scan_parquet",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
)
def scan_parquet(spark, folder):
    return files.scan_parquet(spark, f"{folder}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


@query("scan_table", sql("SELECT asset_id, model, location, country FROM assets", "assets"))
def scan_table(spark, folder):
    name = "telemetra_scan_table"
    sinks.overwrite_table(
        roles.assets(spark, folder), name, scratch_path(spark, "scan-table"),
        "asset metadata with coordinates as delivered",
    )
    return files.scan_table(spark, name).select("asset_id", "model", "location", "country")


@query(
    "scan_binary",
    "SELECT lang, count(*) AS page_count, CAST(sum(strlen(html) + 1) AS BIGINT) AS total_bytes "
    "FROM (SELECT regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang, html FROM pages) "
    "GROUP BY lang",
)
def scan_binary(spark, folder):
    """Pages land as one text file set per language and are read back as bytes."""
    pages = roles.table(spark, folder, "pages").select(
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"), "html"
    )
    path = scratch_path(spark, "scan-binary")
    pages.write.partitionBy("lang").option("lineSep", "\u0001").text(path)
    found = files.scan_binary(spark, path, "part-*")
    lang = F.regexp_extract("path", r"lang=([a-z]+)/", 1)
    # each page ends in one separator byte, so splitting a file counts its pages
    pages_in_file = F.size(F.split(F.decode("content", "UTF-8"), "\u0001")) - 1
    return found.groupBy(lang.alias("lang")).agg(
        F.sum(pages_in_file.cast("bigint")).alias("page_count"),
        F.sum("length").alias("total_bytes"),
    )


@query(
    "list_files",
    "SELECT 'event_type=' || event_type AS folder, CAST(1 AS BIGINT) AS file_count, "
    "CAST(sum(strlen(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS total_bytes "
    "FROM events GROUP BY event_type",
)
def list_files(spark, folder):
    """Folders of a partitioned copy, one text file of reading numbers each, and their bytes."""
    path = scratch_path(spark, "list-files")
    roles.telemetry(spark, folder).select("event_type", F.col("event_id").cast("string")).repartition(
        "event_type").write.partitionBy("event_type").text(path)
    listed = files.list_files(spark, path, "*.txt")
    return listed.groupBy(F.element_at(F.split("path", "/"), -2).alias("folder")).agg(
        F.count("name").alias("file_count"), F.sum("size").alias("total_bytes")
    )


_LISTED = ("events", "lineitem", "orders")


@query(
    "list_tables",
    " UNION ALL ".join(
        f"SELECT 'telemetra_listed_{name}' AS table_name, count(*) AS row_count FROM {name}"
        for name in _LISTED
    ),
)
def list_tables(spark, folder):
    """Names from the catalog, each with the rows of its table."""
    for name in _LISTED:
        roles.table(spark, folder, name).createOrReplaceTempView(f"telemetra_listed_{name}")
    found = files.list_tables(spark).where(F.col("tableName").startswith("telemetra_listed_"))
    counts = None
    for row in found.collect():
        part = spark.table(row["tableName"]).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(row["tableName"]).alias("table_name"), "row_count"
        )
        counts = part if counts is None else counts.unionByName(part)
    return counts


@query("sink_overwrite", sql("SELECT asset_id, location FROM assets", "assets"))
def sink_overwrite(spark, folder):
    """A second write replaces the first."""
    name = "telemetra_sink_overwrite"
    path = scratch_path(spark, "sink-overwrite")
    assets = roles.assets(spark, folder).select("asset_id", "location")
    sinks.overwrite_table(assets.withColumn("location", F.lit("old")), name, path)
    sinks.overwrite_table(assets, name, path)
    return spark.table(name)


@query(
    "sink_append",
    sql(
        "SELECT model, lat, count(*) AS row_count FROM (SELECT model, lat FROM assets UNION ALL "
        "SELECT model, 'ERROR' FROM assets) GROUP BY model, lat",
        "assets",
    ),
)
def sink_append(spark, folder):
    """Unreadable rows appended to a folder of good ones."""
    assets = roles.assets(spark, folder).select("asset_id", "model", "lat")
    path = landing_copy(spark, assets, "sink-append")
    sinks.append_folder(assets.withColumn("lat", F.lit("ERROR")), path, "json")
    return (
        files.scan_json(spark, path, "asset_id bigint, model string, lat string")
        .groupBy("model", "lat").agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "sink_repartitioned",
    "SELECT CAST(5 AS BIGINT) AS file_count, count(*) AS row_count FROM orders",
)
def sink_repartitioned(spark, folder):
    path = scratch_path(spark, "sink-repartitioned")
    sinks.write_files(roles.table(spark, folder, "orders"), path, 5)
    rows = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return rows.agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("n").alias("row_count")
    )


@query(
    "compact_files",
    "SELECT count(*) AS row_count, round(sum(o_totalprice), 2) AS total_price FROM orders",
)
def compact_files(spark, folder):
    small = scratch_path(spark, "compact-small")
    large = scratch_path(spark, "compact-large")
    sinks.write_files(roles.table(spark, folder, "orders"), small, 32)
    sinks.compact(spark, small, large)
    return spark.read.parquet(large).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.sum("o_totalprice"), 2).alias("total_price"),
    )


@query(
    "cluster_by_asset",
    sql(
        "SELECT asset_id, count(*) AS reading_count, round(sum(energy), 4) AS total_energy "
        "FROM telemetry GROUP BY asset_id",
        "telemetry",
    ),
)
def cluster_by_asset(spark, folder):
    path = scratch_path(spark, "clustered")
    sinks.cluster_by(roles.telemetry(spark, folder), path, "asset_id")
    return spark.read.parquet(path).groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.round(F.sum("energy"), 4).alias("total_energy"),
    )


@query("ctas_if_absent", sql("SELECT asset_id, model FROM assets", "assets"))
def ctas_if_absent(spark, folder):
    """The second creation is ignored."""
    name = "telemetra_ctas_" + scratch_path(spark, "x")[-12:]
    assets = roles.assets(spark, folder).select("asset_id", "model")
    sinks.create_if_absent(assets, name, scratch_path(spark, "ctas"))
    sinks.create_if_absent(assets.limit(0), name, scratch_path(spark, "ctas"))
    return spark.table(name)


@query(
    "truncate_reload",
    sql("SELECT asset_id, location FROM assets WHERE model = 'large'", "assets"),
)
def truncate_reload(spark, folder):
    """Empty a table, then insert new rows into it."""
    name = "telemetra_truncate"
    assets = roles.assets(spark, folder)
    slim = assets.select("asset_id", "location")
    sinks.overwrite_table(slim, name, scratch_path(spark, "truncate"))
    sinks.truncate(spark, name)
    sinks.insert_into(slim.where(assets.model == "large"), name)
    return spark.table(name)


@query(
    "values_table",
    "SELECT p.type, v.factor * count(*) AS weighted_parts FROM (SELECT p_type AS type FROM part) p "
    "JOIN (VALUES ('ECONOMY', 2), ('SMALL', 3), ('PROMO', 5)) v(type, factor) ON p.type = v.type "
    "GROUP BY p.type, v.factor",
)
def values_table(spark, folder):
    """Literal rows inserted into a table, then joined with the parts."""
    rows = spark.sql("SELECT * FROM VALUES ('ECONOMY', 2), ('SMALL', 3), ('PROMO', 5) AS v(type, factor)")
    name = "telemetra_values"
    sinks.overwrite_table(rows.limit(0), name, scratch_path(spark, "values"))
    sinks.insert_into(rows, name, overwrite=True)
    counted = roles.parts(spark, folder).groupBy("type").agg(F.count(F.lit(1)).alias("_n"))
    return counted.join(spark.table(name), "type").select(
        "type", (F.col("factor") * F.col("_n")).alias("weighted_parts")
    )


@query("row_identity", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row_id FROM documents")
def row_identity(spark, folder):
    documents = roles.table(spark, folder, "documents").select("doc_id")
    return global_row_number(documents, [F.col("doc_id")], "row_id")


@query("distinct_values", sql("SELECT DISTINCT location, country FROM assets", "assets"))
def distinct_values(spark, folder):
    return roles.assets(spark, folder).select("location", "country").distinct()


@query(
    "rescue_unmatched",
    sql(
        """
        SELECT event_type, count(*) AS line_count,
               count(*) FILTER (event_type IN ('click', 'view', 'signup')) AS rescued_count,
               count(*) FILTER (event_type <> 'signup') AS typed_ids,
               count(*) FILTER (event_type NOT IN ('signup', 'click')) AS typed_energies
        FROM telemetry GROUP BY event_type""",
        "telemetry",
    ),
)
def rescue_unmatched(spark, folder):
    """Clicks carry a wrong type, views an extra field, signups are not JSON at all."""
    readings = roles.telemetry(spark, folder)
    good = F.to_json(F.struct("event_id", "event_type", "energy"))
    wrong = F.to_json(F.struct("event_id", "event_type", F.lit("n/a").alias("energy")))
    extra = F.to_json(F.struct("event_id", "event_type", "energy", F.lit(1).alias("unknown")))
    line = (
        F.when(F.col("event_type") == "click", wrong)
        .when(F.col("event_type") == "view", extra)
        .when(F.col("event_type") == "signup", F.lit("not json"))
        .otherwise(good)
    )
    lines = readings.select(F.col("event_type").alias("sent"), line.alias("value"))
    fields = type(READING)([f for f in READING if f.name in ("event_id", "energy", "event_type")])
    return rescue.rescue_json(lines, fields).groupBy(F.col("sent").alias("event_type")).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count(rescue.RESCUED).alias("rescued_count"),
        F.count("event_id").alias("typed_ids"),
        F.count("energy").alias("typed_energies"),
    )


@query(
    "rescue_parquet",
    sql(
        """
        SELECT event_id, event_type, CASE WHEN event_type <> 'click' THEN energy END AS energy,
               CASE event_type WHEN 'click' THEN '{"energy":"n/a"}'
                    WHEN 'view' THEN '{"unknown":' || event_id || '}' END AS rescued
        FROM telemetry""",
        "telemetry",
    ),
)
def rescue_parquet(spark, folder):
    """Files with energies as text and a column nobody declared: clicks carry no number, views
    something unknown."""
    kind = F.col("event_type")
    sent = roles.telemetry(spark, folder).select(
        "event_id", "event_type",
        F.when(kind == "click", "n/a").otherwise(F.col("energy").cast("string")).alias("energy"),
        F.when(kind == "view", F.col("event_id")).alias("unknown"),
    )
    landing = landing_copy(spark, sent, "rescue-parquet", "parquet")
    fields = type(READING)([f for f in READING if f.name in ("event_id", "energy", "event_type")])
    return rescue.rescue_columns(files.scan_parquet(spark, landing), fields).withColumnRenamed(
        rescue.RESCUED, "rescued")
