"""Stored indexes and layouts: text, vectors, curves, checksums, buckets, numbers, comments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from telemetra.catalog.guides import TOP, _BATCH, _similar, asked
from telemetra.catalog.registry import CHECKS, query, rounded, sql
from telemetra.catalog.upkeep import order_versions
from telemetra.functions.search import register_vector_search
from telemetra.operators import changes, joins, latest, layout, retrieval
from telemetra.operators.stored import StoredTable, hashed
from telemetra.operators.textindex import TextIndex
from telemetra.operators.vectorindex import VectorIndex
from telemetra.plans import gold
from telemetra.schemas import ASSET
from telemetra.session import scratch_path
from telemetra.sources import roles, sinks


@query("text_index_topk", CHECKS["text_topk"])
def text_index_topk(spark, folder):
    """The same question as ``text_topk``, asked of an index that grew in two segments."""
    documents = roles.table(spark, folder, "documents").select("doc_id", "text")
    index = TextIndex(spark, scratch_path(spark, "text-index"))
    for part in (0, 1):
        index.add(documents.where(F.col("doc_id") % 2 == part), "doc_id", "text")
    question = roles.table(spark, folder, "benchmark").orderBy("item_id").first()["text"]
    return index.search(question, TOP).select(
        F.col("key").alias("doc_id"), F.round("similarity", 4).alias("similarity"))


_RARE = """
    WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents),
    rare AS (SELECT term FROM words GROUP BY term HAVING count(DISTINCT doc_id) = 2 ORDER BY term LIMIT 1)
    SELECT DISTINCT doc_id FROM words SEMI JOIN rare USING (term)"""


@query("text_index_rare_term", _RARE)
def text_index_rare_term(spark, folder):
    """A term that two documents have finds both of them and, past them, documents that score 0."""
    documents = roles.table(spark, folder, "documents").select("doc_id", "text")
    index = TextIndex(spark, scratch_path(spark, "text-index"))
    index.add(documents, "doc_id", "text")
    heads = spark.read.parquet(f"{index.path}/postings").groupBy("term").agg(F.sum("documents").alias("n"))
    rare = heads.where("n = 2").agg(F.min("term")).first()[0]
    found = index.search(rare or "", 4)
    return found.where("similarity > 0").select(F.col("key").alias("doc_id"))


def stored_vectors(spark, folder):
    """Two thirds of the vectors first, the rest added, some removed and put back."""
    vectors = roles.table(spark, folder, "embeddings")
    index = VectorIndex(spark, scratch_path(spark, "vector-index"))
    later = F.col("vec_id") % 3 == 2
    index.create(vectors.where(~later), "vec_id", "embedding")
    index.add(vectors.where(later), "vec_id", "embedding")
    back = vectors.where(F.col("vec_id") % 10 == 4)
    index.remove(back.select("vec_id"))
    index.add(back, "vec_id", "embedding")
    return index


@query(
    "vector_index_recall",
    "SELECT count(*) AS questions, true AS recall_reached FROM (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 50)",
)
def vector_index_recall(spark, folder):
    """Share of the true five neighbours of 50 questions that the index finds: at least 0.9."""
    questions = asked(spark, folder, 50)
    found = stored_vectors(spark, folder).search(questions, TOP).select("question_id", F.col("key").alias("vec_id"))
    true = retrieval.nearest_batch(
        roles.table(spark, folder, "embeddings"), "embedding", "vec_id", questions, TOP)
    both = true.join(found.withColumn("hit", F.lit(1)), ["question_id", "vec_id"], "left")
    return both.agg(
        F.count_distinct("question_id").alias("questions"),
        (F.sum(F.coalesce("hit", F.lit(0))) / F.count(F.lit(1)) >= 0.9).alias("recall_reached"))


@query(
    "vector_index_self",
    "SELECT vec_id AS question_id, CASE WHEN vec_id % 4 <> 1 THEN vec_id END AS vec_id "
    "FROM (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 50)",
)
def vector_index_self(spark, folder):
    """A stored vector finds itself with similarity 1, a removed one does not."""
    index = stored_vectors(spark, folder)
    index.remove(roles.table(spark, folder, "embeddings").where("vec_id % 4 = 1").select("vec_id"))
    best = index.search(asked(spark, folder, 50), 1)
    itself = (F.col("key") == F.col("question_id")) & (F.round("similarity", 9) == 1)
    return best.select("question_id", F.when(itself, F.col("key")).alias("vec_id"))


@query(
    "vector_search_tf",
    sql("SELECT question_id, vec_id, round(similarity, 4) AS similarity FROM best",
        similar_pairs=_similar(10), best=_BATCH),
)
def vector_search_tf(spark, folder):
    """The batch of questions through a table function over a table argument."""
    name = register_vector_search(spark, "telemetra_vector_search")
    roles.table(spark, folder, "embeddings").createOrReplaceTempView("telemetra_search_index")
    questions = asked(spark, folder, 10)
    numbers = ", ".join(
        "array(" + ", ".join(f"{float(x)!r}D" for x in q) + ")" for q in questions.values())
    found = spark.sql(
        f"""SELECT question, item AS vec_id, similarity FROM {name}(
            TABLE(SELECT vec_id, embedding, pmod(xxhash64(vec_id), 8) AS slice FROM telemetra_search_index)
            PARTITION BY (slice), array({numbers}), {TOP})""")
    ids = F.array(*map(F.lit, questions))
    top = latest.top_per_key(found, ["question"], [F.col("similarity").desc(), F.col("vec_id")], TOP)
    return top.select(
        ids[F.col("question")].alias("question_id"), "vec_id", F.round("similarity", 4).alias("similarity"))


# --- layouts ----------------------------------------------------------------------------

FILES = 64
SLICES = {
    "asset": {"asset_id": (3, 3)},
    "time": {"event_time": (dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 10, 12, tzinfo=dt.timezone.utc))},
}


@query(
    "curve_slices",
    sql(
        """
        SELECT 'asset' AS slice, count(*) AS row_count, coalesce(sum(event_id), 0) AS id_sum,
               true AS most_files_skipped FROM telemetry WHERE asset_id = 3
        UNION ALL
        SELECT 'time', count(*), coalesce(sum(event_id), 0), true FROM telemetry
        WHERE event_time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 12:00:00'""",
        "telemetry",
    ),
)
def curve_slices(spark, folder):
    """One layout serves a slice by asset and one by time: both skip more than half of the files."""
    path = scratch_path(spark, "curve")
    layout.write_along_curve(roles.telemetry(spark, folder), path, ["asset_id", "event_time"], FILES)
    total = spark.read.parquet(f"{path}/files").count()
    out = None
    for name, wanted in SLICES.items():
        read = len(layout.files_for(spark, path, wanted))
        part = layout.read_slice(spark, path, wanted).agg(
            F.lit(name).alias("slice"), F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.sum("event_id"), F.lit(0)).alias("id_sum"),
            F.lit(2 * read < total).alias("most_files_skipped"))
        out = part if out is None else out.unionByName(part)
    return out


@query("diff_by_checksums", CHECKS["snapshot_diff"])
def diff_by_checksums(spark, folder):
    """The change feed of two versions, joined only where checksums of key ranges differ."""
    first, second = order_versions(spark, folder)
    return checksum_feed(first, second)[0]


def checksum_feed(first, second):
    edges = layout.key_edges(first, "o_orderkey")
    ranges = layout.unequal_ranges(*(layout.checksums(t, "o_orderkey", edges) for t in (first, second)))
    parts = (layout.rows_in_ranges(t, "o_orderkey", edges, ranges) for t in (first, second))
    return changes.snapshot_diff(*parts, ["o_orderkey"]), len(ranges), len(edges) + 1


@query(
    "checksum_ranges",
    "SELECT 'update_before' AS change_type, count(*) AS row_count, true AS few_ranges FROM "
    "(SELECT 1 FROM orders LIMIT 1) UNION ALL "
    "SELECT 'update_after', count(*), true FROM (SELECT 1 FROM orders LIMIT 1)",
)
def checksum_ranges(spark, folder):
    """One changed order: one key range is read on both sides."""
    orders = roles.table(spark, folder, "orders")
    key = orders.agg(F.max("o_orderkey")).first()[0]
    other = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") == key, 0.5).otherwise(F.col("o_totalprice")))
    feed, read, _ = checksum_feed(orders, other)
    return feed.groupBy("change_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(read == 1).alias("few_ranges"))


def bucketed_tables(spark, folder):
    """Daily statistics, metadata and intervals as tables in the same buckets."""
    daily = gold.bucketed(roles.telemetry(spark, folder), "day", percentiles=())
    frames = {"stats": daily, "assets": roles.assets(spark, folder), "spans": roles.status_intervals(spark, folder)}
    names = []
    for label, df in frames.items():
        names.append(f"telemetra_{label}_" + scratch_path(spark, "x")[-12:])
        joins.write_bucketed(df, names[-1], scratch_path(spark, f"bucketed-{label}"), buckets=16)
    return names


@query("label_by_key_bucketed", CHECKS["label_by_key"])
def label_by_key_bucketed(spark, folder):
    labelled = joins.label_by_key_bucketed(spark, *bucketed_tables(spark, folder))
    return rounded(labelled.select("asset_id", "bucket", "avg_energy", "model", "abnormal_channel"))


@query(
    "row_identity_loads",
    "SELECT doc_id, row_number() OVER (ORDER BY doc_id % 3, doc_id) AS row_id FROM documents",
)
def row_identity_loads(spark, folder):
    """Three loads; each goes on counting where the last one ended."""
    documents = roles.table(spark, folder, "documents").select("doc_id")
    table = StoredTable(spark, scratch_path(spark, "identity"))
    table.create(documents.limit(0).withColumn("row_id", F.lit(0).cast("bigint")), ["doc_id"], hashed(["doc_id"], 8))
    for part in range(3):
        table.append_numbered(documents.where(F.col("doc_id") % 3 == part), [F.col("doc_id")], "row_id")
    return table.read()


@query(
    "table_comments",
    "SELECT column_name, comment, table_comment, (SELECT count(*) FROM supplier) AS row_count FROM (VALUES "
    + ", ".join(f"('{f.name}', '{f.metadata['comment']}', 'equipment under watch')" for f in ASSET)
    + ") v(column_name, comment, table_comment)",
)
def table_comments(spark, folder):
    """Descriptions of a stored table and its columns, read back from the catalog."""
    name = "telemetra_commented"
    assets = roles.assets(spark, folder)
    described = assets.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in ASSET])
    sinks.overwrite_table(described, name, scratch_path(spark, "commented"), comment="equipment under watch")
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    columns = spark.createDataFrame(
        [(c.name, c.description) for c in spark.catalog.listColumns(name)], "column_name string, comment string")
    return columns.select(
        "*", F.lit(about["Comment"]).alias("table_comment"), F.lit(spark.table(name).count()).alias("row_count"))
