"""Text extraction and retrieval."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from telemetra.catalog.registry import query, sql
from telemetra.functions import registered, text
from telemetra.operators import retrieval
from telemetra.session import spread
from telemetra.sources import roles

TOP = 5


def _hidden(column: str) -> str:
    for pattern in text.HIDDEN:
        quoted = pattern.replace("'", "''")
        column = f"regexp_replace({column}, '{quoted}', ' ', 'g')"
    return column


_BLOCKS = f"""
    SELECT page_id, list_filter(list_transform(
        regexp_split_to_array({_hidden('html')}, '{text.BLOCK}'),
        lambda b: trim(regexp_replace(regexp_replace(b, '{text.TAG}', '', 'g'),
                       '{text.SPACE}', ' ', 'g'))), lambda b: length(b) > 0) AS blocks
    FROM pages"""


@query(
    "page_elements",
    sql(
        "SELECT page_id, CAST(generate_subscripts(blocks, 1) - 1 AS INTEGER) AS position, "
        "unnest(blocks) AS content FROM split_pages",
        split_pages=_BLOCKS,
    ),
)
def page_elements(spark, folder):
    return text.page_elements(spread(roles.table(spark, folder, "pages").select("page_id", "html")))


@query(
    "page_text",
    sql(
        "SELECT page_id, array_to_string(blocks, chr(10)) AS full_text FROM split_pages",
        split_pages=_BLOCKS,
    ),
)
def page_text(spark, folder):
    return text.page_text(spread(roles.table(spark, folder, "pages").select("page_id", "html")))


@query(
    "join_elements",
    "SELECT doc_id, length(text) AS char_count, md5(text) AS text_digest FROM documents",
)
def join_elements(spark, folder):
    """Lines of a document as elements, joined back to the same text."""
    lines = F.transform(F.split("text", "\n"), lambda l: F.struct(l.alias("content")))
    joined = text.join_elements(lines)
    return roles.table(spark, folder, "documents").select(
        "doc_id",
        F.length(joined).cast("bigint").alias("char_count"),
        F.md5(joined).alias("text_digest"),
    )


@query(
    "variant_elements",
    "SELECT doc_id, len(string_split(text, chr(10))) AS element_count, "
    "md5(text) AS text_digest FROM documents",
)
def variant_elements(spark, folder):
    """A parsed document held as variant; its elements are taken out by path."""
    lines = F.transform(F.split("text", "\n"), lambda l: F.struct(l.alias("content")))
    as_json = F.to_json(F.struct(F.struct(lines.alias("elements")).alias("document")))
    items = text.document_elements(F.parse_json(as_json))
    return roles.table(spark, folder, "documents").select("doc_id", items.alias("items")).select(
        "doc_id",
        F.size("items").cast("bigint").alias("element_count"),
        F.md5(text.join_elements("items")).alias("text_digest"),
    )


@query(
    "extract_fields",
    "SELECT page_id, "
    + ", ".join(
        f"nullif(regexp_extract(html, '{p}', 1), '') AS {n}" for n, p in text.PAGE_FIELDS.items()
    )
    + " FROM pages",
)
def extract_fields(spark, folder):
    pages = roles.table(spark, folder, "pages")
    return pages.select("page_id", text.extract_fields("html").alias("f")).select("page_id", "f.*")


# --- nearest vectors --------------------------------------------------------------------


def asked(spark, folder, count):
    """The questions: the first vectors by key, handed over like a caller would."""
    rows = roles.table(spark, folder, "embeddings").orderBy("vec_id").limit(count).collect()
    return {row["vec_id"]: list(row["embedding"]) for row in rows}


def _similar(count: int) -> str:
    return f"""
        SELECT q.vec_id AS question_id, e.vec_id,
               list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))
               AS similarity
        FROM embeddings e, (SELECT * FROM embeddings ORDER BY vec_id LIMIT {count}) q"""


@query(
    "vector_topk",
    sql(
        f"SELECT vec_id, round(similarity, 4) AS similarity FROM similar_pairs "
        f"ORDER BY similar_pairs.similarity DESC, vec_id LIMIT {TOP}",
        similar_pairs=_similar(1),
    ),
)
def vector_topk(spark, folder):
    (question,) = asked(spark, folder, 1).values()
    index = roles.table(spark, folder, "embeddings")
    found = retrieval.nearest(index, "embedding", "vec_id", question, TOP)
    return found.select("vec_id", F.round("similarity", 4).alias("similarity"))


_BATCH = (
    f"SELECT * FROM similar_pairs QUALIFY row_number() OVER "
    f"(PARTITION BY question_id ORDER BY similarity DESC, vec_id) <= {TOP}"
)


def batch_of(spark, folder):
    index = roles.table(spark, folder, "embeddings")
    return retrieval.nearest_batch(
        index, "embedding", "vec_id", asked(spark, folder, 10), TOP
    )


@query(
    "vector_topk_batch",
    sql(
        "SELECT question_id, vec_id, round(similarity, 4) AS similarity FROM best",
        similar_pairs=_similar(10), best=_BATCH,
    ),
)
def vector_topk_batch(spark, folder):
    return batch_of(spark, folder).withColumn("similarity", F.round("similarity", 4))


@query("vector_topk_lsh")
def vector_topk_lsh(spark, folder):
    (question,) = asked(spark, folder, 1).values()
    index = roles.table(spark, folder, "embeddings")
    return retrieval.nearest_hashed(index, "embedding", "vec_id", question, TOP)


@query(
    "collect_guides",
    sql(
        "SELECT question_id, string_agg(label, ',' ORDER BY label) AS labels FROM "
        "(SELECT question_id, CAST(e.label AS VARCHAR) AS label FROM best "
        "JOIN embeddings e USING (vec_id)) GROUP BY question_id",
        similar_pairs=_similar(10), best=_BATCH,
    ),
)
def collect_guides(spark, folder):
    """The k retrieved labels per question as one sorted list."""
    labels = roles.table(spark, folder, "embeddings").select("vec_id", F.col("label").cast("string"))
    found = batch_of(spark, folder).join(labels, "vec_id")
    listed = F.array_sort(F.collect_list("label"))
    return found.groupBy("question_id").agg(F.array_join(listed, ",").alias("labels"))


@query(
    "guide_fn",
    sql(
        "SELECT question_id, string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY similarity DESC, "
        "vec_id) AS guides FROM best GROUP BY question_id",
        similar_pairs=_similar(10), best=_BATCH,
    ),
)
def guide_fn(spark, folder):
    """The same retrieval behind a SQL function that returns an array."""
    order = Window.partitionBy("question_id").orderBy(F.col("similarity").desc(), "vec_id")
    answers = batch_of(spark, folder).select(
        "question_id",
        F.row_number().over(order).alias("position"),
        F.col("vec_id").cast("string").alias("guide"),
    )
    name = registered.register_answers(spark, answers, "telemetra_guides_for")
    questions = roles.table(spark, folder, "embeddings").orderBy("vec_id").limit(10)
    return questions.selectExpr(
        "vec_id AS question_id", f"array_join({name}(vec_id), ',') AS guides"
    )


_TERMS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query(
    "text_topk",
    f"""
    WITH asked AS (
        SELECT DISTINCT unnest({_TERMS}) AS term
        FROM (SELECT text FROM benchmark ORDER BY item_id LIMIT 1)),
    cut AS (SELECT doc_id, coalesce({_TERMS}, []) AS terms FROM documents),
    corpus AS (SELECT count(*) AS n, avg(len(terms)) AS mean_length FROM cut),
    hits AS (
        SELECT doc_id, term, count(*) AS c
        FROM (SELECT doc_id, unnest(terms) AS term FROM cut) SEMI JOIN asked USING (term)
        GROUP BY ALL),
    weights AS (
        SELECT term, ln(1 + ((SELECT n FROM corpus) - count(*) + 0.5) / (count(*) + 0.5)) AS w
        FROM hits GROUP BY term),
    scores AS (
        SELECT doc_id, sum(w * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(terms)
               / (SELECT mean_length FROM corpus)))) AS score
        FROM hits JOIN weights USING (term) JOIN cut USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, round(similarity, 4) AS similarity
    FROM (SELECT doc_id, coalesce(score, 0) AS similarity
          FROM cut LEFT JOIN scores USING (doc_id) ORDER BY similarity DESC, doc_id LIMIT {TOP})""",
)
def text_topk(spark, folder):
    """The first benchmark passage as a question to all documents, whole texts on both sides."""
    documents = spread(roles.table(spark, folder, "documents").select("doc_id", "text"))
    question = roles.table(spark, folder, "benchmark").orderBy("item_id").first()["text"]
    found = retrieval.nearest_texts(documents, "doc_id", "text", question, TOP)
    return found.select("doc_id", F.round("similarity", 4).alias("similarity"))
