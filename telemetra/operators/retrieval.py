"""Nearest vectors and texts for given questions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.operators.latest import top_per_key
from telemetra.session import materialize

QUESTION_BLOCK = 256


def cosine(vector: str, question: Sequence[float]) -> Column:
    """Cosine with a literal vector, null for a zero vector. Compiled, no Python."""
    wanted = F.array(*[F.lit(float(x)) for x in question])
    length = float(np.linalg.norm(np.asarray(question, dtype="float64")))
    wide = F.col(vector).cast("array<double>")
    dot = F.aggregate(F.zip_with(wide, wanted, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda s, x: s + x * x)) * F.lit(length)
    return F.when(norm > 0, dot / norm)


def nearest(index: DataFrame, vector: str, key: str, question: Sequence[float], k: int) -> DataFrame:
    """Top-k for one question: every task keeps its own k best, the driver merges nothing."""
    scored = index.select(key, cosine(vector, question).alias("similarity"))
    return (
        scored.where(F.col("similarity").isNotNull())
        .orderBy(F.col("similarity").desc(), F.col(key))
        .limit(k)
    )


def nearest_batch(
    index: DataFrame, vector: str, key: str, questions: Mapping[int, Sequence[float]], k: int
) -> DataFrame:
    """Exact top-k for many questions the caller holds in memory.

    The index stays partitioned. Each task multiplies its Arrow batches with a block of
    questions and emits only the k best per question and batch, so no pair list is ever
    formed; a rank limit per question finishes the job. Questions beyond one block run as
    further blocks and are unioned, so any number of them is answered.
    """
    ids = sorted(questions)
    blocks = [ids[i : i + QUESTION_BLOCK] for i in range(0, len(ids), QUESTION_BLOCK)]
    found = None
    for block in blocks:
        part = _block_candidates(index, vector, key, {q: questions[q] for q in block}, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("no question given")
    return top_per_key(found, ["question_id"], [F.col("similarity").desc(), F.col(key)], k)


def _block_candidates(index, vector, key, questions, k) -> DataFrame:
    question_ids = np.array(list(questions), dtype="int64")
    matrix = np.array([questions[q] for q in questions], dtype="float64")
    lengths = np.linalg.norm(matrix, axis=1)
    matrix = matrix / np.where(lengths > 0, lengths, np.nan)[:, None]

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            rows = np.array(batch[vector].tolist(), dtype="float64")
            norms = np.linalg.norm(rows, axis=1)
            scores = (rows @ matrix.T) / np.where(norms > 0, norms, np.nan)[:, None]
            keys = batch[key].to_numpy()
            for column, question in enumerate(question_ids):
                score = scores[:, column]
                order = np.lexsort((keys, -score))[:k]
                order = order[~np.isnan(score[order])]
                yield pd.DataFrame(
                    {"question_id": question, key: keys[order], "similarity": score[order]}
                )

    schema = f"question_id bigint, {key} bigint, similarity double"
    return index.where(F.col(vector).isNotNull()).select(key, vector).mapInPandas(best, schema)


def nearest_hashed(
    index: DataFrame, vector: str, key: str, question: Sequence[float], k: int, tables: int = 4
) -> DataFrame:
    """Approximate top-k through hash buckets: candidates share a bucket with the question.

    Meant for an index that is hashed once and asked often; :func:`nearest` is the exact form.
    """
    wide = index.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    unit = Normalizer(inputCol="_v", outputCol="_unit", p=2.0)
    model = BucketedRandomProjectionLSH(
        inputCol="_unit", outputCol="_hash", bucketLength=2.0, numHashTables=tables, seed=42
    ).fit(unit.transform(wide))
    asked = np.asarray(question, dtype="float64")
    probe = Vectors.dense(asked / np.linalg.norm(asked))
    near = model.approxNearestNeighbors(unit.transform(wide), probe, k, distCol="_distance")
    # on unit vectors the squared distance is 2 - 2 cos
    return near.select(key, (1 - F.col("_distance") ** 2 / 2).alias("similarity"))


# --- text questions ---------------------------------------------------------------------

# The usual saturation and length weight of BM25.
SATURATION = 1.2
LENGTH_WEIGHT = 0.75
TERM = r"[\p{L}\p{N}]+"


def terms_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; a null text has none."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), F.array())


def nearest_texts(documents: DataFrame, key: str, text: str, question: str, k: int) -> DataFrame:
    """Top-k documents for a question by BM25 over exact terms, ties by key.

    Every whole text is cut into terms once. What is stored per document is its length and
    the counts of the question's terms; the corpus statistics are one mergeable aggregate
    over that narrow table, so there is no vocabulary and no hot word. Documents without any
    of the terms score 0.
    """
    spark = documents.sparkSession
    asked = spark.createDataFrame([(question,)], "q string").select(
        F.array_sort(F.array_distinct(terms_of(F.col("q")))).alias("q")
    ).first()["q"]
    cut = documents.select(F.col(key), terms_of(F.col(text)).alias("_terms"))
    matched = F.filter("_terms", lambda t: t.isin(asked) if asked else F.lit(False))
    hits = cut.select(
        key, F.size("_terms").cast("double").alias("_length"), matched.alias("_matched")
    ).select(
        key, "_length",
        F.transform(
            F.array(*[F.lit(t) for t in asked]).cast("array<string>"),
            lambda q: F.size(F.filter("_matched", lambda t: t == q)).cast("double"),
        ).alias("_counts"),
    )
    hits = materialize(hits, "text-hits")
    corpus = hits.agg(
        F.count(F.lit(1)).alias("documents"),
        F.avg("_length").alias("length"),
        *[F.count_if(F.col("_counts")[i] > 0).alias(f"in_{i}") for i in range(len(asked))],
    ).first()
    if not corpus["documents"] or not corpus["length"]:
        return hits.select(key, F.lit(0.0).alias("similarity")).orderBy(key).limit(k)
    total = float(corpus["documents"])
    weights = [
        math.log(1 + (total - corpus[f"in_{i}"] + 0.5) / (corpus[f"in_{i}"] + 0.5))
        for i in range(len(asked))
    ]
    damping = SATURATION * (
        1 - LENGTH_WEIGHT + LENGTH_WEIGHT * F.col("_length") / float(corpus["length"])
    )
    parts = F.transform("_counts", lambda c: c * (SATURATION + 1) / (c + F.col("_damping")))
    score = F.aggregate(
        F.zip_with(parts, F.array(*[F.lit(w) for w in weights]).cast("array<double>"),
                   lambda a, b: a * b),
        F.lit(0.0), lambda s, x: s + x,
    )
    scored = hits.withColumn("_damping", damping).select(key, score.alias("similarity"))
    return scored.orderBy(F.col("similarity").desc(), F.col(key)).limit(k)
