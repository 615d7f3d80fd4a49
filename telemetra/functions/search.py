"""Vector search as a table function in SQL."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf


@arrow_udtf(returnType="question int, item bigint, similarity double")
class VectorSearch:
    """Best ``k`` rows per question of each batch of a table of (key, vector).

    Questions are numbered from 0. Whoever calls it ranks what all batches gave, which is at
    most ``k`` rows per question and batch.
    """

    def eval(self, index: pa.RecordBatch, questions: pa.Array, k: pa.Array):
        wanted = np.array(questions[0].as_py(), np.float64).reshape(-1, len(questions[0].as_py()[0]))
        wanted = wanted / np.maximum(np.linalg.norm(wanted, axis=1, keepdims=True), 1e-300)
        most = k[0].as_py()
        valid = index.filter(index.column(1).is_valid())
        if not valid.num_rows:
            return
        keys = valid.column(0).to_numpy(zero_copy_only=False)
        rows = np.array(valid.column(1).to_pylist(), np.float64)
        size = np.linalg.norm(rows, axis=1)
        scores = rows @ wanted.T / np.where(size > 0, size, np.nan)[:, None]
        for number in range(len(wanted)):
            score = scores[:, number]
            best = np.lexsort((keys, -score))[:most]
            best = best[~np.isnan(score[best])]
            yield pa.table({
                "question": pa.array(np.full(len(best), number, np.int32)),
                "item": pa.array(keys[best].astype(np.int64)), "similarity": pa.array(score[best])})


def register_vector_search(spark: SparkSession, name: str = "vector_search") -> str:
    """``name(TABLE(index) PARTITION BY ..., questions, k)`` in SQL; returns the name."""
    spark.udtf.register(name, VectorSearch)
    return name
