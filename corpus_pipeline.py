"""From raw documents to packed training sequences, in five stored stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetra.llm import mixing, near, packing, quality, repeats
from telemetra.llm.frames import documents
from telemetra.session import materialize


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.filtered(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near.representatives(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that another document holds first."""
    return repeats.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", good),
    ("near-duplicates", distinct),
    ("repeated passages", unrepeated),
    ("source mix", mixed),
    ("packing", packed),
]

# Tokenisers, sketches and hashed windows have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again by the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
