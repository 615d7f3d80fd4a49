"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from telemetra.llm import (
    audit, chat, collocations, langid, mixing, near, packing, quality, quantise, recurrent,
    repeats, secretscan, sharding,
)
from telemetra.llm.frames import documents, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(
        table(spark, sf_dir, "pages"), documents(spark, sf_dir))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.canonical(table(spark, sf_dir, "conversations"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_tokens", "n_fallback", "token_entropy")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.membership(documents(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(documents(spark, sf_dir))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent.rate(documents(spark, sf_dir))


def op9_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("full", "cut")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantise.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(documents(spark, sf_dir))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op13_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f for f in (
        op1_language_id, op2_chat_formatting, op3_quality_rules, op4_best_fit_packing,
        op5_minhash_near_dedup, op6_sharding, op7_suffix_array_dedup, op8_lm_scoring,
        op9_mixing_sources, op10_embedding_near_dedup, op11_secret_scans,
        op12_filter_interaction_audit, op13_phrase_collocation_mining)
} | {"pipeline": corpus_pipeline.run}

CHECKS = {
    "op9_mixing_sources": mixing.check_sql(),
    "op11_secret_scans": secretscan.check_sql(),
    "op12_filter_interaction_audit": audit.check_sql(),
    "op13_phrase_collocation_mining": collocations.check_sql(),
}
