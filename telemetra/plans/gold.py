"""From checked readings to scored assets and labelled training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemetra.functions.columns import rule_score
from telemetra.operators import joins, latest, quality, stats

CHANNELS = ("energy", "channel_k")

READING_RULES = [
    quality.Expectation("has_asset", "asset_id IS NOT NULL"),
    quality.Expectation("positive_energy", "energy IS NOT NULL AND energy > 0", drop=True),
]


def clean_readings(readings: DataFrame) -> DataFrame:
    return quality.expect(readings, READING_RULES)


def bucketed(
    readings: DataFrame, grain: str = "hour", percentiles: tuple[float, ...] = stats.PERCENTILES
) -> DataFrame:
    """Checked readings as statistics per asset and bucket."""
    return stats.bucket_stats(
        clean_readings(readings), "energy", CHANNELS, grain, percentiles=percentiles
    )


def current_features(bucket_stats: DataFrame, assets: DataFrame) -> DataFrame:
    """The latest bucket of every known asset with its metadata."""
    slim = bucket_stats.drop(*stats.channels_like(bucket_stats, "percentiles_"))
    newest = latest.latest_per_key(slim, ["asset_id"], "bucket")
    return joins.enrich(newest, assets, measure=False)


def current_features_every_bucket(bucket_stats: DataFrame, assets: DataFrame) -> DataFrame:
    """The other reading of "current": first row per asset and bucket, so all buckets stay.

    Statistics are already unique on that pair, which makes a ranking window redundant; use
    :func:`telemetra.operators.latest.dedupe_by_key` first on input that is not.
    """
    slim = bucket_stats.drop(*stats.channels_like(bucket_stats, "percentiles_"))
    return joins.enrich(slim.where(F.col("asset_id").isNotNull()), assets, measure=False)


def score(features: DataFrame) -> DataFrame:
    return features.withColumn("prediction", rule_score())


def current_status(readings: DataFrame, assets: DataFrame, grain: str = "day") -> DataFrame:
    """Latest state and predicted fault per asset; percentiles are not computed for it."""
    return score(current_features(bucketed(readings, grain, percentiles=()), assets))


def training_set(
    bucket_stats: DataFrame, assets: DataFrame, intervals: DataFrame, skip_nulls: bool = False
) -> DataFrame:
    known = joins.enrich(bucket_stats, assets, measure=False)
    labelled = joins.label_by_interval(known, intervals)
    return joins.training_rows(labelled, [f"std_{c}" for c in CHANNELS], skip_nulls=skip_nulls)


FEATURE_COLUMNS = [
    "asset_id", "bucket", "avg_energy", "std_energy", "std_channel_k",
    "location", "model", "country", "abnormal_channel",
]


def feature_table(training: DataFrame) -> DataFrame:
    """Selected features without nulls, one row per asset and bucket."""
    return latest.dedupe_by_key(
        training.select(*FEATURE_COLUMNS).dropna(), ["asset_id", "bucket"]
    )
