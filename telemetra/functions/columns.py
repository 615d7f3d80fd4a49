"""Column expressions shared by the plans. All compile to JVM code."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def epoch_hour(seconds: Column | str) -> Column:
    return F.date_trunc("hour", F.timestamp_seconds(seconds))


def time_features(time: Column | str) -> dict[str, Column]:
    """Hour, weekday (Monday 0), month, weekend flag and quarter."""
    at = F.col(time) if isinstance(time, str) else time
    weekday = F.weekday(at)
    return {
        "ts_hour": F.hour(at),
        "ts_dayofweek": weekday,
        "ts_month": F.month(at),
        "ts_is_weekend": (weekday >= 5).cast("int"),
        "ts_quarter": F.quarter(at),
    }


def hours_ahead(start: dt.datetime, hours: str) -> Column:
    """A fixed start plus a whole number of hours per row."""
    seconds = F.unix_seconds(F.lit(start).cast("timestamp")) + F.col(hours) * 3600
    return F.timestamp_seconds(seconds)


def numeric_coordinates(df: DataFrame, columns: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Text coordinates as doubles, null where unreadable."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def is_damaged(label: str) -> Column:
    return F.col(label) != "ok"


def status_label(prediction: str) -> Column:
    healthy = F.col(prediction) == "ok"
    fault = F.concat(F.lit("Faulty ("), F.col(prediction), F.lit(")"))
    return F.when(healthy, "Healthy").otherwise(fault)


def severity_hash(key: str) -> Column:
    """Repeatable pseudo-severity in [0, 1) from Spark's own hash.

    Widened before ``abs``, since the smallest int has no positive counterpart.
    """
    return (F.abs(F.hash(key).cast("bigint")) % 100 / 100.0).cast("double")


def severity_md5(key: str) -> Column:
    """Repeatable pseudo-severity in [0, 1) that other engines can recompute."""
    digest = F.md5(F.col(key).cast("string"))
    return (F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % 100 / 100.0).cast("double")


# Severity band edges.
SEVERITY_HIGH = 0.7
SEVERITY_MEDIUM = 0.4


def severity_band(score: str) -> Column:
    return (
        F.when(F.col(score) > SEVERITY_HIGH, "High")
        .when(F.col(score) >= SEVERITY_MEDIUM, "Medium")
        .otherwise("Low")
    )


def contains_any(columns: Sequence[str], term: str) -> Column:
    """Case-insensitive substring search over several columns; null never matches."""
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.lower(c).contains(term.lower()), F.lit(False))
    return found


# Fixed values of the rule that stands in for a trained model: the inputs it takes and the
# thresholds, checked in this order.
RULE_INPUTS = ("avg_energy", "std_energy")
RULE_SPREAD = 60.0
RULE_WEAK = 25.0
RULE_STRONG = 120.0


def rule_score(mean: Column | str = "avg_energy", spread: Column | str = "std_energy") -> Column:
    """Predicted failing channel of an asset, or ok."""
    mean = F.col(mean) if isinstance(mean, str) else mean
    spread = F.col(spread) if isinstance(spread, str) else spread
    return (
        F.when(spread > RULE_SPREAD, "channel_b")
        .when(mean < RULE_WEAK, "channel_d")
        .when(mean > RULE_STRONG, "channel_f")
        .otherwise("ok")
    )


def add_if_missing(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def random_choice(values: Sequence[str], seed: int) -> Column:
    """One of the values per row, all equally likely."""
    place = (F.floor(F.rand(seed) * len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), place)
