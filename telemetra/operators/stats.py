"""Time-bucketed statistics, histograms and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PERCENTILES = (0.1, 0.3, 0.6, 0.8, 0.95)  # fixed values of the reported percentile array


def channels_like(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name contains the pattern, in table order."""
    return [c for c in df.columns if pattern in c]


def channel_stats(
    measure: str,
    channels: Sequence[str],
    spread: bool = True,
    percentiles: Sequence[float] = PERCENTILES,
) -> list[Column]:
    exprs = [F.avg(measure).alias(f"avg_{measure}")]
    if spread:
        exprs += [F.stddev_pop(c).alias(f"std_{c}") for c in channels]
    if percentiles:
        exprs += [
            F.percentile_approx(c, list(percentiles)).alias(f"percentiles_{c}") for c in channels
        ]
    return exprs


def bucket_stats(
    readings: DataFrame,
    measure: str,
    channels: Sequence[str],
    grain: str = "hour",
    time: Column | str = "event_time",
    key: str = "asset_id",
    percentiles: Sequence[float] = PERCENTILES,
) -> DataFrame:
    """Mean of the measure, population deviation and percentiles per channel, asset and bucket.

    Every aggregate here merges partial states, so an asset holding a third of all readings
    leaves each scan task as one row per bucket. Rows without asset or time are dropped
    before the aggregate, which is the same as dropping their groups after it.
    """
    at = F.col(time) if isinstance(time, str) else time
    return (
        readings.withColumn("bucket", F.date_trunc(grain, at))
        .where(F.col(key).isNotNull() & F.col("bucket").isNotNull())
        .groupBy(key, "bucket")
        .agg(*channel_stats(measure, channels, percentiles=percentiles))
    )


# --- mergeable states -------------------------------------------------------------------

SKETCH_K = 800  # size of a quantile sketch; its rank error stays below half a percent


def channel_states(
    readings: DataFrame, channels: Sequence[str], grain: str = "hour",
    time: Column | str = "event_time", key: str = "asset_id",
) -> DataFrame:
    """Count, mean, squared deviation and quantile sketch per channel, asset and bucket.

    States of the same bucket from other rows merge with these (:func:`merged_states`), so a
    bucket never needs its raw readings again. A channel without values has count 0.
    """
    at = F.col(time) if isinstance(time, str) else time
    exprs = []
    for c in channels:
        exprs += [
            F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"mean_{c}"),
            (F.var_pop(c) * F.count(c)).alias(f"m2_{c}"),
            F.kll_sketch_agg_double(F.col(c).cast("double"), SKETCH_K).alias(f"sketch_{c}"),
        ]
    return (
        readings.withColumn("bucket", F.date_trunc(grain, at))
        .where(F.col(key).isNotNull() & F.col("bucket").isNotNull())
        .groupBy(key, "bucket").agg(*exprs)
    )


def merged_states(states: DataFrame, channels: Sequence[str], *by: str) -> DataFrame:
    """States of all rows with the same ``by`` as one."""
    exprs = []
    for c in channels:
        n, mean = F.sum(f"n_{c}"), F.sum(F.col(f"n_{c}") * F.col(f"mean_{c}")) / F.sum(f"n_{c}")
        spread = F.sum(F.col(f"m2_{c}") + F.col(f"n_{c}") * F.col(f"mean_{c}") ** 2)
        exprs += [
            n.alias(f"n_{c}"), F.when(n > 0, mean).alias(f"mean_{c}"),
            F.when(n > 0, F.greatest(spread - n * mean**2, F.lit(0.0))).alias(f"m2_{c}"),
            F.kll_merge_agg_double(f"sketch_{c}", SKETCH_K).alias(f"sketch_{c}"),
        ]
    return states.groupBy(*by).agg(*exprs)


def sketch_quantiles(sketch: str, count: str, shares: Sequence[float]) -> Column:
    """Quantiles of a stored sketch, null if it holds no value."""
    wanted = F.array(*[F.lit(float(p)) for p in shares])
    return F.when(F.col(count) > 0, F.kll_sketch_get_quantile_double(sketch, wanted))


def stats_of_states(
    states: DataFrame, measure: str, channels: Sequence[str], keys: Sequence[str],
    percentiles: Sequence[float] = PERCENTILES,
) -> DataFrame:
    """The columns of :func:`bucket_stats` from states; percentiles come from the sketches."""
    spread = [F.sqrt(F.col(f"m2_{c}") / F.col(f"n_{c}")).alias(f"std_{c}") for c in channels]
    points = [
        sketch_quantiles(f"sketch_{c}", f"n_{c}", percentiles).alias(f"percentiles_{c}")
        for c in channels] if percentiles else []
    return states.select(*keys, F.col(f"mean_{measure}").alias(f"avg_{measure}"), *spread, *points)


def spread_percentiles(df: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Percentile arrays as one column per point, named p10_x, p30_x and so on."""
    points = {
        f"p{int(round(p * 100))}_{c}": F.col(f"percentiles_{c}")[i]
        for c in channels
        for i, p in enumerate(PERCENTILES)
    }
    return df.withColumns(points).drop(*[f"percentiles_{c}" for c in channels])


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Fixed-width bins, labelled with their lower edge."""
    edge = (F.floor(F.col(column) / F.lit(width)) * F.lit(width)).cast("double")
    return df.groupBy(edge.alias("bin_floor")).agg(F.count(F.lit(1)).alias("row_count"))


def series_sum(df: DataFrame, measures: Sequence[str], time: str = "event_time") -> DataFrame:
    """Sum of each measure per point in time."""
    return df.groupBy(time).agg(*[F.sum(m).alias(f"sum_{m}") for m in measures])


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    exprs = []
    for c in columns:
        exprs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*exprs)


def class_profile(df: DataFrame, label: str, x: str, y: str) -> DataFrame:
    """Distribution of two features per class, from mergeable moments."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(x).alias(f"avg_{x}"),
        F.stddev_pop(x).alias(f"std_{x}"),
        F.avg(y).alias(f"avg_{y}"),
        F.stddev_pop(y).alias(f"std_{y}"),
        F.corr(x, y).alias("correlation"),
    )
