"""Enrichment and labelling joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BROADCAST_BYTES = 32 << 20
TEXT_BYTES = 64
SECONDS_PER_BIN = 86_400
LEVEL_BINS = 64  # an interval uses the level at which it spans at most this many bins
LEVELS = 4  # widths of 1, 64, 4,096 and 262,144 fine bins


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a join side for broadcast if its measured size is below the limit.

    The size is summed over all rows in a distributed pass, because Spark's own estimate for
    a joined or filtered frame can be far off and would shuffle the facts for nothing. A
    larger side is returned as it is: Spark then shuffles both sides and splits skewed
    partitions.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def measured_bytes(df: DataFrame) -> int:
    """About the memory all rows take, summed in a distributed pass."""
    text = F.to_json(F.struct(*df.columns))
    fixed = 8 * (len(df.columns) + 1)  # numbers, offsets and null bits of a row
    row = F.octet_length(text).cast("bigint") + fixed
    return df.agg(F.sum(row).alias("bytes")).first()["bytes"] or 0


def row_bytes(schema: T.StructType) -> int:
    """About the memory a row takes, texts and arrays reckoned at ``TEXT_BYTES``."""
    return 16 + sum(
        8 if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) else TEXT_BYTES
        for f in schema)


def enrich(
    facts: DataFrame, assets: DataFrame, key: str = "asset_id", measure: bool = True
) -> DataFrame:
    """Inner join with asset metadata, key merged.

    ``measure`` sizes the metadata first, so that raw readings need no shuffle when it is
    small. For facts that are already aggregated it can be turned off; Spark then decides
    while it runs.
    """
    return facts.join(small_side(assets) if measure else assets, [key], "inner")


def interval_bins(intervals: DataFrame, bin_seconds: int) -> DataFrame:
    """One row per time bin an interval touches, at the level that suits its length.

    An interval gets at most ``LEVEL_BINS + 1`` rows, however long it is.
    """
    span = F.col("end_time") - F.col("start_time")
    level = F.lit(LEVELS - 1)
    for lower in reversed(range(LEVELS - 1)):
        level = F.when(span <= bin_seconds * LEVEL_BINS ** (lower + 1), lower).otherwise(level)
    width = F.lit(bin_seconds) * F.pow(F.lit(LEVEL_BINS), F.col("_level")).cast("bigint")
    return (
        intervals.where(F.col("start_time") < F.col("end_time"))
        .withColumn("_level", level)
        .withColumn(
            "_bin",
            F.explode(
                F.sequence(
                    F.floor(F.col("start_time") / width), F.floor(F.col("end_time") / width)
                )
            ),
        )
    )


def label_by_interval(
    stats: DataFrame,
    intervals: DataFrame,
    key: str = "asset_id",
    time: str = "bucket",
    bin_seconds: int = SECONDS_PER_BIN,
) -> DataFrame:
    """Attach every interval of the asset that strictly contains the row's time.

    Overlapping intervals fan out. Both sides are keyed by asset and time bin: an interval is
    repeated once per bin it touches, and a row lies in one bin of each level, so each match is
    found exactly once. An asset with very many rows and intervals is thereby cut into
    day-sized pieces instead of comparing all its rows with all its intervals in one task.
    Spark cannot see how many rows the bins make, so they are broadcast only after they were
    counted, and otherwise joined by sorting, where skewed partitions can be split. Rows are
    looked up only at levels that some interval uses.
    """
    seconds = F.unix_seconds(time)
    bins = interval_bins(intervals, bin_seconds)
    # one narrow pass tells which levels occur, at most four, and how many rows they have
    counted = bins.groupBy("_level").agg(F.count(F.lit(1)).alias("n")).collect()
    places = F.array(*[
        F.struct(
            F.lit(level).alias("_level"),
            F.floor(seconds / (bin_seconds * LEVEL_BINS**level)).alias("_bin"))
        for level in sorted(r["_level"] for r in counted) or [0]
    ])
    left = stats.withColumn("_place", F.explode(places)).select(*stats.columns, "_place.*")
    small = sum(r["n"] for r in counted) * row_bytes(bins.schema) <= BROADCAST_BYTES
    side = F.broadcast(bins) if small else bins.hint("merge")
    matched = left.join(side, [key, "_level", "_bin"], "inner")
    at = F.unix_micros(time)
    return matched.where(
        (F.col("start_time") * 1_000_000 < at) & (F.col("end_time") * 1_000_000 > at)
    ).drop("_level", "_bin")


def label_by_key(
    stats: DataFrame, assets: DataFrame, intervals: DataFrame, key: str = "asset_id"
) -> DataFrame:
    """Three-way join on the key alone: every interval of the asset, whatever the time.

    With the metadata broadcast, only one join shuffles on the key, whose skewed partitions
    Spark can then split.
    """
    return enrich(stats, assets, key).join(intervals, [key])


def write_bucketed(df: DataFrame, name: str, path: str, key: str = "asset_id", buckets: int = 64) -> None:
    """Store a table hashed and sorted by key, so that joins on the key need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def label_by_key_bucketed(
    spark: SparkSession, stats: str, assets: str, intervals: str, key: str = "asset_id"
) -> DataFrame:
    """:func:`label_by_key` over three tables of :func:`write_bucketed`, bucket by bucket.

    All sides lie in the same buckets, in order of the key, so they are merged as they are read.
    """
    facts, known, spans = (spark.table(t) for t in (stats, assets, intervals))
    return facts.join(known.hint("merge"), [key]).join(spans.hint("merge"), [key])


def training_rows(
    labelled: DataFrame, features: list[str], key: str = "asset_id", skip_nulls: bool = False
) -> DataFrame:
    """Composite key and feature vector in front of the labelled rows.

    ``skip_nulls`` selects the join of the non-null key parts instead of a null key.
    """
    parts = [F.col(key).cast("string"), F.col("start_time").cast("string")]
    if skip_nulls:
        composite = F.concat_ws("-", *parts)
    else:
        composite = F.concat(parts[0], F.lit("-"), parts[1])
    return labelled.select(
        composite.alias("composite_key"),
        F.array(*features).alias("feature_vector"),
        "*",
    )


def spec_lookup(requests: DataFrame, specs: DataFrame, key: str = "asset_id") -> DataFrame:
    """One struct per requested key, null where the key is unknown. ``specs`` is unique on it."""
    packed = specs.select(key, F.struct(*specs.columns).alias("spec"))
    return requests.join(packed, [key], "left")
