"""Random and repeatable row samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from telemetra.session import materialize


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def sample_by_hash(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """Keep a row when the leading 60 bits of its key's md5 fall below the fraction.

    Repeatable across runs, partitionings and engines.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    slot = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("double")
    return df.where(slot < fraction * 2.0**60)


def shuffle_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    return df.orderBy(F.rand(seed))


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Parts that together hold every row exactly once.

    Each part is a scan of its own, so the rows are stored first: a frame computed anew could
    deal them differently.
    """
    return materialize(df, "random-split").randomSplit(list(weights), seed=seed)
