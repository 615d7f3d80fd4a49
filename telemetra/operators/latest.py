"""One row per key: latest, first, deduplicated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int = 1
) -> DataFrame:
    """The first ``count`` rows of every key in the given order.

    The rank limit is applied inside each map task before the shuffle as well as after it
    (``WindowGroupLimit``), so a hot key sends at most ``count`` rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= count)
        .drop("_rank")
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key; ``ties`` make the choice deterministic."""
    return top_per_key(df, keys, [F.col(time).desc(), *[F.col(t).asc() for t in ties]])


def dedupe_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; the survivor is the smallest by the remaining columns."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return top_per_key(df, keys, rest or [F.lit(1)])
