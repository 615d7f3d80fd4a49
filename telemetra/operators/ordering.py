"""Exact global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.session import materialize

_ROW_BITS = 33  # fixed value: monotonically_increasing_id keeps the row number in these bits


def _sliced(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Range-partition and sort, then record slice number and row number within the slice.

    The result is written out once, so both numbers stay put on re-reads and after a lost
    executor.
    """
    marked = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    split = marked.withColumns(
        {
            "_slice": F.shiftright("_id", _ROW_BITS),
            "_row": F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1),
        }
    ).drop("_id")
    return materialize(split, label)


def _running_before(sizes: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sum over earlier slices. ``sizes`` has one row per slice (and key), never per input row."""
    before = (
        Window.partitionBy(*keys).orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.withColumn("_before", F.coalesce(F.sum(value).over(before), F.lit(0)))


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_id") -> DataFrame:
    """Dense numbers from 1 in the given order, which should be unique.

    One range shuffle sorts the rows; only one count per slice is ever gathered.
    """
    sliced = _sliced(df, order, "row-number")
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _running_before(sizes, "_n").select("_slice", "_before")
    # at most one row per slice, so this side is bounded by the partition count
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_before") + F.col("_row") + 1)
        .drop("_slice", "_row", "_before")
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the key, in a unique order.

    A key of any size is spread over range slices; each slice is summed alone and shifted by
    the totals of the slices before it.
    """
    sliced = _sliced(df, [F.col(c) for c in [*keys, *order]], "running-total")
    sizes = sliced.groupBy("_slice", *keys).agg(F.sum(value).alias("_n"))
    offsets = _running_before(sizes, "_n", keys).select("_slice", *keys, "_before")
    within = (
        Window.partitionBy("_slice", *keys).orderBy("_row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sliced.withColumn("_part", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(offsets, ["_slice", *keys])
        .withColumn(name, F.col("_before") + F.col("_part"))
        .drop("_slice", "_row", "_before", "_part")
    )
