"""Row and column security as a join and a mask."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 10_000
MASK = "***"  # fixed value shown in place of a hidden one


def entitlements(spark: SparkSession, rows: Sequence[tuple[str, int]]) -> DataFrame:
    """User to depot assignments from literal rows.

    The caller holds the rows, so their number is known: a list below the bound is broadcast,
    which spares the parts a shuffle on their depot, where one depot may dominate.
    """
    frame = spark.createDataFrame(list(rows), "email string, depot int")
    return F.broadcast(frame) if len(rows) <= BROADCAST_ROWS else frame


def masked(column: str, allowed: bool) -> Column:
    return F.when(F.lit(allowed), F.col(column)).otherwise(F.lit(MASK))


def secured_parts(
    parts: DataFrame, grants: DataFrame, user: str | None = None, admin: bool = False
) -> DataFrame:
    """Parts of the user's depots with the article number hidden; by default those of the
    session's own user.

    An administrator matches every grant: parts of a depot appear once per user granted
    there, and parts of a depot granted to nobody do not appear, as in the secured view
    this reproduces.
    """
    mine = grants if admin else grants.where(
        F.col("email") == (F.current_user() if user is None else F.lit(user)))
    joined = parts.join(mine, parts.stock_location == mine.depot, "inner")
    rest = [parts[c] for c in parts.columns if c != "ean"]
    return joined.select(masked("ean", admin).alias("ean"), *rest)
