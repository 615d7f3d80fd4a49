"""Files laid out along a curve through two or more columns, and a table that says what to skip."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BITS = 10  # of a column's rank: rows are ranked into 1,024 equal parts
MOMENTS = ("timestamp", "timestamp_ntz", "date")


def _number(df: DataFrame, column: str) -> Column:
    """Column as a number that orders alike."""
    if dict(df.dtypes)[column] in MOMENTS:
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def curve(df: DataFrame, columns: Sequence[str], name: str = "curve") -> DataFrame:
    """Add the place of each row on a curve that visits near values of all columns together.

    Each column is replaced by its rank among 1,024 quantiles (one mergeable aggregate), and the
    bits of the ranks take turns. Nulls rank first.
    """
    shares = [k / 2**BITS for k in range(1, 2**BITS)]
    numbers = {f"_n{i}": _number(df, c) for i, c in enumerate(columns)}
    plain = df.withColumns(numbers)
    cuts = plain.agg(*[F.percentile_approx(n, shares).alias(n) for n in numbers]).first()
    parts = {}
    for n in numbers:
        edges = [float("-inf"), *sorted(set(cuts[n] or [0.0])), float("inf")]
        parts[n] = len(edges) - 1
        plain = Bucketizer(
            splits=edges, inputCol=n, outputCol=f"{n}_rank", handleInvalid="keep").transform(plain)
    place = F.lit(0).cast("bigint")
    for i, n in enumerate(numbers):
        # ranks of a column with few values are spread, so that all columns weigh the same
        spread = F.floor(F.col(f"{n}_rank") * 2**BITS / parts[n])
        rank = F.when(F.col(n).isNull(), 0).otherwise(spread).cast("bigint")
        for bit in range(BITS + 1):
            place = place.bitwiseOR(F.shiftleft(
                F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(columns) + i))
    return plain.withColumn(name, place).select(*df.columns, name)


def write_along_curve(df: DataFrame, path: str, columns: Sequence[str], files: int) -> None:
    """Store rows in ``files`` files of about equal size along the curve, and their bounds.

    A hash of the row orders equal places, so a hot value is cut over several files.
    """
    placed = curve(df, columns).withColumn("_spread", F.xxhash64(*df.columns))
    placed.repartitionByRange(files, "curve", "_spread").sortWithinPartitions("curve").drop(
        "curve", "_spread").write.mode("overwrite").parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    bounds = [
        part for c in columns
        for part in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"null_{c}"))]
    stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("row_count"), *bounds).coalesce(1).write.mode("overwrite").parquet(f"{path}/files")


def files_for(spark: SparkSession, path: str, wanted: Mapping[str, tuple]) -> list[str]:
    """Files that may hold rows with every column inside its (low, high) range, ends included."""
    table = spark.read.parquet(f"{path}/files")
    for column, (low, high) in wanted.items():
        table = table.where((F.col(f"max_{column}") >= F.lit(low)) & (F.col(f"min_{column}") <= F.lit(high)))
    return sorted(r["file"] for r in table.select("file").collect())


def read_slice(spark: SparkSession, path: str, wanted: Mapping[str, tuple]) -> DataFrame:
    """Rows inside all ranges, read from the files that may hold any."""
    schema = spark.read.parquet(f"{path}/rows").schema
    found = files_for(spark, path, wanted)
    rows = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    for column, (low, high) in wanted.items():
        rows = rows.where(F.col(column).between(F.lit(low), F.lit(high)))
    return rows


# --- change feed by checksums ------------------------------------------------------------

FAN = 16
DEPTH = 3  # 16, 256 and 4,096 ranges of a key
BOUNDS = 32  # separate bounds of a key that are handed to the scan


def key_edges(df: DataFrame, key: str) -> list[float]:
    """Bounds of 4,096 ranges of a numeric key with about equally many rows."""
    shares = [k / FAN**DEPTH for k in range(1, FAN**DEPTH)]
    found = df.agg(F.percentile_approx(F.col(key).cast("double"), shares, 100_000).alias("e")).first()["e"]
    return sorted(set(found or []))


def checksums(df: DataFrame, key: str, edges: Sequence[float]) -> DataFrame:
    """``level, node, n, sum``: rows and checksum of each range, and of the ranges above it.

    Checksums of rows add up, so the upper levels come from the lowest without reading rows.
    """
    lowest = _with_range(df, key, edges).groupBy(F.col("_range").alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("sum"))
    levels = [
        lowest.groupBy(F.floor(F.col("node") / FAN ** (DEPTH - level)).alias("node")).agg(
            F.sum("n").alias("n"), F.sum("sum").alias("sum")).withColumn("level", F.lit(level))
        for level in range(1, DEPTH + 1)]
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("level", "node", "n", "sum")


def _with_range(df: DataFrame, key: str, edges: Sequence[float]) -> DataFrame:
    splits = [float("-inf"), *edges, float("inf")]
    marked = df.withColumn("_k", F.col(key).cast("double"))
    return Bucketizer(splits=splits, inputCol="_k", outputCol="_r", handleInvalid="keep").transform(
        marked).withColumn("_range", F.col("_r").cast("bigint")).drop("_k", "_r")


def unequal_ranges(old: DataFrame, new: DataFrame) -> list[int]:
    """Lowest ranges whose checksums differ, found from the top: a range is only looked at if
    the one above it differs. At most one number per range comes to the driver."""
    above: list[int] | None = None
    for level in range(1, DEPTH + 1):
        sides = [t.where(F.col("level") == level) for t in (old, new)]
        if above is not None:
            sides = [t.where(F.floor(F.col("node") / FAN).isin(above)) for t in sides]
        was, now = (t.select("node", F.struct("n", "sum").alias(name)) for t, name in zip(sides, ("a", "b")))
        rows = was.join(now, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("node").collect()
        above = sorted(r["node"] for r in rows)
        if not above:
            return []
    return above


def rows_in_ranges(df: DataFrame, key: str, edges: Sequence[float], ranges: Sequence[int]) -> DataFrame:
    """Rows of the given ranges: by bounds of the key that reach the scan if these are few, else
    by the range of each row (there are at most 4,096)."""
    bounds = [float("-inf"), *edges, float("inf")]
    joined: list[list[float]] = []
    for r in ranges:  # neighbouring ranges become one
        low, high = bounds[r], bounds[r + 1]
        if joined and joined[-1][1] == low:
            joined[-1][1] = high
        else:
            joined.append([low, high])
    if len(joined) > BOUNDS:
        numbers = df.sparkSession.createDataFrame([(r,) for r in ranges], "_range bigint")
        return _with_range(df, key, edges).join(F.broadcast(numbers), "_range", "left_semi").drop("_range")
    wanted = F.lit(False)
    for low, high in joined:
        part = F.lit(True)
        if low != float("-inf"):
            part = part & (F.col(key) >= low)
        if high != float("inf"):
            part = part & (F.col(key) < high)
        wanted = wanted | part
    return df.where(wanted)
