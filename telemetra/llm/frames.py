"""Distributed helpers: numbering inside keys and connected components."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from telemetra.session import materialize, pin_settings

BITMAP_BITS = 1 << 15  # bits of one of Spark's bitmaps
SIFT_BITS = 1 << 28  # 32 MB
TASK_EDGES = 50_000  # of a graph, for which one more task stores a round's tables
BROADCAST_EDGES = 100_000  # of a graph up to which a round's minima are sent to all tasks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def arrow_map(df: DataFrame, run, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` whose function yields dictionaries of columns instead of batches."""
    kinds = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kinds)

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(batches):
            yield pa.RecordBatch.from_arrays(
                [as_arrow(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(wrapped, kinds)


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def number_within(df: DataFrame, key: str, name: str, label: str) -> DataFrame:
    """Gapless numbers from 0 inside each key, in no particular order.

    Each task numbers its own rows per key; the counts of earlier tasks shift them. Only one
    count per task and key is ever gathered, so a key of any size stays spread out.
    """
    schema = T.StructType([*df.schema, T.StructField("_part", T.IntegerType()),
                           T.StructField("_place", T.LongType())])

    def run(batches):
        seen: Counter = Counter()
        part = TaskContext.get().partitionId()
        for batch in batches:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            place = np.empty(len(keys), np.int64)
            order = np.argsort(keys, kind="stable")
            values, first, counts = np.unique(keys[order], return_index=True, return_counts=True)
            before = np.array([seen[v] for v in values.tolist()], np.int64)
            place[order] = np.arange(len(keys)) - np.repeat(first - before, counts)
            seen.update(dict(zip(values.tolist(), counts.tolist())))
            columns = {n: batch.column(n) for n in batch.schema.names}
            yield columns | {"_part": np.full(len(keys), part, np.int32), "_place": place}

    return shifted(materialize(arrow_map(df, run, schema), label), key, name)


def shifted(placed: DataFrame, key: str, name: str) -> DataFrame:
    """Turn stored places inside (``_part``, key) into places inside the key."""
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(key, "_part").agg(F.max("_place").alias("_top"))
        .select(key, "_part", F.coalesce(F.sum(F.col("_top") + 1).over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(offsets, [key, "_part"])
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_part", "_place", "_before")
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex``, ``root`` of the connected components of undirected edges.

    The root is the smallest vertex of the component and is listed as a vertex too. Large-star
    and small-star rounds repeat until the edges no longer change; every round is stored, and
    only a count and a checksum come to the driver. The minimum over neighbours merges before
    the shuffle and is stored before it is joined, so a hub is a skewed join key at most, which
    adaptive execution can split (it does not where an aggregate and its join share a stage).
    Tables of a round are stored by as many tasks as its edges need, whatever the number of
    shuffle partitions, as rounds over few edges would cost their tasks and files alone.
    """
    def tidy(df):
        return df.where(F.col("u") != F.col("v")).distinct()

    def summary(df):
        return df.agg(F.count("u"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()

    now = materialize(
        tidy(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))), "edges")
    cores = now.sparkSession.sparkContext.defaultParallelism
    state = summary(now)
    while state[0]:
        tasks = max(cores, -(-state[0] // TASK_EDGES))
        sent = F.broadcast if state[0] <= BROADCAST_EDGES else (lambda df: df)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = materialize(both.groupBy("u").agg(F.min("v").alias("_m")).select(
            "u", F.least("u", "_m").alias("m")).coalesce(tasks), "lowest")
        large = both.join(sent(lowest), "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(tidy(large).coalesce(tasks), "large-star")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), "least")
        small = large.join(sent(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(
            tidy(small.unionByName(least.select("u", F.col("m").alias("v")))).coalesce(tasks), "small-star")
        found = summary(now)
        if found == state:
            break
        state = found
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(roots)


def sifted(df: DataFrame, place: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``place`` may be among ``keys``, and those for which it is not.

    ``place`` and the one column of ``keys`` are 64-bit hashes. The keys are marked in bitmaps of
    16 bits a key, at most ``SIFT_BITS`` in all, so the broadcast is bounded. A few rows pass
    by chance: the first part is to be joined exactly, the second needs no shuffle.
    """
    hashed = F.col(keys.columns[0])
    stored = keys.where(hashed.isNotNull())
    bits = min(SIFT_BITS, 1 << max(15, (16 * stored.count()).bit_length()))

    def bit(c: Column) -> Column:
        return F.pmod(c, F.lit(bits))

    def bucket(c: Column) -> Column:
        return F.shiftright(bit(c), 15)

    maps = materialize(
        stored.groupBy(bucket(hashed).alias("_bucket")).agg(
            F.bitmap_construct_agg(bit(hashed) % BITMAP_BITS).alias("_map")), "bitmaps")
    placed = df.withColumn("_place", place)
    at = bit(F.col("_place")) % BITMAP_BITS
    byte = F.conv(F.hex(F.substring("_map", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10)
    joined = placed.join(
        F.broadcast(maps), bucket(F.col("_place")) == F.col("_bucket"), "left")
    maybe = F.coalesce(F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1, F.lit(False))
    return joined.where(maybe).select(*df.columns), joined.where(~maybe).select(*df.columns)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by the keys, with the bounds of the groups.

    A group is held until its last row has come; callers see to it that groups are bounded.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        cuts = _changes(table, keys)
        if len(cuts) > 1:
            yield table.slice(0, cuts[-1]).combine_chunks(), cuts
        held = table.slice(cuts[-1])
    if held is not None:
        cuts = np.append(_changes(held, keys), held.num_rows)
        yield held.combine_chunks(), cuts


def _changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a group begins."""
    differs = np.zeros(table.num_rows, bool)
    differs[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        differs[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(differs)


def rest_of_group(cuts: np.ndarray) -> np.ndarray:
    """How many rows of its group come after each row."""
    ends = np.repeat(cuts[1:], np.diff(cuts))
    return ends - np.arange(len(ends)) - 1


def pairs_within(partners: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of each row with its next ``partners`` rows, a bounded number at a time."""
    total = np.cumsum(partners)
    at = 0
    while at < len(partners):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + most, "right")))
        count = partners[at:end]
        first = np.repeat(np.arange(at, end), count)
        inside = np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
        yield first, first + 1 + inside
        at = end
