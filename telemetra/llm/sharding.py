"""Shards of near-equal bytes by Karmarkar-Karp differencing of indivisible groups."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from telemetra.llm import text as tx
from telemetra.llm.frames import number_within
from telemetra.session import materialize

SHARDS = 40
ROW_BYTES = 16  # added to each document's text
UNIT = 20_000  # groups differenced together in one task
FAN_IN = 512  # partial partitions combined together in one task


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows of sums) until one is left.

    The two with the largest spread are joined in opposite order, largest sum to smallest, over
    and over. Returns the final position of each row's parts and the sums by position.
    """
    n, k = parts.shape
    if n == 0:
        return np.zeros((0, k), np.int64), np.zeros(k, np.int64)
    order = np.argsort(-parts, axis=1, kind="stable")
    sums = [parts[i][order[i]] for i in range(n)]  # descending
    heap = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    joins = []  # (left node, right node, position of each left part, of each right part)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        rank = np.argsort(-total, kind="stable")
        place = np.empty(k, np.int64)
        place[rank] = np.arange(k)
        joins.append((a, b, place, place[::-1]))
        sums[a] = sums[b] = None
        node = len(sums)
        sums.append(total[rank])
        heapq.heappush(heap, (int(total[rank[-1]] - total[rank[0]]), node))
    final = {heap[0][1]: np.arange(k)}
    top = sums[heap[0][1]]
    for node in range(len(joins) - 1, -1, -1):
        a, b, left, right = joins[node]
        position = final.pop(n + node)
        final[a], final[b] = position[left], position[right]
    places = np.empty((n, k), np.int64)
    for i in range(n):
        places[i][order[i]] = final[i]
    return places, top


def assign(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``digest`` and ``shard`` for unique rows of ``digest, size``.

    Tasks difference up to about ``UNIT`` groups each into one partial partition; partial
    partitions are then combined ``FAN_IN`` at a time by the same rule, level by level, until
    one is left. A group heavier than a fair share fills a shard alone.
    """
    units = max(1, -(-groups.count() // UNIT))

    def first_level(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame["size"].to_numpy(np.int64)
        parts = np.zeros((len(sizes), shards), np.int64)
        parts[:, 0] = sizes
        places, _ = difference(parts)
        return pd.DataFrame({
            "digest": frame["digest"], "size": sizes, "unit": key[0], "part": places[:, 0]})

    placed = materialize(
        groups.withColumn("unit", F.pmod(F.xxhash64("digest"), F.lit(units)))
        .groupBy("unit").applyInPandas(
            first_level, "digest binary, size long, unit long, part long"), "units")

    def next_level(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        inside = frame.groupby("unit", sort=True)
        names = list(inside.groups)
        parts = np.zeros((len(names), shards), np.int64)
        for i, (_, rows) in enumerate(inside):
            parts[i, rows["part"].to_numpy()] = rows["size"].to_numpy()
        places, _ = difference(parts)
        return pd.DataFrame({
            "unit": np.repeat(names, shards), "part": np.tile(np.arange(shards), len(names)),
            "_unit": key[0], "_part": places.ravel()})

    while units > 1:
        sums = placed.groupBy("unit", "part").agg(F.sum("size").alias("size"))
        moves = sums.withColumn("_key", F.floor(F.col("unit") / FAN_IN)).groupBy(
            "_key").applyInPandas(next_level, "unit long, part long, _unit long, _part long")
        placed = materialize(
            placed.join(moves, ["unit", "part"])
            .select("digest", "size", F.col("_unit").alias("unit"), F.col("_part").alias("part")),
            "units")
        units = -(-units // FAN_IN)
    return placed.select("digest", F.col("part").cast("int").alias("shard"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every row of ``doc_id, text``; law ``bytes``.

    Rows with equal texts form a group that stays together; null and empty texts are one group.
    Repeated rows are separate rows of their group. Slots are gapless from 0 inside a shard, in
    no particular order. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), tx.text_digest().alias("digest")),
        "sizes")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    placed = rows.join(assign(groups, shards), "digest").drop("digest")
    return number_within(placed, "shard", "slot", "shards").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
