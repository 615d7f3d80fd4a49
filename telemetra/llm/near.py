"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document is the multiset of its five-word shingles (all its words, if it has fewer). Two
documents are linked when their probability Jaccard similarity is 0.8 or more. For shingles
that occur once each this is the plain Jaccard similarity; weights count as shares, so a text
repeated as a whole stays the same document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm import text as tx
from telemetra.llm.frames import arrow_map, components, pairs_within, sifted, sorted_groups
from telemetra.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
# Bands of six registers: at similarity 0.8 a pair shares none of 32 bands with probability
# (1 - 0.8**6)**32 = 6e-5; pairs below 0.3 seldom share one.
BANDS, BAND_ROWS = 32, 6
REGISTERS = 1024  # of the finer sketch that decides which texts are compared
# A pair at the threshold agrees in 80 % of these registers, give or take 1.25 points; pairs
# more than four such deviations lower are not compared in full.
PROMISING = 0.745
BLOCK = 1024  # texts of one bucket compared with as many others at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NO_REGISTER = np.uint64(0xD1B54A32D192ED03)


def shingles(block: tx.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hash, text number and how often it occurs there."""
    runs = tx.RunHashes(block.hashes())
    owner = block.owners()
    n = len(owner)
    start = np.arange(n)
    last = np.repeat(block.first[1:], block.counts)
    whole = (last - start >= SHINGLE) | (start == np.repeat(block.first[:-1], block.counts))
    start = start[whole]
    hashes = runs.between(start, np.minimum(start + SHINGLE, last[whole]))
    key = tx.mix(hashes ^ tx.mix(owner[start].astype(np.uint64) + np.uint64(1)))
    _, at, times = np.unique(key, return_index=True, return_counts=True)
    return hashes[at], owner[start][at], times


def signatures(
    hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, registers: int
) -> np.ndarray:
    """Winning shingle per text and register.

    Each shingle is a Poisson process of arrivals whose rate is its weight; an arrival falls
    into a random register, and the earliest arrival of a register wins. A process stops as
    soon as its next arrival is later than the latest winner of its text, which is when no
    register can change any more.
    """
    best = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(hashes))
    step = np.uint64(0)
    while len(hashes):
        # a few slow processes (short texts) make several arrivals at a time
        ahead = int(min(64, max(1, 20_000 // len(hashes))))
        turn = step + np.arange(1, ahead + 1, dtype=np.uint64)
        step += np.uint64(ahead)
        random = tx.mix(hashes[:, None] + turn * _STEP)
        gap = -np.log((random >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54)
        arrival = time[:, None] + np.cumsum(gap / weight[:, None], axis=1)
        register = (tx.mix(random ^ _NO_REGISTER) % np.uint64(registers)).astype(np.int64)
        slot = (owner[:, None] * registers + register).ravel()
        np.minimum.at(best, slot, arrival.ravel())
        won = best[slot] == arrival.ravel()
        winner[slot[won]] = np.repeat(hashes, ahead)[won]
        latest = best.reshape(n, registers).max(axis=1)
        time = arrival[:, -1]
        going = time < latest[owner]
        hashes, owner, weight, time = hashes[going], owner[going], weight[going], time[going]
    return winner.reshape(n, registers)


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, keys``: the text's digest and one key per band, null without words."""

    def run(batches):
        for part, block in tx.blocks(batches):
            hashes, owner, times = shingles(block)
            won = signatures(hashes, owner, times.astype(float), len(block), BANDS * BAND_ROWS)
            banded = tx.mix(won.reshape(-1, BAND_ROWS) + np.arange(BAND_ROWS, dtype=np.uint64) * _STEP)
            place = np.tile(np.arange(BANDS, dtype=np.uint64), len(block))
            keys = tx.mix(banded.sum(axis=1) + tx.mix(place)).view(np.int64).reshape(-1, BANDS)
            yield {
                "doc_id": part.column("doc_id"), "digest": part.column("digest"),
                "keys": [k if c else None for k, c in zip(list(keys), block.counts)]}

    rows = docs.select("doc_id", tx.text_digest().alias("digest"), "text")
    return arrow_map(rows, run, "doc_id long, digest binary, keys array<long>")


def similarity(x: dict[str, np.ndarray], y: dict[str, np.ndarray]) -> float:
    """Probability Jaccard of two multisets: sorted hashes and their counts.

    Sum over common items d of 1 / sum over items e of max(x_e / x_d, y_e / y_d). With items in
    order of x_e / y_e, the maximum is the first term for those above d's ratio and the second
    for the others, so two running sums give all denominators.
    """
    both, i, j = np.intersect1d(x["hash"], y["hash"], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    a, b = x["n"][i].astype(float), y["n"][j].astype(float)
    only_x, only_y = x["n"].sum() - a.sum(), y["n"].sum() - b.sum()
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    above = only_x + a.sum() - np.cumsum(a)
    below = only_y + np.cumsum(b)
    return float(np.sum(1.0 / (above / a + below / b)))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows ``a, b`` (digests) whose texts are similar enough, with ``similarity``."""
    joined = (
        pairs.join(texts.select(F.col("digest").alias("a"), F.col("text").alias("x")), "a")
        .join(texts.select(F.col("digest").alias("b"), F.col("text").alias("y")), "b")
        .select("a", "b", "x", "y"))

    def profiles(block: tx.Block) -> list[dict]:
        hashes, owner, times = shingles(block)
        order = np.lexsort((hashes, owner))
        hashes, times = hashes[order], times[order]
        cut = np.searchsorted(owner[order], np.arange(len(block) + 1))
        return [{"hash": hashes[s:e], "n": times[s:e]} for s, e in zip(cut[:-1], cut[1:])]

    def run(batches):
        for part, block in tx.blocks(batches, "x"):
            left, right = profiles(block), profiles(tx.Block(part.column("y")))
            alike = np.array([similarity(x, y) for x, y in zip(left, right)])
            good = pa.array(alike >= SIMILARITY)
            yield {
                "a": part.column("a").filter(good), "b": part.column("b").filter(good),
                "similarity": alike[alike >= SIMILARITY]}

    return arrow_map(joined, run, "a binary, b binary, similarity double")


def texts_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``digest, text`` of the wanted digests; rows other than a class's first are left out early."""
    chosen = materialize(classes.join(wanted, "digest").select("digest", "class_id"), "chosen")
    rows = docs.select("doc_id", "text", tx.text_digest().alias("digest"))
    rows, _ = sifted(rows, row_place("digest", "doc_id"), chosen.select(row_place("digest", "class_id")))
    return rows.select("digest", "text").dropDuplicates(["digest"]).join(
        chosen.select("digest"), "digest", "left_semi")


def row_place(digest: str, doc_id: str) -> Column:
    return F.xxhash64(digest, doc_id)


def fine(texts: DataFrame) -> DataFrame:
    """``digest, sketch`` of rows of ``digest, text``: one byte of each register's winner."""

    def run(batches):
        for part, block in tx.blocks(batches):
            hashes, owner, times = shingles(block)
            won = signatures(hashes, owner, times.astype(float), len(block), REGISTERS)
            yield {
                "digest": part.column("digest"),
                "sketch": [w.tobytes() for w in (won >> np.uint64(56)).astype(np.uint8)]}

    return arrow_map(texts, run, "digest binary, sketch binary")


def across(members: DataFrame) -> DataFrame:
    """Promising pairs ``a, b`` of rows of one bucket that differ in ``root``.

    ``members`` are rows of ``key, band, digest, root, _blocks, keys, sketch``. Large buckets are dealt
    in blocks, every two of which meet in one task. Only rows outside a block's largest group
    look for partners. A pair is returned by the first band that it shares.
    """
    names = ["key", "low", "high"]
    met = (
        members.withColumn("block", F.pmod(F.xxhash64("digest"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other"),
                      "group": F.xxhash64("root")})
        .select(*names, "block", "band", "group", "digest", "keys", "sketch")
        .repartition(*names).sortWithinPartitions(*names, "digest")
    )

    def run(batches):
        for table, cuts in sorted_groups(batches, names):
            group = table.column("group").to_numpy()
            order, partners = [], []
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                values, at, counts = np.unique(group[begin:end], return_inverse=True, return_counts=True)
                large = at == counts.argmax()
                order.append(begin + np.argsort(large, kind="stable"))
                few = int((~large).sum())
                partners.append(np.where(np.arange(end - begin) < few, np.arange(end - begin)[::-1], 0))
            order, partners = np.concatenate(order), np.concatenate(partners)
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
            keys = np.array(table.column("keys").to_pylist(), np.int64)
            block, low, high, band = (table.column(c).to_numpy() for c in ("block", "low", "high", "band"))
            digests = np.array(table.column("digest").to_pylist(), object)
            out = {"a": [], "b": []}
            for first, second in pairs_within(partners, 1 << 14):
                first, second = order[first], order[second]
                own = group[first] != group[second]
                own &= np.minimum(block[first], block[second]) == low[first]
                own &= np.maximum(block[first], block[second]) == high[first]
                first, second = first[own], second[own]
                own = (keys[first] == keys[second]).argmax(axis=1) == band[first]
                first, second = first[own], second[own]
                good = (sketch[first] == sketch[second]).mean(axis=1) >= PROMISING
                x, y = digests[first[good]], digests[second[good]]
                swap = x > y
                out["a"] += np.where(swap, y, x).tolist()
                out["b"] += np.where(swap, x, y).tolist()
            yield out

    return arrow_map(met, run, "a binary, b binary")


def groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their digests, and ``digest, class_id, root`` of each distinct text.

    Texts of one bucket are first compared with the text that shares most buckets with others
    (of a group of copies, the one nearest to all), which joins most of a large group with a
    few comparisons per member. Then every two texts that share a bucket but not a group are
    looked at, whatever their number, so that no link between two groups is lost; pairs inside
    a group need none.
    """
    rows = materialize(sketched(docs), "sketches")
    classes = materialize(
        rows.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.first("keys").alias("keys")),
        "classes")
    banded = classes.select("digest", F.posexplode("keys").alias("band", "key"))
    # aggregates are stored before they are joined, so that Spark can split a full bucket
    full = materialize(
        banded.groupBy("key").agg(F.count("digest").alias("_n")).where("_n > 1"), "full-buckets")
    likely, _ = sifted(banded, F.col("key"), full.select("key"))
    members = materialize(likely.join(full, "key"), "buckets")
    # at most one row per band and text
    reach = F.sum("_n").over(Window.partitionBy("digest"))
    hubs = materialize(members.withColumn("_reach", reach).groupBy("key").agg(
        F.max(F.struct("_reach", "digest")).alias("_hub")).select("key", F.col("_hub.digest").alias("hub")),
        "hubs")
    tried = materialize(
        members.join(hubs, "key").where("digest <> hub").select(
            F.least("hub", "digest").alias("a"), F.greatest("hub", "digest").alias("b")).distinct(),
        "star-pairs")
    wanted = members.select("digest").distinct()
    texts = materialize(texts_of(docs, classes, wanted), "texts")
    links = materialize(verified(tried, texts), "links").drop("similarity")
    first = components(links)

    grouped = materialize(members.join(first.withColumnRenamed("vertex", "digest"), "digest", "left").select(
        "key", "band", "digest", F.coalesce("root", "digest").alias("root")), "grouped")
    mixed = materialize(grouped.groupBy("key").agg(
        F.min("root").alias("_l"), F.max("root").alias("_h"),
        F.ceil(F.count("digest") / BLOCK).cast("int").alias("_blocks")).where(
        "_l <> _h").select("key", "_blocks"), "mixed-buckets")
    likely, _ = sifted(grouped, F.col("key"), mixed.select("key"))
    open_ = materialize(likely.join(mixed, "key"), "open-buckets")
    sketches = materialize(
        fine(texts.join(open_.select("digest").distinct(), "digest")), "fine-sketches")
    told = classes.select("digest", "keys").join(sketches, "digest")
    untried = materialize(
        across(open_.join(told, "digest")).join(tried, ["a", "b"], "left_anti"), "cross-pairs")
    more = materialize(verified(untried, texts), "links").drop("similarity")
    # the trees join the same texts as the links they were found by, in fewer rounds
    trees = first.where("vertex <> root").select(F.col("vertex").alias("a"), F.col("root").alias("b"))
    whole = components(trees.unionByName(more))
    return rows, classes.select("digest", "class_id").join(
        whole.withColumnRenamed("vertex", "digest"), "digest", "left").select(
        "digest", "class_id", F.coalesce("root", "digest").alias("root"))


def membership(docs: DataFrame) -> DataFrame:
    """One row per row of ``doc_id, text``: ``doc_id, class_id, component_id, kept``.

    ``class_id`` is the smallest id with the same text, ``component_id`` the smallest id that
    links of similarity 0.8 or more reach, and ``kept`` tells whether that is the row itself.
    Texts without words (null, empty, blank) are like nothing: such rows are classes of their
    own and stay. Null ids come before others only where a class has no other id; repeated
    rows share class and verdict. An empty table gives no rows.
    """
    rows, classes = groups(docs)
    roots = classes.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = classes.join(roots, "root").select("digest", "class_id", "component_id")
    joined = rows.select("doc_id", "digest", F.col("keys").isNull().alias("_bare")).join(
        named, "digest")
    own = F.col("_bare") | F.col("component_id").isNull()
    return joined.select(
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (own | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))).alias("kept"),
        F.hex("digest").alias("text_md5"),
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per group of near-duplicates, with the columns of ``docs``.

    Where rows repeat an id with the same text, one of them stays. Only rows that go or are
    repeated, and the few that look like them, are shuffled with their texts.
    """
    verdicts = materialize(
        membership(docs).groupBy(F.col("text_md5").alias("_md5"), F.col("doc_id").alias("_id"))
        .agg(F.bool_or("kept").alias("_kept"), F.count(F.lit(1)).alias("_n")), "kept")
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), "doc_id",
        F.hex(tx.text_digest()).alias("_digest"))
    doubtful, kept = sifted(
        rows, row_place("_digest", "doc_id"),
        verdicts.where("not _kept or _n > 1").select(row_place("_md5", "_id")))
    known = verdicts.where("_kept").select("_md5", "_id")
    met = (F.col("_digest") == F.col("_md5")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    single = doubtful.join(known, met).dropDuplicates(["_digest", "doc_id"])
    return kept.select("_row.*").unionByName(single.select("_row.*"))
