"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from telemetra.llm.frames import arrow_map, components, pairs_within, rest_of_group, sorted_groups
from telemetra.session import materialize

COSINE = 0.93
BITS = 64
TABLES, SUB_BITS = 4, 16
SUB_RADIUS = 2  # differing bits inside one sub-code at which two vectors still meet
RADIUS = 24  # differing bits of whole codes at which vectors are compared
FIT_ROWS = 10_000  # distinct vectors that the rotation is learned from
RECALL = 0.99  # share of checked pairs at the cosine that the codes must bring together
CHECK_ROWS = 1_000  # vectors that the check takes partners for
BLOCK = 512  # vectors of one bucket compared with as many others at a time


def learn(
    sample: np.ndarray, rounds: int = 30, seed: int = 7, centring: float = 1.0
) -> tuple[np.ndarray, np.ndarray]:
    """Centre and projection (dimensions x 64) whose signs are balanced binary codes.

    Principal directions, then a rotation that is alternately fitted to the signs it gives
    (iterative quantisation). With fewer dimensions than bits, random directions fill up.
    """
    random = np.random.default_rng(seed)
    mean = centring * sample.mean(axis=0)
    centred = sample - mean
    size = sample.shape[1]
    bits = min(size, BITS)
    _, directions = np.linalg.eigh(centred.T @ centred)
    chosen = directions[:, ::-1][:, :bits]
    projected = centred @ chosen
    rotation = np.linalg.qr(random.normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(signs.T @ projected)
        rotation = (u @ v).T
    return mean, np.hstack([chosen @ rotation, random.normal(size=(size, BITS - bits))])


def codes(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    signs = (vectors - mean) @ projection >= 0
    return np.packbits(signs, axis=1).view(">u8").ravel().astype(np.uint64)


def sub_codes(code: np.ndarray) -> np.ndarray:
    shifts = np.arange(TABLES, dtype=np.uint64) * np.uint64(SUB_BITS)
    return (code[:, None] >> shifts) & np.uint64((1 << SUB_BITS) - 1)


def unit(lists) -> np.ndarray:
    vectors = np.array(lists, np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def met(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two codes become a candidate pair."""
    apart = np.bitwise_count(sub_codes(a ^ b)).min(axis=1)
    return (apart <= SUB_RADIUS) & (np.bitwise_count(a ^ b) <= RADIUS)


def fitted(sample: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The most centred codes that still bring pairs at the cosine together.

    Links are cosines of uncentred vectors. Where vectors share a strong direction, a pair that
    links is far apart once the mean is taken away, so less of it is, down to nothing. Checked
    on the vectors nearest to the mean, which centring hurts most, each with one partner in any
    direction and one in the direction of another vector, both at exactly the cosine.
    """
    random = np.random.default_rng(seed)
    apart = np.linalg.norm(sample - sample.mean(axis=0), axis=1)
    checked = sample[np.argsort(apart, kind="stable")[:CHECK_ROWS]]
    pairs = []
    for aim in (random.normal(size=checked.shape), sample[random.integers(0, len(sample), len(checked))]):
        aside = aim - np.einsum("ij,ij->i", aim, checked)[:, None] * checked
        size = np.linalg.norm(aside, axis=1, keepdims=True)
        usable = size[:, 0] > 1e-6
        other = COSINE * checked[usable] + (1 - COSINE**2) ** 0.5 * aside[usable] / size[usable]
        if len(other):
            pairs.append((checked[usable], other))
    for centring in (1.0, 0.75, 0.5, 0.25, 0.0):
        model = learn(sample, centring=centring)
        if all(met(codes(x, *model), codes(y, *model)).mean() >= RECALL for x, y in pairs):
            break
    return model


def own_pairs(table, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which pairs are to be looked at here: close codes, and no other bucket has the pair.

    Two vectors meet in every table in which their sub-codes differ by two bits at most, under
    each key that both reach by changing at most one bit. The first such table and, in it, the
    smallest such key (their own, if the sub-codes agree) owns the pair. Of a bucket dealt in
    blocks, a pair belongs to the task that has exactly its two blocks.
    """
    code = table.column("code").to_numpy().view(np.uint64)
    bucket = table.column("bucket").to_numpy()
    block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
    a, b = code[first], code[second]
    close = np.bitwise_count(a ^ b) <= RADIUS
    close &= np.minimum(block[first], block[second]) == low[first]
    close &= np.maximum(block[first], block[second]) == high[first]
    at = np.flatnonzero(close)
    a, b = a[at], b[at]
    apart = np.bitwise_count(sub_codes(a ^ b)) <= SUB_RADIUS
    number = (bucket[first[at]] >> SUB_BITS) & 0xFF
    key = (bucket[first[at]] & ((1 << SUB_BITS) - 1)).astype(np.uint64)
    rows = np.arange(len(at))
    x, y = sub_codes(a)[rows, number], sub_codes(b)[rows, number]
    change = x ^ y
    lowest = change & (~change + np.uint64(1))
    smallest = np.minimum(x ^ lowest, x ^ (change ^ lowest))
    own = (np.argmax(apart, axis=1) == number) & apart[rows, number] & (key == smallest)
    mine = np.zeros(len(first), bool)
    mine[at[own]] = True
    return mine


GROUP = ["label", "bucket", "low", "high"]
_ROW = "label long, bucket long, low int, high int, block int, id long, code long"


def dealt(df: DataFrame) -> DataFrame:
    return df.repartition(*GROUP).sortWithinPartitions(*GROUP, "id")


def linked(classes: DataFrame) -> DataFrame:
    """``id, root, links`` per bucket: vectors an id links with there, and one it hangs on.

    ``classes`` has unique ``id`` and ``label, embedding, n``. Links are counted where they are
    found and only one edge per vector goes on, so a dense group makes no list of its pairs.
    """
    sample = [
        r["embedding"] for r in classes.select("embedding").orderBy(F.xxhash64("embedding"))
        .limit(FIT_ROWS).collect()
    ]
    lengths = [len(v) for v in sample]
    usual = max(set(lengths), key=lengths.count) if lengths else 1
    model = fitted(unit([v for v in sample if len(v) == usual])) if lengths else None

    def coded(batches):
        random = {}
        for batch in batches:
            vectors = batch.column("embedding").to_pylist()
            own = np.array([len(v) for v in vectors])
            code = np.zeros(len(vectors), np.uint64)
            for d in np.unique(own).tolist():
                if d != usual and d not in random:
                    random[d] = (0.0, np.random.default_rng(d).normal(size=(d, BITS)))
                rows = np.flatnonzero(own == d)
                code[rows] = codes(
                    unit([vectors[i] for i in rows]), *(model if d == usual else random[d]))
            flips = np.concatenate([[0], 1 << np.arange(SUB_BITS)]).astype(np.uint64)
            reached = sub_codes(code)[:, :, None] ^ flips  # vector, table, key
            number = np.arange(TABLES, dtype=np.uint64)[None, :, None] << np.uint64(SUB_BITS)
            place = (own.astype(np.uint64) << np.uint64(SUB_BITS + 8))[:, None, None]
            bucket = (reached | number | place).reshape(len(code), -1).view(np.int64)
            times = bucket.shape[1]
            yield {
                "label": np.repeat(batch.column("label").to_numpy(), times),
                "bucket": bucket.ravel(),
                "id": np.repeat(batch.column("id").to_numpy(), times),
                "code": np.repeat(code.view(np.int64), times)}

    reached = materialize(arrow_map(
        classes.select("id", "label", "embedding"), coded,
        "label long, bucket long, id long, code long"), "codes")
    # stored before the join, so that Spark can split a full bucket
    full = materialize(
        reached.groupBy("label", "bucket").agg(F.count("id").alias("_n")).where("_n > 1").withColumn(
            "_blocks", F.ceil(F.col("_n") / BLOCK).cast("int")), "full-buckets")
    met = (
        reached.join(full, ["label", "bucket"])
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns({"low": F.least("block", "_other"), "high": F.greatest("block", "_other")})
        .select("label", "bucket", "low", "high", "block", "id", "code")
    )

    def candidates(batches):
        for table, cuts in sorted_groups(batches, GROUP):
            useful = np.zeros(table.num_rows, bool)
            for first, second in pairs_within(rest_of_group(cuts)):
                mine = own_pairs(table, first, second)
                useful[first[mine]] = useful[second[mine]] = True
            rows = np.flatnonzero(useful)
            yield {c: table.column(c).to_numpy()[rows] for c in table.column_names}

    wanted = materialize(arrow_map(dealt(met), candidates, _ROW), "candidates")
    with_vectors = wanted.join(classes.select("id", "embedding", "n"), "id").select(
        *[f.split()[0] for f in _ROW.split(", ")], "embedding", "n")

    def compared(batches):
        for table, cuts in sorted_groups(batches, GROUP):
            vectors = table.column("embedding").to_pylist()
            ids, weight = table.column("id").to_numpy(), table.column("n").to_numpy()
            links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
            flat = np.concatenate([unit([v]).ravel() for v in vectors])
            begin = np.cumsum([0, *map(len, vectors)])
            for first, second in pairs_within(rest_of_group(cuts), 1 << 18):
                mine = own_pairs(table, first, second)
                first, second = first[mine], second[mine]
                near = np.zeros(len(first), bool)
                for s in range(0, len(first), 1 << 14):
                    f, g = first[s: s + (1 << 14)], second[s: s + (1 << 14)]
                    for d in np.unique(np.diff(begin)[f]).tolist():
                        k = np.flatnonzero(np.diff(begin)[f] == d)
                        span = np.arange(d)
                        x, y = flat[begin[f[k]][:, None] + span], flat[begin[g[k]][:, None] + span]
                        near[s + k] = np.einsum("ij,ij->i", x, y) >= COSINE
                first, second = first[near], second[near]
                np.add.at(links, first, weight[second])
                np.add.at(links, second, weight[first])
                while True:
                    least = np.minimum(root[first], root[second])
                    before = root.copy()
                    np.minimum.at(root, first, least)
                    np.minimum.at(root, second, least)
                    np.minimum.at(root, before, root)  # pull whole trees along
                    root = root[root]
                    if (root == before).all():
                        break
            rows = np.flatnonzero(links)
            yield {"id": ids[rows], "root": ids[root[rows]], "links": links[rows]}

    return materialize(
        arrow_map(dealt(with_vectors), compared, "id long, root long, links long"), "vector-links")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Links and components of rows of ``vec_id, embedding, label``.

    Two vectors link when their labels are equal and not null, their lengths agree and their
    cosine, in doubles, is 0.93 or more. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. Candidates come from four 16-bit pieces of the
    learned codes (a pair is met if one piece differs in two bits or less) and every candidate
    is reranked with the original vectors, so no link is false; a few true ones near the
    threshold may be missed. Equal vectors are one class, compared once and counted in full.
    Labels that are no whole numbers are told apart by 64-bit hashes.

    Returns one row per row: ``vec_id, n_links, component_id, kept``. Null ids get null
    components unless they link with a vector that has one.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(
        F.col("label").isNotNull() & (F.size("embedding") > 0) & finite
        & F.exists("embedding", lambda x: x != 0), F.lit(False))
    whole = isinstance(vectors.schema["label"].dataType, T.IntegralType)
    label = F.col("label").cast("long") if whole else F.when(
        F.col("label").isNotNull(), F.xxhash64(F.col("label").cast("string")))
    rows = vectors.withColumn("_good", good).select("vec_id", label.alias("label"), "embedding", "_good")
    usable = rows.where("_good")
    classes = materialize(
        usable.groupBy("label", "embedding")
        .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("class_id"))
        .withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    found = linked(classes)
    trees = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("_links"))
    placed = classes.join(counts, "id", "left").join(
        trees.withColumnRenamed("vertex", "id"), "id", "left").withColumn(
        "root", F.coalesce("root", "id"))
    lowest = placed.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = placed.join(lowest, "root").select(
        "label", "embedding", "component_id",
        (F.col("n") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"))
    linked_rows = usable.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not _good").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("n_links") == 0))
