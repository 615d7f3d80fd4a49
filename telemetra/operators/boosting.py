"""Gradient-boosted classification trees grown on histograms.

Features are cut once into at most 256 quantile bins. Every level of every tree needs only sums of
gradients and hessians by (trial, class, node, feature, bin), which add up over blocks of rows, so
one pass over the rows serves all trials and classes of a search. Only the lighter child of a split
is summed from rows, a heavy one is what its parent has besides. The loss is softmax.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator, Mapping, Sequence
from copy import copy
from dataclasses import asdict, dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from telemetra.operators.arrow import map_columns
from telemetra.session import materialize, mounted, scratch_path

BINS = 256  # the first is for nulls
BLOCK_ROWS = 1 << 21  # rows whose sums one task makes together; 48 MB of bins, labels and keys
CHUNK = 1 << 15  # rows of a block that are routed and summed at a time
DIRECT = 32  # partitions whose sums the driver adds up itself
SHRINK = 1.0  # added to every sum of hessians
LEAST_GAIN = 1e-9
HEAVY = 2.0**-5  # share of a tree's hessian from which a child is taken as its parent less its sibling
NOISE = 2.0**-46  # share of a tree's sums below which a difference of sums is nothing
DIGITS = 9  # to which gains are compared, so that the order of the rows does not decide
PADDING = 1 << 17  # bytes sent with a piece's place: short messages wait for an acknowledgement
STORE_EVERY = 25  # rounds after which the scores of the rows are stored


@dataclass(frozen=True)
class Trial:
    rounds: int
    depth: int
    rate: float
    subsample: float


@dataclass
class Binning:
    """How columns become bins: cut points of numbers, values of texts and cuts of their codes."""

    numbers: list[str]
    texts: list[str]
    values: dict[str, list[str]]
    edges: dict[str, list[float]]
    classes: list[str]

    @property
    def features(self) -> list[str]:
        return [*self.numbers, *self.texts]

    @property
    def starts(self) -> np.ndarray:
        """First cell of each feature, and the number of all cells, if bins stand side by side."""
        return np.cumsum([0, *(len(self.edges[f]) + 2 for f in self.features)])

    def bins(self, batch: pa.RecordBatch) -> np.ndarray:
        """Rows x features. A value falls behind all cut points that are smaller; null is 0."""
        found = np.zeros((batch.num_rows, len(self.features)), np.uint8)
        for i, name in enumerate(self.features):
            column = batch.column(name)
            if name in self.values:
                known = pa.array(self.values[name], pa.string())
                codes = pc.index_in(column.cast(pa.string()), known).fill_null(-1)
                values, missing = codes.to_numpy(zero_copy_only=False), np.zeros(len(codes), bool)
            else:
                values = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
                missing = np.isnan(values)
            at = np.searchsorted(np.array(self.edges[name]), values, "left") + 1
            found[:, i] = np.where(missing, 0, at)
        return found


def learn_binning(rows: DataFrame, numbers: Sequence[str], texts: Sequence[str], label: str) -> Binning:
    """Quantiles of the numbers in one pass, and of the codes of texts from counts of values.

    Texts are meant to have thousands of values, not millions: the model keeps them all.
    """
    shares = [k / BINS for k in range(1, BINS - 1)]
    cuts = rows.agg(*[
        F.percentile_approx(F.col(c).cast("double"), shares).alias(c) for c in numbers
    ]).first()
    edges = {c: sorted(set(cuts[c] or [])) for c in numbers}
    listed = F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in [*texts, label]]))
    counted = rows.select(listed.alias("p")).where("p.v IS NOT NULL").groupBy("p.c", "p.v").agg(
        F.count(F.lit(1)).alias("n")).collect()
    values: dict[str, list[str]] = {}
    for c in texts:
        own = sorted((r["v"], r["n"]) for r in counted if r["c"] == c)
        values[c] = [v for v, _ in own]
        reach = np.cumsum([n for _, n in own]) if own else np.zeros(0)
        at = np.searchsorted(reach, np.array(shares) * (reach[-1] if len(own) else 0), "left")
        edges[c] = sorted({-1.0, *(float(k) for k in at if k < len(own))})[: BINS - 2]
    classes = sorted(r["v"] for r in counted if r["c"] == label)
    return Binning(list(numbers), list(texts), values, edges, classes)


# --- trees ------------------------------------------------------------------------------


class Tree:
    """One tree per class, each a heap of ``2**(depth + 1) - 1`` nodes; feature -1 is a leaf."""

    def __init__(self, classes: int, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature = np.full((classes, size), -1, np.int16)
        self.cut = np.zeros((classes, size), np.int16)
        self.value = np.zeros((classes, size))
        self.gain = np.zeros((classes, size))

    def grow(self, level: int, kind: np.ndarray, place: np.ndarray, found: Mapping[str, np.ndarray],
             rate: float) -> None:
        """Put in the splits of nodes ``place`` of a level, of the classes ``kind``."""
        node = 2**level - 1 + place
        good = found["gain"] > LEAST_GAIN
        if level == 0:
            self.value[kind, node] = rate * leaf(found["left"] + found["right"])
        kind, node = kind[good], node[good]
        self.feature[kind, node] = found["feature"][good]
        self.cut[kind, node] = found["cut"][good]
        self.gain[kind, node] = found["gain"][good]
        self.value[kind, 2 * node + 1] = rate * leaf(found["left"][good])
        self.value[kind, 2 * node + 2] = rate * leaf(found["right"][good])

    def route(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """Node of each row and class after so many levels."""
        flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        node = np.zeros((len(self.feature), len(bins)), np.int64)
        for own, split, cut in zip(node, self.feature, self.cut):
            for _ in range(levels):
                feature = split.take(own)
                right = flat.take(first + np.maximum(feature, 0)) > cut.take(own)
                own[:] = np.where(feature >= 0, 2 * own + 1 + right, own)
        return node.T

    def add(self, scores: np.ndarray, bins: np.ndarray) -> None:
        scores += self.value[np.arange(len(self.feature)), self.route(bins, depth_of(self))]


def depth_of(tree: Tree) -> int:
    return int(np.log2(tree.feature.shape[1] + 1)) - 1


def leaf(sums: np.ndarray) -> np.ndarray:
    return -sums[..., 0] / (sums[..., 1] + SHRINK)


def softmax(scores: np.ndarray) -> np.ndarray:
    power = np.exp(scores - scores.max(axis=1, keepdims=True))
    return power / power.sum(axis=1, keepdims=True)


def sampled(keys: np.ndarray, trial: int, turn: int, share: float) -> np.ndarray:
    """Rows that a tree sees: a hash of row, trial and round below the share."""
    x = keys ^ np.uint64((trial * 100_003 + turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share


@dataclass(frozen=True)
class Folded:
    """Bins of rows by column; features that occur in few combinations share one column of codes."""

    codes: np.ndarray  # columns x rows
    column: np.ndarray  # of each feature
    bins: np.ndarray  # features x codes: the bin that a code of its column stands for

    def only(self, rows: np.ndarray) -> Folded:
        return replace(self, codes=self.codes.take(rows, axis=1))


def folded(bins: np.ndarray) -> Folded:
    """Features with fewest bins first, each into the first column that stays within ``BINS`` codes.

    A column has the combinations that occur in these rows, so nothing is lost by it.
    """
    columns: list[np.ndarray] = []
    held: list[dict[int, np.ndarray]] = []
    kinds = [np.count_nonzero(np.bincount(own, minlength=BINS)) for own in bins.T]
    for f in sorted(range(bins.shape[1]), key=kinds.__getitem__):
        own = np.ascontiguousarray(bins[:, f])
        for i, column in enumerate(columns):
            joint = column * np.intp(BINS) + own
            there = np.flatnonzero(np.bincount(joint, minlength=BINS * BINS))
            if len(there) <= BINS:
                code = np.zeros(BINS * BINS, np.uint8)
                code[there] = np.arange(len(there))
                columns[i] = code.take(joint)
                held[i] = {g: table.take(there // BINS) for g, table in held[i].items()} | {f: there % BINS}
                break
        else:
            columns.append(own)
            held.append({f: np.arange(BINS)})
    column, meant = np.zeros(bins.shape[1], np.intp), np.zeros((bins.shape[1], BINS), np.intp)
    for i, tables in enumerate(held):
        for f, table in tables.items():
            column[f], meant[f, : len(table)] = i, table
    return Folded(np.stack(columns), column, meant)


def gradients(scores: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Classes x rows: the gradient as real part, the hessian as imaginary part."""
    found = np.empty(scores.shape, complex)
    for at in range(0, len(labels), CHUNK):
        part = slice(at, at + CHUNK)
        power = np.exp(scores[:, part] - scores[:, part].max(axis=0))
        share = power / power.sum(axis=0)
        found.imag[:, part] = share * (1 - share)
        share[labels[part], np.arange(share.shape[1])] -= 1
        found.real[:, part] = share
    return found


def steps(tree: Tree, level: int, rows: Folded) -> tuple[np.ndarray, np.ndarray]:
    """By class: where the column of each node's split begins, and node x code to the next node.

    Nodes are those down to a level; only those at the level itself go on.
    """
    first, size = 2**level - 1, 2 ** (level + 1) - 1
    feature, cut = tree.feature[:, :size], tree.cut[:, :size]
    begins = rows.column[np.maximum(feature, 0)] * rows.codes.shape[1]
    onward = np.empty((len(feature), size, BINS), np.intp)
    onward[:] = np.arange(size)[:, None]
    kind, at = np.nonzero(feature[:, first:] >= 0)
    at += first
    onward[kind, at] = 2 * at[:, None] + 1 + (rows.bins[feature[kind, at]] > cut[kind, at][:, None])
    return begins, onward.reshape(len(feature), -1)


def step(nodes: np.ndarray, begins: np.ndarray, onward: np.ndarray, rows: Folded, at: int) -> np.ndarray:
    """The next node of rows from ``at`` on, of one class."""
    place = begins.take(nodes)
    place += np.arange(at, at + len(nodes))
    code = rows.codes.ravel().take(place)
    np.multiply(nodes, BINS, out=place)
    place += code
    return onward.take(place)


def routed(tree: Tree, levels: int, rows: Folded) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Parts of the rows with their nodes of each class after so many levels."""
    plans = [steps(tree, level, rows) for level in range(levels)]
    count = rows.codes.shape[1]
    for at in range(0, count, CHUNK):
        part, found = slice(at, min(at + CHUNK, count)), []
        for k in range(len(tree.feature)):
            nodes = np.zeros(part.stop - at, np.intp)
            for begins, onward in plans:
                nodes = step(nodes, begins[k], onward[k], rows, at)
            found.append(nodes)
        yield part, found


def sibling(node: np.ndarray) -> np.ndarray:
    return ((node - 1) ^ 1) + 1  # children are 2i + 1 and 2i + 2


class Growth:
    """A tree as it grows: which nodes need sums, and what their sums make of it."""

    def __init__(self, classes: int, trial: Trial, starts: np.ndarray):
        self.tree, self.trial, self.starts = Tree(classes, trial.depth), trial, starts
        self.level = 0
        # nodes whose sums are asked for, by class; those of ``apart`` tell their sibling's too
        self.kind, self.node = np.arange(classes), np.zeros(classes, np.intp)
        self.apart = np.zeros(classes, bool)
        self.whole: np.ndarray | None = None  # sums of the parents of ``apart``
        self.heavy = self.noise = np.zeros(classes)

    def slots(self) -> np.ndarray:
        """By class and node the number of its sums, or -1."""
        found = np.full((len(self.tree.feature), 2 ** (self.level + 1) - 1), -1, np.intp)
        found[self.kind, self.node] = np.arange(len(self.node))
        return found

    def take(self, sums: np.ndarray) -> bool:
        """Split the nodes of a level by the sums of ``kind`` and ``node``; whether some were split."""
        kind, node = self.kind, self.node
        if self.whole is None:
            self.heavy = HEAVY * sums[:, : self.starts[1], 1].sum(axis=1)
            self.noise = NOISE * np.abs(sums).sum(axis=(1, 2)) / (len(self.starts) - 1)
        else:
            # a cell all of whose rows are in one child must be empty in the other
            other = kind[self.apart]
            rest = self.whole - sums[self.apart]
            rest[(np.abs(rest) <= self.noise[other][:, None, None]).all(axis=2)] = 0
            kind = np.concatenate([kind, other])
            node = np.concatenate([node, sibling(node[self.apart])])
            sums = np.concatenate([sums, rest])
        found = best_splits(sums, self.starts)
        self.tree.grow(self.level, kind, node - (2**self.level - 1), found, self.trial.rate)
        good = np.flatnonzero(found["gain"] > LEAST_GAIN)
        good = good[np.lexsort((node[good], kind[good]))]
        kind, left, right = kind[good], found["left"][good, 1], found["right"][good, 1]
        lighter = 2 * node[good] + 1 + (right < left)
        apart = np.maximum(left, right) >= self.heavy[kind]
        order = np.argsort(np.concatenate([kind, kind[~apart]]), kind="stable")
        self.kind = np.concatenate([kind, kind[~apart]])[order]
        self.node = np.concatenate([lighter, sibling(lighter[~apart])])[order]
        self.apart = np.concatenate([apart, apart[~apart]])[order]
        self.whole = sums[good[apart]]
        self.level += 1
        return len(good) > 0

    def asked(self) -> Growth:
        """Without the sums that were taken."""
        found = copy(self)
        found.whole = None
        return found

    @property
    def over(self) -> bool:
        return self.level == self.trial.depth or not len(self.node)


def summed(
    growth: Growth, rows: Folded, weights: np.ndarray, parts: Iterator[tuple[slice, list[np.ndarray]]],
    seen: np.ndarray | None = None,
) -> np.ndarray:
    """Gradient and hessian sums: (nodes that ``growth`` asks for) x (feature and bin) x 2.

    One part, class and column at a time, so that what is in use stays in the processor's cache.
    """
    slots, starts = growth.slots(), growth.starts
    codes = rows.codes
    cells = np.zeros((len(codes), len(growth.node) * BINS), complex)
    for part, nodes in parts:
        for k, own in enumerate(nodes):
            slot = slots[k].take(own)
            asked = slot >= 0
            if seen is not None:
                asked &= seen[part]
            here = np.flatnonzero(asked)
            place = slot.take(here)
            place *= BINS
            weight = weights[k, part].take(here)
            for total, column in zip(cells, codes):
                np.add.at(total, place + column[part].take(here), weight)
    cells = cells.reshape(len(codes), -1, BINS)
    found = np.zeros((len(growth.node), int(starts[-1])), complex)
    shared = np.bincount(rows.column, minlength=len(codes)) > 1
    for f, (column, low, high) in enumerate(zip(rows.column, starts, starts[1:])):
        if not shared[column]:
            found[:, low:high] = cells[column, :, : high - low]
            continue
        order = np.argsort(rows.bins[f], kind="stable")
        bins, first = np.unique(rows.bins[f][order], return_index=True)
        found[:, low + bins] = np.add.reduceat(cells[column][:, order], first, axis=1)
    return found.view(float).reshape(*found.shape, 2)


def best_splits(sums: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """For each node the split of largest gain, the first feature and smallest cut of equals."""
    reach = np.cumsum(sums, axis=1)
    feature = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    before = np.concatenate([np.zeros_like(reach[:, :1]), reach], axis=1)[:, starts[:-1]]
    left = reach - before[:, feature]
    # each feature's own total, so that nothing is left behind its last row
    total = left[:, starts[1:] - 1][:, feature]
    right = total - left

    def worth(s: np.ndarray) -> np.ndarray:
        return s[..., 0] ** 2 / (s[..., 1] + SHRINK)

    gain = np.round(worth(left) + worth(right) - worth(total), DIGITS)
    at = gain.argmax(axis=1)
    rows = np.arange(len(sums))
    return {"feature": feature[at], "cut": at - starts[feature[at]], "gain": gain[rows, at],
            "left": left[rows, at], "right": right[rows, at]}


# --- the model --------------------------------------------------------------------------


class BoostedModel:
    """Trees with the binning of their inputs."""

    def __init__(self, binning: Binning, trial: Trial, start: np.ndarray, trees: list[Tree]):
        self.binning, self.trial, self.start, self.trees = binning, trial, start, trees

    def scores(self, bins: np.ndarray) -> np.ndarray:
        found = np.tile(self.start, (len(bins), 1))
        for tree in self.trees:
            tree.add(found, bins)
        return found

    def transform(self, df: DataFrame) -> DataFrame:
        """The columns of ``df`` with ``probabilities`` (by class) and ``predicted``.

        Columns are found by name, so their order does not matter and others may come along.
        """
        shared = df.sparkSession.sparkContext.broadcast(self)
        schema = T.StructType([
            *(f for f in df.schema if f.name not in ("probabilities", "predicted")),
            T.StructField("probabilities", T.ArrayType(T.DoubleType())),
            T.StructField("predicted", T.StringType())])

        def run(batches):
            model = shared.value
            names = np.array(model.binning.classes, object)
            for batch in batches:
                share = softmax(model.scores(model.binning.bins(batch)))
                yield {n: batch.column(n) for n in batch.schema.names} | {
                    "probabilities": list(share), "predicted": names[share.argmax(axis=1)]}

        return map_columns(df, run, schema)

    def to_json(self) -> str:
        return json.dumps({
            "binning": asdict(self.binning), "trial": asdict(self.trial), "start": self.start.tolist(),
            "trees": [{k: v.tolist() for k, v in vars(t).items()} for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> "BoostedModel":
        held = json.loads(text)
        binning, trial = Binning(**held["binning"]), Trial(**held["trial"])
        trees = []
        for t in held["trees"]:
            tree = Tree(len(binning.classes), trial.depth)
            for k, v in t.items():
                setattr(tree, k, np.array(v, getattr(tree, k).dtype))
            trees.append(tree)
        return cls(binning, trial, np.array(held["start"]), trees)

    def store(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode(
            "overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedModel":
        return cls.from_json(spark.read.parquet(path).first()["model"])


# --- fitting ----------------------------------------------------------------------------


def blocks_of(
    rows: DataFrame, binning: Binning, label: str, block_rows: int, trials: int = 1
) -> tuple[DataFrame, int]:
    """Rows as blocks ``keys, labels, bins``, dealt by a hash of the row, and their number.

    If they are more than one, blocks times trials fill all cores equally often.
    """
    parts = max(1, -(-rows.count() // block_rows))
    if parts > 1:
        cores = rows.sparkSession.sparkContext.defaultParallelism
        rounds = -(-parts * trials // cores)
        parts = max(parts, -(-rounds * cores // trials))
    keyed = rows.select(
        F.xxhash64(*rows.columns).alias("_key"), F.col(label).cast("string").alias("_label"),
        *binning.features)
    dealt = keyed.repartition(parts, "_key").sortWithinPartitions("_key")

    def run(batches):
        known = pa.array(binning.classes, pa.string())
        held, size = [], 0

        def block():
            keys, labels, bins = (np.concatenate(side) for side in zip(*held))
            return {"keys": [keys.tobytes()], "labels": [labels.tobytes()], "bins": [bins.tobytes()]}

        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("_label")))
            labels = pc.index_in(batch.column("_label"), known).to_numpy(zero_copy_only=False)
            keys = batch.column("_key").to_numpy(zero_copy_only=False).view(np.uint64)
            bins = binning.bins(batch)
            for at in range(0, len(keys), block_rows):
                part = slice(at, at + block_rows)
                held.append((keys[part], labels[part].astype(np.int32), bins[part]))
                size += len(held[-1][0])
                if size >= block_rows:
                    yield block()
                    held, size = [], 0
        if size:
            yield block()

    stored = materialize(map_columns(dealt, run, "keys binary, labels binary, bins binary"), "blocks")
    return stored, stored.count()


def _opened(row: Mapping[str, bytes], features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["labels"], np.int32),
            np.frombuffer(row["bins"], np.uint8).reshape(-1, features))


def grown(
    block: tuple, trial: Trial, number: int, start: np.ndarray, starts: np.ndarray
) -> Iterator[Tree]:
    """All trees of a trial on rows that are in one block, whose sums need no other block.

    Every row keeps its nodes from level to level, so that it is routed once.
    """
    keys, labels, bins = block
    rows, classes, count = folded(bins), len(start), len(keys)
    scores = np.repeat(start[:, None], count, axis=1)
    nodes = np.empty((classes, count), np.intp)

    def moved(plan: tuple[np.ndarray, np.ndarray] | None):
        for at in range(0, count, CHUNK):
            part = slice(at, at + CHUNK)
            if plan is not None:
                for own, begins, onward in zip(nodes, *plan):
                    own[part] = step(own[part], begins, onward, rows, at)
            yield part, [own[part] for own in nodes]

    for turn in range(trial.rounds):
        weights, growth, plan = gradients(scores, labels), Growth(classes, trial, starts), None
        seen = sampled(keys, number, turn, trial.subsample) if trial.subsample < 1 else None
        nodes[:] = 0
        while not growth.over:
            if growth.take(summed(growth, rows, weights, moved(plan), seen)):
                plan = steps(growth.tree, growth.level - 1, rows)
            else:
                plan = None
        for part, found in moved(plan):
            for score, value, own in zip(scores, growth.tree.value, found):
                score[part] += value.take(own)
        yield growth.tree


def _grown_apart(blocks: DataFrame, trials: Sequence[Trial], binning: Binning, start: np.ndarray):
    """Every trial in a task of its own, over the one block; those with most work begin first."""
    features, starts = len(binning.features), binning.starts
    order = sorted(range(len(trials)), key=lambda i: -trials[i].rounds * trials[i].depth)
    turn = {number: at for at, number in enumerate(order)}

    def run(held):
        for number, row in held:
            yield number, list(grown(_opened(row, features), trials[number], number, start, starts))

    each = blocks.rdd.flatMap(lambda row: [(i, row.asDict()) for i in order])
    found = dict(each.partitionBy(len(trials), lambda i: turn[i]).mapPartitions(run).collect())
    return [BoostedModel(binning, t, start, found[i]) for i, t in enumerate(trials)]


@dataclass(frozen=True)
class _Piece:
    """The rows of one block as one trial sees them; ``number`` orders the pieces of a trial."""

    trial: int
    number: int
    keys: np.ndarray
    labels: np.ndarray
    rows: Folded
    scores: np.ndarray

    def later(self, tree: Tree) -> _Piece:
        scores = self.scores.copy()
        for part, nodes in routed(tree, depth_of(tree), self.rows):
            for score, value, own in zip(scores, tree.value, nodes):
                score[part] += value.take(own)
        return replace(self, scores=scores)

    def view(self, turn: int, trial: Trial) -> _View:
        seen = np.flatnonzero(sampled(self.keys, self.trial, turn, trial.subsample))
        weights = gradients(self.scores, self.labels)
        return _View(self.trial, self.number, self.rows.only(seen), weights.take(seen, axis=1))


@dataclass(frozen=True)
class _View:
    """What the levels of one round need of a piece: the rows that its tree sees."""

    trial: int
    number: int
    rows: Folded
    weights: np.ndarray


def _parts(context: SparkContext, trials: int, count: int) -> int:
    cores = context.defaultParallelism
    return min(count * trials, cores if trials == 1 else 2 * max(cores, trials))


def _pieces(blocks: DataFrame, trials: Sequence[Trial], features: int, count: int, start: np.ndarray) -> RDD:
    """Every block once per trial, the pieces of a trial beside each other in few partitions."""
    context = blocks.sparkSession.sparkContext
    total, parts = count * len(trials), _parts(context, len(trials), count)

    def opened(row):
        at, (keys, labels, bins) = row[1], _opened(row[0], features)
        rows = folded(bins)
        for t in range(len(trials)):
            yield t * count + at, _Piece(
                t, at, keys, labels, rows, np.repeat(start[:, None], len(keys), axis=1))

    dealt = blocks.rdd.zipWithIndex().flatMap(opened)
    return dealt.partitionBy(parts, lambda place: place * parts // total).values()


def _level(views: RDD, growths: Mapping[int, Growth]) -> dict[int, np.ndarray]:
    """Sums of one level of all trials in ``growths``, by trial: one pass over the rows.

    Few partitions send their sums to the driver; those of many are added by trial and class first.
    """
    def sums(held):
        total: dict[int, np.ndarray] = {}
        first: dict[int, int] = {}
        for view in held:
            t = view.trial
            if t not in growths:
                continue
            growth = growths[t]
            found = summed(growth, view.rows, view.weights, routed(growth.tree, growth.level, view.rows))
            total[t] = total[t] + found if t in total else found
            first.setdefault(t, view.number)
        for t, found in total.items():
            kind = growths[t].kind
            for k in np.unique(kind):
                yield (t, int(k)), (first[t], found[kind == k])

    def added(held):
        # always added in the same order, so that reruns round alike
        total: dict[tuple[int, int], list] = {}
        for key, part in held:
            total.setdefault(key, []).append(part)
        for key, parts in total.items():
            yield key, sum(found for _, found in sorted(parts, key=lambda p: p[0]))

    # views look at the nodes of a level only, not at the sums of their parents
    growths = {t: g.asked() for t, g in growths.items()}
    found = views.mapPartitions(sums)
    if views.getNumPartitions() > DIRECT:
        keys = sum(len(np.unique(g.kind)) for g in growths.values())
        found = found.partitionBy(min(keys, views.context.defaultParallelism)).mapPartitions(added)
    by_trial: dict[int, list] = {}
    for (t, k), total in sorted(added(found.collect()), key=lambda p: p[0]):
        by_trial.setdefault(t, []).append(total)
    return {t: np.concatenate(parts) for t, parts in by_trial.items()}


class _InSpark:
    """Pieces and views as Spark holds them, in memory and on disk.

    Every ``STORE_EVERY`` rounds the pieces are written, which cuts their lineage.
    """

    def __init__(self, blocks: DataFrame, trials: Sequence[Trial], features: int, start: np.ndarray):
        self.spark, self.trials = blocks.sparkSession, trials
        self.pieces = _pieces(blocks, trials, features, blocks.count(), start)
        self.held: list[RDD] = []

    def begin(self, turn: int, trees: Mapping[int, Tree]) -> RDD:
        if turn:
            self.pieces = self.pieces.filter(partial(_goes_on, turn, self.trials)).map(partial(_added, trees))
            if turn % STORE_EVERY == 0:
                path = scratch_path(self.spark, "scores")
                self.pieces.saveAsPickleFile(path)
                self.pieces = self.spark.sparkContext.pickleFile(path, self.pieces.getNumPartitions())
        self.pieces.persist(StorageLevel.MEMORY_AND_DISK)
        views = self.pieces.map(partial(_seen, turn, self.trials)).persist(StorageLevel.MEMORY_AND_DISK)
        self.held += [self.pieces, views]
        return views

    def begun(self, turn: int) -> RDD:
        while len(self.held) > 2:  # this round's pieces are held by now, the last round's can go
            self.held.pop(0).unpersist()
        return self.held[-1]

    def close(self) -> None:
        for rest in self.held:
            rest.unpersist()


def _seen(turn: int, trials: Sequence[Trial], piece: _Piece) -> _View:
    return piece.view(turn, trials[piece.trial])


def _goes_on(turn: int, trials: Sequence[Trial], piece: _Piece) -> bool:
    return turn < trials[piece.trial].rounds


def _added(trees: Mapping[int, Tree], piece: _Piece) -> _Piece:
    return piece.later(trees[piece.trial])


class _InFiles:
    """Pieces and views as files below the shared folder, which tasks map instead of copying.

    Each round writes scores and views of its own, so that a task can run again; those of the
    round before go when all are written.
    """

    def __init__(
        self, blocks: DataFrame, trials: Sequence[Trial], features: int, start: np.ndarray, folder: str
    ):
        self.trials, self.start, self.folder = trials, start, folder
        context = blocks.sparkSession.sparkContext
        count = blocks.rdd.zipWithIndex().map(partial(_block_written, folder, features)).count()
        places = [(t, at, bytes(PADDING)) for t in range(len(trials)) for at in range(count)]
        self.places = context.parallelize(places, _parts(context, len(trials), count))

    def begin(self, turn: int, trees: Mapping[int, Tree]) -> RDD:
        return self.places.flatMap(
            partial(_view_written, self.folder, turn, self.trials, self.start, trees))

    def begun(self, turn: int) -> RDD:
        shutil.rmtree(f"{self.folder}/{turn - 1}", ignore_errors=True)
        return self.places.flatMap(partial(_view_mapped, self.folder, turn, self.trials))

    def close(self) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def _put(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Write arrays so that readers see whole files only."""
    os.makedirs(folder, exist_ok=True)
    for kind, array in arrays.items():
        own = f"{folder}/.{name}-{kind}-{uuid.uuid4().hex}"
        with open(own, "wb") as file:
            np.save(file, array)
        os.replace(own, f"{folder}/{name}-{kind}.npy")


def _mapped(folder: str, name: str, *kinds: str) -> list[np.ndarray]:
    """Arrays of :func:`_put`; empty ones cannot be mapped and are read."""
    found = []
    for kind in kinds:
        path = f"{folder}/{name}-{kind}.npy"
        try:
            found.append(np.asarray(np.load(path, mmap_mode="r")))
        except ValueError:
            found.append(np.load(path))
    return found


def _block_written(folder: str, features: int, row: tuple) -> int:
    keys, labels, bins = _opened(row[0], features)
    rows = folded(bins)
    _put(f"{folder}/rows", str(row[1]), keys=keys, labels=labels, codes=rows.codes,
         column=rows.column, bins=rows.bins)
    return row[1]


def _view_written(
    folder: str, turn: int, trials: Sequence[Trial], start: np.ndarray, trees: Mapping[int, Tree],
    place: tuple,
) -> Iterator[_View]:
    """Add the last round's tree to the scores of a piece and keep them with the view of this round."""
    t, at, _ = place
    if turn >= trials[t].rounds:
        return
    keys, labels, *rows = _mapped(f"{folder}/rows", str(at), "keys", "labels", "codes", "column", "bins")
    if turn:
        scores, = _mapped(f"{folder}/{turn - 1}", f"{t}-{at}", "scores")
    else:
        scores = np.repeat(start[:, None], len(keys), axis=1)
    piece = _Piece(t, at, keys, labels, Folded(*rows), scores)
    if turn:
        piece = piece.later(trees[t])
    view = piece.view(turn, trials[t])
    _put(f"{folder}/{turn}", f"{t}-{at}", scores=piece.scores, codes=view.rows.codes, weights=view.weights)
    yield view


def _view_mapped(folder: str, turn: int, trials: Sequence[Trial], place: tuple) -> Iterator[_View]:
    t, at, _ = place
    if turn < trials[t].rounds:
        codes, weights = _mapped(f"{folder}/{turn}", f"{t}-{at}", "codes", "weights")
        yield _View(t, at, Folded(codes, *_mapped(f"{folder}/rows", str(at), "column", "bins")), weights)


def _grown_together(blocks: DataFrame, trials: Sequence[Trial], binning: Binning, start: np.ndarray):
    """All trials level by level over all blocks, each level a short job over the views of a round.

    A round's trees are added to the scores, and the rows of the next round chosen, in the first
    pass of the next round. Rows are kept in files where all processes reach the shared folder by
    path, and held by Spark elsewhere.
    """
    spark, starts = blocks.sparkSession, binning.starts
    folder = mounted(spark, scratch_path(spark, "growing"))
    known = blocks, trials, len(binning.features), start
    rounds = _InFiles(*known, folder) if folder else _InSpark(*known)
    models: list[list[Tree]] = [[] for _ in trials]
    trees: dict[int, Tree] = {}
    for turn in range(max(t.rounds for t in trials)):
        growths = {i: Growth(len(start), t, starts) for i, t in enumerate(trials) if turn < t.rounds}
        views = rounds.begin(turn, trees)
        going, first = {i: g for i, g in growths.items() if not g.over}, True
        while going:
            found = _level(views, going)
            if first:
                views, first = rounds.begun(turn), False
            for i, growth in going.items():
                growth.take(found[i])
            going = {i: g for i, g in going.items() if not g.over}
        trees = {i: g.tree for i, g in growths.items()}
        for i, tree in trees.items():
            models[i].append(tree)
    rounds.close()
    return [BoostedModel(binning, t, start, m) for t, m in zip(trials, models)]


def fit(
    rows: DataFrame, numbers: Sequence[str], texts: Sequence[str], label: str,
    trials: Sequence[Trial], block_rows: int = BLOCK_ROWS,
) -> list[BoostedModel]:
    """One model per trial, all on the same rows and bins; rows without a label are left out.

    Up to ``block_rows`` rows are one block: its sums are complete, so each trial grows all its
    trees in a task of its own. More rows are many blocks, and every level of all trials is one
    pass over them, whose sums meet by trial, class and node. Both give the same trees, up to
    the rounding of sums.
    """
    binning = learn_binning(rows, numbers, texts, label)
    if not binning.classes:
        raise ValueError("no labelled rows to learn from")
    blocks, count = blocks_of(rows, binning, label, block_rows, len(trials))
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(
        F.col(label).cast("string")).count().collect()}
    share = np.array([counts[c] for c in binning.classes], float)
    start = np.log(share / share.sum())
    grow = _grown_apart if count == 1 else _grown_together
    return grow(blocks, list(trials), binning, start)


def first_splits(model: BoostedModel) -> list[tuple[str, str, float | None, float]]:
    """Class, feature, largest value that goes left and gain of the first split of each class."""
    found, tree = [], model.trees[0]
    for i, name in enumerate(model.binning.classes):
        at = int(tree.feature[i, 0])
        if at < 0:
            continue
        feature = model.binning.features[at]
        edges, cut = model.binning.edges[feature], int(tree.cut[i, 0])
        found.append((name, feature, edges[cut - 1] if 0 < cut <= len(edges) else None, float(tree.gain[i, 0])))
    return found


def confusion(rows: DataFrame, models: Sequence[BoostedModel], label: str) -> DataFrame:
    """``trial, truth, guess, n`` of all models (numbered from 1) in one pass over the rows."""
    shared = rows.sparkSession.sparkContext.broadcast(list(models))

    def run(batches):
        for batch in batches:
            truth = batch.column("_truth")
            for number, model in enumerate(shared.value, 1):
                names = np.array(model.binning.classes, object)
                guess = names[model.scores(model.binning.bins(batch)).argmax(axis=1)]
                cells = pa.table({"truth": truth, "guess": pa.array(guess, pa.string())}).group_by(
                    ["truth", "guess"]).aggregate([([], "count_all")])
                yield {"trial": [number] * cells.num_rows, "truth": cells["truth"],
                       "guess": cells["guess"], "n": cells["count_all"]}

    needed = sorted({c for m in models for c in m.binning.features})
    asked = rows.select(F.col(label).cast("string").alias("_truth"), *needed)
    counted = map_columns(asked, run, "trial int, truth string, guess string, n long")
    return counted.groupBy("trial", "truth", "guess").agg(F.sum("n").alias("n"))
