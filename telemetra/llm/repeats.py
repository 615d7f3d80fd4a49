"""Passages that several documents share, found with a sparse suffix array.

Words are the symbols. Of all suffixes only those at content-selected positions are kept: the
leftmost smallest 8-word hash among every 24 neighbouring ones (a minimiser). Equal passages
of 50 words select the same position, at most 23 words into the passage, so each shared
passage has a kept suffix whose next 27 words are shared too. Sorted by those words, such
suffixes are neighbours; suffixes unlike both neighbours are dropped. The rest are extended
left and right to every 50-word passage around them, and equal passages are grouped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from telemetra.llm import text as tx
from telemetra.llm.frames import arrow_map, sifted
from telemetra.session import materialize

PASSAGE = 50  # words that make a passage
GRAM = 8  # words hashed to choose positions
REACH = 24  # neighbouring grams of which the smallest is kept
SUFFIX = PASSAGE - REACH + 1  # words that suffixes of one shared passage have in common at least


def anchors(grams: np.ndarray) -> np.ndarray:
    """For each run of ``REACH`` grams, the position of the leftmost smallest."""
    at = np.arange(len(grams))
    width = 1
    while width < REACH:
        step = min(width, REACH - width)
        left, right = at[:-step], at[step:]
        at = np.where(grams[left] <= grams[right], left, right)
        width += step
    return at


def passages(block: tx.Block) -> tuple[tx.RunHashes, np.ndarray, np.ndarray]:
    """Word hashes, the starts of all passages that lie in one text, and their kept positions."""
    runs = tx.RunHashes(block.hashes())
    room = np.repeat(block.first[1:], block.counts) - np.arange(len(block.starts))
    starts = np.flatnonzero(room >= PASSAGE)
    if not len(starts):
        return runs, starts, starts
    return runs, starts, anchors(runs.every(GRAM))[starts]


def suffixes(texts: DataFrame) -> DataFrame:
    """``key`` (hash of the suffix's first words), ``uid``, ``at`` for rows of ``uid, text``."""

    def run(batches):
        for part, block in tx.blocks(batches):
            runs, _, kept = passages(block)
            kept = np.unique(kept)
            owner = np.searchsorted(block.first, kept, "right") - 1
            uid = part.column("uid").to_numpy()
            yield {
                "key": runs.between(kept, kept + SUFFIX).view(np.int64),
                "uid": uid[owner], "at": (kept - block.first[owner]).astype(np.int32)}

    return arrow_map(texts, run, "key long, uid long, at int")


def alike(sorted_suffixes: DataFrame) -> DataFrame:
    """Suffixes that share their first words with a neighbour from another text.

    The first and last run of equal suffixes of each task are let through as they are: the
    neighbours may lie in the next task, and letting too many through changes no result.
    """

    def run(batches):
        # rows of the open run that are held back, and whether that run is let through
        held, passes = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            key, uid = table.column("key").to_numpy(), table.column("uid").to_numpy()
            edge = key[1:] != key[:-1]
            number = np.concatenate([[0], np.cumsum(edge)])
            shared = np.bincount(number[1:], (uid[1:] != uid[:-1]) & ~edge, number[-1] + 1) > 0
            shared[0] |= passes
            take, passes = shared[number], shared[-1]
            # one row of a run that passes is enough to recognise its rest
            kept = len(key) - 1 if passes else int(np.searchsorted(number, number[-1]))
            take[kept:] = False
            held = table.slice(kept)
            yield from (columns(b) for b in table.filter(pa.array(take)).to_batches())
        if held is not None:
            yield from (columns(b) for b in held.to_batches())

    def columns(batch):
        return {c: batch.column(c) for c in ("key", "uid", "at")}

    return arrow_map(sorted_suffixes, run, "key long, uid long, at int")


def extended(texts: DataFrame) -> DataFrame:
    """All passages around the kept suffixes ``places`` of rows of ``uid, text, places``.

    A suffix extends to the left by up to ``REACH - 1`` words and to the right by the rest of a
    passage. ``hash`` and ``check`` together are 96 bits of hash of the 50 words from ``start``.
    """

    def run(batches):
        for part, block in tx.blocks(batches):
            runs, starts, kept = passages(block)
            uid = part.column("uid").to_numpy()
            places = part.column("places")
            wanted = np.zeros(len(block.starts) + 1, bool)
            flat = places.flatten().to_numpy()
            wanted[flat + np.repeat(block.first[:-1], np.diff(places.offsets.to_numpy()))] = True
            starts = starts[wanted[kept]]
            owner = np.searchsorted(block.first, starts, "right") - 1
            second = tx.RunHashes(tx.mix(block.hashes())).between(starts, starts + PASSAGE)
            yield {
                "hash": runs.between(starts, starts + PASSAGE).view(np.int64),
                "check": (second >> np.uint64(32)).astype(np.uint32).view(np.int32),
                "uid": uid[owner], "start": (starts - block.first[owner]).astype(np.int32)}

    return arrow_map(texts, run, "hash long, check int, uid long, start int")


def shared_passages(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of texts (``doc_id, uid, n_words``) and passages that several texts hold.

    A passage row is ``uid, starts``: the passages of one text that another text holds too, as
    ``2 * start + 1`` where that text comes first and ``2 * start`` where this one does. The
    order of texts is that of ``uid``, their 64-bit hash: arbitrary, but the same in each run.
    """
    keyed = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("uid", F.xxhash64("text"))
    found = materialize(suffixes(keyed), "suffixes")
    order = ["key", "uid", "at"]
    again = materialize(
        found.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key"), "keys")
    found, _ = sifted(found, F.col("key"), again)
    near = materialize(
        alike(found.repartitionByRange(*order).sortWithinPartitions(*order)), "alike")
    rows = materialize(keyed.select(
        "doc_id", "uid", F.regexp_count("text", F.lit(tx.WORD)).alias("n_words")), "texts")
    first = rows.groupBy("uid").agg(F.min("doc_id").alias("_first"))
    places = materialize(
        near.groupBy("uid").agg(F.collect_set("at").alias("places")).join(first, "uid"), "places")
    likely, _ = sifted(keyed, F.col("uid"), places.select("uid"))
    texts = likely.join(
        places.withColumnRenamed("uid", "_uid"),
        (F.col("uid") == F.col("_uid")) & F.col("doc_id").eqNullSafe(F.col("_first")),
    ).select("uid", "text", "places")
    held = materialize(extended(texts), "passages")
    # stored before the join, so that Spark can split a passage that very many texts hold
    groups = materialize(
        held.groupBy("hash", "check").agg(F.min("uid").alias("_low"), F.max("uid").alias("_high"))
        .where("_low <> _high").drop("_high"), "shared-passages")
    likely, _ = sifted(held, F.col("hash"), groups.select("hash"))
    several = likely.join(groups, ["hash", "check"]).groupBy("uid").agg(F.collect_set(
        2 * F.col("start") + (F.col("uid") != F.col("_low")).cast("int")).alias("starts"))
    return rows, materialize(several, "shared")


def covered(starts: np.ndarray, n_words: int) -> np.ndarray:
    """Words inside the passages that begin at ``starts``."""
    change = np.zeros(n_words + PASSAGE + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + PASSAGE, -1)
    return np.cumsum(change)[:n_words] > 0


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Runs of words of each row of ``doc_id, text`` that other documents hold too.

    Returns ``doc_id, start_word, end_word`` (exclusive), ``kept``, which is false where another
    document holds the words first, so that they can be cut here, and ``text_hash``. A run is a maximal series of words
    inside passages of at least 50 words that occur in two or more documents, divided where
    ``kept`` changes. Of documents with equal texts the one with the smallest id comes first
    and the others are one run to cut, if they have 50 words. Rows that repeat an id with the
    same text count as one document. Null, empty and short texts have no runs; repeats inside
    one document only are none either.
    """
    rows, several = shared_passages(docs)
    classes = rows.groupBy("uid").agg(
        F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"), F.first("n_words").alias("n_words"))
    known = classes.join(several, "uid", "left").select(
        F.col("_first").alias("doc_id"), "uid", "n_words", "starts",
        ((F.col("_first") != F.col("_last")) & (F.col("n_words") >= PASSAGE)).alias("_copied"),
    ).where("_copied or starts is not null")

    def run(batches):
        for batch in batches:
            out = {c: [] for c in ("doc_id", "start_word", "end_word", "kept", "text_hash")}
            for doc, uid, n, starts, copied in zip(*(c.to_pylist() for c in batch.columns)):
                coded = np.array(starts or [], np.int64)
                state = np.maximum(
                    covered(coded >> 1, n) | bool(copied), 2 * covered(coded[coded % 2 == 1] >> 1, n))
                cuts = np.flatnonzero(np.diff(state, prepend=0, append=0))
                for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    if state[begin]:
                        for name, value in zip(out, (doc, begin, end, state[begin] == 1, uid)):
                            out[name].append(value)
            yield out

    spans = arrow_map(
        known, run, "doc_id long, start_word int, end_word int, kept boolean, text_hash long")
    copies = rows.join(classes.select("uid", "_first"), "uid").where(
        (F.col("doc_id") != F.col("_first")) & (F.col("n_words") >= PASSAGE))
    return spans.unionByName(copies.select(
        "doc_id", F.lit(0).alias("start_word"), F.col("n_words").alias("end_word"),
        F.lit(False).alias("kept"), F.col("uid").alias("text_hash")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the words that another document holds first.

    Cut words go with the blanks after them; ``n_chars``, if there is such a column, is set
    anew. Rows that lose all their words go, rows that had none stay as they are. Only rows
    with cuts, and the few that look like them, are shuffled with their texts.
    """
    cuts = materialize(
        repeated_spans(docs).where("not kept")
        .groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_uid"))
        .agg(F.sort_array(F.collect_set(F.struct("start_word", "end_word"))).alias("_cuts")),
        "cuts")
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    touched, whole = sifted(
        rows, F.xxhash64("_hash", "doc_id"), cuts.select(F.xxhash64("_uid", "_doc")))
    joined = touched.join(
        cuts, (F.col("_hash") == F.col("_uid")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left"
    ).select("_row", F.col("_row.text").alias("text"), "_cuts")
    schema = T.StructType([
        joined.schema["_row"], T.StructField("_new", T.StringType()),
        T.StructField("_left", T.BooleanType())])

    def run(batches):
        for part, block in tx.blocks(batches):
            texts, left = [], []
            for i, (text, cut) in enumerate(zip(
                    part.column("text").to_pylist(), part.column("_cuts").to_pylist())):
                n = int(block.counts[i])
                left.append(True)
                if cut:
                    at = block.offsets[i]
                    edges = np.append(block.starts[block.first[i]: block.first[i + 1]], block.offsets[i + 1]) - at
                    raw, rest, done, lost = text.encode(), [], 0, 0
                    for span in cut:
                        rest.append(raw[done: edges[min(span["start_word"], n)]])
                        done = edges[min(span["end_word"], n)]
                        lost += min(span["end_word"], n) - min(span["start_word"], n)
                    text = b"".join([*rest, raw[done:]]).decode()
                    left[-1] = lost < n
                texts.append(text)
            yield {"_row": part.column("_row"), "_new": texts, "_left": left}

    done = arrow_map(joined, run, schema).where("_left")
    every = done.select("_row", "_new").unionByName(
        whole.select("_row", F.col("_row.text").alias("_new")))
    row = F.col("_row").withField("text", F.col("_new"))
    if "n_chars" in docs.columns:
        row = row.withField(
            "n_chars", F.length("_new").cast(docs.schema["n_chars"].dataType))
    return every.select(row.alias("_row")).select("_row.*")
