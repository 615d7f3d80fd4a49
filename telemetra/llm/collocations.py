"""Phrase collocations: direct-address tiles of pairs of frequency-ranked ids, level by level.

Frequent words get ids by frequency. Neighbouring ids are counted as pairs in square tiles of
the id space: tiles that a task fills densely by ``bincount`` over the whole tile, the others as
sorted coordinates. Frequent pairs are ranked again, texts are rewritten as ids of pairs, and two
neighbouring pairs overlap in all but their outer words, so the same count gives phrases of three
words, then four, then five.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm.frames import arrow_map
from telemetra.operators.ordering import global_row_number
from telemetra.session import materialize, spread

MIN_COUNT = 100
LONGEST = 5
BEST = 2000  # phrases reported per language
LANES = 64  # parts of a language whose best phrases are found apart
TILE = 2048
DENSE = TILE * TILE // 16  # pairs in a tile from which it is counted by address
CHUNK = 1 << 21  # pairs that a task counts at a time
TEXT_BYTES = 1 << 20  # text of one language that is cut into words at a time
HELD_BYTES = 1 << 23  # text of all languages that waits for that
COUNTED_WORDS = 200_000  # distinct words that a task holds
LOOKUP_WORDS = 300_000  # larger tables of ids are joined instead of sent to the tasks
LOOKUP_PAIRS = 2_000_000
NO_LANG = "und"

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_PLAIN = bytes.maketrans(_UPPER + b"\t" + _BREAKS, _UPPER.lower() + b" " + b"." * len(_BREAKS))
BREAK = b"."
_BITS, _LOW = np.uint64(11), np.uint64(TILE - 1)  # of a place inside a tile


def tokens(texts: list[bytes]) -> list[bytes]:
    """Lower-cased words of the texts, with ``BREAK`` between pieces."""
    return BREAK.join(texts).translate(_PLAIN).replace(BREAK, b" . ").split()


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Language and words of whole texts, about ``TEXT_BYTES`` at a time."""
    waiting: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.large_binary())
        for lang, text in zip(langs, texts):
            text = text.as_py()
            waiting.setdefault(lang, []).append(text)
            sizes[lang] += len(text) + 1
            if sizes[lang] > TEXT_BYTES:
                yield lang, tokens(waiting.pop(lang))
                del sizes[lang]
            elif sizes.total() > HELD_BYTES:
                yield from ((name, tokens(held)) for name, held in waiting.items())
                waiting, sizes = {}, Counter()
    yield from ((name, tokens(held)) for name, held in waiting.items())


def _texts(docs: DataFrame) -> DataFrame:
    return spread(docs.select(
        F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")))


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """``lang, word, n`` of words found ``least`` times; a null word holds the language's total."""
    def run(batches):
        found: dict[str, Counter] = {}

        def rows():
            for lang, counts in found.items():
                pauses = counts.pop(BREAK, 0)
                total = counts.total()
                assert pauses >= 0
                words = pa.array([*counts, None], pa.binary()).cast(pa.string())
                yield {"lang": [lang] * len(words), "word": words, "n": [*counts.values(), total]}

        for lang, words in runs(batches):
            found.setdefault(lang, Counter()).update(words)
            if sum(map(len, found.values())) > COUNTED_WORDS:
                yield from rows()
                found.clear()
        yield from rows()

    counts = arrow_map(_texts(docs), run, "lang string, word string, n long")
    summed = counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return materialize(summed.where((F.col("n") >= least) | F.col("word").isNull()), "words")


def ranked(counts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Ids from 1, the most frequent first; they fit in 32 bits."""
    numbered = global_row_number(counts, [F.col("n").desc(), *map(F.col, key)], "id")
    fits = F.when(F.col("id") < 1 << 32, F.col("id")).otherwise(
        F.raise_error(F.lit("more frequent phrases than ids")).cast("bigint"))
    return materialize(numbered.withColumn("id", fits), "ranked")


def _packed(ids: np.ndarray) -> np.ndarray:
    """Ids without repeated breaks (zeros), or nothing if no two neighbours are left."""
    ids = np.concatenate([[0], ids]).astype(np.uint32)
    ids = ids[(ids > 0) | np.append(ids[1:] > 0, False)]
    return ids if np.any((ids[1:] > 0) & (ids[:-1] > 0)) else ids[:0]


def _row(ids: np.ndarray) -> dict:
    packed = _packed(ids)
    return {"ids": [packed.tobytes()] if len(packed) else []}


def _blocks(df: DataFrame, label: str) -> DataFrame:
    return materialize(df.withColumn("block", F.monotonically_increasing_id()), label)


def word_blocks(docs: DataFrame, words: DataFrame, lookup: int) -> DataFrame:
    """``block, ids``: texts of one language as ids of frequent words, zero between others."""
    if words.count() <= lookup:
        table: dict[str, dict[bytes, int]] = {}
        for lang, word, number in zip(
                *(c.to_pylist() for c in words.select("lang", "word", "id").toArrow().columns)):
            table.setdefault(lang, {})[word.encode()] = number
        shared = docs.sparkSession.sparkContext.broadcast(table)

        def run(batches):
            for lang, found in runs(batches):
                get = shared.value.get(lang, {}).get
                yield _row(np.fromiter(map(get, found, repeat(0)), np.int64, len(found)))

        return _blocks(arrow_map(_texts(docs), run, "ids binary"), "word-ids")

    def local(batches):
        for lang, found in runs(batches):
            known = {word: i for i, word in enumerate(dict.fromkeys([BREAK, *found]))}
            ids = np.fromiter(map(known.__getitem__, found), np.uint32, len(found))
            names = pa.array(list(known)[1:], pa.binary()).cast(pa.string())
            keys = pa.StructArray.from_arrays(
                [pa.array([lang] * len(names), pa.string()), names], ["lang", "word"])
            yield {"ids": [ids.tobytes()], "keys": pa.ListArray.from_arrays([0, len(keys)], keys)}

    schema = "ids binary, keys array<struct<lang: string, word: string>>"
    return resolved(arrow_map(_texts(docs), local, schema), words, ["lang", "word"])


def neighbours(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both ids of each pair of neighbours, and where it stands."""
    at = np.flatnonzero((ids[1:] > 0) & (ids[:-1] > 0))
    return ids[at].astype(np.int64), ids[at + 1].astype(np.int64), at


def count_tiles(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs and their counts: dense tiles by direct address, the others by sorting."""
    # a tile's number stands in front of the place in it, so sorting by one sorts by both
    x, y = x.astype(np.uint64), y.astype(np.uint64)
    codes = ((x >> _BITS) << np.uint64(43)) | ((y >> _BITS) << np.uint64(22)) | ((x & _LOW) << _BITS) | (y & _LOW)
    del x, y
    codes.sort()
    tile = codes >> np.uint64(22)
    starts = np.flatnonzero(np.append(True, tile[1:] != tile[:-1])[: len(tile)])
    sizes = np.diff(np.append(starts, len(tile)))
    dense = sizes >= DENSE
    place = np.uint64(TILE * TILE - 1)

    def pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left = (codes >> np.uint64(43)) << _BITS | (codes >> _BITS) & _LOW
        right = ((codes >> np.uint64(22)) & np.uint64((1 << 21) - 1)) << _BITS | codes & _LOW
        return left.astype(np.int64), right.astype(np.int64)

    for start, size in zip(starts[dense].tolist(), sizes[dense].tolist()):
        part = codes[start: start + size]
        counts = np.bincount((part & place).astype(np.int64), minlength=TILE * TILE)
        hit = np.flatnonzero(counts)
        yield *pairs(part[0] & ~place | hit.astype(np.uint64)), counts[hit]
    rest = codes[~np.repeat(dense, sizes)]
    first = np.flatnonzero(np.append(True, rest[1:] != rest[:-1])[: len(rest)])
    yield *pairs(rest[first]), np.diff(np.append(first, len(rest)))


def pair_counts(blocks: DataFrame, least: int) -> DataFrame:
    """``x, y, n`` of neighbouring ids found ``least`` times."""
    def run(batches):
        held, size = [], 0

        def rows():
            x, y = (np.concatenate(side) for side in zip(*held))
            for left, right, n in count_tiles(x, y):
                yield {"x": left, "y": right, "n": n}

        for batch in batches:
            for ids in batch.column("ids"):
                x, y, _ = neighbours(np.frombuffer(ids.as_py(), np.uint32))
                held.append((x, y))
                size += len(x)
                if size >= CHUNK:
                    yield from rows()
                    held, size = [], 0
        if size:
            yield from rows()

    counts = arrow_map(blocks.select("ids"), run, "x long, y long, n long")
    return materialize(
        counts.groupBy("x", "y").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "pairs")


def pair_blocks(blocks: DataFrame, pairs: DataFrame, lookup: int) -> DataFrame:
    """The blocks rewritten as ids of frequent pairs, one for each two neighbours."""
    if pairs.count() <= lookup:
        x, y, number = (c.to_numpy() for c in pairs.select("x", "y", "id").toArrow().columns)
        codes = (x.astype(np.int64) << 32) | y
        order = np.argsort(codes)
        shared = blocks.sparkSession.sparkContext.broadcast(
            (codes[order], number[order].astype(np.uint32)))

        def run(batches):
            codes, numbers = shared.value
            for batch in batches:
                for held in batch.column("ids"):
                    ids = np.frombuffer(held.as_py(), np.uint32)
                    x, y, at = neighbours(ids)
                    wanted = (x << 32) | y
                    place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
                    found = np.zeros(len(ids), np.uint32)
                    found[at] = np.where(codes[place] == wanted, numbers[place], 0)
                    yield _row(found)

        return _blocks(arrow_map(blocks.select("ids"), run, "ids binary"), "pair-ids")

    def local(batches):
        for batch in batches:
            for held in batch.column("ids"):
                ids = np.frombuffer(held.as_py(), np.uint32)
                x, y, at = neighbours(ids)
                codes, inverse = np.unique((x << 32) | y, return_inverse=True)
                found = np.zeros(len(ids), np.uint32)
                found[at] = inverse + 1
                keys = pa.StructArray.from_arrays(
                    [pa.array(codes >> 32), pa.array(codes & 0xFFFFFFFF)], ["x", "y"])
                yield {"ids": [found.tobytes()], "keys": pa.ListArray.from_arrays([0, len(keys)], keys)}

    schema = "ids binary, keys array<struct<x: long, y: long>>"
    return resolved(arrow_map(blocks.select("ids"), local, schema), pairs, ["x", "y"])


def resolved(local: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Blocks whose ids point into their own ``keys``, rewritten with the ids of ``table``.

    Each block asks once for each of its distinct keys. A key that all blocks have is a skewed
    join key at most; both sides are stored, so Spark can split it.
    """
    stored = _blocks(local, "local-ids")
    asked = stored.select("block", F.posexplode("keys").alias("at", "key")).select(
        "block", "at", *(F.col(f"key.{c}").alias(c) for c in on))
    answers = asked.join(table.select(*on, "id"), on).groupBy("block").agg(
        F.collect_list(F.struct("at", "id")).alias("found"))

    def run(batches):
        for batch in batches:
            for held, found in zip(batch.column("ids"), batch.column("found")):
                local = np.frombuffer(held.as_py(), np.uint32)
                at, numbers = (c.to_numpy() for c in found.values.flatten())
                remap = np.zeros(max(local.max(initial=0), at.max(initial=0) + 1) + 1, np.uint32)
                remap[at + 1] = numbers
                yield _row(remap[local])

    both = stored.select("block", "ids").join(answers, "block").select("ids", "found")
    return _blocks(arrow_map(both, run, "ids binary"), "resolved-ids")


def longer(pairs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases of the ranked pairs: words, and counts of all their beginnings and ends."""
    first = phrases.select(F.col("id").alias("x"), "lang", "words", "heads")
    last = phrases.select(
        F.col("id").alias("y"), F.element_at("words", -1).alias("_word"), "tails")
    count = F.array("n")
    return materialize(pairs.join(first, "x").join(last, "y").select(
        "id", "x", "y", "lang", "n", F.concat("words", F.array("_word")).alias("words"),
        F.concat("heads", count).alias("heads"), F.concat("tails", count).alias("tails")), "phrases")


def best_cut() -> Column:
    """Score, place and counts of the lowest-scoring cut, in exact decimal arithmetic."""
    return F.expr("""
        array_min(transform(sequence(1, size(words) - 1), k -> named_struct(
            'score', (1000BD * cast(n as decimal(19,0)) * cast(total as decimal(14,0)))
                     div (cast(heads[k - 1] as decimal(19,0)) * cast(tails[size(words) - k - 1] as decimal(19,0))),
            'k', k, 'l', heads[k - 1], 'r', tails[size(words) - k - 1])))""")


def candidates(
    docs: DataFrame, least: int = MIN_COUNT, longest: int = LONGEST,
    lookup_words: int = LOOKUP_WORDS, lookup_pairs: int = LOOKUP_PAIRS,
) -> DataFrame | None:
    """``lang, phrase, a, l, r, n, score`` of all phrases found ``least`` times that no longer
    one covers at the same count; None if there are none.

    ``lookup_words`` and ``lookup_pairs`` are the rows up to which a table of ids is sent to the
    tasks; larger ones are joined, with the same result.
    """
    counts = word_counts(docs, least)
    totals = counts.where("word IS NULL").select("lang", F.col("n").alias("total"))
    words = ranked(counts.where("word IS NOT NULL"), ["lang", "word"])
    blocks = word_blocks(docs, words, lookup_words)
    single = F.array("n")
    phrases = words.select(
        "id", "lang", F.array("word").alias("words"), single.alias("heads"), single.alias("tails"))
    levels = []
    for size in range(2, longest + 1):
        pairs = ranked(pair_counts(blocks, least), ["x", "y"])
        if pairs.isEmpty():
            break
        phrases = longer(pairs, phrases)
        levels.append(phrases)
        if size < longest:
            blocks = pair_blocks(blocks, pairs, lookup_pairs)
    if not levels:
        return None
    kept = []
    for level, above in zip(levels, [*levels[1:], None]):
        if above is not None:
            covers = above.select(F.explode(F.array("x", "y")).alias("id"), "n").groupBy("id").agg(
                F.max("n").alias("_above"))
            level = level.join(covers, "id", "left").where(
                F.coalesce(F.col("_above") < F.col("n"), F.lit(True)))
        kept.append(level.select("lang", "words", "n", "heads", "tails"))
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionByName(more)
    return rows.join(totals, "lang").withColumn("cut", best_cut()).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"),
        "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")


def mine(docs: DataFrame, best: int = BEST, **options) -> DataFrame:
    """The highest-scoring phrases of each language.

    Columns ``lang, rank, phrase, a, l, r, n, score``. Null texts count as empty, a null
    language as ``und``; repeated rows count as often as they come; extra columns are ignored.
    An empty table, or one without frequent phrases, gives no rows.
    """
    found = candidates(docs, **options)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of a language are among the best of its parts, so no task ranks all its phrases
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(LANES))).orderBy(*order)
    first = found.withColumn("_part", F.row_number().over(part)).where(F.col("_part") <= best)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return first.withColumn("rank", rank).where(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def check_sql() -> str:
    """The same rows in SQL over ``documents``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cuts = ", ".join(
        f"CASE WHEN c.m > {k} THEN list_value({k}, coalesce(f{k}.f, 0), coalesce(g{k}.f, 0)) END"
        for k in range(1, LONGEST))
    joins = " ".join(
        f"LEFT JOIN f f{k} ON f{k}.lang = c.lang AND c.m > {k} AND f{k}.p = array_to_string(c.ws[1:{k}], ' ') "
        f"LEFT JOIN f g{k} ON g{k}.lang = c.lang AND c.m > {k} AND g{k}.p = array_to_string(c.ws[{k + 1}:c.m], ' ')"
        for k in range(1, LONGEST))
    return rf"""
    WITH d AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(coalesce(text, ''), '{upper}', '{lower}') AS t
      FROM documents),
    p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
    t AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
    g AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
      FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS m) WHERE len(ws) >= m),
    f AS (SELECT lang, m, ws[i:i + m - 1] AS ws, array_to_string(ws[i:i + m - 1], ' ') AS p, count(*) AS f
      FROM g GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
    c AS (SELECT * FROM f WHERE m > 1),
    k AS (SELECT c.lang, c.m, c.p, c.f, c.ws, t.n, list_sort(list_transform(
          list_filter([{cuts}], lambda x: x IS NOT NULL),
          lambda x: {{'score': CAST(1000 AS HUGEINT) * c.f * t.n // (CAST(x[2] AS HUGEINT) * x[3]),
            'k': x[1], 'l': x[2], 'r': x[3]}}))[1] AS cut
      FROM c JOIN t USING (lang) {joins}),
    s AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM c o WHERE o.lang = k.lang AND o.m = k.m + 1
        AND o.f = k.f AND (array_to_string(o.ws[1:k.m], ' ') = k.p OR array_to_string(o.ws[2:o.m], ' ') = k.p)))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, f DESC, encode(p)) AS rank,
      p AS phrase, CAST(f AS BIGINT) AS a, CAST(cut.l AS BIGINT) AS l, CAST(cut.r AS BIGINT) AS r,
      CAST(n AS BIGINT) AS n, CAST(cut.score AS BIGINT) AS score
    FROM s QUALIFY rank <= {BEST}"""
