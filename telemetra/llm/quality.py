"""Quality rules: cheap base rules and the fertility of a public tokeniser."""

from __future__ import annotations

import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F, types as T

from telemetra.llm import text as tx
from telemetra.llm.frames import arrow_map, sifted
from telemetra.session import materialize

SYMBOLS = b"#*$%&|<>"  # fixed values
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
WINDOW = 64  # tokens whose entropy is taken together
SHRINK = 20  # documents that the script weighs in the band of a language

# A document is rejected when a measure leaves the band of its language: this many robust
# deviations and at least this share of the median away from the median.
FERTILITY_WIDTH, FERTILITY_SHARE = 8.0, 0.25
ENTROPY_WIDTH, ENTROPY_SHARE = 8.0, 0.18
FALLBACK_SLACK = 0.05

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, n_fallback long, token_entropy double, window_entropy double, script string"
)


def repeated_words(block: tx.Block) -> np.ndarray:
    """Per text, the words inside word windows that occur at least twice in that text."""
    owners = block.owners()
    n = len(owners)
    covered = np.zeros(n + 1, np.int64)
    if n >= REPEAT_WINDOW:
        runs = tx.RunHashes(block.hashes()).every(REPEAT_WINDOW)
        inside = np.flatnonzero(owners[: len(runs)] == owners[REPEAT_WINDOW - 1:])
        keys = tx.mix(runs[inside] ^ tx.mix(owners[inside].astype(np.uint64)))
        _, group, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = inside[counts[group] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + REPEAT_WINDOW, -1)
    return np.bincount(owners, np.cumsum(covered)[:n] > 0, len(block)).astype(np.int64)


def window_entropy(ids: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Per text, the entropy of its windows of ``WINDOW`` tokens, averaged, as a share of the most.

    The last window ends with the text and may overlap the one before; a shorter text is one
    window. So the value does not drift with the length of the text.
    """
    size = np.minimum(tokens, WINDOW)
    count = -(-tokens // WINDOW)
    owner = np.repeat(np.arange(len(tokens)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = (np.cumsum(tokens) - tokens)[owner] + np.minimum(number * WINDOW, (tokens - size)[owner])
    each = size[owner]
    window = np.repeat(np.arange(len(owner)), each)
    place = np.arange(len(window)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begin, each)
    pair, times = np.unique(window * 65536 + ids[place], return_counts=True)
    spread = np.bincount(pair // 65536, times * np.log2(times), len(owner))
    safe = np.maximum(each, 2)
    share = np.where(each > 1, (np.log2(safe) - spread / safe) / np.log2(safe), 1.0)
    return np.where(count > 0, np.bincount(owner, share, len(tokens)) / np.maximum(count, 1), 1.0)


def duplicate_lines(raw: bytes) -> int:
    lines = Counter(line for line in raw.split(b"\n") if line.split())
    return sum(lines.values()) - len(lines)


def script_of(text: str) -> str:
    """Most frequent script among the letters, by the first word of their Unicode names."""
    names = Counter()
    for letter, n in Counter(text).items():
        if letter.isalpha():
            names[unicodedata.name(letter, "OTHER").split()[0]] += n
    return min(names, key=lambda s: (-names[s], s)).lower() if names else "none"


def measured(docs: DataFrame, carry: list[str], model: str | None = None) -> DataFrame:
    """The columns ``carry`` of the given rows and the measures of their texts.

    Tokens are those of a public sentencepiece vocabulary with byte fallback, applied word by
    word. Entropy is that of the document's own token frequencies, as a share of the most that
    so many tokens could have (0 to 1; 1 for fewer than two tokens); it falls with the length of the
    text, so verdicts use ``window_entropy``. Null and empty texts have no words.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    schema = T.StructType([
        *(docs.schema[c] for c in carry), *T._parse_datatype_string(MEASURES)])

    def run(batches):
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        fallback = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])
        vocabulary = tx.Vocabulary(
            lambda w: np.array(pieces.encode(w.decode("utf-8", "replace")), "<u2").tobytes(), 2)
        for part, block in tx.blocks(batches):
            n = len(block)
            ids, per_word = vocabulary.ids(block)
            owner = np.repeat(np.repeat(np.arange(n), block.counts), per_word)
            tokens = np.bincount(owner, minlength=n)
            # entropy from the counts of (text, token) pairs
            pair, times = np.unique(owner * 65536 + ids, return_counts=True)
            spread = np.bincount(pair // 65536, times * np.log2(times), n)
            safe = np.maximum(tokens, 2)
            entropy = np.where(tokens > 1, (np.log2(safe) - spread / safe) / np.log2(safe), 1.0)
            # code points: bytes that do not continue one
            chars = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
            length = chars[block.ends] - chars[block.starts]
            symbol = np.isin(block.data, np.frombuffer(SYMBOLS, np.uint8))
            symbols = np.concatenate([[0], np.cumsum(symbol)])[block.offsets]
            texts = part.column("text").to_pylist()
            yield {c: part.column(c) for c in carry} | {
                "n_words": block.counts,
                "word_chars": np.bincount(block.owners(), length, n).astype(np.int64),
                "n_symbols": np.diff(symbols),
                "n_dup_lines": [duplicate_lines(t.encode()) if t else 0 for t in texts],
                "n_repeat_words": repeated_words(block),
                "n_tokens": tokens,
                "n_fallback": np.bincount(owner, fallback[ids], n).astype(np.int64),
                "token_entropy": entropy,
                "window_entropy": window_entropy(ids, tokens),
                "script": [script_of(t or "") for t in texts],
            }

    return arrow_map(docs, run, schema)


def named_language() -> Column:
    return F.coalesce(F.lower("lang").rlike("^[a-z]{2}$"), F.lit(False))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def group_name() -> Column:
    """Two-letter language, else the script: a few hundred values at most."""
    return F.when(named_language(), F.lower("lang")).otherwise(
        F.concat(F.lit("script:"), F.coalesce("script", F.lit("none"))))


def bands(measures: DataFrame) -> DataFrame:
    """Median, median deviation and ``widen`` of each measure per language or script.

    All documents that pass the base rules count, and every group of them has a row. The values
    of a language lie between its own and those of its most frequent script, of which the script
    weighs ``SHRINK`` documents; a script has its own, as nothing else tells what is usual for
    it, and documents without letters lean on all. ``widen`` goes from 2 for the smallest group
    towards 1.
    """
    script = F.coalesce("script", F.lit("none"))
    everything = F.lit("")
    rows = measures.where(~base_failed()).select(
        F.explode(F.array_distinct(F.array(
            group_name(), F.concat(F.lit("script:"), script), everything))).alias("band"),
        script.alias("script"),
        (F.col("word_chars") / F.col("n_tokens")).alias("fertility"),
        (F.col("n_fallback") / F.col("n_tokens")).alias("fallback"),
        F.col("window_entropy").alias("entropy"))
    values = ("fertility", "fallback", "entropy")
    # the interquartile range stands for the deviation: 1.349 of them in a normal distribution
    found = rows.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.mode("script", True).alias("script"),
        *[F.percentile_approx(v, [0.25, 0.5, 0.75], 10_000).alias(v) for v in values])
    own = found.select(
        "band", (F.col("n") / (F.col("n") + SHRINK)).alias("_share"),
        F.when(F.col("script") == "none", everything)
        .when(F.col("band").startswith("script:"), F.col("band"))
        .otherwise(F.concat(F.lit("script:"), "script")).alias("_parent"),
        *[F.col(v)[1].alias(f"{v}_mid") for v in values],
        *[((F.col(v)[2] - F.col(v)[0]) / 1.349).alias(f"{v}_dev") for v in values])
    names = [f"{v}_{kind}" for v in values for kind in ("mid", "dev")]
    parents = own.select(F.col("band").alias("_parent"), *[F.col(c).alias(f"_{c}") for c in names])
    return own.where(F.col("band") != everything).join(F.broadcast(parents), "_parent").select(
        "band", (2 - F.col("_share")).alias("widen"),
        *[(F.col("_share") * F.col(c) + (1 - F.col("_share")) * F.col(f"_{c}")).alias(c) for c in names])


def judged(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``base_failed`` and ``kept``: false where a measure leaves the band of its group.

    Every document that passes the base rules has a group in ``limits``, which is broadcast:
    two-letter languages and Unicode scripts, under 1,000 rows.
    """
    joined = measures.withColumn("_band", group_name()).join(
        F.broadcast(limits.withColumnRenamed("band", "_band")), "_band", "left")
    fertility = F.col("word_chars") / F.greatest("n_tokens", F.lit(1))
    share = F.col("n_fallback") / F.greatest("n_tokens", F.lit(1))

    def room(v: str, width: float, least: Column) -> Column:
        return F.col("widen") * F.greatest(width * F.col(f"{v}_dev"), least)

    outside = (
        (F.abs(fertility - F.col("fertility_mid")) > room(
            "fertility", FERTILITY_WIDTH, FERTILITY_SHARE * F.col("fertility_mid")))
        | (share > F.col("fallback_mid") + room("fallback", FERTILITY_WIDTH, F.lit(FALLBACK_SLACK)))
        | (F.col("window_entropy") < F.col("entropy_mid") - room(
            "entropy", ENTROPY_WIDTH, ENTROPY_SHARE * F.col("entropy_mid")))
    )
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False)))
        .drop("_band", *[c for c in limits.columns if c != "band"])
    )


def rate(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Measures and verdict of each row of ``doc_id, text, lang``; the texts are not returned.

    Every row gets one result row, repeated rows too. Null and empty texts fail the base rules.
    """
    measures = materialize(
        measured(docs.select("doc_id", "text", "lang"), ["doc_id", "lang"], model), "quality")
    return judged(measures, bands(measures))


def filtered(docs: DataFrame, model: str | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``, whatever their names.

    Rows of one text and language have one verdict. Texts are not stored; only those of rows
    that go, and of the few that look like them, are shuffled.
    """
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), "text", "lang", tx.text_digest().alias("_digest"))
    measures = materialize(
        measured(rows.select("_digest", "lang", "text"), ["_digest", "lang"], model), "quality")
    gone = materialize(
        judged(measures, bands(measures)).where("not kept")
        .select(F.col("_digest").alias("_gone"), F.col("lang").alias("_lang")).distinct(), "rejected")
    doubtful, kept = sifted(
        rows, F.xxhash64("_digest", "lang"), gone.select(F.xxhash64("_gone", "_lang")))
    met = (F.col("_digest") == F.col("_gone")) & F.col("lang").eqNullSafe(F.col("_lang"))
    return kept.select("_row.*").unionByName(
        doubtful.join(gone, met, "left_anti").select("_row.*"))
