"""Language of web pages by Bayesian fusion of text, markup, address and host evidence."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from telemetra.llm import text as tx
from telemetra.llm.frames import arrow_map
from telemetra.session import materialize

BINS = 1 << 14  # hashed byte trigrams
EFFECTIVE = 60.0  # independent trigrams that a long text is worth
STRENGTH = 8.0  # pages that a parent's distribution counts for in a child's
OTHER = "other"

_HIDDEN = re.compile(r"<!--.*?-->|<(script|style|nav)\b.*?</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")


def visible(page: str) -> str:
    """Text of a page without scripts, styles, navigation, comments and tags."""
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of lower-cased texts and the number of the text of each."""
    block = tx.Block(texts, fold=True)
    data = np.where((block.data >= 9) & (block.data <= 13), 32, block.data).astype(np.uint64)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = data[:-2] << np.uint64(16) | data[1:-1] << np.uint64(8) | data[2:]
    owner = np.searchsorted(block.offsets, np.arange(len(data)), "right") - 1
    inside = owner[:-2] == owner[2:]
    return (tx.mix(grams[inside]) % np.uint64(BINS)).astype(np.int64), owner[:-2][inside]


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and log-probabilities of trigram bins per language.

    All documents with a language code count, by the code's first part (``pt-br`` and ``pt_BR``
    as ``pt``, ``fil`` as itself). The counts that come to the driver are at most ``BINS`` for
    each language, however many documents there are.
    """
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for part, block in tx.blocks(batches):
            names = np.array(part.column("lang").to_pylist(), object)
            bins, owner = trigrams(part.column("text"))
            for name in np.unique(names):
                found = np.bincount(bins[(names == name)[owner]], minlength=BINS)
                total[name] = total.get(name, 0) + found
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield {"lang": [name] * len(at), "bin": at.astype(np.int32), "n": counts[at]}

    used = docs.select(
        F.regexp_extract(F.lower("lang"), "^([a-z]{2,3})(?:[-_].*)?$", 1).alias("lang"), "text"
    ).where((F.col("lang") != "") & F.col("text").isNotNull())
    counts = arrow_map(used, run, "lang string, bin int, n long").groupBy("lang", "bin").agg(
        F.sum("n").alias("n")).toPandas()
    names = sorted(counts["lang"].unique())
    table = np.full((len(names), BINS), 0.5)
    table[counts["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(int), counts["bin"]] += counts["n"]
    return names, np.log(table / table.sum(axis=1, keepdims=True))


def evidence(pages: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """``page_id, host, site, suffix, declared, text_score, weight`` of rows of
    ``page_id, url, html``.

    ``text_score`` is the log-likelihood per language, scaled down to that of ``EFFECTIVE``
    trigrams because neighbouring trigrams are not independent; ``weight`` are the shares it
    gives under equal priors. ``declared`` is the first part of the html element's
    language, ``other`` if it is none of the languages, and empty without one.
    """
    url = F.coalesce("url", F.lit(""))
    address = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    markup = F.lower(F.regexp_extract(
        F.coalesce("html", F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})\b""", 1))
    rows = pages.select(
        "page_id", "html", address.alias("host"),
        F.regexp_extract(address, r"([^.]+\.[^.]+)$", 1).alias("site"),
        F.regexp_extract(address, r"\.([^.]+)$", 1).alias("suffix"),
        F.when((markup == "") | markup.isin(names), markup).otherwise(OTHER).alias("declared"))
    width = max(1, len(names))

    def run(batches):
        turned = np.ascontiguousarray(table.T)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = pa.array([visible(p) if p else "" for p in part.column("html").to_pylist()])
                bins, owner = trigrams(texts)
                n = np.bincount(owner, minlength=len(texts))
                score = np.zeros((len(texts), width))
                for i in range(len(names)):
                    score[:, i] = np.bincount(owner, turned[bins, i], len(texts))
                score *= np.minimum(1.0, EFFECTIVE / np.maximum(n, 1))[:, None]
                share = np.exp(score - score.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                yield {c: part.column(c) for c in ("page_id", "host", "site", "suffix", "declared")} | {
                    "text_score": list(score), "weight": list(share)}

    schema = T.StructType([
        *(rows.schema[c] for c in ("page_id", "host", "site", "suffix", "declared")),
        T.StructField("text_score", T.ArrayType(T.DoubleType())),
        T.StructField("weight", T.ArrayType(T.DoubleType()))])
    return arrow_map(rows, run, schema)


TABLES = ("declared", "suffix", "site", "host")


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Language of each row of ``page_id, url, html``, learned from ``text, lang`` of ``docs``.

    log P(language | page) = text + log P(declared | language) + log P(suffix | language)
    + log prior of the host, up to a constant. The four tables are sums of the text shares of
    all pages, grouped by declared language, suffix, site and host. A host's prior is smoothed
    with its site's, that with the whole corpus's; a page without address, whose host and site
    are empty, gets the corpus's. A page's own share is taken out of every table before it is
    judged. Pages without address, markup or text are judged by what they have; ids may repeat
    or be null, each row is judged alone. Without labelled documents the language is null; an
    empty table gives no rows. Returns ``page_id, language, probability, text_language,
    declared, suffix, host, host_prior``.
    """
    names, table = learn(docs)
    found = materialize(evidence(pages, names, table), "page-evidence")
    if not names:
        return found.select(
            "page_id", F.lit(None).cast("string").alias("language"),
            F.lit(None).cast("double").alias("probability"),
            F.lit(None).cast("string").alias("text_language"), "declared", "suffix", "host",
            F.lit(None).cast("double").alias("host_prior"))
    size = len(names)

    def sums(name: str) -> Column:
        return F.array(*[F.sum(F.col("weight")[i]) for i in range(size)]).alias(name)

    whole = np.array(found.agg(sums("all")).first()["all"] or [0.0] * size)  # a number per language
    joined = found
    for column in TABLES:
        # stored before the join, so that Spark can split a host that very many pages share
        totals = materialize(found.groupBy(column).agg(sums(f"_{column}")), f"pages-by-{column}")
        joined = joined.join(totals, column)

    def run(batches):
        known = np.array(names, object)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n = part.num_rows

                def numbers(column: str) -> np.ndarray:
                    return part.column(column).flatten().to_numpy().reshape(n, size)

                text, own = numbers("text_score"), numbers("weight")
                addressed = {
                    c: np.array([bool(v) for v in part.column(c).to_pylist()]) for c in ("site", "host")}
                score, prior = fused(
                    text, own, whole, *(numbers(f"_{c}") for c in TABLES), **addressed)
                best = score.argmax(axis=1)
                rows = np.arange(n)
                yield {c: part.column(c) for c in ("page_id", "declared", "suffix", "host")} | {
                    "language": known[best], "text_language": known[own.argmax(axis=1)],
                    "probability": 1 / np.exp(score - score[rows, best][:, None]).sum(axis=1),
                    "host_prior": prior[rows, best]}

    names_out = ["page_id", "language", "probability", "text_language", "declared", "suffix", "host", "host_prior"]
    kinds = {"probability": "double", "host_prior": "double"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in names_out[1:])
    judged = arrow_map(joined, run, T.StructType(
        [joined.schema["page_id"], *T._parse_datatype_string(schema)]))
    return judged.select(*names_out)


def fused(
    text: np.ndarray, own: np.ndarray, whole: np.ndarray, declared: np.ndarray, suffix: np.ndarray,
    site_sums: np.ndarray, host_sums: np.ndarray, site: np.ndarray, host: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and host priors of pages, all arrays of pages x languages.

    ``own`` is a page's share in the sums; ``site`` and ``host`` tell whether it has any.
    """
    everything = np.maximum(whole - own, 0) + 1
    total = everything.sum(axis=1, keepdims=True)
    prior = everything / total
    for sums, has in ((site_sums, site), (host_sums, host)):
        parts = np.maximum(sums - own, 0) + STRENGTH * prior
        prior = np.where(has[:, None], parts / parts.sum(axis=1, keepdims=True), prior)
    score = text + np.log(prior)
    for sums in (declared, suffix):
        # P(value | language): seen with the language, smoothed towards how often it is seen
        rest = np.maximum(sums - own, 0)
        often = (rest.sum(axis=1, keepdims=True) + 1) / (total + 1)
        score = score + np.log((rest + STRENGTH * often) / (everything + STRENGTH))
    return score, prior
