"""A stored inverted index: postings by term and span of documents, searched from the best span down."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.operators.retrieval import LENGTH_WEIGHT, SATURATION, terms_of
from telemetra.session import materialize

FOLDERS = 64  # of terms, by hash
SPAN = 1024  # documents of one span, on average
SPANS_AT_ONCE = 8  # spans that one task cuts, if the cores have work
PROBED = 8  # spans that are scored to learn what a document must reach


class TextIndex:
    """Postings below ``path``, in segments that are added one by one.

    A posting row holds all documents of one span (a hash of the key) that have the term, with
    their counts and lengths as arrays side by side, and beside them the largest count and
    smallest length. From those follows the most that a document of the span can score, so spans that cannot reach the k
    best are never opened. A segment counts once its statistics are stored, which is last; one
    that was left unfinished is written over. Keys are unique over all segments.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _segments(self) -> list[tuple[int, int, int]]:
        try:
            rows = self.spark.read.parquet(f"{self.path}/statistics").collect()
        except AnalysisException:
            return []  # nothing there yet
        return sorted((r["segment"], r["documents"], r["length"]) for r in rows)

    def add(self, documents: DataFrame, key: str, text: str) -> int:
        """Index the rows as a new segment and return its number.

        Texts meet once by span and are cut there, so counts and postings need no shuffle of
        their own; only finished postings are dealt to folders. Keys are read for themselves,
        and the length of all texts is the sum of the counts that were stored.
        """
        segment = len(self._segments()) + 1
        keys, stored = f"{self.path}/keys/segment={segment}", f"{self.path}/postings/segment={segment}"
        documents.select(F.col(key).alias("key")).write.mode("overwrite").parquet(keys)
        n = self.spark.read.parquet(keys).count()
        spans = max(1, round(n / SPAN))
        tasks = min(spans, max(2 * self.spark.sparkContext.defaultParallelism, spans // SPANS_AT_ONCE))
        span = F.pmod(F.xxhash64("key"), F.lit(spans)).cast("int")
        dealt = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn(
            "span", span).repartition(tasks, "span")
        cut = dealt.select("key", "span", terms_of(F.col("text")).alias("terms"))
        opened = cut.select("key", "span", F.size("terms").alias("length"), F.explode("terms").alias("term"))
        counts = opened.groupBy("term", "span", "key", "length").agg(F.count(F.lit(1)).alias("count"))
        postings = counts.groupBy("term", "span").agg(F.collect_list(
            F.struct("key", F.col("count").cast("int").alias("count"), "length")).alias("hits"))
        # what follows from the arrays is added behind the last shuffle
        placed = postings.select(
            "term", "span", F.col("hits.key").alias("keys"), F.col("hits.count").alias("counts"),
            F.col("hits.length").alias("lengths"), _folder(F.col("term")).alias("folder"))
        placed.hint("rebalance", "folder").sortWithinPartitions("folder", "term").withColumns({
            "documents": F.size("keys").cast("long"), "most": F.array_max("counts").cast("long"),
            "least": F.array_min("lengths"),
            "occurrences": F.aggregate("counts", F.lit(0).cast("long"), lambda total, c: total + c),
        }).write.mode("overwrite").partitionBy("folder").parquet(stored)
        length = self.spark.read.schema("occurrences long").parquet(stored).agg(
            F.coalesce(F.sum("occurrences"), F.lit(0))).first()[0]
        self.spark.createDataFrame([(n, length)], "documents long, length long").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/statistics/segment={segment}")
        return segment

    def asked_terms(self, question: str) -> list[str]:
        """Distinct terms of a question, cut like the documents."""
        row = self.spark.createDataFrame([(question,)], "q string").select(
            F.array_sort(F.array_distinct(terms_of(F.col("q")))).alias("q")).first()
        return row["q"]

    def postings(self, terms: list[str], segments: list[int]) -> DataFrame:
        """Posting rows of the terms; only their folders are listed and only their rows pass."""
        folders = {r[0] for r in self.spark.createDataFrame(
            [(t,) for t in terms], "t string").select(_folder(F.col("t"))).collect()}
        stored = self.spark.read.parquet(f"{self.path}/postings")
        return stored.where(
            F.col("folder").isin(sorted(folders)) & F.col("segment").isin(segments) & F.col("term").isin(terms))

    def search(self, question: str, k: int) -> DataFrame:
        """Top-k ``key, similarity`` by BM25 over all segments, ties by key.

        One pass over the posting heads gives each term's weight and each span's bound. The
        spans of highest bound are scored first; then all spans whose bound reaches the k-th
        best score found there, and no others. Documents without any of the terms score 0.
        """
        asked = _Search(self, question, k)
        if asked.bounds is None:
            return asked.nothing.orderBy("key").limit(k)
        best = [F.col("similarity").desc(), F.col("key")]
        top = asked.scores(asked.open_spans()).orderBy(*best).limit(k)
        if asked.enough:
            return top
        # fewer documents than asked for have any of the terms; the smallest other keys fill up
        top = materialize(top, "text-hits")
        rest = asked.nothing.join(top, "key", "left_anti").orderBy("key").limit(k)
        return top.unionByName(rest).orderBy(*best).limit(k)


class _Search:
    """One question: weights, bounds by span (None without hits), and what the k-th best reaches."""

    def __init__(self, index: TextIndex, question: str, k: int):
        segments = index._segments()
        if not segments:
            raise ValueError("nothing is indexed yet")
        numbers = [s for s, _, _ in segments]
        self.total = float(sum(n for _, n, _ in segments))
        self.length = sum(size for _, _, size in segments)
        keys = index.spark.read.parquet(f"{index.path}/keys").where(F.col("segment").isin(numbers))
        self.nothing = keys.select("key", F.lit(0.0).alias("similarity"))
        self.bounds, self.weights = None, {}
        terms = index.asked_terms(question)
        if terms and self.length:
            self.found = index.postings(terms, numbers)
            held = self.found.groupBy("term").agg(F.sum("documents").alias("n")).collect()
            self.weights = {
                r["term"]: math.log(1 + (self.total - r["n"] + 0.5) / (r["n"] + 0.5)) for r in held}
        if not self.weights:
            return
        self.bounds = materialize(self.found.groupBy("segment", "span").agg(
            F.sum(self.part(F.col("most"), F.col("least"))).alias("bound")), "span-bounds")
        probed = self.bounds.orderBy(F.desc("bound"), "segment", "span").limit(PROBED)
        first = self.scores(probed).orderBy(F.desc("similarity")).limit(k).collect()
        self.enough = len(first) == k
        # a little less, as the bound is summed in another order than the scores
        self.reach = first[-1]["similarity"] * (1 - 1e-9) if self.enough else 0.0

    def part(self, count: Column, size: Column) -> Column:
        """What a term adds to the score of a document."""
        weight = F.create_map(*[F.lit(x) for pair in self.weights.items() for x in pair])[F.col("term")]
        mean = self.length / self.total
        damping = SATURATION * (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * size / mean)
        return weight * count * (SATURATION + 1) / (count + damping)

    def open_spans(self) -> DataFrame:
        return self.bounds.where(F.col("bound") >= self.reach)

    def scores(self, spans: DataFrame) -> DataFrame:
        chosen = self.found.join(spans.select("segment", "span"), ["segment", "span"], "left_semi")
        hits = chosen.select("term", F.explode(F.arrays_zip("keys", "counts", "lengths")).alias("h"))
        return hits.groupBy(F.col("h.keys").alias("key")).agg(
            F.sum(self.part(F.col("h.counts"), F.col("h.lengths"))).alias("similarity"))


def _folder(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(FOLDERS)).cast("int")
