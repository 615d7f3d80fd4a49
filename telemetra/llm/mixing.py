"""Mixing sources to target weights: random order, prefix sums, cuts at exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.llm import text as tx
from telemetra.operators.joins import small_side
from telemetra.operators.ordering import running_total
from telemetra.session import materialize

WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
EPOCHS = 2  # a source gives at most this many times its size
SEED = "mix"


def targets(sizes: DataFrame) -> DataFrame:
    """``_rank, source, n, target, budget`` for unique rows of ``source, n``.

    The mix holds one and a half times all words. Sources weigh ``WEIGHTS`` in code-point
    order, null last. Words per unit of weight are the same for all sources that do not stop at
    ``EPOCHS`` times their size. In order of size per weight the first sources stop; assuming
    that all before a source stop gives a level, and the highest of these levels is the true
    one. One row per source is ordered here, never a document. ``budget`` is the target
    rounded to whole words.
    """
    big = "decimal(38,0)"
    line = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.col("_rank") % len(WEIGHTS) + 1).cast("int"))
    fill = Window.orderBy(F.col("n") / F.col("w"), "_rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()

    def earlier(value: str):
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    words = 3 * F.sum("n").over(everything).cast(big) - 2 * EPOCHS * earlier("n").cast(big)
    weights = 2 * (F.sum("w").over(everything) - earlier("w"))
    return (
        sizes.withColumn("_rank", F.row_number().over(line) - 1).withColumn("w", weight)
        .withColumn("_level", words.cast("double") / weights.cast("double"))
        .withColumn("_level", F.max("_level").over(everything))
        .withColumn("target", F.least(
            F.col("w") * F.col("_level"), (EPOCHS * F.col("n")).cast("double")))
        .select("_rank", "source", "n", "target", F.least(
            F.floor(F.col("target") + 0.5), EPOCHS * F.col("n")).alias("budget"))
    )


def size(text: str = "text") -> Column:
    """Words of the text."""
    return F.coalesce(F.regexp_count(text, F.lit(tx.WORD)), F.lit(0)).cast("bigint")


def key() -> Column:
    """Where a row stands in the random order."""
    return F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def ordered(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """``carry, size, _key`` with the columns of the source's target and where each row begins."""
    rows = materialize(docs.select(
        *carry, F.col("source").alias("_source"), size().alias("size"), key().alias("_key")), "sizes")
    aims = materialize(
        targets(rows.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("n"))),
        "targets")
    aimed = rows.join(aims, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    return running_total(aimed, ["_rank"], ["_key", "size", *carry], "size", "begins")


def shares() -> dict[str, Column]:
    """What the mix takes of a row that begins at ``begins``: words, whole copies, words of a cut one."""
    zero = F.lit(0).cast("bigint")
    left = F.col("budget") - F.col("begins")
    first = F.greatest(zero, F.least(left, F.col("size")))
    again = F.greatest(zero, F.least(left - F.col("n"), F.col("size")))
    whole = [((part == F.col("size")) & (part > 0)).cast("int") for part in (first, again)]
    return {
        "taken": first + again, "full": whole[0] + whole[1],
        "cut": F.when(whole[0] == 0, first).when(whole[1] == 0, again).otherwise(zero)}


def mix(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Words that the mix takes of each row of ``doc_id, source, text``.

    Inside a source, rows follow the md5 of their id (a random order that reruns repeat); the
    prefix sum of sizes says where each row begins. The mix takes the words before the
    source's budget, so one row is cut where the budget ends, and once the source is used up
    the order starts again. Ids may repeat or be null: ties are ordered by size and are
    interchangeable. Null and empty texts have size 0. An empty table gives no rows.

    Returns the columns ``carry``, ``size, source_size, target, taken``, and ``full`` (whole
    copies of the row) and ``cut`` (words of one more, cut copy; 0 for none).
    """
    return ordered(docs, carry).select(
        *carry, "size", F.col("n").alias("source_size"), "target",
        *[c.alias(name) for name, c in shares().items()])


def edges(docs: DataFrame) -> DataFrame:
    """Per source where each pass over it stops: ``_rank, source, n, budget, _edges``.

    An edge is ``_key, size, begins`` of the first rows in the order that the pass does not
    take as a whole, null where it takes all. Rows that tie there have equal sizes.
    """
    source = ["_rank", "source", "n", "budget"]
    ties = ordered(docs, ["doc_id"]).groupBy(*source, "_key", "size").agg(
        F.min("begins").alias("begins"), F.count(F.lit(1)).alias("_n"))
    ends = F.col("begins") + F.col("_n") * F.col("size")
    edge = F.struct("_key", "size", "begins")
    return materialize(
        ties.groupBy(*source).agg(F.array(
            F.min(F.when(ends > F.col("budget"), edge)),
            F.min(F.when(ends > F.col("budget") - F.col("n"), edge))).alias("_edges")), "edges")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: copies as often as taken.

    The one copy per source and pass that the budget cuts keeps its first words, joined by
    blanks. Rows without words are not part of a mix. A pass takes every row before its edge as
    a whole, so texts are neither shuffled nor stored, but for the rows that tie at an edge.
    """
    # one row per source
    stops = small_side(edges(docs))
    rows = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.col("source").alias("_source"), key().alias("_key"))
    rows = rows.join(stops, F.col("_source").eqNullSafe(F.col("source")))
    words = size("_doc.text")
    passes = [F.get("_edges", F.lit(0)), F.get("_edges", F.lit(1))]
    before, tied = [], []
    for edge in passes:
        # conditions one after the other, so that words are counted only where keys are equal
        before.append(
            F.when(edge.isNull(), True).when(F.col("_key") != edge["_key"], F.col("_key") < edge["_key"])
            .otherwise(words < edge["size"]))
        tied.append(
            F.when(edge.isNull() | (F.col("_key") != edge["_key"]), False)
            .otherwise(words == edge["size"]))
    copies = before[0].cast("int") + before[1].cast("int")
    plain = rows.where(~tied[0] & ~tied[1] & (copies > 0) & F.col("_doc.text").rlike(tx.WORD)).select(
        "_doc", F.explode(F.array_repeat(F.lit(True), copies)))
    close = materialize(
        rows.where(tied[0] | tied[1]).select(
            "_doc", "_rank", "_key", words.alias("size"), "n", "budget",
            F.when(tied[0], passes[0]["begins"]).otherwise(passes[1]["begins"]).alias("_begin"),
            F.monotonically_increasing_id().alias("row_key")), "mix-edges")
    ahead = running_total(close, ["_rank", "_key", "size"], ["row_key"], "size", "_ahead")
    shared = ahead.withColumn("begins", F.col("_begin") + F.col("_ahead")).select(
        "_doc", *[c.alias(name) for name, c in shares().items()]).where("taken > 0")
    cut = F.array_join(
        F.slice(F.regexp_extract_all("_doc.text", F.lit(tx.WORD), F.lit(0)), 1, F.col("cut").cast("int")), " ")
    texts = F.filter(
        F.concat(
            F.array_repeat(F.col("_doc.text"), F.col("full")),
            F.array(F.when(F.col("cut") > 0, cut))),
        lambda t: t.isNotNull())
    opened = shared.select("_doc", F.explode(texts).alias("_text")).select(
        F.col("_doc").withField("text", F.col("_text")).alias("_doc"))
    return plain.select("_doc.*").unionByName(opened.select("_doc.*"))


def check_sql() -> str:
    """The same rows in SQL over ``documents``, for ``mix`` without its last two columns."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return f"""
    WITH d AS (SELECT doc_id, source, md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
      FROM documents),
    s AS (SELECT source, sum(size) AS n,
        row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
    w AS (SELECT *, CASE r % {len(WEIGHTS)} {weight} END AS w FROM s),
    l AS (SELECT *, CAST(3 * sum(n) OVER () - {2 * EPOCHS} * coalesce(sum(n) OVER b, 0) AS DOUBLE)
        / CAST(2 * (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS DOUBLE) AS level FROM w
      WINDOW b AS (ORDER BY CAST(n AS DOUBLE) / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    t AS (SELECT *, least(w * max(level) OVER (), CAST({EPOCHS} * n AS DOUBLE)) AS target FROM l),
    o AS (SELECT d.doc_id, d.size, CAST(t.n AS BIGINT) AS n, t.target,
        CAST(least(floor(t.target + 0.5), {EPOCHS} * t.n) AS BIGINT) - CAST(coalesce(sum(d.size) OVER (
          PARTITION BY t.r ORDER BY d.k, d.size, d.doc_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, n AS source_size, target,
      greatest(0, least(rest, size)) + greatest(0, least(rest - n, size)) AS taken FROM o"""
