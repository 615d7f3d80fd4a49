"""Filter interaction audit: what five filters remove alone, together and in every order.

Documents are reduced to five fail bits; the counts of all bit patterns of a part form a
2x2x2x2x2 tensor. Every figure of every order of the filters is a contraction of that tensor
with one vector per axis, which selects documents that pass, that fail, or all.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm import text as tx
from telemetra.llm.frames import arrow_map
from telemetra.session import materialize

FILTERS = "ABCDE"
CELLS = 2 ** len(FILTERS)
MIN_WORDS = 50
MIN_DISTINCT = 65  # percent of the words
MAX_CAPITALS = 5  # percent of the code points
MARKS = "[#$%&*|]"
TENSORS = ("all", "good", "toxic")
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PARTS_AT_ONCE = 128  # bounds the contracted arrays of a task

ORDERS = ["".join(order) for order in permutations(FILTERS)]
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def bits(text: str = "text") -> Column:
    """Fail bits of the filters that need only the text: 1 for A, 2 for B, 4 for C, 8 for D."""
    content = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(content, F.lit(tx.WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(content, F.lit("[A-Z]"))
    tests = [
        n < MIN_WORDS,
        100 * distinct.cast("bigint") < MIN_DISTINCT * n.cast("bigint"),
        100 * capitals.cast("bigint") > MAX_CAPITALS * F.length(content).cast("bigint"),
        content.rlike(MARKS),
    ]
    return sum((test.cast("int") * 2 ** i for i, test in enumerate(tests)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cell, good, toxic, n``: documents of each part by fail bits and labels.

    Bit 16 (E) is set if a smaller ``doc_id`` has an equal text. Rows are counted by text, part,
    labels and id before the smallest id of each text is looked for, so a text that a third of
    all documents share is spread over all tasks first and reaches the task that compares its
    ids as one row per part and label at most.
    """
    rows = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"),
        tx.text_digest().alias("digest"), bits().alias("bits"))
    marks = materialize(
        labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
            F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
            F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic")),
        "label-marks")
    marked = rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    key = ["digest", "bits", "part", "good", "toxic"]
    copies = marked.groupBy(*key, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    # of each group all rows and, apart, the rows of its smallest id
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    groups = materialize(copies.groupBy(*key).agg(
        F.sum("n").alias("n"), first,
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unknown")),
        "text-groups")
    smallest = groups.groupBy(F.col("digest").alias("_digest")).agg(
        F.min("first.doc_id").alias("_smallest"), F.count(F.lit(1)).alias("_groups"))
    # texts of one group need no comparison with other groups
    shared = materialize(smallest.where("_groups > 1").drop("_groups"), "shared-texts")
    joined = groups.join(shared, F.col("digest") == F.col("_digest"), "left")
    leads = F.col("first.doc_id") == F.coalesce("_smallest", F.col("first.doc_id"))
    original = F.col("unknown") + F.when(leads, F.col("first.n")).otherwise(0)
    both = F.array(
        F.struct(F.col("bits").alias("cell"), original.alias("n")),
        F.struct((F.col("bits") + 16).alias("cell"), (F.col("n") - original).alias("n")))
    return (
        joined.select("part", "good", "toxic", F.explode(both).alias("c"))
        .groupBy("part", "good", "toxic", "c.cell").agg(F.sum("c.n").alias("n")).where("n > 0"))


def selections() -> dict[str, np.ndarray]:
    """For each figure and each step of each order: a vector for each axis (steps x 5 x 2)."""
    found: dict[str, list] = {"kept": [], "removed": [], "failing": [], "unique_fails": []}
    for order in ORDERS:
        for step, name in enumerate(order):
            before = order[:step]
            axes = {
                "kept": {f: PASS for f in before + name},
                "removed": {f: PASS for f in before} | {name: FAIL},
                "failing": {name: FAIL},
                "unique_fails": {f: PASS for f in FILTERS} | {name: FAIL},
            }
            for figure, chosen in axes.items():
                found[figure].append([chosen.get(f, ALL) for f in FILTERS])
    return {figure: np.array(rows, np.int64) for figure, rows in found.items()}


def contract(tensors: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Counts for each part and step; ``tensors`` is parts x 2 x 2 x 2 x 2 x 2."""
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *np.moveaxis(axes, 1, 0), optimize=True)


def figures(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """All figures of parts x 3 x 2 x 2 x 2 x 2 x 2 counts (everything, good, toxic)."""
    axes = selections()
    everything, good, toxic = np.moveaxis(tensors, 1, 0)
    removed, failing = contract(everything, axes["removed"]), contract(everything, axes["failing"])
    names = np.array([FILTERS.index(name) for order in ORDERS for name in order])
    per_filter = np.stack([removed[:, names == i].sum(1) for i in range(len(FILTERS))], 1)
    return {
        "kept": contract(everything, axes["kept"]), "removed": removed,
        "redundant": failing - removed,
        "unique_fails": contract(everything, axes["unique_fails"]),
        "good_lost": contract(good, axes["removed"]),
        "toxic_lost": contract(toxic, axes["removed"]), "shapley": per_filter[:, names],
    }


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Figures of every part, order of the filters and step.

    Columns ``part, filter_order, step`` and the ``FIGURES``; 600 rows per part, zeros included.
    Null texts count as empty, a null ``source`` as the part ``''``. Rows with equal ids are
    documents of their own and no copies of each other; a null id is neither smaller nor larger
    than another. A document is good (toxic) if any of its label rows says 1. Extra columns are
    ignored; an empty table gives no rows.
    """
    # a part has at most 128 cells, so one row holds all it needs
    parts = cells(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("cell", "good", "toxic", "n")).alias("cells"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in FIGURES)
    orders = np.repeat(np.array(ORDERS, object), len(FILTERS))
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                part = batch.slice(at, PARTS_AT_ONCE)
                listed = part.column("cells")
                owner = np.repeat(np.arange(part.num_rows), listed.value_lengths().to_numpy())
                cell, good, toxic, n = (c.to_numpy() for c in listed.flatten().flatten())
                counts = np.zeros((part.num_rows, len(TENSORS), CELLS), np.int64)
                for i, weight in enumerate((n, n * good, n * toxic)):
                    np.add.at(counts[:, i], (owner, cell), weight)
                # bit 1 is the last axis of a plain reshape, so axes are turned to A..E
                shaped = counts.reshape(part.num_rows, len(TENSORS), *[2] * len(FILTERS))
                found = figures(shaped.transpose(0, 1, 6, 5, 4, 3, 2))
                yield {
                    "part": np.repeat(part.column("part").to_numpy(zero_copy_only=False), len(orders)),
                    "filter_order": np.tile(orders, part.num_rows),
                    "step": np.tile(steps, part.num_rows),
                    **{name: values.ravel() for name, values in found.items()},
                }

    return arrow_map(parts, run, schema)


def check_sql() -> str:
    """The same rows in SQL over ``documents`` and ``labels``."""
    word = r"[^\x20\x09-\x0D]+"
    passed = {f: f"NOT fail_{f.lower()}" for f in FILTERS}

    def over(condition: str) -> str:
        return f"CAST(coalesce(sum(n) FILTER ({condition}), 0) AS BIGINT)"

    def at_step(template: str) -> str:
        """Case by the filter of the step."""
        return "CASE letter " + " ".join(
            f"WHEN '{f}' THEN {template.format(f=f, fail=f'fail_{f.lower()}')}" for f in FILTERS) + " END"

    earlier_pass = " AND ".join(
        f"(position('{f}' IN left(filter_order, step - 1)) = 0 OR {passed[f]})" for f in FILTERS)
    fails = at_step("{fail}")
    others_pass = " AND ".join(f"(letter = '{f}' OR {passed[f]})" for f in FILTERS)
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '{word}') AS ws FROM d),
    l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
        len(ws) < {MIN_WORDS} AS fail_a, 100 * len(list_distinct(ws)) < {MIN_DISTINCT} * len(ws) AS fail_b,
        100 * len(regexp_extract_all(t, '[A-Z]')) > {MAX_CAPITALS} * length(t) AS fail_c,
        regexp_matches(t, '{MARKS}') AS fail_d,
        coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) AS fail_e
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
    c AS (SELECT part, good, toxic, fail_a, fail_b, fail_c, fail_d, fail_e, count(*) AS n FROM f GROUP BY ALL),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
      FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter
      FROM o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
    r AS (SELECT part, filter_order, step, letter,
        {over(f'({earlier_pass}) AND NOT ({fails})')} AS kept,
        {over(f'({earlier_pass}) AND ({fails})')} AS removed,
        {over(f'NOT ({earlier_pass}) AND ({fails})')} AS redundant,
        {over(f'({others_pass}) AND ({fails})')} AS unique_fails,
        {over(f'good AND ({earlier_pass}) AND ({fails})')} AS good_lost,
        {over(f'toxic AND ({earlier_pass}) AND ({fails})')} AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, letter)
    SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r"""
