"""Secret scan by corpus-wide ownership frequency, in DataFrame functions only.

Patterns find candidate values. How many owners and repositories hold a value tells widely copied
examples from credentials of one owner; the latter add spans that no pattern alone would claim.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemetra.session import materialize

# Patterns of the base kinds, least lengths, order of the kinds.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run of 18 and more is the same match as any run, if that is long
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex", "owned")

# Values of the method: what may be a credential without a keyword, and when it is one.
LOOSE = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{12,}"
CHANGES = r"(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[0-9]|(?<=[0-9])[A-Za-z]"
LIVE_LENGTH = 20
LIVE_DIGITS = 3
LIVE_CHANGES = 5  # between small letters, capitals and digits, as random text has them
LIVE_CHARACTERS = 10  # distinct
EXAMPLE_OWNERS = 4  # a value that so many owners hold is an example

_OWNED = KINDS.index("owned")


def _matches(text: Column, pattern: str, kind: str, group: int = 0) -> Column:
    """``kind, place, gap, size, value`` of all leftmost matches.

    The pieces between the matches and the matches themselves take turns, so their lengths (in
    code points) add up to positions. Only texts with a match are cut.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pairs = F.zip_with(whole, values, lambda all_, value: F.struct(
        F.length(all_).alias("size"), value.alias("value")))
    gaps = F.split(text, pattern, -1)
    parts = F.zip_with(
        F.slice(gaps, 1, F.size(whole)), pairs, lambda gap, match: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.length(gap).alias("gap"),
            match["size"].alias("size"), match["value"].alias("value")))
    placed = F.transform(parts, lambda part, i: F.struct(
        part["kind"].alias("kind"), i.alias("place"), part["gap"].alias("gap"),
        part["size"].alias("size"), part["value"].alias("value")))
    none = F.array().cast("array<struct<kind:int,place:int,gap:int,size:int,value:string>>")
    return F.when(text.rlike(pattern), placed).otherwise(none)


def live_looking(value: Column) -> Column:
    """Long, of many characters, and changing between letters of both cases and digits."""
    return (
        (F.length(value) >= LIVE_LENGTH)
        & (F.regexp_count(value, F.lit("[0-9]")) >= LIVE_DIGITS)
        & (F.regexp_count(value, F.lit(CHANGES)) >= LIVE_CHANGES)
        & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS)
    )


def found_matches(docs: DataFrame, repository: str, owner: str) -> DataFrame:
    """One row per document: ``row``, id, repository, owner and its matches, without the text.

    Stored, so that the numbers of the rows stay put and the texts are read once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    matches = F.concat(
        _matches(text, ASSIGN, "assign", 1), _matches(text, ACCESS, "access"),
        _matches(text, HEX, "hex"), _matches(text, LOOSE, "owned"))
    return materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.col(repository).cast("string").alias("_repository"),
        F.col(owner).cast("string").alias("_owner"), matches.alias("matches")), "secret-matches")


def uses(found: DataFrame) -> DataFrame:
    """One row per candidate: where it stands, digest of its value, whether that looks live.

    Loose runs that touch a base span are left out. Rows of a document meet in one task, where
    positions are running sums and neighbours are compared in order, never in pairs.
    """
    opened = found.where(F.size("matches") > 0).select(
        "row", "_repository", "_owner", F.explode("matches").alias("m")
    ).select("row", "_repository", "_owner", "m.*").repartition("row")
    sofar = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    long_enough = (F.col("kind") != KINDS.index("assign")) | (F.length("value") >= ASSIGN_LENGTH)
    placed = (
        opened.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(sofar))
        .withColumn("start", F.col("end") - F.col("size")).where(long_enough))
    # both windows grow with their rows; one that shrinks would look at all pairs
    grows = (Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("row").orderBy("start").rangeBetween(*grows)
    after = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(*grows)
    base = F.col("kind") != _OWNED
    alone = (
        F.coalesce(F.max(F.when(base, F.col("end"))).over(before) <= F.col("start"), F.lit(True))
        & F.coalesce(F.min(F.when(base, F.col("start"))).over(after) >= F.col("end"), F.lit(True)))
    key = F.unhex(F.md5(F.regexp_replace("value", r"^[+/_.=-]+|[+/_.=-]+$", "")))
    return materialize(
        placed.withColumn("_alone", alone).where(base | F.col("_alone")).select(
            "row", "_repository", "_owner", "kind", "start", "end", key.alias("key"),
            (live_looking(F.col("value")) | (F.col("kind") < 2)).alias("live")),
        "secret-uses")


def ownership(used: DataFrame) -> DataFrame:
    """``key, n_owners, n_repositories, assigned`` of each value.

    Uses are first reduced to one per value, owner and repository, then counted by owner, then
    by value, with partial sums before each shuffle, so a value that a third of all documents
    hold stays spread out until it is one row per owner. Null owners and repositories count as
    one each. ``assigned`` says that some use has a keyword or is an access key.
    """
    once = used.groupBy("key", "_owner", "_repository").agg(
        F.max(F.col("kind") < 2).alias("assigned"))
    by_owner = once.groupBy("key", "_owner").agg(
        F.count(F.lit(1)).alias("n"), F.max("assigned").alias("assigned"))
    return by_owner.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"),
        F.max("assigned").alias("assigned"))


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Base spans, spans added by ownership, and how the values are owned; one row per document.

    Base kinds are ``assign`` (a keyword and its value), ``access`` and ``hex``; they stay
    whoever owns them. A loose run of letters, digits, ``_`` and ``-`` becomes an ``owned`` span
    if fewer than ``EXAMPLE_OWNERS`` owners hold its value, and it either looks live or is
    assigned to a keyword somewhere in the corpus.

    Columns ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, then ``n_owned``,
    ``n_live`` (base and owned spans whose value few owners hold and which look live) and
    ``n_examples`` (base spans and loose runs whose value is widely copied). Null texts are
    empty; repeated rows and null ids are rows of their own, extra columns are ignored, an
    empty table gives no rows.
    """
    found = found_matches(docs, repository, owner)
    used = uses(found)
    # stored before the join, so that Spark can split a value with very many uses
    owners = materialize(ownership(used), "secret-owners")
    few, loose = F.col("n_owners") < EXAMPLE_OWNERS, F.col("kind") == _OWNED
    credential = few & (F.col("live") | (F.col("assigned") & loose))
    span = F.struct("start", "kind", "end")
    judged = used.join(owners, "key").groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(~loose, span))).alias("base"),
        F.array_sort(F.collect_list(F.when(~loose | credential, span))).alias("all"),
        *(F.count_if(F.col("kind") == i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])),
        F.count_if(loose & credential).alias("n_owned"),
        F.count_if(credential).alias("n_live"), F.count_if(~few).alias("n_examples"))
    # documents without any match stay out of the join
    loud = found.where(F.size("matches") > 0).select("row", "doc_id").join(judged, "row", "left")
    quiet = found.where(F.size("matches") == 0).select("doc_id")
    counts = ["n_assign", "n_access", "n_hex", "n_owned", "n_live", "n_examples"]
    return loud.unionByName(quiet, allowMissingColumns=True).fillna(0, counts).select(
        "doc_id", *counts[:3], F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("all").alias("spans"), *counts[3:])


def _listed(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    each = F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.coalesce(F.array_join(each, ","), F.lit(""))


def check_sql() -> str:
    """The same rows in SQL over ``documents``."""
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    run = "[A-Za-z0-9_-]+"

    def spans(kind: int, pattern: str, least: int, group: int = 0) -> str:
        return rf"""
        SELECT row, doc_id, source, {kind} AS kind, s AS start, s + length(m) AS end_, v
        FROM (SELECT row, doc_id, source, m, v, sum(length(gap)) OVER o + coalesce(sum(length(m)) OVER (
                PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
              FROM (SELECT row, doc_id, source, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(vs) AS v,
                      unnest(gaps[1:len(ms)]) AS gap
                    FROM (SELECT row, doc_id, source, regexp_extract_all(t, '{pattern}') AS ms,
                        regexp_extract_all(t, '{pattern}', {group}) AS vs,
                        regexp_split_to_array(t, '{pattern}') AS gaps FROM d WHERE regexp_matches(t, '{pattern}')))
              WINDOW o AS (PARTITION BY row ORDER BY i ROWS UNBOUNDED PRECEDING))
        WHERE length(v) >= {least}"""

    def live(v: str) -> str:
        # the pairs overlap, so even and odd places are counted apart
        return rf"""(length({v}) >= {LIVE_LENGTH}
          AND len(regexp_extract_all({v}, '[0-9]')) >= {LIVE_DIGITS}
          AND len(list_filter(range(1, length({v})), lambda i: regexp_matches(
            {v}[i:i + 1], '^([a-z][A-Z0-9]|[A-Z][0-9]|[0-9][A-Za-z])$'))) >= {LIVE_CHANGES}
          AND len(list_distinct(string_split({v}, ''))) >= {LIVE_CHARACTERS})"""

    names = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END"
    listed = f"{names} || ':' || CAST(start AS BIGINT) || ':' || CAST(end_ AS BIGINT)"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents),
    b AS ({spans(0, assign, ASSIGN_LENGTH, 2)} UNION ALL {spans(1, ACCESS, 18)} UNION ALL {spans(2, HEX, 16)}),
    z AS ({spans(3, run, 12)}),
    u AS (SELECT * FROM b UNION ALL SELECT * FROM z WHERE regexp_matches(v, '[0-9]') AND NOT EXISTS (
        SELECT 1 FROM b WHERE b.row = z.row AND b.start < z.end_ AND z.start < b.end_)),
    k AS (SELECT *, regexp_replace(v, '^[+/_.=-]+|[+/_.=-]+$', '', 'g') AS key, {live('v')} OR kind < 2 AS live FROM u),
    o AS (SELECT key, max(kind < 2) AS assigned, count(DISTINCT coalesce('s' || source, '')) AS owners FROM k GROUP BY key),
    j AS (SELECT k.*, owners < {EXAMPLE_OWNERS} AS few,
        owners < {EXAMPLE_OWNERS} AND (live OR (assigned AND kind = 3)) AS credential FROM k JOIN o USING (key)),
    r AS (SELECT row, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex,
        string_agg({listed}, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
        string_agg({listed}, ',' ORDER BY start, kind) FILTER (kind < 3 OR credential) AS spans,
        count(*) FILTER (kind = 3 AND credential) AS n_owned, count(*) FILTER (credential) AS n_live,
        count(*) FILTER (NOT few) AS n_examples FROM j GROUP BY row)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned,
      coalesce(n_live, 0) AS n_live, coalesce(n_examples, 0) AS n_examples
    FROM d LEFT JOIN r USING (row)"""
