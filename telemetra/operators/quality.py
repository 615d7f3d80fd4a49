"""Named quality rules: warn or drop, metrics, key checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F


@dataclass(frozen=True)
class Expectation:
    """``predicate`` is SQL text; a row passes only where it is true, so null fails."""

    name: str
    predicate: str
    drop: bool = False

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def _counters(rules: Sequence[Expectation]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~r.holds).alias(f"failed_{r.name}") for r in rules
    ]


def rule_counts(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row: all rows seen and, per rule, those that failed it."""
    return df.agg(*_counters(rules))


def keep_valid(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Only the dropping rules filter. A filter drops null outcomes by itself, so the bare
    predicate is used, which reaches the scan."""
    for rule in rules:
        if rule.drop:
            df = df.where(rule.predicate)
    return df


def expect(
    df: DataFrame, rules: Sequence[Expectation], observe: Observation | str | None = None
) -> DataFrame:
    """Apply the rules. With ``observe`` the failures are counted in the same pass over the
    rows, before any is dropped; on a stream pass a name and read the query's progress."""
    if observe is not None:
        df = df.observe(observe, *_counters(rules))
    return keep_valid(df, rules)


def expectation_metrics(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule: rows seen, failed and kept. A single aggregate without a shuffle key."""
    totals = rule_counts(df, rules)
    rows = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit("drop" if r.drop else "warn").alias("action"),
            F.col("rows").alias("total_rows"),
            F.col(f"failed_{r.name}").alias("failed_rows"),
        )
        for r in rules
    ]
    return totals.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or repeated, with their row counts."""
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where((F.col("row_count") > 1) | any_null)
    )


def corrupt(df: DataFrame, when: Column, **replacements: Column) -> DataFrame:
    """Seed bad values on a condition, to exercise the rules."""
    return df.withColumns(
        {name: F.when(when, value).otherwise(F.col(name)) for name, value in replacements.items()}
    )
