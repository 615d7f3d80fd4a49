"""Run registered queries against their SQL checks on the given tables."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
import traceback

import duckdb

import __spark_entry__ as contract
from telemetra.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None when rows, columns and values agree, otherwise what differs."""
    frame = contract.queries()[name](spark, folder)
    got_rows = frame.collect()
    check = contract.oracle_sql().get(name)
    if check is None:
        return None if got_rows or not frame.columns else "no rows"
    answer = connection.execute(check)
    names = [c[0] for c in answer.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = rows_of(names, answer.fetchall())
    got = rows_of(frame.columns, got_rows)
    if want == got:
        return None
    extra = list(set(got) - set(want))[:3]
    missing = list(set(want) - set(got))[:3]
    return f"{len(got)} rows against {len(want)}; only here {extra}; only there {missing}"


def main() -> None:
    folder = sys.argv[1]
    chosen = sys.argv[2:] or list(contract.queries())
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(folder)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            wrong = difference(spark, connection, folder, name)
        except Exception:
            wrong = traceback.format_exc(limit=6)[-1800:]
        bad += wrong is not None
        kind = "checked" if name in contract.oracle_sql() else "rows only"
        print(f"{'ok ' if wrong is None else 'BAD'} {name} {kind} {time.time() - start:.1f}s", wrong or "", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")


if __name__ == "__main__":
    main()
