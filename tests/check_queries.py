"""Run queries against their SQL at one scale: ``python tests/check_queries.py DIR [name…]``."""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows):
    """Rows with columns sorted by name, in an order that does not depend on the engine."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """None if both engines give the same rows, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    want = rows_of(columns, cursor.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} is not {w}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = build_session("local[8]"), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in wanted or queries:
        began = time.time()
        try:
            problem = compare(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s", flush=True)
        if problem:
            print("    ", problem, flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
