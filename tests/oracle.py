"""Side-by-side comparison of a registered query with its SQL twin in DuckDB.

    python tests/oracle.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def normal(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, dt.date):
        return value
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    number = float(value)
    return int(number) if number == int(number) else number


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(data, key=repr)


def differences(spark, connection, folder, query, sql) -> tuple[str | None, int]:
    """(what differs or None, number of rows)."""
    df = query(spark, folder)
    columns, rows = table_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    expected_columns, expected = table_of([c[0] for c in result.description], result.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}", len(rows)
    if len(rows) != len(expected):
        return f"{len(rows)} rows, expected {len(expected)}; {rows[:2]} / {expected[:2]}", len(rows)
    bad = [(a, b) for a, b in zip(rows, expected) if repr(a) != repr(b)]
    return (f"{len(bad)} rows differ, e.g. {bad[:2]}" if bad else None), len(rows)


def main() -> None:
    from conftest import new_session

    from cyclograph.workload import QUERIES, SQL

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, connection, failed = new_session(), connect(folder), 0
    for name, query in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        started = time.perf_counter()
        try:
            if name in SQL:
                problem, n = differences(spark, connection, folder, query, SQL[name])
            else:
                problem, n = None, query(spark, folder).count()
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n} {time.perf_counter() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
