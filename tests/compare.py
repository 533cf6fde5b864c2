"""Run registered queries next to their SQL checks: python tests/compare.py [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def cell(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0 if value != int(value) else int(value))
    return str(value)


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(spark_rows, sql_rows) -> str | None:
    (names, left), (sql_names, right) = spark_rows, sql_rows
    if names != sql_names:
        return f"columns differ: {set(names) ^ set(sql_names)}"
    if len(left) != len(right):
        return f"{len(left)} rows, SQL has {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if not wrong:
        return None
    a, b = wrong[0]
    cells = [(n, x[:60], y[:60]) for n, x, y in zip(names, a, b) if x != y]
    return f"{len(wrong)} of {len(left)} rows differ, first: {a[:3]!s:.120} {cells[:4]}"


def check(spark, connection, folder: str, name: str, query, sql: str) -> str | None:
    result = query(spark, folder)
    ours = normal(result.columns, result.collect())
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return difference(ours, normal(names, cursor.fetchall()))


if __name__ == "__main__":
    import __spark_entry__ as contract

    from quillsift.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    session, con = local_session(), database(folder)
    all_queries, all_sql = contract.queries(), contract.oracle_sql()
    print("SQL without query:", sorted(set(all_sql) - set(all_queries)), flush=True)
    for key in sys.argv[2:] or all_queries:
        start = time.time()
        try:
            if key in all_sql:
                found = check(session, con, folder, key, all_queries[key], all_sql[key]) or "ok"
            else:
                found = f"rows only: {all_queries[key](session, folder).count()}"
        except Exception as error:
            found = f"ERROR {str(error)[:600]}"
        print(f"{key:28s} {time.time() - start:6.1f}s  {found}", flush=True)
