"""Compare registered queries with their SQL. Usage: python -m tests.oracle_check [sf_dir] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def normal(rows, columns):
    """Rows as an order-free multiset over columns sorted by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(x):
        return f"{x:.9g}" if isinstance(x, float) else x

    return sorted(([cell(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, connection, name: str, query, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = query(spark, sf_dir)
    rows = df.collect()  # bounded by the fixture
    spent = time.time() - started
    if sql is None:
        return True, f"{len(rows)} rows, no SQL, {spent:.2f}s"
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(columns) ^ set(df.columns))}"
    mine, theirs = normal(rows, df.columns), normal(expected, columns)
    if mine != theirs:
        diff = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
        return False, f"rows {len(mine)} vs {len(theirs)}; first differences ({sorted(columns)}): {diff}"
    return True, f"{len(rows)} rows, {spent:.2f}s"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from sedimenta.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    session, con, bad = local_session(), duck(sf), 0
    for query_name in wanted:
        try:
            ok, detail = compare(session, con, query_name, queries()[query_name], oracle_sql().get(query_name), sf)
        except Exception as error:  # report and go on with the next query
            ok, detail = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", query_name, detail, flush=True)
    print(f"{len(wanted) - bad}/{len(wanted)} equal")
