"""Run registered queries and their SQL side by side and report differences.

    python -m verification.compare <folder of tables> [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{folder}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _sorted(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark, con, name: str, folder: str) -> str | None:
    """None when both sides agree on columns, types of values and rows."""
    from verification.cases import QUERIES
    from verification.oracle import SQL

    df = QUERIES[name](spark, folder)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    expected = _sorted(names, cursor.fetchall())
    actual = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e or [type(v) for v in a] != [type(v) for v in e]:
            return f"{sorted(names)}\n    {a}\n != {e}"
    return None


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    from verification.cases import QUERIES
    from verification.oracle import SQL

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        if name not in SQL:
            rows = QUERIES[name](spark, folder).count()
            print(f"rows {name}: {rows} ({time.time() - start:.1f}s)", flush=True)
            continue
        try:
            found = difference(spark, con, name, folder)
        except Exception as error:  # report every query, then fail
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} ({time.time() - start:.1f}s)"
              + (f"\n  {found}" if found else ""), flush=True)
    print(f"{bad} differences")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
