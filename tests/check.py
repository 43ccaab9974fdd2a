"""Compare registered queries with their SQL: `python tests/check.py [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
          " conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v + 0.0))
    if isinstance(v, bool) or not isinstance(v, int):
        return (1, str(v))
    return (1, repr(v))


def normal(columns, rows):
    """Columns by name, rows in order."""
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted(tuple(_key(r[i]) for i in at) for r in rows)


def compare(df, con, sql) -> str | None:
    """Difference of a query and its SQL, or None."""
    got_columns, got = normal(df.columns, df.collect())
    cur = con.execute(sql)
    want_columns, want = normal([d[0] for d in cur.description], cur.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} <> {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} <> {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            bad = [(c, x[1], y[1]) for c, x, y in zip(got_columns, a, b) if x != y]
            return f"values {bad[:4]}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from tradeloom.session import build

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    spark = build(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in argv[1:] or e.queries():
        start = time.time()
        try:
            df = e.queries()[name](spark, sf_dir)
            sql = e.oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else (None if df.count() else "no rows")
        except Exception as x:  # report and go on
            problem = f"{type(x).__name__}: {str(x)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
