"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python tools/check_oracle.py [folder] [name-part ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from casemill.registry import all_queries, all_sql  # noqa: E402
from casemill.registry.base import TABLES  # noqa: E402
from casemill.session import local_session  # noqa: E402


def cell(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return float(f"{value:.10g}")
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def connect(folder):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return db


def check(spark, db, name, folder):
    """A problem, or None when both engines agree (or there is no SQL)."""
    df = all_queries()[name](spark, folder)
    got = df.collect()
    sql = all_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cur = db.execute(sql)
    want_names = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    ours, theirs = as_rows(df.columns, got), as_rows(want_names, cur.fetchall())
    if not theirs:
        return "the SQL gives no rows"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, SQL has {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(df.columns)}: {str(a)[:600]} != {str(b)[:600]}"
    return None


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark, db = local_session(8), connect(folder)
    bad = 0
    for name in all_queries():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            problem = check(spark, db, name, folder)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok '} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} bad")
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
