"""Runs catalog queries on Spark and their SQL on DuckDB and compares all rows.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.date()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if bad:
        return f"{len(bad)} of {len(left[1])} rows differ, first {bad[0][0]} / {bad[0][1]}"
    return None


def main() -> None:
    from loanframe.plans import catalog, oracle
    from loanframe.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    con, sqls = connect(folder), oracle.oracle_sql()
    bad = 0
    for name, run in catalog.queries().items():
        if (wanted and name not in wanted) or (not wanted and name not in sqls):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print("not equal:", bad)


if __name__ == "__main__":
    main()
