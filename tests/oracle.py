"""Compare registered queries with their SQL twins in DuckDB.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kind(value) -> str:
    return type(value).__name__


def compare(spark, con, base: str, run, sql: str | None) -> tuple[bool, str]:
    df = run(spark, base)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return False, f"{len(got)} rows, expected {len(want)}; first {got[:1]} / {want[:1]}"
    for a, b in zip(got, want):
        if a != b:
            return False, f"row {a} != {b}"
        if [kind(x) for x in a] != [kind(x) for x in b]:
            return False, f"types of {a}: {[kind(x) for x in a]} != {[kind(x) for x in b]}"
    return True, f"{len(got)} rows"


def main() -> int:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    from wardlake.plans import QUERIES
    from wardlake.session import build_session

    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(base), 0
    for name, q in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, base, q.run, q.sql)
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        empty = " EMPTY" if note.startswith("0 rows") else ""
        print(f"{'ok  ' if ok else 'FAIL'} {time.time() - start:6.2f}s {name}: {note}{empty}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
