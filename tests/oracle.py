"""Side-by-side run of the registered queries in Spark and DuckDB.

`python tests/oracle.py [sf_dir] [name ...]` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, Decimal)):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in at) for r in rows]
    return [columns[i] for i in at], sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(df, con, text: str) -> str:
    """'' when equal, else what differs first."""
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(text)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} / {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} / {b}"
    return ""


def main(argv: list[str]) -> int:
    from roadtally.session import build_session

    import __spark_entry__ as entry

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, texts = entry.queries(), entry.oracle_sql()
    con, bad = connect(sf), 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            diff = compare(df, con, texts[name]) if name in texts else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            diff = f"ERROR {str(e)[:600]}"
        ok = not diff or diff.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.2f}s {diff}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
