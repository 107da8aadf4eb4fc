"""Spark-vs-DuckDB comparison used by the tests and by ``python -m tests.compare``.

Mirrors the driver's gate: same row count, same column names, same multiset of rows
(floats compared to 9 significant digits).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from ledgerline.sources.tables import RAW_TABLES  # noqa: E402


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(rows, order):
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = spark_df.collect()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    names = sorted(s_cols)
    s = _rows(s_rows, [s_cols.index(n) for n in names])
    d = _rows(d_rows, [d_cols.index(n) for n in names])
    if len(s) != len(d):
        return False, f"row count spark={len(s)} duckdb={len(d)}"
    if s != d:
        diff = [(a, b) for a, b in zip(s, d) if a != b][:3]
        return False, f"values differ ({len(s)} rows), first: {diff}"
    return True, f"{len(s)} rows"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from ledgerline.session import build_session

    data_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(entry.queries())
    spark = build_session()
    con = duck(data_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name in names:
        t = time.time()
        df = entry.queries()[name](spark, data_dir)
        if name not in oracle:
            n = df.count()
            print(f"{name:32s} NO-ORACLE {n} rows {time.time() - t:.1f}s")
            continue
        ok, msg = compare(df, con, oracle[name])
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {msg} {time.time() - t:.1f}s")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
