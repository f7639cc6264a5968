"""Run queries against their SQL on DuckDB: python -m suite.check [sf] [name ...]."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from suite import load_all
from suite.registry import QUERIES, SQL
from tallyworks.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(spark, con, name: str, folder: str) -> str:
    """Empty when equal, else what differs."""
    start = time.time()
    df = QUERIES[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in SQL:
        return f"rows only: {len(got)} ({took:.1f}s)" if got else "no rows"
    start = time.time()
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    duck = time.time() - start
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _sorted(got, df.columns), _sorted(want, names)
    if len(a) != len(b):
        extra = list(set(a) - set(b))[:2]
        lack = list(set(b) - set(a))[:2]
        return f"rows {len(a)} != {len(b)}\n   only spark {extra}\n   only sql   {lack}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        cols = sorted(df.columns)
        x, y = bad[0]
        diff = {c: (p, q) for c, p, q in zip(cols, x, y) if p != q or type(p) is not type(q)}
        return f"{len(bad)} of {len(a)} rows differ, first {diff}\n   row {dict(zip(cols, x))}"
    types = {c: t for c, t in df.dtypes}
    return f"ok {len(a)} rows, spark {took:.1f}s duckdb {duck:.1f}s {'EMPTY' if not a else ''}" + (
        f" types {types}" if any(t.startswith(("array", "map", "struct", "decimal")) for t in types.values()) else "")


def main(argv: list[str]) -> int:
    load_all()
    sf = argv[0] if argv else "0.01"
    folder = f"/root/testdata/sf{sf}"
    names = argv[1:] or list(QUERIES)
    spark, con = local_session(8), connect(folder)
    failed = 0
    for n in names:
        try:
            said = compare(spark, con, n, folder)
        except Exception as e:  # noqa: BLE001 - every query is reported
            said = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        good = said.startswith(("ok", "rows only"))
        failed += not good
        print(("   " if good else "!! ") + f"{n}: {said}", flush=True)
        spark.catalog.clearCache()
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
