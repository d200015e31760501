"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.  Rows are
compared as multisets after sorting columns by name; floats are compared
after rounding to 6 significant decimals of their magnitude.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["why"] = f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))} " \
                     f"oracle-only {sorted(set(d_cols) - set(s_cols))}"
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted((tuple(norm(r[i]) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(norm(r[i]) for i in di) for r in d_rows), key=_key)
    out["ok"] = a == b
    if not out["ok"]:
        sa, sb = set(a), set(b)
        out["why"] = {"spark_only": [dict(zip(order, r)) for r in list(sa - sb)[:2]],
                      "oracle_only": [dict(zip(order, r)) for r in list(sb - sa)[:2]]}
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as e
    from terrace.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            print({"name": name, "ok": None, "why": "no oracle"}, flush=True)
            continue
        try:
            res = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            res = {"name": name, "ok": False, "why": f"{type(exc).__name__}: {str(exc)[:800]}"}
        bad += not res.get("ok")
        print(res, flush=True)
    print({"failed": bad})
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
