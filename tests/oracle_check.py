"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's check: row count, column names, and an
order-insensitive comparison of values.  Used by ``test_oracle.py`` and
runnable by hand: ``python -m tests.oracle_check [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, float(v) + 0.0)
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x) for x in v))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, int):
        return (1, float(v))
    return (3, str(v))


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None, rel_tol: float = 1e-9):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(s_rows), "oracle": None, "spark_s": t1 - t0}
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    out = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_s": round(t1 - t0, 2)}
    out["cols_ok"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_ok"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    dorder = [d_cols.index(s_cols[i]) for i in order]
    a = sorted(tuple(_norm(r[i]) for i in order) for r in s_rows)
    b = sorted(tuple(_norm(r[i]) for i in dorder) for r in d_rows)
    exact = a == b
    close = exact
    first_bad = None
    if not exact and len(a) == len(b):
        close = True
        for ra, rb in zip(a, b):
            for x, y in zip(ra, rb):
                if x[0] == 1 and y[0] == 1:
                    if not math.isclose(x[1], y[1], rel_tol=rel_tol, abs_tol=1e-9):
                        close = False
                elif x != y:
                    close = False
                if not close:
                    break
            if not close:
                first_bad = (ra, rb)
                break
    out["exact"] = exact
    out["close"] = close
    if first_bad:
        out["first_bad"] = [dict(zip(sorted(s_cols), first_bad[0])), dict(zip(sorted(s_cols), first_bad[1]))]
    return out


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from lapengine.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = build_session()
    con = duck(sf_dir)
    qs, sq = queries(), oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n, qs[n], sq.get(n))
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "error": repr(e)[:600]}
        ok = r.get("oracle") is None and "error" not in r and "oracle_rows" not in r or r.get("exact") or r.get("close")
        bad += 0 if ok else 1
        print(r, flush=True)
    print("BAD", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
