"""Side-by-side check of registered Spark queries against their DuckDB SQL.

Mirrors the driver's gate: same column names, same row count, and the same
multiset of rows (columns sorted by name).  Usage:
    python -m tests.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, digits)) if digits is not None else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x, digits) for x in v) + "]"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return _norm(tuple(v), digits)
    return repr(v)


def canon(cols, rows, digits=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted("|".join(_norm(r[i], digits) for i in order) for r in rows)
    return [cols[i] for i in order], out


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck_connect(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols = list(rel.columns)
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    res["duck_sec"] = round(time.time() - t1, 2)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS {sorted(scols)} != {sorted(dcols)}"
        return res
    if len(srows) != len(drows):
        res["status"] = "ROWCOUNT"
        return res
    _, a = canon(scols, srows)
    _, b = canon(dcols, drows)
    if a == b:
        res["status"] = "exact"
        return res
    _, a6 = canon(scols, srows, 6)
    _, b6 = canon(dcols, drows, 6)
    if a6 == b6:
        res["status"] = "approx6"
        return res
    diff = [x for x in a if x not in set(b)][:2]
    diffb = [x for x in b if x not in set(a)][:2]
    res["status"] = "VALUES"
    res["example"] = (diff, diffb)
    return res


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from trendlens.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    q, o = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    bad = 0
    for n in (names or list(q)):
        try:
            r = compare(spark, n, q[n], o.get(n), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("exact", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names or q) - bad} ok, {bad} not exact")


if __name__ == "__main__":
    main(sys.argv[1:])
