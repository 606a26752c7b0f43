"""Run registered Spark queries next to their DuckDB reference SQL and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, schema and value equality.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("ORACLE_EXACT") else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_v = ok_cols and ok_n and _rows(scols, srows) == _rows(dcols, drows)
    stypes = dict(sdf.dtypes)
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    status = "OK" if ok_v else "FAIL"
    print(f"{status:4} {name:22} rows spark={len(srows)} duck={len(drows)} cols={ok_cols} "
          f"spark={t1 - t0:.2f}s duck={t2 - t1:.2f}s", flush=True)
    if not ok_cols:
        print("   spark cols", sorted(scols), "\n   duck  cols", sorted(dcols))
    print("   types", {c: (stypes.get(c), dtypes.get(c)) for c in sorted(set(scols) | set(dcols))})
    if ok_cols and not ok_v:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        sa, sb = set(a), set(b)
        print("   only spark:", list(sa - sb)[:3])
        print("   only duck :", list(sb - sa)[:3])
    return ok_v


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from parlance.session import get_session
    import __spark_entry__ as E
    if os.environ.get("VANILLA"):
        from pyspark.sql import SparkSession   # driver-like: no settings of ours
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for n in names or list(qs):
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"ROWS {n:22} rows={df.count()} (no oracle)")
            continue
        try:
            if not compare(spark, con, n, qs[n], sqls[n], sf_dir):
                bad.append(n)
        except Exception as e:  # report and continue
            print(f"ERR  {n}: {type(e).__name__}: {str(e)[:800]}")
            bad.append(n)
    print("FAILED:", bad)


if __name__ == "__main__":
    main(sys.argv)
