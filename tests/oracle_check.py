"""Driver-like check: run registered Spark queries and their DuckDB oracles.

Compares row count, column names and an order-insensitive value hash (doubles
rounded to 6 places).  Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = df.columns
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        res = {"rows": len(rows), "spark_s": round(t1 - t0, 2)}
        if name in sqls:
            rel = con.sql(sqls[name])
            ocols = rel.columns
            orows = rel.fetchall()
            res.update(oracle_rows=len(orows),
                       cols_ok=sorted(cols) == sorted(ocols),
                       hash_ok=sorted(cols) == sorted(ocols) and digest(cols, rows) == digest(ocols, orows),
                       duck_s=round(time.time() - t1, 2))
            if not res["cols_ok"]:
                res["cols"] = (sorted(cols), sorted(ocols))
        out[name] = res
        print(name, res, flush=True)
    return out


if __name__ == "__main__":
    from textlens.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    check(spark, sf, sys.argv[2:] or None)
