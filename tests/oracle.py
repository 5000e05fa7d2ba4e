"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


# Spark type -> DuckDB type name that must come out of the oracle SQL
SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR",
                 "DateType": "DATE", "BooleanType": "BOOLEAN", "DoubleType": "DOUBLE",
                 "TimestampType": "TIMESTAMP WITH TIME ZONE", "TimestampNTZType": "TIMESTAMP"}


def type_mismatches(sdf, con, sql):
    rel = con.sql(sql)
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
        got = duck_types.get(f.name)
        if got != want:
            out.append((f.name, type(f.dataType).__name__, got))
    return out


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str, con=None):
    from trendlake.plans.catalog import REGISTRY
    q = REGISTRY[name]
    t0 = time.time()
    sdf = q.run(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    if q.sql is None:
        out["ok"] = None
        return out
    con = con or duck(sf_dir)
    cur = con.execute(q.sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    out["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, why=f"columns {sorted(s_cols)} != {sorted(d_cols)}")
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3] if len(a) < 200000 else []
        out.update(ok=False, why=f"values differ; spark-only sample {diff}")
        return out
    bad_types = type_mismatches(sdf, con, q.sql)
    if bad_types:
        out.update(ok=False, why=f"types differ {bad_types}")
        return out
    out["ok"] = True
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from trendlake.session import local_session
    from trendlake.plans.catalog import REGISTRY
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = local_session()
    import os
    if os.environ.get("ORACLE_TZ"):   # check independence from the session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf, n, con)
        except Exception as e:  # report and go on
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
