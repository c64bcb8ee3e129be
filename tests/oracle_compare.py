"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python -m tests.oracle_compare [sf_dir] [key ...]
Comparison: same column names, same row count, and equal multisets of rows
after sorting columns by name (floats compared exactly after rounding to 9
decimals, so real differences are reported, not hidden).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


_SPARK = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "float64", "FloatType": "float32",
          "StringType": "string", "BooleanType": "bool", "DateType": "date", "ShortType": "int16",
          "TimestampNTZType": "timestamp", "TimestampType": "timestamp"}
_DUCK = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "string",
         "BOOLEAN": "bool", "DATE": "date", "SMALLINT": "int16", "TIMESTAMP": "timestamp"}


def _spark_type(t) -> str:
    n = type(t).__name__
    return _SPARK.get(n, t.simpleString())


def _duck_type(t) -> str:
    n = str(t)
    return _DUCK.get(n, n)


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    scols = sdf.columns
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    t2 = time.time()
    msg = []
    if sorted(scols) != sorted(dcols):
        msg.append(f"columns differ: spark={sorted(scols)} duck={sorted(dcols)}")
        return False, "; ".join(msg), t1 - t0, t2 - t1
    stypes = {f.name: _spark_type(f.dataType) for f in sdf.schema.fields}
    dtypes_ = {c: _duck_type(t) for c, t in zip(dcols, rel.types)}
    bad_types = {c: (stypes[c], dtypes_[c]) for c in scols if stypes[c] != dtypes_[c]}
    if bad_types:
        msg.append(f"types differ: {bad_types}")
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=_key)
    if len(s) != len(d):
        msg.append(f"rows differ: spark={len(s)} duck={len(d)}")
    if s != d:
        diffs = [(a, b) for a, b in zip(s, d) if a != b][:3]
        msg.append(f"values differ (cols {order}): {diffs}")
    return not msg, "; ".join(msg), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from staylens.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            n = df.count()
            print(f"ROWS-ONLY {k}: {n} rows")
            continue
        try:
            ok, msg, ts, td = compare(spark, con, k, qs[k], sqls[k], sf_dir)
        except Exception as e:  # report and continue
            ok, msg, ts, td = False, f"error: {type(e).__name__}: {str(e)[:600]}", 0, 0
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {k} spark={ts:.1f}s duck={td:.1f}s {msg}", flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
