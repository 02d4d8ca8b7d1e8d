"""Run registered plans with Spark and their SQL with DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH with details.  Mirrors the driver's
check: same column names, same row count, same multiset of values.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, _dt.datetime) else v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


# Spark type name -> DuckDB type name, for the schema check.
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
                 "smallint": "SMALLINT", "date": "DATE"}


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return f"{key}: ROWS-ONLY rows={len(srows)} spark={t1 - t0:.1f}s"
    rel = con.sql(sql)
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"{key}: MISMATCH columns spark={scols} duck={dcols}"
    stypes = dict(sdf.dtypes)
    bad_types = {c: (stypes[c], dtypes.get(c)) for c in scols
                 if SPARK_TO_DUCK.get(stypes[c], stypes[c]) != dtypes.get(c)}
    if bad_types:
        return f"{key}: MISMATCH types {bad_types}"
    if len(srows) != len(drows):
        return f"{key}: MISMATCH rows spark={len(srows)} duck={len(drows)}"
    a = rows_of(scols, srows)
    b = rows_of(dcols, drows)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return f"{key}: MISMATCH values {diffs}"
    return f"{key}: OK rows={len(srows)} spark={t1 - t0:.1f}s"


def main(argv):
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from loadbay.plans.common import TABLES
    from loadbay.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    if os.environ.get("ORACLE_PLAIN_SESSION"):
        # A session as a caller would build it: no settings of ours, and a
        # session time zone far from UTC.
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", "America/Los_Angeles")
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs = queries()
    sqls = oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            line = compare(spark, con, key, qs[key], sqls.get(key), sf_dir)
        except Exception as ex:  # noqa: BLE001
            line = f"{key}: ERROR {type(ex).__name__}: {str(ex)[:300]}"
        if "MISMATCH" in line or "ERROR" in line:
            bad += 1
        print(line, flush=True)
    print(f"done, {bad} bad of {len(keys or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
