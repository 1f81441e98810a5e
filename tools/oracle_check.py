"""Run registered queries in Spark and their SQL oracle in DuckDB, compare.

    python tools/oracle_check.py [sf_dir] [name ...]

Compares column names, row counts and the sorted rows (exact values).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from airlens.plans import catalog, stored  # noqa: E402
from airlens.plans.oracle import ORACLE  # noqa: E402
from airlens.sources.tables import TABLES  # noqa: E402

QUERIES = catalog.QUERIES | stored.QUERIES


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def register_views(con, sf):
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")


SPARK_TYPES = {"int": "int32", "bigint": "int64", "smallint": "int16", "tinyint": "int8",
               "double": "float64", "float": "float32", "string": "string", "date": "date",
               "timestamp_ntz": "timestamp", "timestamp": "timestamp", "boolean": "bool"}
DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "SMALLINT": "int16", "TINYINT": "int8",
              "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "string", "DATE": "date",
              "TIMESTAMP": "timestamp", "BOOLEAN": "bool"}


def type_names(spark_df, rel):
    """Column -> (spark type, duckdb type), both in a common vocabulary."""
    s = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_df.schema.fields}
    d = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    return {c: (s.get(c), d.get(c)) for c in sorted(set(s) | set(d))}


def compare(spark, con, name, sf):
    """(ok, message) for one query: same sorted column names and same sorted rows."""
    df = QUERIES[name](spark, sf)
    scols = df.columns
    srows = [tuple(norm(v) for v in r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    dcols = rel.columns
    drows = [tuple(norm(v) for v in r) for r in rel.fetchall()]
    order_s = sorted(range(len(scols)), key=lambda i: scols[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    sc = [scols[i] for i in order_s]
    dc = [dcols[i] for i in order_d]
    if sc != dc:
        return False, f"columns differ: {sc} vs {dc}"
    types = type_names(df, rel)
    bad_types = {c: t for c, t in types.items() if t[0] != t[1]}
    if bad_types:
        return False, f"types differ: {bad_types}"
    s2 = sorted((tuple(r[i] for i in order_s) for r in srows), key=key)
    d2 = sorted((tuple(r[i] for i in order_d) for r in drows), key=key)
    if len(s2) != len(d2):
        return False, f"row counts differ: {len(s2)} vs {len(d2)}"
    for a, b in zip(s2, d2):
        if a != b:
            return False, f"first differing row: {a} vs {b}"
    return True, f"{len(s2)} rows"


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", os.environ.get("CHECK_PARTITIONS", "8"))
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.ansi.enabled", os.environ.get("CHECK_ANSI", "true"))
             .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    register_views(con, sf)
    bad = 0
    for name in names:
        t0 = time.time()
        if name not in ORACLE:
            try:
                n = QUERIES[name](spark, sf).count()
                print(f"{name:32s} rows={n:6d} (no oracle) spark={time.time() - t0:.1f}s")
            except Exception as exc:
                print(f"{name:32s} SPARK ERROR {str(exc)[:400]}")
                bad += 1
            continue
        try:
            ok, msg = compare(spark, con, name, sf)
        except Exception as exc:
            ok, msg = False, f"ERROR {str(exc)[:400]}"
        print(f"{name:32s} {'OK ' if ok else 'MISMATCH'} {msg} ({time.time() - t0:.1f}s)")
        bad += 0 if ok else 1
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()


if __name__ == "__main__":
    main()
