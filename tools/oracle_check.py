"""Compare every catalog query with its DuckDB oracle (row count, column
names, order-insensitive values).  Usage:

    python tools/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from starbuild.plans import catalog  # noqa: E402
from starbuild.plans.fixtures import TABLES  # noqa: E402
from starbuild.session import local_session  # noqa: E402


_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _norm(v, exact):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if exact else f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), exact)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i], exact) for i in order) for r in rows)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(catalog.QUERIES)
    spark = local_session()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = catalog.QUERIES[k](spark, sf)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        sql = catalog.ORACLE.get(k)
        if sql is None:
            print(f"{k:28s} rows={len(s_rows):7d} (no oracle) {dt:.2f}s")
            continue
        try:
            rel = con.sql(sql)
            d_cols = rel.columns
            d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        type_diff = [(f.name, f.dataType.simpleString(), d_types.get(f.name))
                     for f in df.schema.fields
                     if _DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                     != d_types.get(f.name)]
        exact = same_cols and _rows(s_cols, s_rows, True) == _rows(d_cols, d_rows, True)
        approx = same_cols and _rows(s_cols, s_rows, False) == _rows(d_cols, d_rows, False)
        status = "OK" if exact else ("APPROX" if approx else "MISMATCH")
        if exact and type_diff:
            status = "TYPES"
        if not exact or type_diff:
            bad += 1
        print(f"{k:28s} {status:8s} rows={len(s_rows):7d}/{len(d_rows):7d} {dt:.2f}s")
        if type_diff:
            print("   types (spark, duckdb):", type_diff)
        if not same_cols:
            print("   spark cols:", s_cols, "\n   duck cols: ", d_cols)
        elif not exact:
            a = _rows(s_cols, s_rows, True)
            b = _rows(d_cols, d_rows, True)
            diff_a = [r for r in a if r not in set(b)][:3]
            diff_b = [r for r in b if r not in set(a)][:3]
            print("   cols:", sorted(s_cols))
            print("   spark-only:", diff_a)
            print("   duck-only: ", diff_b)
    print(f"{bad} problem(s) of {len(keys)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
