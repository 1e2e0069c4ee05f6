"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Columns are compared by name (sorted), rows as an order-insensitive
multiset of exact values — the same strictness as the round's correctness gate.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def duck_conn(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"create view {t} as select * from read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT",
    "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def type_mismatches(spark_types: dict, duck_types: dict) -> list[str]:
    """Columns whose Spark type does not map to the DuckDB result type."""
    out = []
    for c, t in spark_types.items():
        want = SPARK_TO_DUCK.get(t, t.upper())
        got = duck_types.get(c)
        if got is not None and got != want and not (t.startswith("array") and got.endswith("[]")):
            out.append(f"{c}: spark {t} vs duck {got}")
    return out


def compare(spark_cols, spark_rows, duck_cols, duck_rows):
    msgs = []
    if sorted(spark_cols) != sorted(duck_cols):
        msgs.append(f"columns differ: spark-only {sorted(set(spark_cols) - set(duck_cols))} duck-only {sorted(set(duck_cols) - set(spark_cols))}")
        return msgs
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    s = collections.Counter(tuple(norm(r[i]) for i in si) for r in spark_rows)
    d = collections.Counter(tuple(norm(r[i]) for i in di) for r in duck_rows)
    if len(spark_rows) != len(duck_rows):
        msgs.append(f"row count spark={len(spark_rows)} duck={len(duck_rows)}")
    if s != d:
        only_s = list((s - d).elements())[:3]
        only_d = list((d - s).elements())[:3]
        # locate differing columns
        bad_cols = set()
        for a, b in zip(sorted(only_s, key=str), sorted(only_d, key=str)):
            for c, x, y in zip(order, a, b):
                if x != y:
                    bad_cols.add(c)
        msgs.append(f"values differ ({sum((s - d).values())} rows); cols {sorted(bad_cols)}")
        msgs.append(f"  spark-only e.g. {only_s[:2]}")
        msgs.append(f"  duck-only  e.g. {only_d[:2]}")
    return msgs


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from revlens.session import get_session

    spark = get_session(master="local[8]", shuffle_partitions=8, extra_conf={"spark.driver.memory": "8g"})
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck_conn(sf_dir)
    ok = bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = df.collect()
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(oracle[name])
            dcols, drows = rel.columns, rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msgs = compare(scols, srows, dcols, drows)
        tm = type_mismatches(dict(df.dtypes), {c: str(t) for c, t in zip(rel.columns, rel.types)})
        if tm:
            msgs.append("types differ: " + "; ".join(tm))
        if msgs:
            bad += 1
            print(f"FAIL {name} ({len(srows)} rows, {ts:.1f}s)")
            for m in msgs:
                print("   ", m)
        else:
            ok += 1
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
    print(f"== {ok} ok, {bad} failed")


if __name__ == "__main__":
    main()
