"""Command line: build the warehouse, run its tests, snapshot products.

    python -m revlens build    --reviews R --products P --mapping M.csv --rules R.csv --out DIR [--threads 4]
    python -m revlens test     --reviews R --products P --mapping M.csv --rules R.csv [--out DIR]
    python -m revlens snapshot --products P --mapping M.csv --rules R.csv --history DIR [--as-of TS]
                                  (history stored append-only: DIR/run=N/kind=closed|open)

Inputs are parquet or JSON-lines paths (files, directories or globs;
``--format json``) and seed CSVs. The session comes from ``spark-submit``/the environment; only a local session
without ``spark.checkpoint.dir`` gets a scratch checkpoint folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _inputs(spark, a):
    from revlens.sources.io import read_products, read_reviews, read_seed
    from revlens.sources.seeds import MAPPING_SCHEMA, RULES_SCHEMA

    reviews = read_reviews(spark, a.reviews, fmt=a.format) if getattr(a, "reviews", None) else None
    products = read_products(spark, a.products, fmt=a.format)
    mapping = read_seed(spark, a.mapping, MAPPING_SCHEMA)
    rules = read_seed(spark, a.rules, RULES_SCHEMA)
    return reviews, products, mapping, rules


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="revlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("build", "test", "snapshot"):
        s = sub.add_parser(name)
        if name != "snapshot":
            s.add_argument("--reviews", required=True)
        s.add_argument("--products", required=True)
        s.add_argument("--mapping", required=True)
        s.add_argument("--rules", required=True)
        s.add_argument("--format", default="parquet", choices=["parquet", "json"],
                       help="raw review/product files: parquet or JSON lines")
        if name == "build":
            s.add_argument("--out", required=True)
            s.add_argument("--threads", type=int, default=4)
            s.add_argument("--with-tests", action="store_true")
        if name == "test":
            s.add_argument("--out", help="tables written by a previous build (default: compute lazily)")
        if name == "snapshot":
            s.add_argument("--history", required=True)
            s.add_argument("--as-of", default=None, help="timestamp of this load (default: now, UTC)")
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from revlens.session import BASE_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.appName(f"revlens-{a.cmd}")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    reviews, products, mapping, rules = _inputs(spark, a)

    if a.cmd == "snapshot":
        from revlens.operators.scd2 import scd2_snapshot
        from revlens.operators.staging import stg_products
        from revlens.plans.warehouse import PRODUCT_CHECK_COLS

        as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        hist = scd2_snapshot(spark, stg_products(products, mapping, rules), a.history, "product_id", PRODUCT_CHECK_COLS, as_of)
        print(json.dumps(hist.selectExpr("count(*) history_rows", "count_if(valid_to is null) open_rows").first().asDict()))
        return 0

    from revlens.plans.checks import run_suite
    from revlens.plans.warehouse import Warehouse

    if a.cmd == "build":
        wh = Warehouse(reviews, products, mapping, rules, materialize="table", output_root=a.out)
        print(json.dumps(wh.build(threads=a.threads)))
        if a.with_tests:
            failing = [r for r in run_suite(wh).collect() if r.failures]
            for r in failing:
                print(f"FAIL {r.model}.{r.column} {r.check}: {r.failures}", file=sys.stderr)
            return 1 if failing else 0
        return 0

    # test
    if a.out:
        wh = Warehouse(reviews, products, mapping, rules, materialize="table", output_root=a.out).load()
    else:
        wh = Warehouse(reviews, products, mapping, rules, materialize="ephemeral")
    rows = run_suite(wh).collect()
    bad = [r for r in rows if r.failures]
    for r in rows:
        print(f"{'FAIL' if r.failures else 'PASS'} {r.model}.{r.column} {r.check} {r.failures}")
    print(f"{len(rows) - len(bad)} passed, {len(bad)} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
