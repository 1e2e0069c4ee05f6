"""Benchmark: headline queries and the end-to-end warehouse build.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line:
  {"metric": "warehouse_build_models_and_tests", "value": <sec>, "unit": "sec",
   "queries": {name: sec, ...}, "sf": ..., ...}

* ``queries`` — each headline query built from the raw tables and executed
  through the ``noop`` sink (full execution, nothing collected). Before timing,
  every headline query and one build run once on the smallest tables
  (``BENCH_WARMUP_DIR``, default sf0.001) to load classes and JIT-compile the
  generated code — a JVM warm-up; no data or result carries over.
* ``warehouse_build`` — every model of the warehouse written as a parquet
  table under the checkpoint folder (shared models re-read by their
  consumers) and all 99 column tests run on the written tables — the
  equivalent of a full models + tests build; independent models of a
  dependency level, and the tests of the models already built, run as
  concurrent jobs (4 threads).
``value`` is the warehouse build (models + all column tests) — the
counterpart of the reference's published end-to-end "models + tests" runtime.
``queries_total`` is the sum of the individual query times (each recomputes
its inputs from the raw tables, so shared work is counted once per query).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fct_reviews",
    "daily_rollup",
    "monthly_rollup",
    "product_review_stats",
    "stg_products",
    "dim_products",
    "reviewer_history",
    "reviewer_context",
    "category_performance",
    "products_at_risk",
    "date_dimension",
    "scd2_apply",
    "run_checks",
    "profile_joined_categories",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from revlens.plans.queries import QUERIES, warehouse
    from revlens.session import get_session, scratch_path

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus, extra_conf={"spark.driver.memory": "12g"})
    # warm-up on other (tiny) tables: JVM class loading and JIT, not counted
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            run(QUERIES[name](spark, warm_dir))
        warehouse(spark, warm_dir, materialize="table", run_id=f"warmup-{uuid.uuid4().hex[:8]}",
                  output_root=scratch_path(spark, f"warmup-{uuid.uuid4().hex[:8]}/marts")).build(
            threads=4, tests=True)

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    run_id = f"bench-{uuid.uuid4().hex[:8]}"
    out = scratch_path(spark, f"{run_id}/marts")
    wh = warehouse(spark, sf_dir, materialize="table", run_id=run_id, output_root=out)
    breakdown = wh.build(threads=4, tests=True)
    build = round(time.perf_counter() - t0, 3)
    times["warehouse_build"] = build

    queries_total = round(sum(v for k, v in times.items() if k != "warehouse_build"), 3)
    reviews = wh.table("fct_reviews").count()
    print(json.dumps({
        "metric": "warehouse_build_models_and_tests",
        "value": build,
        "unit": "sec",
        "queries": times,
        "queries_total": queries_total,
        "build_breakdown": breakdown,
        "deduplicated_reviews": reviews,
        "sf": sf,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
