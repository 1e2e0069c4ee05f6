"""Type-2 history: invariants, null-safe change detection, no-op re-apply, stored versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revlens.operators.scd2 import scd2_apply, scd2_as_of, scd2_history, scd2_snapshot
from revlens.plans.queries import _history
from tests.conftest import SF_SMALL

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
SCHEMA = "id string, name string, brand string, untracked int"


def load(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_change_detection_is_null_safe(spark):
    v1 = load(spark, [("a", "x", "b1", 1), ("b", "y", None, 1), ("c", "z", "b3", 1), ("d", "w", "b4", 1)])
    v2 = load(spark, [("a", "x2", "b1", 1),   # changed tracked column
                      ("b", "y", None, 2),     # null → null: no change; untracked change ignored
                      ("c", "z", None, 1),     # value → null: change
                      ("e", "n", "b5", 1)])    # new key; d missing: stays open
    h1 = scd2_apply(None, v1, "id", ["name", "brand"], T1)
    h2 = scd2_apply(h1, v2, "id", ["name", "brand"], T2)
    rows = {(r.id, r.valid_from, r.valid_to) for r in h2.collect()}
    assert rows == {
        ("a", T1, T2), ("a", T2, None),
        ("b", T1, None),
        ("c", T1, T2), ("c", T2, None),
        ("d", T1, None),
        ("e", T2, None),
    }


def test_close_missing_option(spark):
    v1 = load(spark, [("a", "x", "b", 1), ("d", "w", "b", 1)])
    v2 = load(spark, [("a", "x", "b", 1)])
    h = scd2_apply(scd2_apply(None, v1, "id", ["name"], T1), v2, "id", ["name"], T2, close_missing=True)
    assert {(r.id, r.valid_to) for r in h.collect()} == {("a", None), ("d", T2)}


def test_duplicate_keys_in_load_are_rejected(spark):
    v = load(spark, [("a", "x", "b", 1), ("a", "y", "b", 1)])
    with pytest.raises(ValueError):
        scd2_apply(None, v, "id", ["name"], T1)


def test_fixture_history_invariants(spark):
    h = _history(spark, SF_SMALL).cache()
    # one open version per key
    assert h.where(F.col("valid_to").isNull()).groupBy("product_id").count().where("count > 1").count() == 0
    # intervals of a key do not overlap and valid_from < valid_to
    assert h.where(F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from"))).count() == 0
    per_key = h.groupBy("product_id").agg(F.count("*").alias("n"), F.countDistinct("valid_from").alias("d"))
    assert per_key.where("n != d").count() == 0
    # a re-apply of the same load is a no-op
    from revlens.plans.queries import Inputs, build_stg_products
    from revlens.plans.warehouse import PRODUCT_CHECK_COLS
    i = Inputs(spark, SF_SMALL)
    v2 = build_stg_products(i.products_v2(), i.mapping(), i.rules())
    again = scd2_apply(h, v2, "product_id", PRODUCT_CHECK_COLS, T3)
    assert again.exceptAll(h).count() == 0 and h.exceptAll(again).count() == 0
    # as-of reads: one version per key at any instant
    snap = scd2_as_of(h, dt.datetime(2024, 2, 15))
    assert snap.count() == snap.select("product_id").distinct().count()
    h.unpersist()


def test_snapshot_versions_on_disk(spark, tmpdir_path):
    root = f"{tmpdir_path}/snap"
    v1 = load(spark, [("a", "x", "b", 1), ("b", "y", "c", 1)])
    v2 = load(spark, [("a", "x2", "b", 1), ("b", "y", "c", 1)])
    first = scd2_snapshot(spark, v1, root, "id", ["name"], T1)
    assert first.count() == 2
    second = scd2_snapshot(spark, v2, root, "id", ["name"], T2)
    assert second.count() == 3
    same = scd2_snapshot(spark, v2, root, "id", ["name"], T3)  # re-applied load: no new versions
    assert sorted(map(tuple, same.collect()), key=str) == sorted(map(tuple, second.collect()), key=str)
    # append-only layout: each run stores only what it closed + the open set
    parts = spark.read.parquet(root).groupBy("run", "kind").count().orderBy("run", "kind").collect()
    assert [(r.run, r.kind, r["count"]) for r in parts] == [
        (0, "open", 2), (1, "closed", 1), (1, "open", 2), (2, "open", 2)]
    assert scd2_history(spark, root).count() == 3


def test_snapshot_reads_only_the_previous_open_set(spark, tmpdir_path):
    from revlens.operators.scd2 import _latest_run

    root = f"{tmpdir_path}/snap"
    scd2_snapshot(spark, load(spark, [("a", "x", "b", 1)]), root, "id", ["name"], T1)
    scd2_snapshot(spark, load(spark, [("a", "y", "b", 1)]), root, "id", ["name"], T2)
    stored, latest = _latest_run(spark, root)
    assert latest == 1
    open_h = stored.where((F.col("run") == latest) & (F.col("kind") == "open"))
    plan = open_h._jdf.queryExecution().executedPlan().toString()
    filters = [l.split("PartitionFilters: ")[1] for l in plan.split("\n") if "PartitionFilters: [" in l][0]
    assert "run" in filters and "kind" in filters  # pruned to one directory


def test_warehouse_snapshot_products(spark):
    from revlens.plans.queries import warehouse

    wh = warehouse(spark, SF_SMALL)
    h = wh.snapshot_products(None, T1)
    assert h.count() == wh.stg_products.count()
    assert wh.snapshot_products(h, T2).exceptAll(h).count() == 0  # same load: no-op


def test_null_keys_out_of_order_and_changed_columns(spark):
    v1 = load(spark, [("k1", "x", "b", 1), (None, "n", "b", 1)])
    h = scd2_apply(None, v1, "id", ["name"], T1)
    assert scd2_apply(h, v1, "id", ["name"], T2).count() == 2  # the null key's version is kept, and found again
    with pytest.raises(ValueError):
        scd2_apply(h, v1, "id", ["name"], dt.datetime(2023, 1, 1))
    with pytest.raises(ValueError):
        scd2_apply(h, v1.withColumn("w", F.lit(1)), "id", ["name"], T2)


def test_failed_read_or_run_loses_no_load(spark, tmpdir_path, monkeypatch):
    import revlens.operators.scd2 as S

    root = f"{tmpdir_path}/snap"
    scd2_snapshot(spark, load(spark, [("a", "x", "b", 1)]), root, "id", ["name"], T1)
    scd2_snapshot(spark, load(spark, [("a", "y", "b", 1)]), root, "id", ["name"], T2)

    def broken(*a):
        raise IOError("503")

    monkeypatch.setattr(S, "_runs", broken)
    with pytest.raises(IOError):
        scd2_snapshot(spark, load(spark, [("a", "z", "b", 1)]), root, "id", ["name"], T3)
    monkeypatch.undo()
    # a run that did not finish does not count, and its number is not used again
    load(spark, [("a", "half", "b", 1)]).write.parquet(f"{root}/run=2/kind=open")
    assert S._runs(spark, root) == ([0, 1], 3)
    h = scd2_snapshot(spark, load(spark, [("a", "z", "b", 1)]), root, "id", ["name"], T3)
    assert sorted(r.name for r in h.collect()) == ["x", "y", "z"]
