"""Bucketed tables: same rows, and no exchange of what is stored."""

import random

import pytest
from pyspark.sql import functions as F

from revlens.plans.bucketed import BucketedWarehouse
from revlens.plans.warehouse import Warehouse
from revlens.session import scratch_path
from revlens.sources import bucketing as B
from revlens.sources.fixtures import Inputs
from tests.conftest import SF_SMALL


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("size, least, want", [(0, 1, 1), (1, 1, 1), (256 << 20, 1, 1), ((256 << 20) + 1, 1, 2), (100 << 40, 1, 1 << 19), (0, 6, 8)])
def test_buckets_follow_from_bytes(size, least, want):
    assert B.bucket_count(size, least=least) == want


@pytest.mark.parametrize("rows_per_split", [50, 10**6])
def test_join_of_stored_tables(spark, no_broadcast, tmpdir_path, rows_per_split):
    """A key with a third of the rows and null keys; equal to the plain join, without an exchange."""
    r = random.Random(1)
    facts = spark.createDataFrame(
        [(i, "hot" if r.random() < 0.33 else None if r.random() < 0.2 else f"k{r.randrange(40)}") for i in range(900)], "i int, key string")
    dim = spark.createDataFrame([(k, k.upper()) for k in ["hot", *[f"k{j}" for j in range(30)]]], "key string, name string")
    plan = B.layout(facts, "key", 4, rows_per_split=rows_per_split)
    stored, by = plan.write(plan.facts(facts), f"{tmpdir_path}/facts"), plan.write(plan.dimension(dim), f"{tmpdir_path}/dim")
    out = B.co_join(stored, by, "key")
    assert rows(out) == rows(facts.join(dim, "key", "left"))
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    parts = stored.where("key = 'hot'").select(B.PART).distinct().count()
    assert (parts > 3) == (rows_per_split == 50)
    again = B.co_join(B.open_bucketed(spark, f"{tmpdir_path}/facts", "key", 4), B.open_bucketed(spark, f"{tmpdir_path}/dim", "key", 4), "key")
    assert rows(again) == rows(out)
    assert "Exchange hashpartitioning" not in again._jdf.queryExecution().executedPlan().toString()


def test_marts_join_what_is_stored(spark, no_broadcast):
    i = Inputs(spark, SF_SMALL)
    wh = BucketedWarehouse(i.reviews(), i.products(), i.mapping(), i.rules(), bucket_bytes=4_000, rows_per_split=100)
    plain = Warehouse(i.reviews(), i.products(), i.mapping(), i.rules())
    assert wh.by_reviewer.buckets > 1 and wh.by_product.buckets > 1
    for name in ("reviews_with_context", "mart_products_at_risk", "dim_products"):
        assert rows(getattr(wh, name)) == rows(getattr(plain, name)), name
    for name in ("reviews_with_context", "mart_products_at_risk"):
        shown = getattr(wh, name)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in shown and "Bucketed: true" in shown, name


def test_empty_tables(spark, tmpdir_path):
    none = spark.createDataFrame([], "key string, v int")
    plan = B.layout(none, "key", 2)
    stored = plan.write(plan.facts(none), f"{tmpdir_path}/a")
    assert B.co_join(stored, plan.write(plan.dimension(none.withColumnRenamed("v", "w")), f"{tmpdir_path}/b"), "key").count() == 0
    assert B.stored_bytes(spark, scratch_path(spark, "") .rsplit("/", 2)[0]) >= 0
    assert F is not None
