"""Loads through the review store against one full build, and loads that fail."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from revlens.operators.rollups import daily_rollup, monthly_rollup, product_review_stats
from revlens.operators.staging import clean_reviews, fct_reviews
from revlens.plans import refresh
from revlens.plans.refresh import ReviewStore

SCHEMA = (
    "parent_asin string, asin string, user_id string, rating double, title string, text string,"
    " timestamp timestamp_ntz, helpful_vote int, verified_purchase boolean"
)


def reviews(spark, rows):
    """(product, user, rating, text, when) -> raw reviews."""
    cols = "parent_asin string, user_id string, rating double, text string, at string"
    return spark.createDataFrame(rows, cols).select(
        "parent_asin", F.lit("v").alias("asin"), "user_id", "rating", F.lit("t").alias("title"), "text",
        F.col("at").cast("timestamp_ntz").alias("timestamp"), F.length("text").alias("helpful_vote"), F.lit(True).alias("verified_purchase"),
    )


FIRST = [
    ("p1", "a", 5.0, "good", "2020-01-03 10:00:00"), ("p1", "b", 1.0, "bad", "2020-01-04 10:00:00"),
    ("p1", "a", 4.0, "again", "2020-02-03 10:00:00"), (None, "c", 3.0, "no product", "2020-02-05 10:00:00"),
    ("p2", None, 2.0, "no reviewer", "2020-03-05 10:00:00"), ("p2", "d", 2.0, "no time", None),
]
SECOND = [
    ("p1", "a", 5.0, "good, and longer", "2020-01-03 10:00:00"),  # a duplicate of an earlier load
    ("p3", "e", 4.0, "new", "2020-04-01 00:00:00"), ("p1", "e", 3.0, "new", "2020-01-31 23:59:59"),
    ("p2", "d", 2.0, "no time, longer", None), ("p1", "f", 3.0, "", "2020-02-01 00:00:00"),
]


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def expected(spark, raw):
    fct = fct_reviews(clean_reviews(raw))
    return rows(product_review_stats(fct)), rows(monthly_rollup(fct)), rows(daily_rollup(fct))


def files(root, month):
    return sorted(glob.glob(f"{root}/facts/load=*/review_month={month}/*.parquet"))


def test_two_loads_equal_one_build(spark, tmpdir_path):
    store, first, second = ReviewStore(spark, tmpdir_path), reviews(spark, FIRST), reviews(spark, SECOND)
    assert len(store.load(first)) == 4
    assert (rows(store.product_review_stats), rows(store.monthly), rows(store.daily)) == expected(spark, first)
    march = files(tmpdir_path, "2020-03-01")
    changed = store.load(second)
    assert sorted(map(str, changed)) == ["2020-01-01", "2020-04-01", "None"]
    assert files(tmpdir_path, "2020-03-01") == march  # no load rewrote it
    both = first.unionByName(second)
    assert (rows(store.product_review_stats), rows(store.monthly), rows(store.daily)) == expected(spark, both)
    assert store.facts.where("review_text = 'good'").count() == 0
    # the same load again changes no figure
    store.load(second)
    assert (rows(store.product_review_stats), rows(store.monthly), rows(store.daily)) == expected(spark, both)
    ids = store.reviewer_ids()
    assert ids.count() == ids.select("id").distinct().count() == ids.select("value").distinct().count() == 5


@pytest.mark.parametrize("step", ["daily_rollup", "distinct_sets"])
def test_a_load_that_fails_leaves_the_earlier_state(spark, tmpdir_path, monkeypatch, step):
    store, first, second = ReviewStore(spark, tmpdir_path), reviews(spark, FIRST), reviews(spark, SECOND)
    store.load(first)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(refresh, step, fail)
        with pytest.raises(RuntimeError):
            store.load(second)
    assert (rows(store.product_review_stats), rows(store.monthly), rows(store.daily)) == expected(spark, first)
    store.load(second)
    assert rows(store.product_review_stats) == expected(spark, first.unionByName(second))[0]


def test_only_listed_months_are_scanned(spark, tmpdir_path):
    import datetime as dt

    store = ReviewStore(spark, tmpdir_path)
    store.load(reviews(spark, FIRST))
    store.load(reviews(spark, SECOND))
    january = store.table("facts", [dt.date(2020, 1, 1)])
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "load" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(january.inputFiles()) and january.count() == 3
    assert os.path.isdir(f"{tmpdir_path}/lists")


def test_empty_store_and_empty_load(spark, tmpdir_path):
    store = ReviewStore(spark, tmpdir_path)
    with pytest.raises(LookupError):
        store.facts  # noqa: B018
    assert store.load(reviews(spark, FIRST).limit(0)) == []
    assert store.months() == {}
