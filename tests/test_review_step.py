"""What the review step moves and how large its tasks are."""

import glob

from pyspark.sql import functions as F

from revlens.operators.staging import fct_reviews
from revlens.plans.queries import warehouse
from revlens.sources import fixtures

from .conftest import SF_SMALL


def test_reviews_are_dealt_by_rows(spark, monkeypatch):
    whole = fixtures.Inputs(spark, SF_SMALL).reviews()
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 100)
    dealt = fixtures.Inputs(spark, SF_SMALL).reviews()
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.rdd.getNumPartitions() >= -(-n // 100)
    assert dealt.exceptAll(whole).count() == 0 and dealt.count() == whole.count()


def test_derived_columns_are_not_moved(spark):
    stg = warehouse(spark, SF_SMALL).stg_reviews
    plan = fct_reviews(stg, cluster_by_month=True)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("REBALANCE_PARTITIONS_BY_COL"):]
    assert "review_key" not in below and "sentiment_bucket" not in below and "review_word_count_approx" not in below


def test_derived_columns_are_those_of_the_staged_reviews(spark):
    stg = warehouse(spark, SF_SMALL).stg_reviews
    derived = ["reviewed_date", "review_word_count_approx"]
    keys = ["reviewer_id", "product_id", "reviewed_at", "review_text"]
    assert fct_reviews(stg).select(*keys, *derived).exceptAll(stg.select(*keys, *derived)).count() == 0
    assert fct_reviews(stg, cluster_by_month=True).where(~F.col("review_month").eqNullSafe(F.trunc("reviewed_date", "month"))).count() == 0


def test_models_are_written_with_zstd(spark):
    wh = warehouse(spark, SF_SMALL, materialize="table")
    assert wh.stg_products.count() > 0
    path = wh._path("stg_products").removeprefix("file:")
    assert glob.glob(f"{path}/*.zstd.parquet")
