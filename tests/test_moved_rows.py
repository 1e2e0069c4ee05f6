"""Reviews are read in tasks of bounded rows, and moved once and narrow."""

from pyspark.sql import functions as F

from revlens.plans import queries as Q
from revlens.sources import fixtures
from revlens.sources.io import read_by_rows

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_tasks_are_sized_by_rows(spark, tmpdir_path):
    path = f"{tmpdir_path}/well-packed"
    rows = spark.range(64_000).select("id", F.repeat(F.lit("same text "), 50).alias("text"))
    rows.repartition(16).write.option("compression", "zstd").parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    read = read_by_rows(spark, path, 4_000)
    assert read.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 4_100
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert read.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_reviews_stay_dealt_through_both_joins(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 100)
    assert plan(fixtures.Inputs(spark, SF_SMALL).reviews()).count("REPARTITION_BY_NUM") == 4


def test_landed_reviews_are_the_reviews(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 1_000)
    inputs = fixtures.Inputs(spark, SF_SMALL)
    made, landed = inputs.reviews(), inputs.landed_reviews()
    assert landed.dtypes == made.dtypes and landed.count() == made.count()
    assert landed.exceptAll(made).count() == 0


def test_table_queries_build_the_reviews_once(spark):
    for query in (Q.q_warehouse_checks,):
        assert "o_custkey" not in plan(query(spark, SF_SMALL))
    assert "o_custkey" not in plan(Q.warehouse(spark, SF_SMALL, materialize="table").stg_reviews)


def test_reviewers_of_a_product_are_counted_in_place(spark, tmpdir_path):
    from revlens.operators.reviewers import first_of_pair, with_reviewer_context

    threshold = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        lazy = Q.warehouse(spark, SF_SMALL)
        context = with_reviewer_context(lazy.fct_reviews, lazy.reviewer_history, rows_per_split=3, part="part")
        first = context.withColumn("first", first_of_pair(context, "part"))
        above = plan(first)
        above = above[: above.index("SortMergeJoin")]
        assert "Window" in above and "Exchange" not in above
        text = plan(context)
        assert "sentiment_bucket" not in text[text.index("SortMergeJoin"):]  # derived after the move
        plain = with_reviewer_context(lazy.fct_reviews, lazy.reviewer_history)
        assert [c for c in context.columns if c != "part"] == plain.columns
        got = first.groupBy("product_id").agg(F.count_if("first").alias("n"))
        want = lazy.fct_reviews.groupBy("product_id").agg(F.countDistinct("reviewer_id").alias("n"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set(threshold, old)


def test_bucketed_reviews_move_without_derived_columns(spark, monkeypatch):
    from revlens.sources.bucketing import Layout

    moved, write = [], Layout.write
    monkeypatch.setattr(Layout, "write", lambda self, df, *a: moved.append(df.columns) or write(self, df, *a))
    i = fixtures.Inputs(spark, SF_SMALL)
    wh = Q.BucketedWarehouse(i.reviews(), i.products(), i.mapping(), i.rules(), bucket_bytes=1 << 20, rows_per_split=5000)
    stored = wh.stored_reviews
    assert "review_key" not in moved[0] and "sentiment_bucket" not in moved[0]
    assert {"review_key", "sentiment_bucket", "bucket_part"} <= set(stored.columns)
