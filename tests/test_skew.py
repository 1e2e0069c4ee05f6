"""One reviewer with a third of all reviews: hot-key split join is exact and spreads the work."""

import pytest
from pyspark.sql import functions as F

from revlens.operators.reviewers import reviewer_history, with_reviewer_context
from revlens.operators.skew import split_hot_join
from revlens.operators.staging import clean_reviews, fct_reviews


def skewed_reviews(spark, n=60000):
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("P"), (i % 500).cast("string")).alias("parent_asin"),
        F.lit("V").alias("asin"),
        F.concat(F.lit("U"), F.when(i % 3 == 1, F.lit(0)).otherwise(i % 2000).cast("string")).alias("user_id"),
        ((i % 5) + 1).cast("double").alias("rating"),
        F.lit("t").alias("title"),
        F.concat(F.lit("text "), i.cast("string")).alias("text"),
        F.timestamp_seconds(i * 37).cast("timestamp_ntz").alias("timestamp"),
        (i % 4).cast("int").alias("helpful_vote"),
        (i % 2 == 0).alias("verified_purchase"),
    )


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def largest_partition(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_hot_reviewer_is_split_and_exact(spark, no_broadcast):
    stg = clean_reviews(skewed_reviews(spark))
    fct, hist = fct_reviews(stg), reviewer_history(stg)
    plain = with_reviewer_context(fct, hist, rows_per_split=10 ** 12)
    split = with_reviewer_context(fct, hist, rows_per_split=2000)
    cols = ["review_key", "reviewer_tendency", "reviewer_harshness_score", "is_high_signal_positive"]
    a, b = plain.select(cols), split.select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert largest_partition(plain) >= 20000          # the hot reviewer in one task
    assert largest_partition(split) < 20000 / 2        # spread over several tasks


def test_split_join_kinds_and_missing_keys(spark, no_broadcast):
    fact = spark.createDataFrame([(k, i) for i, k in enumerate(["a"] * 50 + ["b", "c", None])], "k string, v int")
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "k string, d int")
    for how in ("left", "inner", "left_anti", "left_semi"):
        want = sorted(map(tuple, fact.join(dim, "k", how).collect()), key=str)
        got = sorted(map(tuple, split_hot_join(fact, dim, "k", how, rows_per_split=5).collect()), key=str)
        assert got == want, how


def test_null_keys_are_spread(spark, no_broadcast):
    fact = spark.range(30000).select(F.when(F.col("id") % 3 != 0, (F.col("id") % 40).cast("string")).alias("k"), F.col("id").alias("v"))
    dim = spark.range(40).select(F.col("id").cast("string").alias("k"), F.col("id").alias("d"))
    out = split_hot_join(fact, dim, "k", "left", rows_per_split=500)
    assert out.count() == 30000
    sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
