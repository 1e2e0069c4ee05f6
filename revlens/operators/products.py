"""Product dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import functions as RF

STAT_COLUMNS = [
    "rating_stddev", "five_star_count", "four_star_count", "three_star_count", "two_star_count",
    "one_star_count", "positive_review_count", "neutral_review_count", "negative_review_count",
    "negative_review_pct", "positive_review_pct", "verified_review_pct", "total_helpful_votes",
    "first_reviewed_date", "last_reviewed_date", "review_span_days",
]


def dim_products(stg_products: DataFrame, stats: DataFrame, recent_days: int = 365, anchor=None) -> DataFrame:
    """Products left join review statistics (one row per product, reviewed or not).

    Only the two counts default to 0; other statistics stay null for
    unreviewed products. The recency anchor is the latest review date over all
    reviewed products. Pass it as ``anchor`` (a scalar Column) when a cheaper
    source exists — e.g. ``max(reviewed_date)`` of the staged reviews, which is
    the same date because deduplication keeps every review date; by default it
    is a scalar subquery over the statistics.
    """
    if anchor is None:
        anchor = stats.agg(F.max("last_reviewed_date")).scalar()
    s = stats.select(
        "product_id", "review_count", "distinct_reviewer_count", "avg_rating", *STAT_COLUMNS
    ).withColumnRenamed("distinct_reviewer_count", "__drc")
    j = stg_products.join(s, "product_id", "left")
    last = F.col("last_reviewed_date")
    recent = F.when(last.isNull(), F.lit(False)).otherwise(
        F.coalesce(F.datediff(anchor, last) <= recent_days, F.lit(False))
    )
    return j.select(
        "product_id", "product_title", "brand", "main_category", "category_group", "subcategory",
        "is_premium", "price_usd", "price_bucket", "amazon_average_rating", "amazon_rating_count",
        F.coalesce(F.col("review_count"), F.lit(0).cast("long")).alias("our_review_count"),
        F.coalesce(F.col("__drc"), F.lit(0).cast("long")).alias("distinct_reviewer_count"),
        F.col("avg_rating").alias("our_avg_rating"),
        *STAT_COLUMNS,
        RF.review_volume_bucket("review_count").alias("review_volume_bucket"),
        RF.rating_delta("avg_rating", "amazon_average_rating", 2).alias("our_vs_amazon_rating_delta"),
        recent.alias("is_recently_reviewed"),
    )
