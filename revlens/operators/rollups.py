"""Rollups by product, day, month and category.

All are single ``groupBy`` aggregations: partial (map-side) aggregation runs
before the shuffle, so a product or day holding a large share of the reviews
reaches the exchange as one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import functions as RF


def _distinct(col: str, approx: bool):
    return F.approx_count_distinct(col) if approx else F.countDistinct(col)


def _sentiment_counts(prefix: str = "", suffix: str = "_review_count"):
    s = F.col("sentiment_bucket")
    return [
        RF.count_if(s == "positive").alias(f"{prefix}positive{suffix}"),
        RF.count_if(s == "neutral").alias(f"{prefix}neutral{suffix}"),
        RF.count_if(s == "negative").alias(f"{prefix}negative{suffix}"),
    ]


STAT_AGG_COLUMNS = [
    "review_count", "distinct_reviewer_count", "avg_rating", "min_rating", "max_rating", "rating_stddev",
    "five_star_count", "four_star_count", "three_star_count", "two_star_count", "one_star_count",
    "positive_review_count", "neutral_review_count", "negative_review_count",
    "verified_purchase_review_count", "total_helpful_votes", "first_reviewed_date", "last_reviewed_date",
]


def product_stat_aggregates(approx_distinct: bool = False, first: Column | None = None) -> list:
    """A1's aggregate columns over review rows (finished by ``finish_product_stats``).
    ``first`` marks one row of each reviewer of a product, where that is known."""
    r = F.col("rating")
    return [
        F.count(F.lit(1)).alias("review_count"),
        (_distinct("reviewer_id", approx_distinct) if first is None else RF.count_if(first)).alias("distinct_reviewer_count"),
        RF.round_half_away(F.avg(r), 2).alias("avg_rating"),
        F.min(r).alias("min_rating"),
        F.max(r).alias("max_rating"),
        RF.stddev_samp_int(r).alias("rating_stddev"),
        *[RF.count_if(r == k).alias(f"{name}_star_count") for k, name in
          [(5, "five"), (4, "four"), (3, "three"), (2, "two"), (1, "one")]],
        *_sentiment_counts(),
        RF.count_if(F.col("is_verified_purchase")).alias("verified_purchase_review_count"),
        F.sum("helpful_vote_count").cast("long").alias("total_helpful_votes"),
        F.min("reviewed_date").alias("first_reviewed_date"),
        F.max("reviewed_date").alias("last_reviewed_date"),
    ]


def finish_product_stats(agg: DataFrame) -> DataFrame:
    """Span and percentages over the A1 aggregates, in the published column order."""
    return agg.select(
        "product_id", *STAT_AGG_COLUMNS,
        F.datediff("last_reviewed_date", "first_reviewed_date").cast("long").alias("review_span_days"),
        RF.pct("negative_review_count", "review_count").alias("negative_review_pct"),
        RF.pct("positive_review_count", "review_count").alias("positive_review_pct"),
        RF.pct("verified_purchase_review_count", "review_count").alias("verified_review_pct"),
    )


def product_review_stats(fct: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """A1: per-product review statistics over the deduplicated fact table."""
    return finish_product_stats(fct.groupBy("product_id").agg(*product_stat_aggregates(approx_distinct)))


def daily_rollup(fct: DataFrame, approx_distinct: bool = False, products: DataFrame | None = None) -> DataFrame:
    """A5/O1: one row per review date, sorted by date.

    Two exact distinct counts plan as one ``Expand`` + two-level aggregation;
    ``approx_distinct=True`` swaps them for HyperLogLog++ sketches. ``products``
    (reviewed_date, products_reviewed) gives the products of a day where they are counted
    already: then only pairs of day and reviewer are exchanged, without the sums.
    """
    neg = RF.count_if(F.col("sentiment_bucket") == "negative")
    figures = [
        RF.round_half_away(F.avg("rating"), 2).alias("avg_rating"),
        *_sentiment_counts(suffix="_reviews"),
        RF.pct(neg, F.count(F.lit(1))).alias("negative_review_pct"),
    ]
    by, n = fct.groupBy("reviewed_date"), F.count(F.lit(1)).alias("reviews_count")
    if products is None:
        out = by.agg(
            n, _distinct("product_id", approx_distinct).alias("products_reviewed"),
            _distinct("reviewer_id", approx_distinct).alias("distinct_reviewers"), *figures,
        )
    else:
        out = by.agg(n, *figures)
        pairs = fct.select("reviewed_date", "reviewer_id") if approx_distinct else fct.select("reviewed_date", "reviewer_id").distinct()
        reviewers = pairs.groupBy("reviewed_date").agg(
            (_distinct("reviewer_id", True) if approx_distinct else F.count("reviewer_id")).alias("distinct_reviewers")
        )
        columns = ["reviewed_date", "reviews_count", "products_reviewed", "distinct_reviewers", *out.columns[2:]]
        for counted in (products, reviewers):
            counted = counted.withColumnRenamed("reviewed_date", "of")
            out = out.join(counted, F.col("reviewed_date").eqNullSafe(F.col("of")), "left").drop("of")
        out = out.na.fill(0, ["products_reviewed", "distinct_reviewers"]).select(*columns)
    return out.orderBy(F.col("reviewed_date").asc_nulls_last())


def monthly_rollup(fct: DataFrame, approx_distinct: bool = False, of_states: bool = False, narrow: bool = False) -> DataFrame:
    """One row per (product, first day of month). ``of_states``: from one row per
    product and month that holds the sums (``plans.refresh.product_states``), in place.
    ``narrow`` moves the reviews, without texts, to the task of their product and month,
    which takes fewer bytes than two moves of partial sums; it sums them up as they come."""
    if of_states:
        n = F.col("review_count")
        return fct.select(
            "product_id", F.col("review_month").alias("month_start_date"), "review_count", "distinct_reviewer_count",
            RF.round_half_away(F.try_divide(F.col("rating_sum").cast("double"), F.col("ratings").cast("double")), 2).alias("avg_rating"),
            "min_rating", "max_rating", "positive_review_count", "neutral_review_count", "negative_review_count",
            RF.pct("negative_review_count", n).alias("negative_review_pct"),
            "verified_purchase_review_count", "total_helpful_votes",
        )
    r = F.col("rating")
    neg = RF.count_if(F.col("sentiment_bucket") == "negative")
    by = ["product_id", F.trunc("reviewed_date", "month").alias("month_start_date")]
    if narrow:
        moved = fct.select(*by, "reviewer_id", "rating", "is_verified_purchase", "helpful_vote_count")
        fct = moved.repartition("product_id", "month_start_date").withColumn("sentiment_bucket", RF.sentiment_from_rating("rating"))
        by = ["product_id", "month_start_date"]
    return fct.groupBy(*by).agg(
        F.count(F.lit(1)).alias("review_count"),
        _distinct("reviewer_id", approx_distinct).alias("distinct_reviewer_count"),
        RF.round_half_away(F.avg(r), 2).alias("avg_rating"),
        F.min(r).alias("min_rating"),
        F.max(r).alias("max_rating"),
        *_sentiment_counts(),
        RF.pct(neg, F.count(F.lit(1))).alias("negative_review_pct"),
        RF.count_if(F.col("is_verified_purchase")).alias("verified_purchase_review_count"),
        F.sum("helpful_vote_count").cast("long").alias("total_helpful_votes"),
    )


def category_rollup(dim_products: DataFrame) -> DataFrame:
    """dim_categories — reviewed products rolled up by (group, subcategory).

    Sums per-product distinct-reviewer counts (a reviewer of two products in
    one category counts twice), and averages product averages unweighted.
    These have two digits, so they are summed as whole hundredths: the average
    does not depend on the order of rows, nor does the side a tie rounds to.
    """
    hundredths = RF.round_half_away(F.col("our_avg_rating") * 100, 0).cast("long")
    neg_sum = F.sum("negative_review_count")
    rev_sum = F.sum("our_review_count")
    return (
        dim_products.where(F.col("our_review_count") > 0)
        .groupBy("category_group", "subcategory")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            RF.count_if(F.col("is_premium")).alias("premium_product_count"),
            rev_sum.cast("long").alias("total_reviews"),
            F.sum("distinct_reviewer_count").cast("long").alias("total_distinct_reviewers"),
            RF.round_half_away(F.try_divide(F.sum(hundredths), F.count("our_avg_rating") * 100), 3).alias("avg_product_rating"),
            F.sum("positive_review_count").cast("long").alias("positive_review_count"),
            neg_sum.cast("long").alias("negative_review_count"),
            F.sum("neutral_review_count").cast("long").alias("neutral_review_count"),
            RF.pct(neg_sum, F.nullif(rev_sum, F.lit(0))).alias("negative_review_pct"),
            F.min("first_reviewed_date").alias("first_reviewed_date_in_category"),
            F.max("last_reviewed_date").alias("last_reviewed_date_in_category"),
        )
    )


def date_bounds(df: DataFrame, col: str = "reviewed_date") -> DataFrame:
    """One-row min/max of a date column."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))
