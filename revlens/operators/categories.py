"""Category performance by reviewer tendency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import functions as RF

TENDENCIES = ("harsh", "generous", "balanced")


def tendency_aggregates() -> list:
    """Per-product partial sums/counts the scorecard is rebuilt from (aggregate columns)."""
    r = F.col("rating")
    t = F.col("reviewer_tendency")
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(r).cast("long").alias("r_sum"),
        F.count(r).alias("r_n"),
        *[F.sum(F.when(t == k, r)).cast("long").alias(f"{k}_sum") for k in TENDENCIES],
        *[F.count(F.when(t == k, r)).alias(f"{k}_n") for k in TENDENCIES],
        *[F.count(F.when(t == k, F.lit(1))).alias(f"{k}_rows") for k in TENDENCIES],
        RF.count_if(F.col("sentiment_bucket") == "negative").alias("neg"),
        RF.count_if(F.col("is_verified_purchase")).alias("ver"),
    ]


def category_performance(ctx: DataFrame, products: DataFrame, sort: bool = True, per_product: DataFrame | None = None) -> DataFrame:
    """Scorecard per (category_group, subcategory), split by reviewer tendency.

    Reviews are first reduced to one row per product (sums and counts, map-side
    partial aggregation), then joined to the products' category columns and
    re-aggregated. Averages are rebuilt as sum / count, which is exact for
    integer ratings, so the result equals a review-level join + group-by while
    the join runs at product grain (no hot-product skew, no review-sized
    shuffle into the join). ``per_product`` may pass that reduction in when it
    is already computed (it must hold the ``tendency_aggregates`` columns).
    """
    if per_product is None:
        per_product = ctx.groupBy("product_id").agg(*tendency_aggregates())
    cats = products.select("product_id", "category_group", "subcategory")
    joined = per_product.join(cats, "product_id")

    def avg_of(s, n):
        return RF.round_half_away(F.sum(s).cast("double") / F.nullif(F.sum(n), F.lit(0)).cast("double"), 2)

    total = F.sum("n")
    out = joined.groupBy("category_group", "subcategory").agg(
        total.cast("long").alias("total_reviews"),
        avg_of("r_sum", "r_n").alias("overall_avg_rating"),
        avg_of("harsh_sum", "harsh_n").alias("harsh_reviewer_avg_rating"),
        F.sum("harsh_rows").cast("long").alias("harsh_reviewer_count"),
        avg_of("generous_sum", "generous_n").alias("generous_reviewer_avg_rating"),
        F.sum("generous_rows").cast("long").alias("generous_reviewer_count"),
        avg_of("balanced_sum", "balanced_n").alias("balanced_reviewer_avg_rating"),
        F.sum("balanced_rows").cast("long").alias("balanced_reviewer_count"),
        RF.pct(F.sum("neg"), total).alias("negative_review_pct"),
        RF.pct(F.sum("ver"), total).alias("verified_review_pct"),
    )
    out = out.select(
        "*",
        RF.rating_delta("generous_reviewer_avg_rating", "harsh_reviewer_avg_rating", 2).alias("polarization_score"),
        RF.category_health("overall_avg_rating", "negative_review_pct").alias("category_health"),
    )
    order = [F.col("total_reviews").desc_nulls_last(), F.col("category_group").asc_nulls_last(),
             F.col("subcategory").asc_nulls_last()]
    return out.orderBy(*order) if sort else out
