"""Reviewer history, harshness, reviewer dimension and review context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens import functions as RF
from revlens.operators.skew import ROWS_PER_SPLIT, hot_keys, per_split, split_hot_join


#: Tasks among which the reviews of a reviewer are dealt, by product.
PARTS = 4


def _of_parts(stg: DataFrame, approx_distinct: bool) -> DataFrame:
    """A2's aggregates by reviewer: narrow reviews move once, and their sums per reviewer
    and part. A product is in one part, so that its counts add up."""
    r, n = F.col("rating").cast("long"), F.count(F.lit(1))
    rows = stg.select(
        "reviewer_id", "product_id", "reviewed_date", "rating", "is_verified_purchase", "review_text_length", "helpful_vote_count",
        F.pmod(F.xxhash64("product_id"), F.lit(PARTS)).cast("int").alias("part"),
    ).repartition("reviewer_id", "part")
    parts = rows.groupBy("reviewer_id", "part").agg(
        n.alias("n"), F.min("reviewed_date").alias("first"), F.max("reviewed_date").alias("last"),
        F.count(r).alias("ratings"), F.sum(r).alias("s1"), F.sum(r * r).alias("s2"),
        RF.count_if(F.col("is_verified_purchase")).alias("verified"),
        F.count("review_text_length").alias("lengths"), F.sum(F.col("review_text_length").cast("long")).alias("length"),
        F.sum("helpful_vote_count").cast("long").alias("votes"),
        (F.approx_count_distinct("product_id") if approx_distinct else F.countDistinct("product_id")).alias("products"),
    )
    mean = lambda s, n: F.try_divide(F.sum(s).cast("double"), F.sum(n).cast("double"))
    return parts.groupBy("reviewer_id").agg(
        F.sum("n").alias("lifetime_review_count"),
        F.min("first").alias("first_reviewed_date"),
        F.max("last").alias("last_reviewed_date"),
        RF.round_half_away(mean("s1", "ratings"), 3).alias("avg_rating_given"),
        RF.stddev_from_moments(F.sum("ratings"), F.sum("s1"), F.sum("s2")).alias("rating_stddev"),
        F.sum("verified").alias("verified_review_count"),
        RF.round_half_away(mean("length", "lengths"), 0).alias("avg_review_text_length"),
        F.sum("votes").alias("total_helpful_votes_received"),
        F.sum("products").alias("distinct_products_reviewed"),
    )


def _of_reviews(stg: DataFrame, approx_distinct: bool) -> DataFrame:
    """A2's aggregates by reviewer, as partial sums: few columns of them move less so."""
    r = F.col("rating")
    distinct = F.approx_count_distinct("product_id") if approx_distinct else F.countDistinct("product_id")
    return stg.groupBy("reviewer_id").agg(
        F.count(F.lit(1)).alias("lifetime_review_count"),
        F.min("reviewed_date").alias("first_reviewed_date"),
        F.max("reviewed_date").alias("last_reviewed_date"),
        RF.round_half_away(F.avg(r), 3).alias("avg_rating_given"),
        RF.stddev_samp_int(r).alias("rating_stddev"),
        RF.count_if(F.col("is_verified_purchase")).alias("verified_review_count"),
        RF.round_half_away(F.avg("review_text_length"), 0).alias("avg_review_text_length"),
        F.sum("helpful_vote_count").cast("long").alias("total_helpful_votes_received"),
        distinct.alias("distinct_products_reviewed"),
    )


def reviewer_history(
    stg: DataFrame, approx_distinct: bool = False, min_reviews: int = 3, band: float = 0.75, in_parts: bool = False
) -> DataFrame:
    """A2–A4: lifetime statistics and harshness per reviewer.

    Runs on the *staged* (not deduplicated) reviews. The global average rating
    is an uncorrelated scalar subquery (one-column scan with a partial
    average, evaluated once) instead of a cross join with a one-row table. ``in_parts``
    moves the reviews and not their partial sums: for readers of all columns.
    """
    per = (_of_parts if in_parts else _of_reviews)(stg, approx_distinct)
    global_avg = stg.agg(F.avg("rating")).scalar()
    diff = F.col("avg_rating_given") - F.col("global_avg_rating")
    return per.select(
        "reviewer_id",
        "lifetime_review_count",
        "first_reviewed_date",
        "last_reviewed_date",
        F.datediff("last_reviewed_date", "first_reviewed_date").cast("long").alias("active_days_span"),
        "avg_rating_given",
        "rating_stddev",
        "verified_review_count",
        RF.pct("verified_review_count", "lifetime_review_count").alias("verified_review_pct"),
        "avg_review_text_length",
        "total_helpful_votes_received",
        "distinct_products_reviewed",
        global_avg.alias("global_avg_rating"),
    ).select(
        "*",
        RF.round_half_away(diff, 3).alias("harshness_score"),
        RF.reviewer_tendency("lifetime_review_count", diff, min_reviews, band).alias("reviewer_tendency"),
        (F.col("lifetime_review_count") >= 5).alias("is_prolific_reviewer"),
    )


def dim_reviewers(history: DataFrame) -> DataFrame:
    """Reviewer dimension (history without the global average, plus buckets)."""
    return history.select(
        "reviewer_id", "lifetime_review_count", "distinct_products_reviewed", "first_reviewed_date",
        "last_reviewed_date", "active_days_span", "avg_rating_given", "rating_stddev", "harshness_score",
        "reviewer_tendency", "verified_review_count", "verified_review_pct", "avg_review_text_length",
        "total_helpful_votes_received", "is_prolific_reviewer",
        RF.engagement_bucket("lifetime_review_count").alias("engagement_bucket"),
        RF.rating_consistency("rating_stddev").alias("rating_consistency"),
        RF.is_trusted("is_prolific_reviewer", "reviewer_tendency", "verified_review_pct").alias("is_trusted_reviewer"),
    )


def with_reviewer_context(
    fct: DataFrame,
    history: DataFrame,
    rows_per_split: int = ROWS_PER_SPLIT,
    part: str | None = None,
) -> DataFrame:
    """Each review with its reviewer's harshness context and signal flags.

    A left join on reviewer_id. The history already knows every reviewer's
    review count, so reviewers above ``rows_per_split`` reviews are split
    across tasks (their reviews spread by review key, their history row
    replicated per split) — see ``revlens.operators.skew``. With ``part``, they
    are spread by product and keep their split under that name: reviews of a product
    by a reviewer are then in one task, where ``first_of_pair`` finds them. Key and
    sentiment are then those of ``derived_facts``, worked out after the move. Facts that
    have that column are dealt already (``reviews_by_reviewer``) and do not move.
    """
    if part in fct.columns:
        hot = hot_keys(history, "reviewer_id", "lifetime_review_count", rows_per_split)
        j = fct.join(per_split(context_columns(history), hot, "reviewer_id", part), ["reviewer_id", part], "left")
        return flag_signals(j, fct.columns)
    ctx, columns = context_columns(history), fct.columns
    # what follows from other columns of the facts is not moved
    follows = {"sentiment_bucket": ["rating"], "review_key": ["reviewer_id", "product_id", "reviewed_at"]}
    derived = [c for c, of in follows.items() if part and c in columns and set(of) <= set(columns)]
    fct = fct.drop(*derived)
    counts = history.select("reviewer_id", "lifetime_review_count")
    spread = ["review_key"] if "review_key" in fct.columns else ()
    spread = ["product_id"] if part else spread
    j = split_hot_join(
        fct, ctx, "reviewer_id", "left", spread=spread, counts=counts, count_col="lifetime_review_count",
        rows_per_split=rows_per_split, part=part,
    )
    if "sentiment_bucket" in derived:
        j = j.withColumn("sentiment_bucket", RF.sentiment_from_rating("rating"))
    if "review_key" in derived:
        j = j.withColumn("review_key", RF.surrogate_key(*follows["review_key"]))
    return flag_signals(j, [*columns, part] if part else columns)


def first_of_pair(context: DataFrame, part: str) -> Column:
    """True for one review of each (product, reviewer), so that their sum counts the
    reviewers of a product. Joined by (reviewer, part) and spread by product, the rows
    need not move for it."""
    pair = Window.partitionBy("reviewer_id", part, "product_id").orderBy("rating")
    return context["reviewer_id"].isNotNull() & (F.row_number().over(pair) == 1)


def by_product(context: DataFrame) -> DataFrame:
    """The review context, with ``first_of_pair``, in tasks of its products: narrow rows take
    fewer bytes than partial sums. A product has several tasks, by reviewer; what follows
    from rating and tendency is not moved."""
    rows = context.select(
        "product_id", "rating", "reviewed_date", "is_verified_purchase", "helpful_vote_count", "first_of_pair",
        "reviewer_lifetime_review_count", "reviewer_harshness_score", "reviewer_tendency", "is_prolific_reviewer",
        F.pmod(F.xxhash64("reviewer_id"), F.lit(PARTS)).cast("int").alias("part"),
    ).repartition("product_id", "part").drop("part")
    return flag_signals(rows.withColumn("sentiment_bucket", RF.sentiment_from_rating("rating")), [*rows.columns[:6], "sentiment_bucket"])


def context_columns(history: DataFrame, *more: str) -> DataFrame:
    """What a review gets from its reviewer's history."""
    return history.select(
        "reviewer_id",
        F.col("lifetime_review_count").alias("reviewer_lifetime_review_count"),
        F.col("harshness_score").alias("reviewer_harshness_score"),
        "reviewer_tendency",
        "is_prolific_reviewer",
        *more,
    )


def flag_signals(joined: DataFrame, columns: list[str]) -> DataFrame:
    """Reviews (``columns``) joined to their context, with the signal flags."""
    t = F.col("reviewer_tendency")
    return joined.select(
        *columns,
        "reviewer_lifetime_review_count",
        "reviewer_harshness_score",
        "reviewer_tendency",
        "is_prolific_reviewer",
        RF.flag((F.col("rating") >= 4) & (t == "harsh")).alias("is_high_signal_positive"),
        RF.flag((F.col("rating") <= 2) & (t == "generous")).alias("is_high_signal_negative"),
    )
