"""Staging and the review fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import functions as RF
from revlens.operators.classify import classify_by_rules, map_lookup
from revlens.operators.dedupe import keep_best
from revlens.operators.skew import dealt

REVIEW_COLUMNS = [
    "product_id", "variant_id", "reviewer_id", "review_title", "review_text", "rating",
    "helpful_vote_count", "is_verified_purchase", "reviewed_at", "reviewed_date",
    "review_text_length", "review_word_count_approx",
]

FACT_COLUMNS = [
    "review_key", "product_id", "variant_id", "reviewer_id", "review_title", "review_text",
    "review_text_length", "review_word_count_approx", "rating", "helpful_vote_count",
    "is_verified_purchase", "reviewed_at", "reviewed_date", "sentiment_bucket",
    "review_length_bucket", "has_helpful_votes",
]

PRODUCT_COLUMNS = [
    "product_id", "product_title", "brand", "main_category", "category_group", "is_premium",
    "subcategory", "amazon_average_rating", "amazon_rating_count", "price_usd", "price_bucket",
    "is_new_or_unreviewed",
]


def _timestamp_ntz(df: DataFrame, name: str):
    """Raw review time → naive timestamp: epoch milliseconds, text or timestamp input."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.timestamp_millis(c).cast("timestamp_ntz")
    return c.cast("timestamp_ntz")


def clean_reviews(
    raw: DataFrame,
    product: str = "parent_asin",
    variant: str = "asin",
    reviewer: str = "user_id",
    title: str = "title",
    text: str = "text",
    rating: str = "rating",
    votes: str = "helpful_vote",
    verified: str = "verified_purchase",
    ts: str = "timestamp",
) -> DataFrame:
    """Rename + type review columns and drop rows without text or variant id.

    Only ``text``/``variant`` null checks reach the parquet reader; the
    empty-text test stays a Spark filter. The product id is *not* required.
    """
    schema = raw.schema
    reviewed_at = _timestamp_ntz(raw, ts)
    body = F.col(text)
    return raw.where(body.isNotNull() & (F.length(body) > 0) & F.col(variant).isNotNull()).select(
        F.col(product).alias("product_id"),
        F.col(variant).alias("variant_id"),
        F.col(reviewer).alias("reviewer_id"),
        F.col(title).alias("review_title"),
        body.alias("review_text"),
        RF.to_int(rating, schema[rating].dataType).alias("rating"),
        RF.to_int(votes, schema[votes].dataType).alias("helpful_vote_count"),
        F.col(verified).cast("boolean").alias("is_verified_purchase"),
        reviewed_at.alias("reviewed_at"),
        reviewed_at.cast("date").alias("reviewed_date"),
        RF.text_length(body).alias("review_text_length"),
        RF.word_count_approx(body).alias("review_word_count_approx"),
    )


REVIEW_KEY = ["reviewer_id", "product_id", "reviewed_at"]
_TIEBREAK = ("variant_id", "review_title", "review_text", "rating", "is_verified_purchase")


def best_reviews(reviews: DataFrame, keys=REVIEW_KEY, tiebreak=_TIEBREAK) -> DataFrame:
    """One review per key, with the longest text, then the most helpful votes."""
    return keep_best(
        reviews, keys=list(keys),
        order=[F.col("review_text_length").desc_nulls_last(), F.col("helpful_vote_count").desc_nulls_last()],
        tiebreak=list(tiebreak),
    )


def fct_reviews(stg: DataFrame, tiebreak=_TIEBREAK, cluster_by_month: bool = False, slots: int | None = None) -> DataFrame:
    """W1 + F3 + P5–P7: one row per (reviewer, product, time) with derived buckets.

    Duplicates keep the longest text, then the most helpful votes; ``tiebreak``
    (ascending) takes every remaining column, so the order is total and the
    same row stays whatever the input order. The dedup keeps its hash
    exchange so the partial ``WindowGroupLimit`` cuts any group of copies to
    one row per map task before the shuffle.

    ``cluster_by_month`` adds ``review_month`` (first day of the review's month)
    and rebalances the deduplicated rows by month, ready to be written
    partitioned by month: adaptive execution splits the shuffle blocks of a big
    month over several tasks and merges small ones, without a sampling job.

    ``slots`` moves the rows once for both: their columns ``slot`` (below ``slots``) and
    ``whole`` (``MonthSlots.dealt``) name the task that takes them, a month's or a part of
    it. Adds ``review_month`` and ``first_of_month``: true for one review of each reviewer
    of a product and month, null where these may lie in several tasks.
    """
    if slots is not None:
        return _fct_reviews_of_slots(stg, tiebreak, slots)
    # what follows from other columns is not moved with the rows
    best = best_reviews(stg.drop("review_word_count_approx", "reviewed_date"), tiebreak=tiebreak)
    month = []
    if cluster_by_month:
        best = best.withColumn("review_month", F.trunc(F.col("reviewed_at").cast("date"), "month")).hint("rebalance", "review_month")
        month = ["review_month"]
    return derived_facts(best, *month)


def _fct_reviews_of_slots(stg: DataFrame, tiebreak, slots: int) -> DataFrame:
    moved = stg.drop("review_word_count_approx", "reviewed_date", "review_text_length").repartitionById(slots, F.col("slot"))
    moved = moved.withColumns({
        "review_text_length": RF.text_length(F.col("review_text")),
        "review_month": F.trunc(F.col("reviewed_at").cast("date"), "month"),
    })
    # both windows and the write by month need one sort: by month, product, reviewer, time
    pair = ["review_month", "product_id", "reviewer_id", "slot"]
    best = best_reviews(moved, [*pair, "reviewed_at"], tiebreak)
    first = (F.row_number().over(Window.partitionBy(*pair).orderBy("reviewed_at")) == 1) & F.col("reviewer_id").isNotNull()
    return derived_facts(best.withColumn("first_of_month", F.when(F.col("whole"), first)), "review_month", "first_of_month")


def reviews_by_reviewer(stg: DataFrame, hot: DataFrame, part: str, buckets: int | None = None, tiebreak=_TIEBREAK) -> DataFrame:
    """The deduplicated reviews in tasks of their reviewers, where these meet their history:
    whole reviews move once for both, without derived columns. A reviewer of ``hot``
    (``skew.hot_keys``) and reviews without one have parts, by product, in a column
    ``part``; copies among these, which may be any number, are cut before the move.
    ``buckets``: the number of tasks, if it is fixed."""
    narrow = stg.drop("review_word_count_approx", "reviewed_date")
    rows = dealt(narrow, hot, "reviewer_id", ["product_id"], part, lambda crowd: best_reviews(crowd, tiebreak=tiebreak))
    moved = rows.repartition(*([] if buckets is None else [buckets]), "reviewer_id", part)
    return best_reviews(moved, ["reviewer_id", part, "product_id", "reviewed_at"], tiebreak)


#: Columns of the facts that follow from the others.
DERIVED_COLUMNS = [
    "review_key", "review_word_count_approx", "reviewed_date", "sentiment_bucket", "review_length_bucket", "has_helpful_votes",
]


def derived_facts(reviews: DataFrame, *more: str) -> DataFrame:
    """Deduplicated reviews with every column of the facts, and ``more`` columns as they are."""
    return reviews.select(
        RF.surrogate_key("reviewer_id", "product_id", "reviewed_at").alias("review_key"),
        "product_id", "variant_id", "reviewer_id", "review_title", "review_text",
        "review_text_length", RF.word_count_approx(F.col("review_text")).alias("review_word_count_approx"), "rating", "helpful_vote_count",
        "is_verified_purchase", "reviewed_at", F.col("reviewed_at").cast("date").alias("reviewed_date"),
        RF.sentiment_from_rating("rating").alias("sentiment_bucket"),
        RF.review_length_bucket("review_text_length").alias("review_length_bucket"),
        RF.has_votes("helpful_vote_count").alias("has_helpful_votes"),
        *more,
    )


def dedupe_products(raw: DataFrame, key: str = "parent_asin", count_col: str = "rating_number", tiebreak=("title",)) -> DataFrame:
    """One row per product id with the most ratings (nulls last); null ids dropped.

    Ties go by ``tiebreak``, then by every other column.
    """
    # maps cannot be ordered; columns that hold some go by their JSON text
    rest = [
        F.to_json(f.name).asc_nulls_last() if "map<" in f.dataType.simpleString() else f.name
        for f in raw.schema.fields if f.name not in (key, count_col, *tiebreak)
    ]
    return keep_best(
        raw,
        keys=[key],
        order=[F.col(count_col).desc_nulls_last()],
        tiebreak=[*tiebreak, *rest],
        drop_null_keys=True,
    )


def clean_products(raw: DataFrame, tiebreak=("title",)) -> DataFrame:
    """Dedup, rename, type and parse price (before enrichment)."""
    d = dedupe_products(raw, tiebreak=tiebreak)
    return d.select(
        F.col("parent_asin").alias("product_id"),
        F.col("title").alias("product_title"),
        F.col("main_category"),
        F.col("store").alias("brand"),
        F.col("average_rating").cast("double").alias("amazon_average_rating"),
        RF.to_int("rating_number", raw.schema["rating_number"].dataType).alias("amazon_rating_count"),
        RF.parse_price("price").alias("price_usd"),
    )


def stg_products(
    raw: DataFrame,
    mapping: DataFrame,
    rules: DataFrame,
    tiebreak=("title",),
) -> DataFrame:
    """Staged products: dedup + clean + category group (J1) + rule subcategory."""
    cleaned = clean_products(raw, tiebreak=tiebreak)
    grouped = map_lookup(cleaned, mapping, on="main_category", defaults={"category_group": "Unknown", "is_premium": False})
    labelled = classify_by_rules(grouped, F.lower(F.col("product_title")), rules)
    return labelled.select(
        "product_id", "product_title", "brand", "main_category", "category_group", "is_premium",
        "subcategory", "amazon_average_rating", "amazon_rating_count", "price_usd",
        RF.price_bucket("price_usd").alias("price_bucket"),
        RF.is_null_or_zero("amazon_rating_count").alias("is_new_or_unreviewed"),
    )
