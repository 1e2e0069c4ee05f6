"""Product risk scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens import functions as RF


@dataclass(frozen=True)
class RiskWeights:
    """Composite risk-score weights; defaults are the warehouse's published scoring."""

    negative_pct_factor: float = 0.8
    negative_pct_cap: float = 40
    signal_points: int = 5
    signal_cap: int = 20
    trend_steep: float = -0.5
    trend_steep_points: int = 20
    trend_points: int = 10
    trust_low: float = 40
    trust_low_points: int = 10
    trust_mid: float = 60
    trust_mid_points: int = 5
    premium_negative_pct: float = 20
    premium_points: int = 10
    damper_small_n: int = 5
    damper_small: float = 0.3
    damper_mid_n: int = 20
    damper_mid: float = 0.7
    damper_full: float = 1.0
    score_cap: float = 100


def risk_score(
    negative_pct: Column,
    signal_negatives: Column,
    recent_delta: Column,
    verified_pct: Column,
    is_premium: Column,
    review_count: Column,
    w: RiskWeights = RiskWeights(),
) -> Column:
    """0–100 score, volume-damped, rounded to one decimal."""
    base = F.least(negative_pct * F.lit(w.negative_pct_factor), F.lit(w.negative_pct_cap))
    signal = F.least(signal_negatives * F.lit(w.signal_points), F.lit(w.signal_cap))
    trend = (
        F.when(recent_delta.isNull(), F.lit(0))
        .when(recent_delta < F.lit(w.trend_steep), F.lit(w.trend_steep_points))
        .when(recent_delta < F.lit(0), F.lit(w.trend_points))
        .otherwise(F.lit(0))
    )
    trust = (
        F.when(verified_pct.isNull(), F.lit(0))
        .when(verified_pct < F.lit(w.trust_low), F.lit(w.trust_low_points))
        .when(verified_pct < F.lit(w.trust_mid), F.lit(w.trust_mid_points))
        .otherwise(F.lit(0))
    )
    premium = F.when(is_premium & (negative_pct > F.lit(w.premium_negative_pct)), F.lit(w.premium_points)).otherwise(F.lit(0))
    damper = (
        F.when(review_count < F.lit(w.damper_small_n), F.lit(w.damper_small))
        .when(review_count < F.lit(w.damper_mid_n), F.lit(w.damper_mid))
        .otherwise(F.lit(w.damper_full))
    )
    raw = (base + signal + trend + trust + premium) * damper
    return F.least(F.lit(float(w.score_cap)), RF.round_half_away(raw, 1))


def risk_tier(negative_pct: Column, review_count: Column) -> Column:
    """First matching tier."""
    return (
        F.when(review_count < 5, F.lit("insufficient_data"))
        .when((negative_pct >= 40) & (review_count >= 20), F.lit("critical"))
        .when((negative_pct >= 25) & (review_count >= 10), F.lit("high"))
        .when(negative_pct >= 15, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def signal_counts(ctx: DataFrame) -> DataFrame:
    """High-signal negative/positive review counts per product."""
    return ctx.groupBy("product_id").agg(
        RF.count_if(F.col("is_high_signal_negative")).alias("high_signal_negative_count"),
        RF.count_if(F.col("is_high_signal_positive")).alias("high_signal_positive_count"),
    )


def trailing_window(
    df: DataFrame, date_col: str = "reviewed_date", days: int = 90, anchor=None, ts_col: str | None = None
) -> DataFrame:
    """P25: rows within ``days`` of the latest date in the data (inclusive).

    The anchor (default: a scalar subquery over ``df``) is evaluated once. When
    ``ts_col`` is the timestamp the date was taken from, the cutoff is applied
    to it instead (``ts >= midnight of the cutoff day`` ⟺ ``date >= cutoff``):
    a timestamp that is a dedup key lets Catalyst push the filter below the
    dedup window and toward the scan, so only the trailing rows are deduped.
    """
    if anchor is None:
        anchor = df.agg(F.max(date_col)).scalar()
    cutoff = F.date_sub(anchor, days)
    if ts_col is not None:
        out = df.where(F.col(ts_col) >= cutoff.cast("timestamp_ntz"))
    else:
        out = df.where(F.col(date_col) >= cutoff)
    if "review_month" in df.columns:
        # month-partitioned table: prune whole partitions at runtime
        out = out.where(F.col("review_month") >= F.trunc(cutoff, "month"))
    return out


def recent_sentiment(fct: DataFrame, days: int = 90, anchor=None) -> DataFrame:
    """A10: trailing-window average rating, negatives and volume per product."""
    ts_col = "reviewed_at" if "reviewed_at" in fct.columns else None
    cols = ["product_id", "reviewed_date", "rating", "sentiment_bucket"] + ([ts_col] if ts_col else [])
    cols += ["review_month"] if "review_month" in fct.columns else []
    recent = trailing_window(fct.select(*cols), "reviewed_date", days, anchor, ts_col=ts_col)
    return recent.groupBy("product_id").agg(
        RF.round_half_away(F.avg("rating"), 2).alias("avg_rating_last_90d"),
        RF.count_if(F.col("sentiment_bucket") == "negative").alias("negative_count_last_90d"),
        F.count(F.lit(1)).alias("review_count_last_90d"),
    )


RISK_COLUMNS = [
    "product_id", "product_title", "brand", "subcategory", "category_group", "is_premium", "price_bucket",
    "our_review_count", "our_avg_rating", "negative_review_pct", "verified_review_pct",
    "review_volume_bucket", "high_signal_negative_count", "high_signal_positive_count",
    "avg_rating_last_90d", "negative_count_last_90d", "review_count_last_90d", "recent_rating_delta",
    "risk_score", "risk_tier",
]


SIGNAL_COLUMNS = [
    "high_signal_negative_count", "high_signal_positive_count",
    "avg_rating_last_90d", "negative_count_last_90d", "review_count_last_90d",
]


def signal_aggregates(anchor, days: int = 90) -> list:
    """A9 + A10 as aggregate columns over review rows (see ``review_signals``)."""
    recent = F.col("reviewed_date") >= F.date_sub(anchor, days)
    n_recent = F.count(F.when(recent, F.lit(1)))
    return [
        RF.count_if(F.col("is_high_signal_negative")).alias("high_signal_negative_count"),
        RF.count_if(F.col("is_high_signal_positive")).alias("high_signal_positive_count"),
        RF.round_half_away(F.avg(F.when(recent, F.col("rating"))), 2).alias("avg_rating_last_90d"),
        F.when(n_recent > 0, RF.count_if(recent & (F.col("sentiment_bucket") == "negative"))).alias("negative_count_last_90d"),
        F.when(n_recent > 0, n_recent).alias("review_count_last_90d"),
    ]


def review_signals(ctx: DataFrame, days: int = 90, anchor=None) -> DataFrame:
    """A9 + A10 in one pass: high-signal counts and trailing-window sentiment per product.

    Both are per-product aggregates over the same review rows, so one
    aggregation computes them; the trailing-window figures are conditional
    aggregates and are null for products without reviews in the window (as
    an outer join with ``recent_sentiment`` would leave them).
    """
    if anchor is None:
        anchor = ctx.agg(F.max("reviewed_date")).scalar()
    return ctx.groupBy("product_id").agg(*signal_aggregates(anchor, days))


def products_at_risk(
    dim_products: DataFrame,
    ctx: DataFrame,
    days: int = 90,
    weights: RiskWeights = RiskWeights(),
    sort: bool = True,
    anchor=None,
    signals: DataFrame | None = None,
) -> DataFrame:
    """Reviewed products + signal counts + recent sentiment → score and tier.

    The review-level inputs are reduced to one row per product in a single
    aggregation (``review_signals``, or a precomputed ``signals`` frame with
    ``SIGNAL_COLUMNS``) and joined to the product dimension on product_id, so
    the join never sees review-level skew and the reviews are aggregated once.
    """
    products = dim_products.where(F.col("our_review_count") > 0)
    if signals is None:
        signals = review_signals(ctx, days, anchor)
    j = products.join(signals.select("product_id", *SIGNAL_COLUMNS), "product_id", "left")
    delta = RF.rating_delta("avg_rating_last_90d", "our_avg_rating", 2)
    scored = j.select(
        "product_id", "product_title", "brand", "subcategory", "category_group", "is_premium", "price_bucket",
        "our_review_count", "our_avg_rating", "negative_review_pct", "verified_review_pct", "review_volume_bucket",
        F.coalesce(F.col("high_signal_negative_count"), F.lit(0).cast("long")).alias("high_signal_negative_count"),
        F.coalesce(F.col("high_signal_positive_count"), F.lit(0).cast("long")).alias("high_signal_positive_count"),
        "avg_rating_last_90d", "negative_count_last_90d", "review_count_last_90d",
        delta.alias("recent_rating_delta"),
    )
    scored = scored.select(
        "*",
        risk_score(
            F.col("negative_review_pct"), F.col("high_signal_negative_count"), F.col("recent_rating_delta"),
            F.col("verified_review_pct"), F.col("is_premium"), F.col("our_review_count"), weights,
        ).alias("risk_score"),
        risk_tier(F.col("negative_review_pct"), F.col("our_review_count")).alias("risk_tier"),
    )
    # the unique id as a tiebreaker lets the range partitioner split runs of
    # equal scores (most products share a few score values)
    order = [F.col("risk_score").desc_nulls_last(), F.col("product_id").asc_nulls_last()]
    return scored.orderBy(*order) if sort else scored


def top_at_risk(at_risk: DataFrame, k: int = 20) -> DataFrame:
    """O3: the k highest risk scores (ties by product id) — a top-k read."""
    return at_risk.orderBy(F.col("risk_score").desc_nulls_last(), F.col("product_id").asc_nulls_last()).limit(k)
