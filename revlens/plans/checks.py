"""The warehouse's column-test suite, re-expressed through the quality operators (Q1–Q6).

``SUITE`` lists every test of the warehouse — raw sources, staging,
intermediate models, marts and seeds — as (model, test, column, argument).
``run_suite`` runs them per model with ``run_checks`` (row-local tests fused
into one pass per model) and returns one (model, check, column, failures)
row per test: the equivalent of a full test run, as a DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.quality import Check, run_checks
from revlens.session import scratch_path
from revlens.sources.io import materialize

RATINGS = [1, 2, 3, 4, 5]
TENDENCIES = ["harsh", "balanced", "generous", "insufficient_data"]

# fixed values: the warehouse's column tests — (model, test, column, accepted values or parent "model.column")
SUITE = [
    ("raw_reviews", "not_null", "rating", None),
    ("raw_reviews", "accepted_values", "rating", [1.0, 2.0, 3.0, 4.0, 5.0]),
    ("raw_reviews", "not_null", "asin", None),
    ("raw_reviews", "not_null", "user_id", None),
    ("raw_products", "not_null", "parent_asin", None),
    ("stg_reviews", "not_null", "product_id", None),
    ("stg_reviews", "not_null", "reviewer_id", None),
    ("stg_reviews", "not_null", "review_text", None),
    ("stg_reviews", "not_null", "rating", None),
    ("stg_reviews", "accepted_values", "rating", RATINGS),
    ("stg_reviews", "not_null", "reviewed_at", None),
    ("stg_reviews", "not_null", "review_text_length", None),
    ("stg_products", "not_null", "product_id", None),
    ("stg_products", "unique", "product_id", None),
    ("stg_products", "not_null", "product_title", None),
    ("stg_products", "not_null", "main_category", None),
    ("stg_products", "not_null", "category_group", None),
    ("stg_products", "accepted_values", "category_group", ["Beauty", "Beauty (Premium)", "Unknown"]),
    ("stg_products", "not_null", "is_premium", None),
    ("stg_products", "not_null", "subcategory", None),
    ("stg_products", "not_null", "price_bucket", None),
    ("stg_products", "accepted_values", "price_bucket", ["unknown", "under_10", "10_to_25", "25_to_50", "50_to_100", "over_100"]),
    ("stg_products", "not_null", "is_new_or_unreviewed", None),
    ("reviewer_history", "not_null", "reviewer_id", None),
    ("reviewer_history", "unique", "reviewer_id", None),
    ("reviewer_history", "not_null", "lifetime_review_count", None),
    ("reviewer_history", "not_null", "avg_rating_given", None),
    ("reviewer_history", "not_null", "harshness_score", None),
    ("reviewer_history", "not_null", "reviewer_tendency", None),
    ("reviewer_history", "accepted_values", "reviewer_tendency", TENDENCIES),
    ("product_review_stats", "not_null", "product_id", None),
    ("product_review_stats", "unique", "product_id", None),
    ("product_review_stats", "not_null", "review_count", None),
    ("product_review_stats", "not_null", "avg_rating", None),
    ("reviews_with_context", "not_null", "review_key", None),
    ("reviews_with_context", "unique", "review_key", None),
    ("reviews_with_context", "not_null", "product_id", None),
    ("reviews_with_context", "not_null", "reviewer_tendency", None),
    ("reviews_with_context", "accepted_values", "reviewer_tendency", TENDENCIES),
    ("fct_reviews", "not_null", "review_key", None),
    ("fct_reviews", "unique", "review_key", None),
    ("fct_reviews", "not_null", "product_id", None),
    ("fct_reviews", "relationship", "product_id", "dim_products.product_id"),
    ("fct_reviews", "not_null", "reviewer_id", None),
    ("fct_reviews", "not_null", "rating", None),
    ("fct_reviews", "accepted_values", "rating", RATINGS),
    ("fct_reviews", "not_null", "sentiment_bucket", None),
    ("fct_reviews", "accepted_values", "sentiment_bucket", ["positive", "neutral", "negative"]),
    ("fct_reviews", "accepted_values", "review_length_bucket", ["short", "medium", "long"]),
    ("fct_reviews", "not_null", "reviewed_at", None),
    ("dim_products", "not_null", "product_id", None),
    ("dim_products", "unique", "product_id", None),
    ("dim_products", "not_null", "subcategory", None),
    ("dim_products", "not_null", "our_review_count", None),
    ("dim_products", "non_negative", "our_review_count", None),
    ("dim_products", "not_null", "review_volume_bucket", None),
    ("dim_products", "accepted_values", "review_volume_bucket", ["no_reviews", "sparse", "moderate", "well_reviewed"]),
    ("dim_reviewers", "not_null", "reviewer_id", None),
    ("dim_reviewers", "unique", "reviewer_id", None),
    ("dim_reviewers", "not_null", "lifetime_review_count", None),
    ("dim_reviewers", "not_null", "reviewer_tendency", None),
    ("dim_reviewers", "accepted_values", "reviewer_tendency", TENDENCIES),
    ("dim_reviewers", "not_null", "engagement_bucket", None),
    ("dim_reviewers", "accepted_values", "engagement_bucket", ["one_shot", "occasional", "regular", "power_reviewer"]),
    ("dim_reviewers", "accepted_values", "rating_consistency",
     ["very_consistent", "consistent", "variable", "highly_variable", "insufficient_data"]),
    ("dim_categories", "not_null", "category_group", None),
    ("dim_categories", "not_null", "subcategory", None),
    ("dim_categories", "not_null", "product_count", None),
    ("dim_dates", "not_null", "date", None),
    ("dim_dates", "unique", "date", None),
    ("dim_dates", "not_null", "year", None),
    ("dim_dates", "not_null", "is_weekend", None),
    ("fct_reviews_daily", "not_null", "reviewed_date", None),
    ("fct_reviews_daily", "unique", "reviewed_date", None),
    ("fct_reviews_daily", "not_null", "reviews_count", None),
    ("fct_reviews_daily", "not_null", "avg_rating", None),
    ("fct_reviews_monthly", "not_null", "product_id", None),
    ("fct_reviews_monthly", "not_null", "month_start_date", None),
    ("fct_reviews_monthly", "not_null", "review_count", None),
    ("fct_reviews_monthly", "non_negative", "review_count", None),
    ("fct_reviews_monthly", "not_null", "avg_rating", None),
    ("mart_products_at_risk", "not_null", "product_id", None),
    ("mart_products_at_risk", "unique", "product_id", None),
    ("mart_products_at_risk", "not_null", "risk_score", None),
    ("mart_products_at_risk", "non_negative", "risk_score", None),
    ("mart_products_at_risk", "not_null", "risk_tier", None),
    ("mart_products_at_risk", "accepted_values", "risk_tier", ["insufficient_data", "low", "medium", "high", "critical"]),
    ("mart_category_performance", "not_null", "subcategory", None),
    ("mart_category_performance", "not_null", "total_reviews", None),
    ("mart_category_performance", "not_null", "category_health", None),
    ("mart_category_performance", "accepted_values", "category_health", ["healthy", "stable", "watch", "struggling"]),
    ("category_mapping", "not_null", "main_category", None),
    ("category_mapping", "unique", "main_category", None),
    ("category_mapping", "not_null", "category_group", None),
    ("category_mapping", "not_null", "is_premium", None),
    ("subcategory_rules", "not_null", "subcategory", None),
    ("subcategory_rules", "not_null", "keyword_pattern", None),
    ("subcategory_rules", "unique", "keyword_pattern", None),
    ("subcategory_rules", "not_null", "priority", None),
]


INPUTS = {"raw_reviews": "raw_reviews", "raw_products": "raw_products",
          "category_mapping": "mapping", "subcategory_rules": "rules"}


def suite_models() -> list[str]:
    """Models with tests, in suite order."""
    return list(dict.fromkeys(m for m, *_ in SUITE))


def _table(wh, name: str) -> DataFrame:
    return getattr(wh, INPUTS[name]) if name in INPUTS else wh.table(name)


def _tested(wh, name: str, checks: list[Check]) -> DataFrame:
    """The table that a model's tests read. In table mode the context, which is not stored,
    is made once, of the tested columns: every test would move the reviews to their history."""
    table = _table(wh, name)
    if name != "reviews_with_context" or wh.materialize != "table" or name in wh._written:
        return table
    columns = dict.fromkeys(ch.column for ch in checks)
    return materialize(table.select(*columns), name, path=scratch_path(wh.spark, f"tested-{uuid.uuid4().hex}"))


def model_checks(wh, name: str) -> list[Check]:
    """The tests of one model; without a warehouse, foreign keys have no parent."""
    out = []
    for model, kind, column, arg in SUITE:
        if model != name:
            continue
        if kind == "accepted_values":
            out.append(Check(kind, column, values=arg))
        elif kind == "relationship":
            parent_model, parent_col = arg.split(".")
            out.append(Check(kind, column, parent=_table(wh, parent_model) if wh else None, parent_field=parent_col))
        else:
            out.append(Check(kind, column))
    return out


def run_suite(wh, models=None) -> DataFrame:
    """Tests of ``SUITE`` on the warehouse ``wh``: (model, check, column, failures).

    ``models`` restricts the run to some models; only those (and the parents of
    their relationship tests) are resolved, so tests can run while other
    models are still being built.
    """
    wanted = set(models) if models is not None else set(suite_models())
    by_model = {model: model_checks(wh, model) for model in suite_models() if model in wanted}
    out = None
    for model, checks in by_model.items():
        part = run_checks(_tested(wh, model, checks), checks).select(
            F.lit(model).alias("model"), "check", "column", "failures"
        )
        out = part if out is None else out.unionByName(part)
    return out
