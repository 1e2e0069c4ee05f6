"""Registered queries: name → (spark, sf_dir) → DataFrame.

Every query reads the scale-factor tables (through the review/product
projections in ``revlens.sources.fixtures``) and runs over them whole. The
matching DuckDB SQL for each name is in ``revlens.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import functions as RF
from revlens.operators import quality as Q
from revlens.operators.asof import as_of_join
from revlens.operators.calendar import date_dimension
from revlens.operators.classify import classify_by_rules, map_lookup
from revlens.operators.distinct import dense_ids, distinct_counts, distinct_sets
from revlens.operators.profiling import (
    coverage, describe_columns, heavy_values, profile_joined_categories, profile_samples, profile_table, value_counts, value_share,
)
from revlens.operators.ranking import rank_rows
from revlens.operators.risk import top_at_risk
from revlens.operators.rule_index import classify_by_rule_index
from revlens.operators.rollups import date_bounds
from revlens.operators.scd2 import scd2_apply, scd2_as_of, scd2_snapshot
from revlens.operators.staging import DERIVED_COLUMNS, clean_products, derived_facts
from revlens.plans.bucketed import BucketedWarehouse
from revlens.plans.checks import SUITE, run_suite
from revlens.plans.observed import ObservedWarehouse
from revlens.plans.refresh import ReviewStore
from revlens.plans.warehouse import PRODUCT_CHECK_COLS, Warehouse
from revlens.sources.clustering import write_clustered
from revlens.sources.fixtures import AS_OF_V1, AS_OF_V2, LOADED_V1, LOADED_V2, Inputs
from revlens.session import scratch_path
from revlens.sources.io import (
    materialize, read_json_lines, read_products, read_reviews, read_seed, register_sources, reject_summary, stringify_nested,
    write_seed, write_sorted, write_table,
)
from revlens.sources.sampling import sample_n
from revlens.sources.seeds import RULES_SCHEMA, default_subcategory_rules
from revlens.operators.staging import stg_products as build_stg_products

Query = Callable[[SparkSession, str], DataFrame]


def warehouse(spark: SparkSession, sf_dir: str, land: bool | None = None, **kw) -> Warehouse:
    i = Inputs(spark, sf_dir)
    # landed where several models or branches of a plan read them
    land = kw.get("materialize") == "table" if land is None else land
    reviews = i.landed_reviews() if land else i.reviews()
    return Warehouse(reviews, i.products(), i.mapping(), i.rules(), **kw)


#: Standard deviations are compared to this many digits: engines differ in the last bits.
STDDEV_DIGITS = 9


def _wh(attr: str, **kw) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(warehouse(spark, sf_dir, **kw), attr)
        return df.withColumn("rating_stddev", F.round("rating_stddev", STDDEV_DIGITS)) if "rating_stddev" in df.columns else df

    q.__name__ = f"q_{attr}"
    return q


# --- products: individual steps -------------------------------------------

def q_parse_price(spark, sf_dir):
    raw = Inputs(spark, sf_dir).products()
    price = RF.parse_price("price")
    return raw.select(
        "parent_asin", "title", "price", price.alias("price_usd"), RF.price_bucket(price).alias("price_bucket"),
        "rating_number", RF.is_null_or_zero("rating_number").alias("is_new_or_unreviewed"),
    )


def q_map_lookup(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    raw = i.products().select("parent_asin", "title", "main_category")
    return map_lookup(raw, i.mapping(), "main_category", {"category_group": "Unknown", "is_premium": False})


def _classified(spark, sf_dir, **kw):
    i = Inputs(spark, sf_dir)
    cleaned = clean_products(i.products()).select("product_id", "product_title")
    return classify_by_rules(cleaned, F.lower("product_title"), i.rules(), **kw)


def q_classify_by_rules(spark, sf_dir):
    return _classified(spark, sf_dir)


def q_classify_by_rules_chained(spark, sf_dir):
    # rules in several CASE expressions, the first match of all counts
    return _classified(spark, sf_dir, rules_per_case=2)


def q_classify_by_rules_join(spark, sf_dir):
    # the same rules looked up by their literals and joined
    i = Inputs(spark, sf_dir)
    cleaned = clean_products(i.products()).select("product_id", "product_title")
    return classify_by_rule_index(cleaned, F.lower("product_title"), i.rules())


def q_classify_by_rule_index(spark, sf_dir):
    # thousands of rules: two alternations of name fragments per part, phrases of benchmark
    # texts with any character between the words, and two that have no literal to look up
    i = Inputs(spark, sf_dir)
    k = F.col("p_partkey")
    fragment = lambda at, n: F.expr(f"substring(p_name, {at}, {n})")
    part = i.table("part").select(
        F.concat(F.lit("P"), k.cast("string")).alias("subcategory"), F.col("p_size").cast("int").alias("priority"),
        F.explode(F.array(
            F.concat_ws("|", fragment("1 + p_partkey % 4", 5), fragment("3 + p_partkey % 5", 4)),
            F.concat_ws("|", F.col("p_name"), fragment("2 + p_partkey % 3", 6)),
        )).alias("keyword_pattern"),
    )
    phrase = F.regexp_extract(F.lower("text"), "[a-z]{4,} [a-z]{4,}", 0)
    phrases = i.table("benchmark").where(phrase != "").select(
        F.concat(F.lit("B"), F.col("item_id").cast("string")).alias("subcategory"), F.lit(60).alias("priority"),
        F.regexp_replace(phrase, " ", ".").alias("keyword_pattern"),
    )
    loose = spark.createDataFrame([("Z short", 0, "[0-9]+%"), ("A empty", None, "^[^a-z]*$")], "subcategory string, priority int, keyword_pattern string")
    docs = i.table("documents").select("doc_id", "text")
    return classify_by_rule_index(docs, F.lower("text"), part.unionByName(phrases).unionByName(loose)).drop("text")


def q_classify_default_rules(spark, sf_dir):
    docs = Inputs(spark, sf_dir).table("documents").select("doc_id", "text")
    return classify_by_rules(docs, F.lower("text"), default_subcategory_rules(spark)).drop("text")


def q_clean_products(spark, sf_dir):
    return clean_products(Inputs(spark, sf_dir).products())


# --- reviews / rollups -----------------------------------------------------

def q_top_at_risk(spark, sf_dir):
    return top_at_risk(warehouse(spark, sf_dir, land=True).mart_products_at_risk, 20)


def q_rank_at_risk(spark, sf_dir):
    mart = warehouse(spark, sf_dir, materialize="table").mart_products_at_risk
    ranked = rank_rows(mart.select("product_id", "risk_tier", "risk_score"), ["risk_score desc", "product_id"])
    return ranked.orderBy("queue_position")


def q_date_bounds(spark, sf_dir):
    return date_bounds(warehouse(spark, sf_dir).stg_reviews)


def q_global_avg_rating(spark, sf_dir):
    return warehouse(spark, sf_dir).stg_reviews.agg(F.avg("rating").alias("global_avg_rating"))


def q_distinct_reviewers(spark, sf_dir):
    # one stored table of sets per day and product; every figure below comes out of it
    wh = warehouse(spark, sf_dir, materialize="table")
    reviews, name = wh.fct_reviews, f"reviewer-sets-{uuid.uuid4().hex}"
    sets = distinct_sets(reviews, "reviewer_id", ["reviewed_date", "product_id"], dense_ids(reviews, "reviewer_id"))
    sets = materialize(sets, name, path=scratch_path(spark, name))
    month = F.trunc("reviewed_date", "month")
    category = sets.join(wh.stg_products.select("product_id", "subcategory"), "product_id")

    def level(rows, grain: str, member) -> DataFrame:
        counted = distinct_counts(rows.withColumn("member", member.cast("string")), ["member"], "distinct_reviewers")
        return counted.select(F.lit(grain).alias("grain"), "member", "distinct_reviewers")

    return (
        level(sets, "day", F.col("reviewed_date")).unionByName(level(sets, "month", month))
        .unionByName(level(sets, "product", F.col("product_id")))
        .unionByName(level(category, "category", F.col("subcategory")))
        .unionByName(level(sets, "all", F.lit("all")))
    )


def _refreshed(spark, sf_dir) -> ReviewStore:
    """The reviews in two loads: the first lacks what was written from 1999 on, and of the
    rest every second text; so duplicates lie in both loads, and some months in one."""
    raw = Inputs(spark, sf_dir).landed_reviews()
    store = ReviewStore(spark, _scratch(spark, "review-store"))
    later = F.coalesce(F.col("timestamp") >= F.lit("1999-01-01").cast("timestamp_ntz"), F.lit(False))
    held_back = F.coalesce((F.col("timestamp") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.crc32(F.col("text").cast("binary")) % 2 == 0), F.lit(False))
    store.load(raw.where(~later & ~held_back))
    store.load(raw.where(later | held_back))
    return store


def q_refresh_product_stats(spark, sf_dir):
    return _refreshed(spark, sf_dir).product_review_stats.withColumn("rating_stddev", F.round("rating_stddev", STDDEV_DIGITS))


def q_refresh_monthly(spark, sf_dir):
    return _refreshed(spark, sf_dir).monthly


def q_refresh_dim_categories(spark, sf_dir):
    return _refreshed(spark, sf_dir).dim_categories(warehouse(spark, sf_dir).stg_products)


def _bucketed(model: str) -> Query:
    def q(spark, sf_dir):
        i = Inputs(spark, sf_dir)
        wh = BucketedWarehouse(i.landed_reviews(), i.products(), i.mapping(), i.rules(), bucket_bytes=1 << 20, rows_per_split=5000)
        return getattr(wh, model)

    return q


# --- history ----------------------------------------------------------------

def _history(spark, sf_dir):
    # both loads are staged products, unique per product_id by construction
    # (dedup by key), so the duplicate-key validation — an eager job — is skipped
    i = Inputs(spark, sf_dir)
    v1 = build_stg_products(i.products(), i.mapping(), i.rules())
    v2 = build_stg_products(i.products_v2(), i.mapping(), i.rules())
    h1 = scd2_apply(None, v1, "product_id", PRODUCT_CHECK_COLS, AS_OF_V1, validate=False)
    return scd2_apply(h1, v2, "product_id", PRODUCT_CHECK_COLS, AS_OF_V2, validate=False)


def q_scd2_apply(spark, sf_dir):
    return _history(spark, sf_dir)


def q_scd2_as_of(spark, sf_dir):
    # the version of every product valid in the middle of the first load's period
    import datetime as dt

    return scd2_as_of(_history(spark, sf_dir), dt.datetime(2024, 1, 15))


def q_reviews_as_of_products(spark, sf_dir):
    # loads in the middle of the reviews' time: some reviews precede every version
    i = Inputs(spark, sf_dir)
    v1 = build_stg_products(i.products(), i.mapping(), i.rules())
    v2 = build_stg_products(i.products_v2(), i.mapping(), i.rules())
    h1 = scd2_apply(None, v1, "product_id", PRODUCT_CHECK_COLS, LOADED_V1, validate=False)
    history = materialize(scd2_apply(h1, v2, "product_id", PRODUCT_CHECK_COLS, LOADED_V2, validate=False), "product-history", path=_scratch(spark, "product-history"))
    reviews = warehouse(spark, sf_dir).fct_reviews.select("review_key", "product_id", "reviewed_at", "rating")
    reviews = _made_once(spark, reviews)  # the join reads them three times
    return as_of_join(reviews, history, "product_id", "reviewed_at", ["product_title", "subcategory", "price_bucket", "scd_id", "valid_from"])


# --- quality ----------------------------------------------------------------

def q_check_not_null(spark, sf_dir):
    return Q.check_not_null(Inputs(spark, sf_dir).products(), "parent_asin")


def q_check_unique(spark, sf_dir):
    return Q.check_unique(Inputs(spark, sf_dir).products(), "parent_asin")


def q_check_accepted_values(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return Q.check_accepted_values(wh.stg_products, "main_category", ["STANDARD", "ECONOMY", "MEDIUM", "LARGE", "SMALL"])


def q_check_relationship(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    wh = warehouse(spark, sf_dir)
    new_load = build_stg_products(i.products_v2(), i.mapping(), i.rules())
    children = _made_once(spark, wh.fct_reviews.select("review_key", "product_id"))  # counted, then joined
    return Q.check_relationship(children, "product_id", new_load, "product_id")


def q_check_non_negative(spark, sf_dir):
    return Q.check_non_negative(
        warehouse(spark, sf_dir).dim_products.select("product_id", "our_vs_amazon_rating_delta"),
        "our_vs_amazon_rating_delta",
    )


def fact_checks(wh: Warehouse) -> list[Q.Check]:
    """The fact table's column tests from the suite (grain, FK, enumerations, not-nulls)."""
    out = []
    for model, kind, column, arg in SUITE:
        if model != "fct_reviews":
            continue
        if kind == "relationship":
            pm, pc = arg.split(".")
            out.append(Q.Check(kind, column, parent=getattr(wh, pm), parent_field=pc))
        elif kind == "accepted_values":
            out.append(Q.Check(kind, column, values=arg))
        else:
            out.append(Q.Check(kind, column))
    return out


def q_run_checks(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    checks = fact_checks(wh)
    tested = dict.fromkeys(ch.column for ch in checks)
    return Q.run_checks(_made_once(spark, wh.fct_reviews.select(*tested)), checks)  # several checks read them


def q_warehouse_checks(spark, sf_dir):
    return run_suite(warehouse(spark, sf_dir, materialize="table"))  # a model is built once, its tests read the table


def q_observed_checks(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    wh = ObservedWarehouse(i.landed_reviews(), i.products(), i.mapping(), i.rules(), output_root=_scratch(spark, "observed"))
    wh.build(threads=4)
    return wh.test_results()


# --- profiling / sources ----------------------------------------------------

def q_value_counts(spark, sf_dir):
    return value_counts(warehouse(spark, sf_dir).stg_products, ["category_group", "is_premium"], "product_count")


def q_describe_columns(spark, sf_dir):
    return describe_columns(warehouse(spark, sf_dir).stg_products)


def q_heavy_reviewers(spark, sf_dir):
    return heavy_values(warehouse(spark, sf_dir).stg_reviews, "reviewer_id", 20, "review_count")


def q_heavy_words(spark, sf_dir):
    words = Inputs(spark, sf_dir).table("documents").select(F.explode(F.split("text", "[ \\n\\t\\r]+")).alias("word"))
    return heavy_values(words, "word", 50, "occurrences")


def q_classify_seeded_rules(spark, sf_dir):
    # the rules written as CSV with a note that needs quoting, read back typed, and used
    i, path = Inputs(spark, sf_dir), _scratch(spark, "rules-csv")
    note = F.when(F.col("priority") % 2 == 0, F.lit('say "even", or not'))
    write_seed(i.rules().withColumn("note", note), path)
    rules = read_seed(spark, path, T.StructType([*RULES_SCHEMA.fields, T.StructField("note", T.StringType())]))
    cleaned = clean_products(i.products()).select("product_id", "product_title")
    return classify_by_rules(cleaned, F.lower("product_title"), rules)


def _landed_lines(spark, sf_dir):
    """Products as JSON lines, and beside them lines that are none or do not fit."""
    raw, landed = Inputs(spark, sf_dir).products(), _scratch(spark, "raw-lines")
    part = Inputs(spark, sf_dir).table("part")
    good = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    name = F.col("p_name")
    bad = part.select(F.explode(F.array_compact(F.array(
        F.when(F.col("p_partkey") % 10 == 1, F.concat(F.lit('{"title": "'), name)),  # cut off
        F.when(F.col("p_partkey") % 10 == 2, F.concat(F.lit('["'), name, F.lit('"]'))),
        F.when(F.col("p_partkey") % 10 == 3, F.concat(F.lit('{"rating_number": "'), name, F.lit('"}'))),
        F.when(F.col("p_partkey") % 10 == 4, F.lit("  ")),  # no line at all
    ))).alias("value"))
    good.unionByName(bad).write.text(landed)
    return read_json_lines(spark, landed, raw.schema, max_bad_share=0.5)


def q_ingest_lines(spark, sf_dir):
    return _landed_lines(spark, sf_dir).rows


def q_ingest_rejects(spark, sf_dir):
    summary = reject_summary(_landed_lines(spark, sf_dir).rejects)
    return summary.groupBy("reason").agg(F.sum("lines").alias("lines"), F.min("example").alias("example"))


def q_value_share(spark, sf_dir):
    return value_share(warehouse(spark, sf_dir).stg_products, "subcategory", "product_count")


def q_coverage(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return coverage(i.reviews(), "parent_asin", i.products(), "parent_asin")


def q_profile_table(spark, sf_dir):
    return profile_table(Inputs(spark, sf_dir).reviews(), {"distinct_products": "asin", "distinct_users": "user_id"})


def q_profile_joined_categories(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return profile_joined_categories(i.products(), i.reviews())


def q_profile_samples(spark, sf_dir):
    p = warehouse(spark, sf_dir).stg_products
    return profile_samples(
        p, F.col("subcategory") != "Uncategorized",
        ["product_id", RF.preview("product_title", 60).alias("title_preview"), "subcategory", "brand"],
        order=["product_id"], n=10,
    )


def q_sample_n(spark, sf_dir):
    return sample_n(warehouse(spark, sf_dir).fct_reviews, 500, 42, "review_key")


def q_stringify_nested(spark, sf_dir):
    return stringify_nested(Inputs(spark, sf_dir).table("embeddings"), ["embedding"])


def q_stringify_nested_text(spark, sf_dir):
    orders = Inputs(spark, sf_dir).table("orders")
    nested = orders.select("o_orderkey", F.struct("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("tags")).alias("status"))
    return stringify_nested(nested)


def _value_counts(column: str) -> Query:
    return lambda spark, sf_dir: value_counts(warehouse(spark, sf_dir).stg_products, [column], "product_count")


def _made_once(spark, facts: DataFrame) -> DataFrame:
    """Columns of the facts as files: each reader would deduplicate the whole reviews again."""
    return materialize(facts, "facts", path=_scratch(spark, "facts"))


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def q_ingest_reviews(spark, sf_dir):
    # raw files with the nested column that the reader leaves out, a table, and the table again
    raw, landed, table = Inputs(spark, sf_dir).reviews(), _scratch(spark, "raw-reviews"), _scratch(spark, "reviews")
    raw.withColumn("images", F.array(F.struct(F.col("asin").alias("id")))).write.parquet(landed)
    write_table(read_reviews(spark, landed), table)
    return register_sources(spark, {"ingested_reviews": table})["ingested_reviews"]


def q_clustered_reviews(spark, sf_dir):
    # stored by interleaved ranks of product and date; both filters skip row groups
    path = _scratch(spark, "clustered-reviews")
    fct = warehouse(spark, sf_dir, materialize="table").fct_reviews
    moved = fct.drop("review_month", *[c for c in DERIVED_COLUMNS if c != "reviewed_date"])
    write_clustered(moved, path, ["product_id", "reviewed_date"], row_group_bytes=1 << 20, derive=derived_facts)
    stored = spark.read.parquet(path)
    return stored.where(F.col("product_id").between("P1", "P2") & F.col("reviewed_date").between("1998-01-01", "1998-06-30"))


def q_ingest_products(spark, sf_dir):
    # JSON lines in two places, read as one, with an explicit schema; sorted output, read again
    raw, landed, table = Inputs(spark, sf_dir).products(), _scratch(spark, "raw-products"), _scratch(spark, "products")
    even = F.coalesce(F.crc32(F.col("parent_asin").cast("binary")) % 2 == 0, F.lit(True))
    raw.where(even).write.json(f"{landed}/a")
    raw.where(~even).write.json(f"{landed}/b")
    read = read_products(spark, [f"{landed}/a", f"{landed}/b"], fmt="json", schema=raw.schema)
    write_sorted(read, ["parent_asin"], table)
    return materialize(spark.read.parquet(table), "ingested_products", "view")


def q_scd2_snapshot_history(spark, sf_dir):
    i, root = Inputs(spark, sf_dir), _scratch(spark, "history")
    v1 = build_stg_products(i.products(), i.mapping(), i.rules())
    v2 = build_stg_products(i.products_v2(), i.mapping(), i.rules())
    later = AS_OF_V2 + (AS_OF_V2 - AS_OF_V1)
    for load, as_of in ((v1, AS_OF_V1), (v2, AS_OF_V2), (v2, later)):  # the last changes nothing
        out = scd2_snapshot(spark, load, root, "product_id", PRODUCT_CHECK_COLS, as_of)
    return out


def q_safe_divide(spark, sf_dir):
    d = warehouse(spark, sf_dir).dim_products
    return d.select(
        "product_id",
        RF.safe_divide("negative_review_count", "our_review_count").alias("negative_share"),
        RF.safe_divide("distinct_reviewer_count", "our_review_count", 0).alias("reviewer_share"),
    )


QUERIES: dict[str, Query] = {
    # step 1: reviews
    "clean_reviews": _wh("stg_reviews"),
    "fct_reviews": _wh("fct_reviews"),
    "daily_rollup": _wh("fct_reviews_daily"),
    # step 2: rollups
    "product_review_stats": _wh("product_review_stats"),
    "monthly_rollup": _wh("fct_reviews_monthly"),
    # step 3: products
    "clean_products": q_clean_products,
    "parse_price": q_parse_price,
    "map_lookup": q_map_lookup,
    "classify_by_rules": q_classify_by_rules,
    "classify_by_rules_chained": q_classify_by_rules_chained,
    "classify_by_rules_join": q_classify_by_rules_join,
    "stg_products": _wh("stg_products"),
    "dim_products": _wh("dim_products"),
    # step 4: reviewers
    "global_avg_rating": q_global_avg_rating,
    "reviewer_history": _wh("reviewer_history"),
    "dim_reviewers": _wh("dim_reviewers"),
    "reviewer_context": _wh("reviews_with_context", land=True),
    # step 5: insight marts
    "dim_categories": _wh("dim_categories"),
    "category_performance": _wh("mart_category_performance", land=True),
    "recent_sentiment": _wh("recent_sentiment"),
    "signal_counts": _wh("signal_counts", land=True),
    "products_at_risk": _wh("mart_products_at_risk", land=True),
    "top_at_risk": q_top_at_risk,
    "rank_at_risk": q_rank_at_risk,
    "distinct_reviewers": q_distinct_reviewers,
    "refresh_product_stats": q_refresh_product_stats,
    "refresh_monthly": q_refresh_monthly,
    "refresh_dim_categories": q_refresh_dim_categories,
    # step 6: calendar
    "date_bounds": q_date_bounds,
    "date_dimension": _wh("dim_dates"),
    "date_dimension_all": lambda spark, d: date_dimension(warehouse(spark, d).stg_reviews),
    # step 7: history
    "scd2_apply": q_scd2_apply,
    "scd2_as_of": q_scd2_as_of,
    "reviews_as_of_products": q_reviews_as_of_products,
    # step 8: quality
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_accepted_values": q_check_accepted_values,
    "check_relationship": q_check_relationship,
    "check_non_negative": q_check_non_negative,
    "run_checks": q_run_checks,
    "warehouse_checks": q_warehouse_checks,
    "observed_checks": q_observed_checks,
    # step 9: profiling and sources
    "value_counts": q_value_counts,
    "value_share": q_value_share,
    "describe_columns": q_describe_columns,
    "heavy_reviewers": q_heavy_reviewers,
    "heavy_words": q_heavy_words,
    "coverage": q_coverage,
    "profile_table": q_profile_table,
    "profile_joined_categories": q_profile_joined_categories,
    "profile_samples": q_profile_samples,
    "sample_n": q_sample_n,
    "stringify_nested": q_stringify_nested,
    "stringify_nested_text": q_stringify_nested_text,
    "safe_divide": q_safe_divide,
    "value_counts_main_category": _value_counts("main_category"),
    "value_counts_price_bucket": _value_counts("price_bucket"),
    "classify_default_rules": q_classify_default_rules,
    "classify_by_rule_index": q_classify_by_rule_index,
    # the build's table mode, ingestion and stored history
    "table_products_at_risk": _wh("mart_products_at_risk", materialize="table"),
    "table_category_performance": _wh("mart_category_performance", materialize="table"),
    "table_dim_products": _wh("dim_products", materialize="table"),
    "bucketed_products_at_risk": _bucketed("mart_products_at_risk"),
    "bucketed_reviewer_context": _bucketed("reviews_with_context"),
    "clustered_reviews": q_clustered_reviews,
    "ingest_reviews": q_ingest_reviews,
    "ingest_products": q_ingest_products,
    "ingest_lines": q_ingest_lines,
    "ingest_rejects": q_ingest_rejects,
    "classify_seeded_rules": q_classify_seeded_rules,
    "scd2_snapshot_history": q_scd2_snapshot_history,
}
