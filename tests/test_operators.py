"""Dedup, classification, lookups, calendar and warehouse invariants."""

import datetime as dt

from pyspark.sql import functions as F

from revlens.operators import classify as C
from revlens.operators.calendar import SPINE_END, SPINE_START, date_dimension
from revlens.operators.classify import classify_by_rules, map_lookup
from revlens.operators.dedupe import keep_best
from revlens.plans.queries import warehouse
from revlens.sources.fixtures import RULES_SCHEMA
from tests.conftest import SF_SMALL


def test_keep_best_order_and_tiebreak(spark):
    df = spark.createDataFrame(
        [("k", 10, 1, "b"), ("k", 10, 1, "a"), ("k", 5, 9, "c"), ("j", None, 1, "z"), ("j", 1, None, "y")],
        "k string, len int, votes int, v string",
    )
    out = keep_best(df, ["k"], [F.col("len").desc_nulls_last(), F.col("votes").desc_nulls_last()], tiebreak=["v"])
    assert sorted((r.k, r.v) for r in out.collect()) == [("j", "y"), ("k", "a")]


def test_keep_best_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = keep_best(df, ["k"], [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


RULES = [("Rings", "ring|gizmo", 10), ("Small Red", "red|small", 5), ("Fasteners", "bolt|rod", 10),
         ("Alpha", "ring", 10)]


def test_rules_priority_then_label(spark):
    rules = spark.createDataFrame(RULES, RULES_SCHEMA)
    df = spark.createDataFrame([(1, "Small Ring"), (2, "small red"), (3, None), (4, "plate"), (5, "rod ring")],
                               "id int, title string")
    for size in (1, 2, 100):
        out = classify_by_rules(df, F.lower("title"), rules, rules_per_case=size)
        got = dict((r.id, r.subcategory) for r in out.collect())
        # ring matches Rings and Alpha at priority 10 → alphabetical: Alpha
        assert got == {1: "Alpha", 2: "Small Red", 3: "Uncategorized", 4: "Uncategorized", 5: "Alpha"}, size


def test_rules_beyond_one_expression_with_null_priority_and_null_key(spark):
    rules = spark.createDataFrame([("B", "ring", None), ("A", "ring", 1)] + [(f"Z{i}", f"word{i}\\b", 5) for i in range(250)], "subcategory string, keyword_pattern string, priority int")
    df = spark.createDataFrame([(None, "ring x"), (1, "word249 ring"), (1, "nothing")], "id int, title string")
    out = classify_by_rules(df, F.lower("title"), rules)
    assert sorted(r.subcategory for r in out.collect()) == ["A", "Uncategorized", "Z249"]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_map_lookup_defaults_and_broadcast(spark):
    m = spark.createDataFrame([("A", "G1", True)], "main_category string, category_group string, is_premium boolean")
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id int, main_category string")
    out = map_lookup(df, m, "main_category", {"category_group": "Unknown", "is_premium": False})
    assert sorted(tuple(r) for r in out.collect()) == [(1, "A", "G1", True), (2, "B", "Unknown", False), (3, None, "Unknown", False)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_calendar_clamp_and_labels(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 20),), (dt.date(2000, 3, 1),)], "reviewed_date date")
    cal = date_dimension(df, floor=SPINE_START, end=SPINE_END)
    rows = cal.orderBy("date").collect()
    assert rows[0].date == dt.date(2000, 1, 1)  # min − 30 days clipped by the spine floor
    assert rows[-1].date == dt.date(2000, 3, 31)
    r = [x for x in rows if x.date == dt.date(2000, 1, 2)][0]
    assert (r.day_name, r.day_of_week, r.is_weekend, r.month_name, r.year_month, r.quarter_label) == \
        ("Sunday", 0, True, "January", "2000-01", "Q1 2000")
    # without bounds the padding shows on both sides; an empty range and no dates yield no rows
    assert date_dimension(df).agg(F.min("date")).first()[0] == dt.date(1999, 12, 21)
    late = spark.createDataFrame([(dt.date(2030, 1, 1),)], "reviewed_date date")
    assert date_dimension(late).count() == 61
    assert date_dimension(late, floor=SPINE_START, end=SPINE_END).count() == 0
    assert date_dimension(df.where("false")).count() == date_dimension(df.where("false"), floor=SPINE_START, end=SPINE_END).count() == 0


def test_warehouse_invariants(spark):
    wh = warehouse(spark, SF_SMALL)
    s = wh.product_review_stats
    assert s.where("positive_review_count + neutral_review_count + negative_review_count != review_count").count() == 0
    assert s.where("five_star_count + four_star_count + three_star_count + two_star_count + one_star_count != review_count").count() == 0
    r = wh.mart_products_at_risk
    assert r.where("risk_score < 0 or risk_score > 100").count() == 0
    assert r.where("our_review_count < 5 and risk_score > 30").count() == 0
    # every tendency occurs and fact keys are unique
    tend = {x[0] for x in wh.reviewer_history.select("reviewer_tendency").distinct().collect()}
    assert tend == {"harsh", "balanced", "generous", "insufficient_data"}
    f = wh.fct_reviews
    assert f.count() == f.select("review_key").distinct().count()


def test_materialized_warehouse_equals_lazy(spark):
    lazy = warehouse(spark, SF_SMALL)
    table = warehouse(spark, SF_SMALL, materialize="table")
    a, b = lazy.mart_products_at_risk, table.mart_products_at_risk
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_default_seed_rules(spark):
    from revlens.sources.seeds import default_category_mapping, default_subcategory_rules

    titles = [(1, "Hydrating Face Cream 50ml"), (2, "Lip Gloss + Mascara set"), (3, "Makeup Sponge Mirror"),
              (4, "Round Brush with Mirror"), (5, "Plain soap")]
    df = spark.createDataFrame(titles, "id int, title string")
    got = dict((r.id, r.subcategory) for r in classify_by_rules(df, F.lower("title"), default_subcategory_rules(spark)).collect())
    # equal priority → alphabetical label; priority 10 beats the priority-5 tools rule
    assert got == {1: "Skincare", 2: "Eye Makeup", 3: "Beauty Tools", 4: "Hair Tools", 5: "Uncategorized"}
    m = map_lookup(spark.createDataFrame([("Premium Beauty",), ("Other",)], "main_category string"),
                   default_category_mapping(spark), "main_category", {"category_group": "Unknown", "is_premium": False})
    assert sorted(tuple(r) for r in m.collect()) == [("Other", "Unknown", False), ("Premium Beauty", "Beauty", True)]


def wh_levels():
    from revlens.plans.warehouse import Warehouse

    return Warehouse.TEST_LEVELS


def test_build_writes_every_model(spark, tmpdir_path):
    import os

    from revlens.plans.checks import run_suite

    from revlens.plans.checks import suite_models

    tested = [m for level in wh_levels() for m in level]
    assert sorted(tested) == sorted(suite_models())  # every tested model, once
    wh = warehouse(spark, SF_SMALL, materialize="table", output_root=f"{tmpdir_path}/marts")
    timings = wh.build(threads=3, tests=True, extra={"column_tests": run_suite})
    names = {n for level in wh.LEVELS for n in level}
    assert names <= set(timings) and "column_tests" in timings
    assert {f"tests:{m}" for m in tested} <= set(timings)
    assert names <= set(os.listdir(f"{tmpdir_path}/marts"))
    lazy = warehouse(spark, SF_SMALL)
    for name in ("mart_products_at_risk", "fct_reviews_daily", "dim_dates"):
        a, b = wh.table(name), getattr(lazy, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_month_partitioned_fact_table(spark, tmpdir_path):
    from revlens.operators.staging import fct_reviews

    lazy = warehouse(spark, SF_SMALL)
    plan = fct_reviews(lazy.stg_reviews, cluster_by_month=True)._jdf.queryExecution().executedPlan().toString()
    # dedup keeps its partial group limit before the hash exchange; the month layout comes after
    assert plan.count("WindowGroupLimit") == 2 and "REBALANCE_PARTITIONS_BY_COL" in plan and "rangepartitioning" not in plan
    wh = warehouse(spark, SF_SMALL, materialize="table", output_root=f"{tmpdir_path}/m")
    assert "review_month" in wh.fct_reviews.columns
    recent = wh.recent_sentiment
    scan = [l for l in recent._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in l]
    assert any("review_month" in l.split("PartitionFilters")[1] for l in scan)
    a, b = recent, lazy.recent_sentiment
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_output_column_contracts(spark):
    from revlens.operators.risk import RISK_COLUMNS
    from revlens.operators.staging import FACT_COLUMNS, PRODUCT_COLUMNS, REVIEW_COLUMNS

    wh = warehouse(spark, SF_SMALL)
    assert wh.stg_reviews.columns == REVIEW_COLUMNS
    assert wh.fct_reviews.columns == FACT_COLUMNS
    assert wh.stg_products.columns == PRODUCT_COLUMNS
    assert wh.mart_products_at_risk.columns == RISK_COLUMNS
    expected_widths = {
        "product_review_stats": 23, "reviewer_history": 16, "reviews_with_context": 22, "dim_products": 33,
        "dim_reviewers": 18, "dim_categories": 13, "dim_dates": 15, "fct_reviews_daily": 9,
        "fct_reviews_monthly": 13, "mart_category_performance": 14,
    }
    for name, width in expected_widths.items():
        assert len(getattr(wh, name).columns) == width, name


def test_dedup_keeps_the_same_row_for_any_input_order(spark):
    from revlens.operators.staging import clean_reviews, fct_reviews

    rows = [("P", "V", "U", r, "t", "same text", dt.datetime(2020, 1, 1), 1, v) for r in (1.0, 5.0) for v in (True, False)]
    schema = "parent_asin string, asin string, user_id string, rating double, title string, text string, timestamp timestamp_ntz, helpful_vote int, verified_purchase boolean"
    kept = {tuple(fct_reviews(clean_reviews(spark.createDataFrame(x, schema).coalesce(1))).select("rating", "is_verified_purchase").first()) for x in (rows, rows[::-1])}
    assert kept == {(1, False)}


def test_category_average_is_exact_at_ties(spark):
    """An average of 3.6595 rounds up in any order of rows; no ratings give null."""
    from revlens.operators.rollups import category_rollup

    day = dt.date(2020, 1, 1)
    rows = [("g", "tie", x) for x in [3.66] * 19 + [3.65]] + [("g", "none", None)]
    products = spark.createDataFrame(
        [(g, s, 1, 1, False, x, 0, 0, 1, day, day) for g, s, x in rows],
        "category_group string, subcategory string, our_review_count long, distinct_reviewer_count long, is_premium boolean, our_avg_rating double, "
        "positive_review_count long, negative_review_count long, neutral_review_count long, first_reviewed_date date, last_reviewed_date date",
    )
    for order in ("our_avg_rating", F.desc("our_avg_rating")):
        got = {r["subcategory"]: r["avg_product_rating"] for r in category_rollup(products.repartition(1).sortWithinPartitions(order)).collect()}
        assert got == {"tie": 3.66, "none": None}
