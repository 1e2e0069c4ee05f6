"""What queries leave on disk: reviews move once, and shuffles end with their write."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from revlens.operators import quality as Q
from revlens.operators.reviewers import by_product, first_of_pair, reviewer_history, with_reviewer_context
from revlens.operators.rollups import monthly_rollup
from revlens.operators.skew import hot_keys
from revlens.operators.staging import clean_reviews, derived_facts, fct_reviews, reviews_by_reviewer
from revlens.plans import checks, queries
from revlens.plans.refresh import MonthSlots
from revlens.session import FREE_SHUFFLES, freed_shuffles
from revlens.sources.clustering import write_clustered
from revlens.sources.io import materialize

from .conftest import SF_SMALL


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def odd_reviews(spark, n=3000):
    """A reviewer with a third of the reviews, copies, null reviewers, products and times."""
    r = random.Random(7)
    out = []
    for i in range(n):
        who = "hot" if r.random() < 0.33 else None if r.random() < 0.1 else f"u{r.randrange(60)}"
        what = None if r.random() < 0.05 else f"p{r.randrange(25)}"
        when = None if r.random() < 0.05 else 1_600_000_000_000 + 86_400_000 * r.randrange(40)
        out.append((what, f"{what}-{i % 2}", who, "t", "word " * r.randrange(1, 4), float(r.randrange(1, 6)), r.randrange(3), r.random() < 0.5, when))
    schema = "parent_asin string, asin string, user_id string, title string, text string, rating double, helpful_vote int, verified_purchase boolean, timestamp long"
    return clean_reviews(spark.createDataFrame(out, schema))


def shuffle_files(spark) -> int:
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return sum(f.startswith("shuffle_") for d in dirs for _, _, fs in os.walk(d.toString()) for f in fs)


def test_a_write_leaves_no_shuffle_files(spark, tmpdir_path):
    before = shuffle_files(spark)
    spark.range(1000).repartition(7, "id").write.parquet(f"{tmpdir_path}/plain")
    plain = shuffle_files(spark)
    assert plain > before
    materialize(spark.range(1000).repartition(7, "id"), "t", path=f"{tmpdir_path}/t")
    for _ in range(50):  # files go soon after the write
        if shuffle_files(spark) <= plain:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= plain


def test_models_of_a_ranked_queue_move_narrow_rows_once(spark, monkeypatch):
    plans, keep = {}, queries.Warehouse._keep

    def seen(self, name, df, *a, **kw):
        plans[name] = plan(df)
        return keep(self, name, df, *a, **kw)

    monkeypatch.setattr(queries.Warehouse, "_keep", seen)
    queue = queries.QUERIES["rank_at_risk"](spark, SF_SMALL)
    assert "REBALANCE" not in plans["fct_reviews"]
    for name in ("reviewer_history", "product_review_facts"):
        assert "REPARTITION_BY_COL" in plans[name], name
    risk = queries.QUERIES["products_at_risk"](spark, SF_SMALL)
    assert rows(queue.select("product_id", "risk_score")) == rows(risk.select("product_id", "risk_score"))


def test_the_session_gets_its_setting_back(spark):
    had = spark.conf.get(FREE_SHUFFLES)
    with freed_shuffles(spark):
        with freed_shuffles(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    assert spark.conf.get(FREE_SHUFFLES) == had


@pytest.mark.parametrize("rows_per_split", [20, 10**6])
def test_reviews_dealt_to_their_reviewers(spark, no_broadcast, rows_per_split):
    stg = odd_reviews(spark)
    history = reviewer_history(stg)
    hot = hot_keys(history, "reviewer_id", "lifetime_review_count", rows_per_split)
    facts = derived_facts(reviews_by_reviewer(stg, hot, "part"), "part")
    assert rows(facts.drop("part")) == rows(fct_reviews(stg))
    assert (facts.where("reviewer_id = 'hot'").select("part").distinct().count() > 3) == (rows_per_split == 20)
    context = with_reviewer_context(facts, history, rows_per_split, "part")
    assert rows(context.drop("part")) == rows(with_reviewer_context(fct_reviews(stg), history))


def test_context_is_made_where_the_reviews_were_deduplicated(spark, no_broadcast):
    for query in ("reviewer_context", "products_at_risk", "signal_counts", "top_at_risk"):
        text = plan(queries.QUERIES[query](spark, SF_SMALL))
        assert "o_custkey" not in text, query  # the reviews are built once
    text = plan(queries.QUERIES["reviewer_context"](spark, SF_SMALL))
    joined = text[text.index("LeftOuter"):]
    at = joined.index("Window")
    assert "Exchange" not in joined[:at]  # from the dedup to the join nothing moves


def test_history_in_parts(spark):
    stg = odd_reviews(spark)
    assert rows(reviewer_history(stg, in_parts=True)) == rows(reviewer_history(stg))
    assert reviewer_history(stg.limit(0), in_parts=True).count() == 0


def test_rows_by_product_sum_up_alike(spark):
    stg = odd_reviews(spark)
    context = with_reviewer_context(fct_reviews(stg), reviewer_history(stg), 50, "part")
    context = context.withColumn("first_of_pair", first_of_pair(context, "part"))
    moved = by_product(context)
    assert rows(moved) == rows(context.select(moved.columns))


def test_narrow_months(spark, no_broadcast):
    facts = fct_reviews(odd_reviews(spark))
    assert rows(monthly_rollup(facts, narrow=True)) == rows(monthly_rollup(facts))
    text = plan(monthly_rollup(facts, narrow=True))
    assert "Exchange" not in text[: text.index("REPARTITION_BY_COL")].rpartition("Exchange")[0]  # sums stay where the rows came


def test_facts_move_once_to_their_month(spark):
    wh = queries.warehouse(spark, SF_SMALL, materialize="table")
    text = plan(wh._reviews_by_month)
    assert "REBALANCE" not in text and text.count("Exchange") - text.count("BroadcastExchange") == 1
    assert rows(wh.fct_reviews.drop("review_month")) == rows(queries.warehouse(spark, SF_SMALL).fct_reviews)


def test_rows_that_were_not_counted_keep_a_place(spark):
    stg = odd_reviews(spark)
    tasks = MonthSlots([(None, 0, 0, 1)], 3)
    assert tasks.dealt(stg).count() == stg.count()
    assert rows(fct_reviews(tasks.dealt(stg), slots=3).drop("review_month", "first_of_month")) == rows(fct_reviews(stg))


@pytest.mark.parametrize("values", [["a", "b", "c"], ["a", "a", "b", None, None], [None], ["é", "é", "x", "x", "y"]])
def test_unique_by_hash_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    want = Q.check_unique(df, "v").count()
    assert [r.failures for r in Q.run_checks(df, [Q.Check("unique", "v")]).collect()] == [want]


def test_texts_that_are_unique_do_not_move(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("v"))
    assert Q._suspects(df, "v").count() == 0
    again = df.unionByName(df.limit(1))
    assert 2 <= Q._suspects(again, "v").count() < 20


def test_facts_that_are_read_again_are_deduplicated_once(spark):
    for query in ("reviews_as_of_products", "check_relationship", "run_checks"):
        assert "o_custkey" not in plan(queries.QUERIES[query](spark, SF_SMALL)), query


def test_context_is_tested_as_a_table(spark):
    wh = queries.warehouse(spark, SF_SMALL, materialize="table")
    text = plan(checks.run_suite(wh, ["reviews_with_context"]))
    assert "Join" not in text
    assert rows(checks.run_suite(wh, ["reviews_with_context"])) == rows(checks.run_suite(queries.warehouse(spark, SF_SMALL), ["reviews_with_context"]))


def test_keys_of_reviews_do_not_move_to_their_history(spark, no_broadcast):
    stg = odd_reviews(spark)
    facts, history = fct_reviews(stg), reviewer_history(stg)
    context = with_reviewer_context(facts, history, 50, "part")
    assert rows(context.drop("part")) == rows(with_reviewer_context(facts, history, 50))
    stored = spark.createDataFrame(facts.limit(1).collect(), facts.schema)
    text = plan(with_reviewer_context(stored, history, 50, "part"))
    below = text[text.index("LeftOuter"):]
    assert "review_key" not in below[: below.index("Scan")]


def test_clustered_rows_derive_after_the_move(spark, tmpdir_path):
    df = spark.range(300).select("id", (F.col("id") % 7).alias("k"))
    seen = []

    def derive(moved):
        seen.append(moved.columns)
        return moved.withColumn("twice", F.col("id") * 2)

    write_clustered(df, f"{tmpdir_path}/c", ["k", "id"], derive=derive)
    assert seen == [["id", "k"]]
    assert rows(spark.read.parquet(f"{tmpdir_path}/c")) == rows(df.withColumn("twice", F.col("id") * 2))


def test_buckets_are_written_where_reviews_were_deduplicated(spark):
    i = queries.Inputs(spark, SF_SMALL)
    wh = queries.BucketedWarehouse(i.landed_reviews(), i.products(), i.mapping(), i.rules(), bucket_bytes=20_000, rows_per_split=100)
    by = wh.by_reviewer
    text = plan(reviews_by_reviewer(wh.stg_reviews, by.hot, "bucket_part", by.buckets))
    assert by.buckets > 1 and "REPARTITION_BY_NUM" in text
    assert rows(wh.fct_reviews) == rows(fct_reviews(wh.stg_reviews))
