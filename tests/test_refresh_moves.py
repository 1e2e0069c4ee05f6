"""A load moves whole reviews once, and crowded months are dealt to several tasks."""

import datetime as dt
from collections import Counter

import pytest

from revlens.operators.distinct import dense_ids, distinct_counts, distinct_sets
from revlens.plans import refresh
from revlens.plans.refresh import MonthSlots, ReviewStore

from .test_refresh import FIRST, SECOND, expected, reviews, rows


def written(store, monkeypatch, raw):
    """Table -> plan and columns of what a load writes."""
    plans, write = {}, ReviewStore._write

    def record(df, path):
        plans[path.split("/")[-2]] = (df._jdf.queryExecution().executedPlan().toString(), df.columns)
        write(df, path)

    with monkeypatch.context() as m:
        m.setattr(ReviewStore, "_write", staticmethod(record))
        store.load(raw)
    return plans


def test_whole_reviews_move_once(spark, tmpdir_path, monkeypatch):
    store = ReviewStore(spark, tmpdir_path)
    store.load(reviews(spark, FIRST))
    plans = written(store, monkeypatch, reviews(spark, SECOND))
    facts, columns = plans["facts"]
    moves = [x for x in facts.split("\n") if "Exchange" in x and "BroadcastExchange" not in x]
    assert len(moves) == 1 and "REPARTITION_BY_NUM" in moves[0]
    assert "review_key" not in columns and "review_text" in columns
    assert "review_key" in store.facts.columns and "first_of_month" not in store.facts.columns
    assert plans["monthly"][0].count("Exchange") == 0
    moves = [x for x in plans["states"][0].split("\n") if "Exchange" in x and "BroadcastExchange" not in x]
    assert len(moves) == 1 and "REPARTITION_BY_NUM" in moves[0]
    assert "Expand" not in plans["daily"][0]


def test_lists_of_sets_are_written_before_they_are_split(spark):
    df = spark.createDataFrame([(f"r{i % 7}", i % 3) for i in range(60)], "reviewer string, g int")
    sets = distinct_sets(df, "reviewer", ["g"], dense_ids(df, "reviewer"))
    assert "Exchange" not in sets.select("g", "bucket", "positions").where("bits is null")._jdf.queryExecution().executedPlan().toString()
    assert {r["g"]: r["n"] for r in distinct_counts(sets, ["g"], "n").collect()} == {0: 7, 1: 7, 2: 7}


def test_slots_hold_whole_buckets_until_they_are_full():
    jan, feb = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    dealt = MonthSlots.of(Counter({(jan, 0): 3, (jan, 1): 4, (feb, 0): 25, (feb, 1): 10, (None, 0): 1}), 10)
    assert dealt.rows == [(jan, 0, 0, 1), (jan, 1, 0, 1), (feb, 0, 1, 3), (feb, 1, 4, 1), (None, 0, 5, 1)]
    assert dealt.slots == 6 and dealt.crowded
    assert not MonthSlots.of(Counter({(jan, 0): 10}), 10).crowded
    products = MonthSlots.of_products(Counter({(jan, 0): 100, (jan, 5): 28}), 10)
    assert len(products.rows) == refresh.BUCKETS and products.slots == -(-refresh.BUCKETS // 5)


@pytest.mark.parametrize("per_task", [1, 7, 40])
def test_any_dealing_gives_one_build(spark, tmpdir_path, monkeypatch, per_task):
    monkeypatch.setattr(refresh, "ROWS_PER_TASK", per_task)
    product = lambda i: None if i % 17 == 0 else "hot" if i % 2 else f"p{i % 5}"
    user = lambda i: None if i % 7 == 0 else f"u{i % 4}"
    when = lambda i: None if i % 29 == 0 else f"2020-0{1 + i % 3}-{1 + i % 9 * 3:02d} 10:0{i % 2}:00"
    made = [(product(i), user(i), float(1 + i % 5), "text " * (i % 6), when(i)) for i in range(200)]
    made += [("hot", "u1", 3.0, "copy", "2020-01-31 10:00:00")] * 60
    first, second = reviews(spark, made[:120]), reviews(spark, made[120:])
    store = ReviewStore(spark, tmpdir_path)
    store.load(first)
    store.load(second)
    both = first.unionByName(second)
    assert (rows(store.product_review_stats), rows(store.monthly), rows(store.daily)) == expected(spark, both)
    assert rows(store.facts.drop("review_month")) == rows(refresh.fct_reviews(refresh.clean_reviews(both)))


def test_raw_reviews_that_change_between_reads_are_an_error(spark, tmpdir_path, monkeypatch):
    store = ReviewStore(spark, tmpdir_path)
    counted = refresh.count_buckets
    monkeypatch.setattr(refresh, "count_buckets", lambda df: counted(df) + Counter({(dt.date(1999, 1, 1), 0): 1}))
    with pytest.raises(RuntimeError, match="changed"):
        store.load(reviews(spark, FIRST))
    assert store.months() == {}


def test_days_of_states_count_products(spark):
    states = spark.createDataFrame(
        [("p", dt.date(2020, 2, 1), 0b101), ("q", dt.date(2020, 2, 1), 0b1), (None, dt.date(2020, 2, 1), 1), ("p", None, None), ("p", dt.date(2020, 3, 1), 1 << 30)],
        "product_id string, review_month date, days int",
    )
    got = {r["reviewed_date"]: r["products_reviewed"] for r in refresh.products_of_days(states).collect()}
    assert got == {dt.date(2020, 2, 1): 2, dt.date(2020, 2, 3): 1, None: 1, dt.date(2020, 3, 31): 1}
