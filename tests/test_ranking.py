"""Distributed positions, ranks and percentiles against DuckDB's windows."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from revlens.operators.ranking import number_rows, rank_rows


def table(spark, n, hot, seed=1):
    """Scores of which ``hot`` share one value, a few null; ids unique."""
    r = random.Random(seed)
    rows = [(7 if r.random() < hot else r.randint(0, 40) if r.random() < 0.9 else None, i, f"t{i % 5}") for i in range(n)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "score int, id long, place string").repartition(5)


@pytest.mark.parametrize("n, hot", [(0, 0), (1, 0), (300, 0.0), (2000, 0.4), (500, 1.0)])
def test_positions_and_ranks(spark, n, hot):
    df = table(spark, n, hot)
    got = rank_rows(df, ["score desc", "id"]).toPandas().sort_values("id").reset_index(drop=True)
    t = df.toPandas()  # noqa: F841 (DuckDB reads it)
    t["score"] = t["score"].astype("Int64")
    want = duckdb.sql(
        "select *, row_number() over (order by score desc nulls last, id) queue_position,"
        " rank() over (order by score desc nulls last) queue_rank,"
        " percent_rank() over (order by score desc nulls last) queue_percent from t order by id"
    ).df()
    assert list(got.columns) == list(want.columns)
    for c in ("id", "place", "queue_position", "queue_rank", "queue_percent"):
        assert got[c].tolist() == want[c].tolist(), c
    assert pd.isna(got["score"]).tolist() == pd.isna(want["score"]).tolist()


def test_a_run_of_ties_spans_ranges(spark):
    df = table(spark, 4000, 0.7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = rank_rows(df, ["score desc", "id"]).where(F.col("score") == 7)
        assert out.select("queue_rank").distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_rows_get_successive_numbers_and_clashing_names_stay(spark):
    df = spark.createDataFrame([(1, 5, 9)] * 50, "row int, `range` int, tie int").coalesce(1)
    out = number_rows(df, ["row", "tie desc"])
    assert out.columns == ["row", "range", "tie", "number"]
    assert sorted(r["number"] for r in out.collect()) == list(range(1, 51))


def test_no_window_over_all_rows(spark):
    plan = number_rows(table(spark, 50, 0.3), ["score desc", "id"])._jdf.queryExecution().toString()
    assert "Window [" not in plan


def test_wrong_order_is_refused(spark):
    with pytest.raises(ValueError):
        number_rows(table(spark, 3, 0), ["score down"])


@pytest.mark.parametrize("n", [0, 1, 400, 900, 5000])
def test_sample_where_a_third_of_the_keys_is_null(spark, n):
    from revlens.sources.sampling import sample_n

    df = spark.range(1200).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("key"), (F.col("id") % 90).alias("v"))
    a, b = (sample_n(df.repartition(p), n, 5, "key").collect() for p in (3, 7))
    assert len(a) == min(n, 1200) and sorted(map(str, a)) == sorted(map(str, b))
    ranked = df.orderBy(F.md5(F.concat(F.lit("5"), F.coalesce("key", F.lit("")))), F.col("key").asc_nulls_last()).limit(n).collect()
    assert sorted(str(r["key"]) for r in a) == sorted(str(r["key"]) for r in ranked)


def test_sample_cuts_null_keys_by_ranges(spark):
    from revlens.sources.sampling import sample_n

    plan = sample_n(spark.range(100).select(F.lit(None).cast("string").alias("key"), "id"), 10, 5, "key")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan
