"""Mergeable distinct counts against count(distinct)."""

import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import distinct as D


def visits(spark, n=3000, seed=5):
    """A reviewer with a third of the rows, null keys and values, many reviewers."""
    r = random.Random(seed)
    rows = [
        (r.randint(0, 9) or None, f"p{r.randint(0, 20)}", "hot" if r.random() < 0.33 else None if r.random() < 0.1 else f"u{r.randint(0, 900)}")
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "day int, product string, reviewer string").repartition(4)


def counts(df, keys, name="n"):
    return {tuple(r[k] for k in keys): r[name] for r in df.collect()}


@pytest.mark.parametrize("sparse", [0, 3, 512])
def test_rolls_up_to_every_level(spark, monkeypatch, sparse):
    monkeypatch.setattr(D, "SPARSE", sparse)
    df = visits(spark)
    sets = D.distinct_sets(df, "reviewer", ["day", "product"], D.dense_ids(df, "reviewer"))
    for keys in (["day", "product"], ["day"], ["product"], []):
        want = counts(df.where("reviewer is not null").groupBy(*keys).agg(F.countDistinct("reviewer").alias("n")), keys)
        assert counts(D.distinct_counts(sets, keys, "n"), keys) == want


def test_ids_in_many_buckets(spark):
    df = spark.range(70_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    ids = D.dense_ids(df, "v")
    assert [tuple(r) for r in ids.agg(F.min("id"), F.max("id"), F.count_distinct("id")).collect()] == [(1, 70_000, 70_000)]
    sets = D.distinct_sets(df, "v", ["g"], ids)
    assert sets.select("bucket").distinct().count() == 3
    assert sets.where("bits is not null and positions is not null or bits is null and positions is null").count() == 0
    assert counts(D.distinct_counts(sets, [], "n"), []) == {(): 70_000}


def test_a_later_load_adds_to_the_sets(spark):
    df = visits(spark)
    first, second = df.where("day < 6 or reviewer = 'hot'"), df.where("day >= 4 or day is null")
    ids = D.dense_ids(first, "reviewer")
    more = D.dense_ids(second, "reviewer", ids)
    assert more.join(ids, ["value", "id"], "left_anti").count() == more.count() - ids.count()
    sets = D.distinct_sets(first, "reviewer", ["product"], ids).unionByName(D.distinct_sets(second, "reviewer", ["product"], more))
    both = first.unionByName(second).where("reviewer is not null").groupBy("product").agg(F.countDistinct("reviewer").alias("n"))
    assert counts(D.distinct_counts(sets, ["product"], "n"), ["product"]) == counts(both, ["product"])


def test_empty_table(spark):
    df = visits(spark).limit(0)
    sets = D.distinct_sets(df, "reviewer", ["day"], D.dense_ids(df, "reviewer"))
    assert D.distinct_counts(sets, ["day"]).count() == 0


def test_lists_never_become_bitmaps(spark):
    # 4,000 groups of one position each: as bitmaps 16 MB
    sets = spark.range(4000).select(
        F.col("id").alias("product"), F.col("id").alias("bucket"), F.array((F.col("id") % 32768).cast("int")).alias("positions"), F.lit(None).cast("binary").alias("bits")
    )
    out = D.distinct_counts(sets, ["product"], "n")
    assert "bitmap_construct_agg" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("n = 1").count() == 4000


def test_lists_and_bitmaps_of_one_group(spark):
    few = [(1, 0, [0, 7, 8, 9, 32767]), (1, 1, [5]), (2, 0, [5, 6]), (None, 0, [1, 2])]
    sets = spark.createDataFrame(few, "g int, bucket long, positions array<int>").withColumn("bits", F.lit(None).cast("binary"))
    many = spark.range(2, 600).select(F.lit(1).alias("g"), F.lit(0).cast("long").alias("bucket"), F.col("id").alias("p"))
    many = many.unionByName(spark.range(600).select(F.lit(None).cast("int").alias("g"), F.lit(0).cast("long").alias("bucket"), (F.col("id") * 3).alias("p")))
    bits = many.groupBy("g", "bucket").agg(F.bitmap_construct_agg("p").alias("bits")).withColumn("positions", F.lit(None).cast("array<int>"))
    got = counts(D.distinct_counts(sets.unionByName(bits), ["g"], "n"), ["g"])
    assert got == {(1,): 598 + 2 + 1, (2,): 2, (None,): 602}
