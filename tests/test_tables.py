"""Tables replaced whole or not at all, rejected lines, seeds, column figures, heavy values."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.profiling import describe_columns, heavy_values, value_counts
from revlens.plans.warehouse import Warehouse
from revlens.sources import io
from revlens.sources.fixtures import Inputs
from revlens.sources.seeds import RULES_SCHEMA
from tests.conftest import SF_SMALL


def ids(spark, path):
    return sorted(r["id"] for r in io.read_table(spark, path).collect())


def test_a_write_that_fails_leaves_the_old_rows(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    io.write_table(spark.range(3), path)
    broken = spark.range(100).select(F.when(F.col("id") < 60, F.col("id")).otherwise(F.raise_error(F.lit("half way"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="half way"):
        io.write_table(broken, path)
    assert ids(spark, path) == [0, 1, 2] and os.listdir(tmpdir_path) == ["t"]
    io.write_table(spark.read.parquet(path).where("id > 0"), path)  # a table may replace itself
    assert ids(spark, path) == [1, 2] and os.listdir(tmpdir_path) == ["t"]
    io.write_table(spark.range(5, 6), path, mode="append")
    assert ids(spark, path) == [1, 2, 5]


@pytest.mark.parametrize("lost", ["before the new table is moved in", "before the old table is deleted"])
def test_a_driver_lost_while_publishing(spark, tmpdir_path, monkeypatch, lost):
    path = f"{tmpdir_path}/t"
    io.write_table(spark.range(3), path)
    staged = io.next_folder(path)
    spark.range(7, 9).write.parquet(staged)
    last = staged.replace(".next-", ".last-")
    os.rename(path, last)
    if lost.startswith("before the old"):
        os.rename(staged, path)
    assert ids(spark, path) == [7, 8]
    assert io._beside(spark, path, "next") == {}


def test_old_state_returns_when_the_new_one_is_gone(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    io.write_table(spark.range(3), path)
    os.rename(path, f"{path}.last-abc")
    assert ids(spark, path) == [0, 1, 2]


def test_a_failed_rebuild_leaves_the_whole_build_before(spark, tmpdir_path, monkeypatch):
    i = Inputs(spark, SF_SMALL)
    make = lambda reviews: Warehouse(reviews, i.products(), i.mapping(), i.rules(), materialize="table", output_root=f"{tmpdir_path}/marts")
    first = make(i.reviews())
    first.build(threads=2)
    before = {n: io.read_table(spark, f"{tmpdir_path}/marts/{n}").count() for n in os.listdir(f"{tmpdir_path}/marts")}
    assert len(before) == 12
    second = make(i.reviews().where("rating = 1"))
    monkeypatch.setattr(Warehouse, "dim_categories", property(lambda self: 1 / 0))
    with pytest.raises(ZeroDivisionError):
        second.build(threads=2)
    after = {n: io.read_table(spark, f"{tmpdir_path}/marts/{n}").count() for n in os.listdir(f"{tmpdir_path}/marts")}
    assert after == before and os.listdir(tmpdir_path) == ["marts"]
    # what the first warehouse hands out still reads the published tables
    assert first.table("mart_products_at_risk").count() == before["mart_products_at_risk"]
    assert first.reviews_with_context.count() == before["fct_reviews"]


LINES = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.ArrayType(T.DoubleType()))])


def test_rejected_lines(spark, tmpdir_path):
    good = ['{"a": 1, "b": "x", "c": [1.5]}', '{"b": "no a", "other": 1}', " {} ", '{"a": null}']
    bad = ['{"a": 1', "[1, 2]", '[{"a": 1}]', '"text"', '{"a": "word"}', "not json at all", '{"c": {"d": 1}}']
    os.makedirs(f"{tmpdir_path}/in")
    open(f"{tmpdir_path}/in/one.json", "w").write("\n".join([*good, "", "   ", *bad[:3]]))
    open(f"{tmpdir_path}/in/two.json", "w").write("\n".join([*bad[3:], good[0]]))
    lines = io.read_json_lines(spark, f"{tmpdir_path}/in", LINES)
    assert sorted(map(tuple, lines.rows.collect()), key=str) == sorted([(1, "x", [1.5]), (None, "no a", None), (None, None, None), (None, None, None), (1, "x", [1.5])], key=str)
    got = {r["line"]: r["reason"] for r in lines.rejects.collect()}
    assert got == {
        bad[0]: "malformed", bad[1]: "not an object", bad[2]: "not an object", bad[3]: "not an object",
        bad[4]: "wrong type", bad[5]: "malformed", bad[6]: "wrong type",
    }
    summary = {(os.path.basename(r["file"]), r["reason"]): (r["lines"], r["example"]) for r in io.reject_summary(lines.rejects).collect()}
    assert summary[("one.json", "not an object")] == (2, "[1, 2]") and len(summary) == 5
    assert io.read_json_lines(spark, f"{tmpdir_path}/in", LINES, max_bad_share=0.6).rows.count() == 5
    with pytest.raises(ValueError, match="7 of 12 lines"):
        io.read_json_lines(spark, f"{tmpdir_path}/in", LINES, max_bad_share=0.5)


def test_seed_round_trip(spark, tmpdir_path):
    rows = [('say "x", y', "a|b,c", 1), ("", "line\\nend", None), (None, "plain", -3), ("a\\", '"', 0), (" space ", " ", 5)]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in RULES_SCHEMA])
    df = spark.createDataFrame(rows, schema)
    io.write_seed(df, f"{tmpdir_path}/seed")
    read = io.read_seed(spark, f"{tmpdir_path}/seed", schema)
    want = df.replace("", None, subset=["subcategory"])  # an empty cell is a null
    assert sorted(map(str, read.collect())) == sorted(map(str, want.collect()))


def test_describe_columns(spark):
    df = spark.createDataFrame([(1, None, [1]), (None, None, [2]), (3, "x", None)], "a int, `b.c` string, d array<int>")
    assert [tuple(r) for r in describe_columns(df).collect()] == [
        (1, "a", "int", 2, 1, 0.3333), (2, "b.c", "string", 1, 2, 0.6667), (3, "d", "array<int>", 2, 1, 0.3333)]
    assert [r["null_share"] for r in describe_columns(df.limit(0)).collect()] == [None] * 3


@pytest.mark.parametrize("k", [1, 5, 40, 5000])
@pytest.mark.parametrize("kind", ["skewed", "even", "ties"])
def test_heavy_values(spark, k, kind):
    i = F.col("id")
    value = {"skewed": F.when(i % 3 == 0, F.lit("hot")).when(i % 7 == 0, None).otherwise(F.concat(F.lit("v"), F.floor(F.sqrt(i)).cast("string"))),
             "even": F.concat(F.lit("v"), (i % 900).cast("string")), "ties": F.concat(F.lit("v"), (i % 4).cast("string"))}[kind]
    df = spark.range(3600).select(value.alias("v"))
    want = value_counts(df, ["v"]).limit(k).collect()
    for buckets in (8, 1 << 16):
        assert heavy_values(df, "v", k, buckets=buckets).collect() == want
    assert heavy_values(df.limit(0), "v", k).collect() == []
