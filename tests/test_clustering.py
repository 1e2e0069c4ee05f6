"""Clustered tables: the same rows, and few row groups for a filter on either column."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from revlens.sources.clustering import rank_bounds, write_clustered


def groups(path):
    """(column -> least and most) of every row group, from the footers."""
    out = []
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            cols = [meta.row_group(g).column(i) for i in range(meta.num_columns)]
            out.append({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in cols if c.statistics and c.statistics.has_min_max})
    return out


def share(path, column, low, high):
    found = groups(path)
    return sum(column in g and g[column][0] <= high and g[column][1] >= low for g in found) / len(found)


@pytest.fixture()
def small_files(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def table(spark, n=40_000):
    i = F.col("id")
    return spark.range(n).select(
        F.format_string("P%05d", F.pmod(F.xxhash64(i), F.lit(5000))).alias("product"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64(i, F.lit(2)), F.lit(700)).cast("int")).alias("day"),
        F.when(i % 50 > 0, F.pmod(F.xxhash64(i, F.lit(3)), F.lit(1000)).cast("int")).alias("v"), (i * 2).alias("place"),
    )


def test_filters_on_either_column_read_few_row_groups(spark, tmpdir_path, small_files):
    import datetime as dt

    df = table(spark)
    write_clustered(df, f"{tmpdir_path}/z", ["product", "day"], row_group_bytes=8_000)
    df.orderBy("product").write.option("parquet.block.size", 8_000).option("parquet.block.size.row.check.min", 100).parquet(f"{tmpdir_path}/sorted")
    day, product = (dt.date(2021, 3, 1), dt.date(2021, 3, 7)), ("P01000", "P01050")
    assert len(groups(f"{tmpdir_path}/z")) > 60
    # either column alone cuts the table to about the root of its row groups; a sort helps one
    assert share(f"{tmpdir_path}/z", "day", *day) < 0.3 and share(f"{tmpdir_path}/z", "product", *product) < 0.3
    assert share(f"{tmpdir_path}/sorted", "day", *day) > 0.9
    read = spark.read.parquet(f"{tmpdir_path}/z")
    assert read.dtypes == df.dtypes and read.exceptAll(df).count() == 0 == df.exceptAll(read).count()
    some = f"day between '{day[0]}' and '{day[1]}'"
    assert sorted(map(str, read.where(some).collect())) == sorted(map(str, df.where(some).collect()))


def test_nulls_repeats_and_a_hot_value(spark, tmpdir_path, small_files):
    df = table(spark, 3000).withColumn("v", F.when(F.col("place") % 3 == 0, F.lit(7)).otherwise(F.col("v"))).unionByName(table(spark, 5))
    write_clustered(df, f"{tmpdir_path}/z", ["v", "product"], bits=4)
    read = spark.read.parquet(f"{tmpdir_path}/z")
    assert read.exceptAll(df).count() == 0 == df.exceptAll(read).count()
    counts = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmpdir_path}/z/*.parquet")]
    assert max(counts) < 1000 and len(counts) > 5


def test_bounds_and_wrong_columns(spark, tmpdir_path):
    df = spark.range(6400).select("id", F.lit(5).alias("same"), F.lit(None).cast("int").alias("none"), F.array("id").alias("list"))
    ids, same, none = rank_bounds(df, ["id", "same", "none"])
    assert len(ids) == 63 and all(abs(b - 100 * (i + 1)) <= 3 for i, b in enumerate(ids)) and same == [5] and none == []
    write_clustered(df, f"{tmpdir_path}/z", ["same", "none", "id"])
    assert spark.read.parquet(f"{tmpdir_path}/z").count() == 6400
    write_clustered(df.limit(0), f"{tmpdir_path}/empty", ["id"])
    assert spark.read.schema(df.schema).parquet(f"{tmpdir_path}/empty").count() == 0
    for columns in ([], ["list"]):
        with pytest.raises((ValueError, TypeError)):
            write_clustered(df, f"{tmpdir_path}/x", columns)
    with pytest.raises(ValueError):
        write_clustered(df, f"{tmpdir_path}/x", ["id", "same"], bits=40)
