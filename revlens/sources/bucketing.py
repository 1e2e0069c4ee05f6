"""Stored co-partitioning: bucketed tables that join and aggregate without a shuffle.

A table that several marts join by one key is written once in buckets of that key, and
then read by bucket: a join of two tables with the same layout needs no exchange. The
number of buckets follows from the bytes. A key with more rows than ``rows_per_split``
would make one bucket too large: its rows get parts, by a hash of the row, the layout is
(key, part), and the unique rows of the other table are stored once per part.

Bucketed tables are tables of the session's catalog over files at a path of their own;
``open_bucketed`` declares such files in another session.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.skew import NULL_SPLITS, ROWS_PER_SPLIT, hot_keys
from revlens.session import freed_shuffles
from revlens.sources.io import stored_bytes  # noqa: F401

#: Bytes of a bucket, as stored.
BUCKET_BYTES = 256 << 20
PART = "bucket_part"


def bucket_count(total_bytes: int, bucket_bytes: int = BUCKET_BYTES, least: int = 1) -> int:
    """The power of two that keeps buckets at about ``bucket_bytes`` or below, so that
    tables of different size have numbers of buckets that divide each other."""
    n = max(least, 1)
    while n * bucket_bytes < total_bytes:
        n *= 2
    return 1 << (n - 1).bit_length()


@dataclass
class Layout:
    """How tables that join on ``key`` are stored. ``hot`` lists the keys that are cut
    into parts (``hot_keys``); it has fewer than rows / rows_per_split entries. Without
    it no key is cut and there are no parts: for tables with one row per key."""

    key: str
    buckets: int
    hot: DataFrame | None = None

    @property
    def columns(self) -> list[str]:
        return [self.key] if self.hot is None else [self.key, PART]

    def facts(self, df: DataFrame, spread: Sequence[str] = ()) -> DataFrame:
        """Rows with their part: a hash of ``spread`` (default: the whole row) in cut keys
        and for null keys, which match nothing and would else share a bucket; else 0."""
        whole = [F.col(c) for c in spread] or [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]
        found = df.join(F.broadcast(self.hot), df[self.key] == F.col("__hot_key"), "left")
        parts = F.when(F.col(self.key).isNull(), F.lit(NULL_SPLITS)).otherwise(F.coalesce("__splits", F.lit(1)))
        return found.withColumn(PART, F.pmod(F.xxhash64(*whole), parts).cast("int")).drop("__hot_key", "__splits")

    def dimension(self, df: DataFrame) -> DataFrame:
        """A unique-keyed table's rows, once for every part of their key."""
        found = df.join(F.broadcast(self.hot), df[self.key] == F.col("__hot_key"), "left")
        parts = F.sequence(F.lit(0), F.coalesce("__splits", F.lit(1)) - 1)
        return found.withColumn(PART, F.explode(parts)).drop("__hot_key", "__splits")

    def write(self, df: DataFrame, path: str, derive: Callable[[DataFrame], DataFrame] | None = None, in_place: bool = False) -> DataFrame:
        """Store rows that have a part; one file per bucket. The table that is read back.
        ``derive`` adds columns, row by row, to what has been moved. Rows that are ``in_place``
        have been moved by ``columns`` to as many tasks as there are buckets."""
        spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
        rows = df if in_place else df.repartition(self.buckets, *self.columns)
        rows = derive(rows) if derive else rows
        with freed_shuffles(spark):
            rows.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(self.buckets, *self.columns).sortBy(*self.columns).saveAsTable(name)
        return spark.table(name)


def layout(facts: DataFrame, key: str, buckets: int, counts: DataFrame | None = None, count_col: str = "n", rows_per_split: int = ROWS_PER_SPLIT) -> Layout:
    """The layout for ``facts`` and the tables joined to them on ``key``."""
    if counts is None:
        counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    return Layout(key, buckets, hot_keys(counts.where(F.col(key).isNotNull()), key, count_col, rows_per_split))


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """Files that ``Layout.write`` stored, as a bucketed table of this session."""
    name = f"bucketed_{uuid.uuid4().hex}"
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{c}`" for c in ([key, PART] if PART in schema.fieldNames() else [key]))
    spark.sql(f"create table {name} ({columns}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{path}'")
    return spark.table(name)


def co_join(facts: DataFrame, dimension: DataFrame, key: str, how: str = "left", keep_part: bool = False) -> DataFrame:
    """Join two tables of one layout; no row of either moves."""
    joined = facts.join(dimension, [key, PART], how)
    return joined if keep_part else joined.drop(PART)
