"""Exact-size, seeded, repeatable sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.ranking import number_rows

# Hash buckets counted to find where the sample ends; fixed, whatever the table holds.
BUCKETS = 16 ** 4


def sample_key(seed: int | str, key: str) -> F.Column:
    """md5(seed || key); a null key counts as an empty one."""
    return F.md5(F.concat(F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def sample_n(df: DataFrame, n: int, seed: int | str, key: str) -> DataFrame:
    """The ``n`` rows with the smallest md5(seed || key) (ties by key, nulls last, then by
    a hash of the row).

    Deterministic for a given seed, independent of partitioning, and one method for
    every ``n``: rows are counted per hash prefix (65,536 counts), whole prefixes below
    the boundary are kept by a filter, and only the rows of the boundary prefix are
    numbered, by ranges of (hash, key, row). So a key, or null keys, that a third of the
    rows share is spread over tasks like any other rows; which of several rows equal in
    every column stay does not matter. Fewer than ``n`` rows are all returned.
    """
    whole_row = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]
    tagged = df.withColumn("__h", sample_key(seed, key)).withColumn("__r", F.xxhash64(*whole_row))
    tagged = tagged.withColumn("__p", F.conv(F.substring("__h", 1, 4), 16, 10).cast("int"))
    counts = dict(tagged.groupBy("__p").count().collect())  # at most BUCKETS rows
    taken, boundary = 0, BUCKETS
    for p in range(BUCKETS):
        if taken + counts.get(p, 0) > n:
            boundary = p
            break
        taken += counts.get(p, 0)
    whole = tagged.where(F.col("__p") < boundary)
    if boundary < BUCKETS and n > taken:
        edge = number_rows(tagged.where(F.col("__p") == boundary), ["__h", key, "__r"], "__number")
        whole = whole.unionByName(edge.where(F.col("__number") <= n - taken).drop("__number"))
    return whole.drop("__h", "__p", "__r")
