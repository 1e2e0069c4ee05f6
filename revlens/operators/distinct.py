"""Distinct counts that add up: exact, mergeable sets of dense ids.

``count(distinct)`` cannot be rolled up: a reviewer of two days of a month counts once
in the month. Here every value gets a dense number once, and a group's values are kept
as a set of numbers, cut into buckets of 32768: a short list of bit positions where
few are set, a bitmap of 4 KB else. Sets of days and products, written once, give those
of months, categories and the total, without the facts: bitmaps by OR, lists position by
position, so that few set positions never cost a bitmap. A later load's sets are added
to them, and values that both hold count once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.ranking import number_rows
from revlens.operators.skew import split_hot_join
from revlens.session import scratch_path
from revlens.sources.io import materialize, read_by_rows

#: Positions that a list holds; a bucket with more becomes a bitmap.
SPARSE = 512

#: Sets that a task reads back; they compress too well to be dealt by bytes.
SETS_PER_TASK = 1_000_000


def new_ids(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, id): the distinct non-null values of ``column`` that ``known`` lacks,
    numbered on from its largest id (from 1 without it)."""
    new = values.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    if known is not None:
        new = new.join(known, "value", "left_anti")
    name = f"values-{uuid.uuid4().hex}"
    new = number_rows(materialize(new, name, path=scratch_path(values.sparkSession, name)), ["value"], "id")
    if known is None:
        return new
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return new.withColumn("id", F.col("id") + top)


def dense_ids(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, id) of the distinct non-null values of ``column`` and of ``known``, an
    earlier result, whose ids stay."""
    new = new_ids(values, column, known)
    return new if known is None else known.unionByName(new)


def distinct_sets(df: DataFrame, column: str, keys: Sequence[str], ids: DataFrame, repeated: bool = True, counts: DataFrame | None = None) -> DataFrame:
    """``keys``, bucket, positions, bits: the set of ids of ``column`` per group.

    One of ``positions`` (sorted, at most ``SPARSE``) and ``bits`` is null. Null keys
    are a group like any other; null values are in no set, and a group that has only
    such values has no row. A value that most rows hold is spread over the join.
    ``repeated=False`` says that no group has a value twice, ``counts`` gives (value, n),
    at least its groups, where they are counted already. Sets are written once, as
    lists; short ones and those that become bitmaps are both read from there.
    """
    pairs = df.select(*keys, F.col(column).alias("value")).where(F.col("value").isNotNull())
    pairs = pairs.distinct() if repeated else pairs
    rows = split_hot_join(pairs, ids, "value", "inner", counts=counts, count_col="n" if counts is not None else None)
    rows = rows.select(*keys, F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").cast("int").alias("position"))
    # at most 32768 positions in a bucket of a group; each moves as a number, not as a set of one
    rows = rows.repartition(*keys, "bucket")
    sets = rows.groupBy(*keys, "bucket").agg(F.sort_array(F.collect_set("position")).alias("positions"))
    name = f"sets-{uuid.uuid4().hex}"
    path = scratch_path(df.sparkSession, name)
    materialize(sets, name, path=path)
    return _packed(read_by_rows(df.sparkSession, path, SETS_PER_TASK), keys)


def _packed(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lists that are too long become bitmaps."""
    short = sets.where(F.size("positions") <= SPARSE).withColumn("bits", F.lit(None).cast("binary"))
    long = sets.where(F.size("positions") > SPARSE).select(*keys, "bucket", F.explode("positions").alias("position"))
    long = long.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.col("position").cast("long")).alias("bits"))
    return short.unionByName(long.withColumn("positions", F.lit(None).cast("array<int>")).select(short.columns))


def merged_bits(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` (with the bucket), bits: the union of the bitmaps of a group.

    Every task ORs its rows of a group before the shuffle, so a group that most sets
    belong to is one bitmap per task and bucket.
    """
    return sets.where(F.col("bits").isNotNull()).select(*by, "bits").groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(sets: DataFrame, keys: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """The exact number of distinct values per group, from sets of finer groups.

    Positions of lists are told apart as rows, and count where no bitmap of their group
    holds them: memory and shuffle follow from the positions that are set, whatever the
    number of groups and buckets.
    """
    by = [*keys, "bucket"]
    bits = merged_bits(sets, by)
    listed = sets.where(F.col("bits").isNull()).select(*by, F.explode("positions").alias("position")).distinct()
    of = bits.select(*[F.col(c).alias(f"__{c}") for c in by], "bits")
    octet = F.conv(F.hex(F.expr("substring(bits, position div 8 + 1, 1)")), 16, 10).cast("int")
    held = F.expr("shiftright(octet, position % 8) & 1") == 1
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    alone = listed.join(of, same, "left").withColumn("octet", octet).where(F.col("bits").isNull() | ~held)
    each = alone.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).unionByName(bits.select(*by, F.bitmap_count("bits").alias("n")))
    return each.groupBy(*keys).agg(F.sum("n").cast("long").alias(name))
