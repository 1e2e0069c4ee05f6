"""Point-in-time join: the version of a key that was valid when each fact happened (H3).

Versions and facts of a key are put in one order by time and the last version is
carried forward, so a fact meets one version and no pairs are made. The order needs
the rows of a key together; a key with more than ``rows_per_range`` facts is cut:

* its time is divided evenly into ranges, as many as its facts need, so a row's range
  is arithmetic on the row; a range that still holds too many (a burst, one instant)
  is divided by a hash of the fact;
* every part gets the versions that begin in its range, and the one that was valid
  when the range began, handed over from the ranges before.

The lists of cut keys and of divided ranges have fewer than rows / ``rows_per_range``
entries each, which bounds their broadcasts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.skew import NULL_SPLITS

ROWS_PER_RANGE = 500_000


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _range_of(t: Column) -> Column:
    """The range of a time in a key cut evenly; times outside belong to the ends."""
    width = F.floor((F.col("t1") - F.col("t0")) / F.col("ranges")) + 1
    at = F.floor((t - F.col("t0")) / width)
    return F.when(F.col("ranges").isNull(), F.lit(0)).otherwise(F.least(F.greatest(at, F.lit(0)), F.col("ranges") - 1)).cast("long")


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    time: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Every fact with ``columns`` of the version of its ``key`` valid at its ``time``:
    ``valid_from <= time``, and ``time < valid_to`` unless that is null.

    Versions of a key must not overlap, as type-2 history's don't; of several that
    begin at once the one that ends last counts (open last). Facts before the first
    version, in a gap, or with a null key or time get nulls, and every fact stays once,
    repeated ones too. Versions with a null key or ``valid_from`` match nothing.
    Columns of facts that have a name of ``columns`` are replaced.
    """
    f = facts.select(F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("fact"), F.col(key).alias("k"), _micros(F.col(time)).alias("t"))
    v = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("k"), _micros(F.col(valid_from)).alias("t"),
        F.struct(_micros(F.col(valid_to)).alias("until"), F.struct(*columns).alias("c")).alias("version"),
    )

    # keys with too many facts, and into how many ranges of time each is cut
    timed = facts.select(F.col(key).alias("k"), _micros(F.col(time)).alias("t")).where(F.col("k").isNotNull() & F.col("t").isNotNull())
    n = F.count(F.lit(1))
    hot = timed.groupBy("k").agg(n.alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1")).where(F.col("n") > rows_per_range)
    hot = hot.select("k", "t0", "t1", F.ceil(F.col("n") / F.lit(float(rows_per_range))).alias("ranges"))
    in_hot = lambda df: df.join(F.broadcast(hot), "k", "left").withColumn("r", _range_of(F.col("t")))
    # ranges with too many facts, and into how many parts each is divided
    full = timed.join(F.broadcast(hot), "k").groupBy("k", _range_of(F.col("t")).alias("r")).agg(n.alias("n")).where(F.col("n") > rows_per_range)
    full = full.select("k", "r", F.ceil(F.col("n") / F.lit(float(rows_per_range))).alias("parts"))
    parts = lambda df: df.join(F.broadcast(full), ["k", "r"], "left").drop("t0", "t1", "ranges")

    v = in_hot(v)
    # the version that every range of a cut key begins with
    last = v.where(F.col("ranges").isNotNull()).groupBy("k", "r").agg(F.max_by(F.struct("t", "version"), F.struct("t", _ends("version"))).alias("last"))
    each = hot.select("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ranges") - 1)).alias("r"))
    before = Window.partitionBy("k").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    carried = each.join(last, ["k", "r"], "left").withColumn("last", F.last("last", ignorenulls=True).over(before)).where(F.col("last").isNotNull())
    carried = carried.select("k", "r", F.col("last.t").alias("t"), F.col("last.version").alias("version"))

    begun = parts(v.select("k", "r", "t", "version").unionByName(carried))
    begun = begun.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1)))
    begun = begun.select("k", "r", "part", "t", F.lit(None).cast(f.schema["fact"].dataType).alias("fact"), "version", F.lit(0).alias("is_fact"))
    whole = [F.col("fact").getField(x.name) for x in facts.schema if not isinstance(x.dataType, T.MapType)]
    spread = F.when(F.col("k").isNull(), F.lit(NULL_SPLITS)).otherwise(F.coalesce("parts", F.lit(1)))
    happened = parts(in_hot(f)).withColumn("part", F.pmod(F.xxhash64(*whole), spread))
    happened = happened.select("k", "r", "part", "t", "fact", F.lit(None).cast(v.schema["version"].dataType).alias("version"), F.lit(1).alias("is_fact"))

    order = [F.col("t").asc_nulls_first(), F.col("is_fact").asc(), _ends("version").asc()]
    window = Window.partitionBy("k", "r", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = begun.unionByName(happened).withColumn("at", F.last("version", ignorenulls=True).over(window)).where(F.col("is_fact") == 1)
    valid = F.col("at.until").isNull() | (F.col("t") < F.col("at.until"))
    return out.select(
        *[F.col("fact").getField(c).alias(c) for c in facts.columns if c not in columns],
        *[F.when(valid, F.col("at.c").getField(c)).alias(c) for c in columns],
    )


def _ends(version: str) -> Column:
    """When a version ends, open ones last."""
    return F.coalesce(F.col(version).getField("until"), F.lit(2**63 - 1))
