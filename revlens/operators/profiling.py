"""Table profiling re-aimed as DataFrames.

The warehouse's inspection scripts printed these to a console; here each is
a lazy DataFrame a caller can show, write or assert on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import functions as RF


def profile_table(df: DataFrame, distinct: Mapping[str, str], approx: bool = False) -> DataFrame:
    """One row with the row count and named distinct counts."""
    fn = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *[fn(c).alias(name) for name, c in distinct.items()])


def describe_schema(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(column, type, nullable) — metadata only, no job."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def describe_columns(df: DataFrame, digits: int = 4) -> DataFrame:
    """A row per column, in order: its type, how many rows have it, how many lack it
    and their share (null for an empty table). One pass, whatever the number of columns."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*[F.count(F.col(f"`{c}`")) for c in df.columns]).alias("filled"))
    of = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema.fields])
    out = counted.select("rows", "filled", F.posexplode(of).alias("at", "c"))
    filled = F.get("filled", F.col("at"))
    return out.select(
        (F.col("at") + 1).alias("position"), "c.column", "c.type", filled.alias("filled"), (F.col("rows") - filled).alias("nulls"),
        RF.round_half_away(F.try_divide((F.col("rows") - filled).cast("double"), F.col("rows").cast("double")), digits).alias("null_share"),
    ).orderBy("position")


#: Hash buckets of ``heavy_values``: at most so many counts reach the driver.
HEAVY_BUCKETS = 1 << 16


def heavy_values(df: DataFrame, col: str, k: int, count_name: str = "n", buckets: int = HEAVY_BUCKETS) -> DataFrame:
    """The first ``k`` rows of ``value_counts(df, [col])``, without grouping every value.

    One pass counts hash buckets; a bucket's count bounds that of each value in it. The
    values of the largest buckets are counted exactly. Every other bucket with fewer rows
    than the k-th count so found cannot hold one of the first ``k``: that proves the
    result. Buckets it does not rule out are counted exactly too, in one more pass, which
    in the worst case (no value stands out) counts all. A null is a value like any other.
    """
    if k < 1:
        raise ValueError(f"k: {k}")
    spark = df.sparkSession
    rows = df.select(F.col(col).alias("value")).withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    sizes = {r["bucket"]: r["n"] for r in rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = set(sorted(sizes, key=sizes.get, reverse=True)[: 2 * k])

    def first(some: set) -> list:
        kept = rows
        if len(some) < len(sizes):  # at most `buckets` numbers
            wanted = spark.createDataFrame([(b,) for b in some], "bucket int")
            kept = rows.join(F.broadcast(wanted), "bucket", "left_semi")
        counts = kept.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        return counts.orderBy(F.col("n").desc(), F.col("value").asc_nulls_last()).limit(k).collect()

    best = first(chosen) if chosen else []
    least = best[-1]["n"] if len(best) == k else 0
    open_ = {b for b, n in sizes.items() if n >= least} - chosen
    if open_:
        best = first(chosen | open_)
    kind = df.schema[col].dataType
    out = spark.createDataFrame([(r["value"], r["n"]) for r in best], T.StructType([T.StructField(col, kind), T.StructField(count_name, T.LongType())]))
    return out.orderBy(F.col(count_name).desc(), F.col(col).asc_nulls_last())


def value_counts(df: DataFrame, cols: Sequence[str], count_name: str = "n") -> DataFrame:
    """Rows per value combination, most frequent first (ties by value)."""
    return (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(F.col(count_name).desc(), *[F.col(c).asc_nulls_last() for c in cols])
    )


def value_share(df: DataFrame, col: str, count_name: str = "n", digits: int = 1) -> DataFrame:
    """Rows per value and its percent of all rows.

    The grand total is a scalar subquery over the grouped counts, not a
    one-partition window over raw rows.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    total = counts.agg(F.sum(count_name)).scalar()
    return counts.select(
        col, count_name, RF.round_half_away(F.lit(100.0) * F.col(count_name) / total, digits).alias("pct")
    ).orderBy(F.col(count_name).desc(), F.col(col).asc_nulls_last())


def coverage(left: DataFrame, left_key: str, right: DataFrame, right_key: str, digits: int = 1) -> DataFrame:
    """Distinct non-null left keys, how many exist on the right, and the match rate."""
    lk = left.select(F.col(left_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    rk = right.select(F.col(right_key).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    j = lk.join(rk, "__k", "left")
    agg = j.agg(F.count(F.lit(1)).alias("distinct_keys"), F.count("__hit").alias("matched_keys"))
    return agg.select(
        "distinct_keys", "matched_keys",
        RF.round_half_away(F.lit(100.0) * F.col("matched_keys") / F.nullif(F.col("distinct_keys"), F.lit(0)), digits).alias("match_rate_pct"),
    )


def profile_joined_categories(products: DataFrame, reviews: DataFrame, key: str = "parent_asin", category: str = "main_category") -> DataFrame:
    """Per category, products that have reviews and the reviews they get.

    Both sides are counted per key first — reviews per product id, product rows
    per (id, category) — so the join runs at key grain: neither a hot product
    nor a product id with many copies lands in one join task. The joined count
    is Σ product rows × reviews, as the row-level join would give.
    """
    per_key = reviews.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    per_product = products.where(F.col(key).isNotNull()).groupBy(key, category).agg(F.count(F.lit(1)).alias("__m"))
    j = per_product.join(per_key, key)
    return (
        j.groupBy(category)
        .agg(F.count(F.lit(1)).alias("products"), F.sum(F.col("__m") * F.col("__n")).cast("long").alias("review_count"))
        .orderBy(F.col("review_count").desc(), F.col(category).asc_nulls_last())
    )


def profile_samples(df: DataFrame, condition: Column, cols: Sequence[Column | str], order: Sequence[str], n: int = 10) -> DataFrame:
    """A small, repeatable preview of matching rows (ordered, then limited)."""
    return df.where(condition).orderBy(*[F.col(c).asc_nulls_last() for c in order]).select(*cols).limit(n)
