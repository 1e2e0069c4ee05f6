"""Deterministic review / product inputs derived from the TPC-H-style tables.

The driver's tables contain no reviews, so the raw review and product inputs
are projections of ``lineitem ⋈ orders ⋈ part`` and ``part`` (FX1..FX5 in
FIXTURES.md). Each builder is a plain DataFrame plan over the given tables, so
its size grows with the scale factor; the same projections exist as SQL text
(``FX*_SQL``) for the independent DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import freed_shuffles, scratch_path
from revlens.sources.io import read_by_rows


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pid(c) -> F.Column:
    return F.concat(F.lit("P"), c.cast("string"))


# --------------------------------------------------------------------------
# FX1 — raw reviews
# --------------------------------------------------------------------------

def _reviewed_part(pk: F.Column, ln: F.Column) -> F.Column:
    """The product a line item reviews. Every line item is a review; parts divisible by 50
    get none and those by 7 or 11 few: their other reviews go to one of the four parts before."""
    sparse = lambda k: (k % 50 == 0) | (k % 7 == 0) | (k % 11 == 0)
    before = F.when(~sparse(pk - 1), pk - 1).when(~sparse(pk - 2), pk - 2).when(~sparse(pk - 3), pk - 3).otherwise(pk - 4)
    moved = (pk % 50 == 0) | ((pk % 7 == 0) & (ln != 1)) | ((pk % 11 == 0) & (ln > 3))
    return F.when(moved, before).otherwise(pk)


#: Line items that a task of ``Inputs.reviews`` turns into reviews.
ROWS_PER_TASK = 200_000


def raw_reviews(lineitem: DataFrame, orders: DataFrame, part: DataFrame, tasks: int | None = None) -> DataFrame:
    """A review has many times the bytes of its line item, which Spark sizes tasks by:
    ``tasks`` deals the line items, so that a task's reviews fit its memory."""
    # narrow: two of the three exchanges below move whole line items
    li = lineitem.select(
        "l_orderkey", _reviewed_part(F.col("l_partkey"), F.col("l_linenumber")).alias("l_partkey"),
        (F.col("l_suppkey") % 3).alias("l_suppkey"), "l_linenumber", F.col("l_quantity").cast("int").alias("l_quantity"),
        (F.col("l_returnflag") == "R").alias("returned"), "l_shipdate",
    )
    o = orders.select("o_orderkey", "o_custkey")
    p = part.select("p_partkey", "p_name")
    if tasks is not None:
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    ck, ln = F.col("o_custkey"), F.col("l_linenumber")
    ordered = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "returned", "l_shipdate",
        F.when(ck % 10 == 0, F.col("l_orderkey") + 1000000).otherwise(ck).alias("user"),
        (ck % 4 - 2 + (ln % 3 - 1)).cast("int").alias("mood"),
    )
    if tasks is not None:  # the next join would deal them by bytes again
        ordered, p = ordered.repartition(tasks, "l_partkey"), p.repartition(tasks, "p_partkey")
    j = ordered.join(p, F.col("l_partkey") == F.col("p_partkey"))
    pk, qty = F.col("l_partkey"), F.col("l_quantity")
    rating = F.least(
        F.lit(5),
        F.greatest(
            F.lit(1),
            F.lit(4)
            + F.col("mood")
            + F.when(pk % 5 == 0, F.lit(-2)).when(pk % 5 == 1, F.lit(-1)).otherwise(F.lit(1)),
        ),
    ).cast("double")
    # one join; a seventh line item also gives a duplicate (kind 1), a sixth one a review without text (kind 2)
    kinds = F.when(ln == 7, F.array(F.lit(0), F.lit(1))).when(ln == 6, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    kind = F.col("kind")
    return j.withColumn("kind", F.explode(kinds)).select(
        _pid(pk).alias("parent_asin"),
        F.concat(F.lit("P"), pk.cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("asin"),
        F.concat(F.lit("U"), F.col("user").cast("string")).alias("user_id"),
        rating.alias("rating"),
        F.col("p_name").alias("title"),
        F.when(kind == 0, F.repeat(F.concat(F.col("p_name"), F.lit(" ")), qty))
        .when(kind == 1, F.lit("dup"))
        .when(qty % 4 != 0, F.lit(""))
        .alias("text"),
        F.col("l_shipdate").alias("timestamp"),
        F.when(kind == 0, qty % 4).otherwise(F.lit(0)).alias("helpful_vote"),
        (~(F.col("returned") & (pk % 3 != 1))).alias("verified_purchase"),
    )


# --------------------------------------------------------------------------
# FX2 / FX5 — raw products, two versions
# --------------------------------------------------------------------------

def raw_products(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    main = part.select(
        _pid(pk).alias("parent_asin"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("main_category"),
        F.when(pk % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("store"),
        (F.lit(1.0) + (pk % 41).cast("double") / F.lit(10.0)).alias("average_rating"),
        (F.col("p_size") * (pk % 4).cast("int")).alias("rating_number"),
        F.when(pk % 6 == 0, F.lit("None"))
        .when(pk % 6 == 1, F.lit(""))
        .when(pk % 6 == 2, F.lit(None).cast("string"))
        .when(pk % 6 == 3, F.lit("from 12.99"))
        .otherwise(F.concat((F.col("p_size") * 3).cast("string"), F.lit(".50")))
        .alias("price"),
    )
    copies = part.where(pk % 10 == 0).select(
        _pid(pk).alias("parent_asin"),
        F.concat(F.col("p_name"), F.lit(" copy")).alias("title"),
        F.col("p_type").alias("main_category"),
        F.col("p_brand").alias("store"),
        F.lit(1.0).alias("average_rating"),
        F.lit(None).cast("int").alias("rating_number"),
        F.lit("None").alias("price"),
    )
    no_id = part.where(pk < 3).select(
        F.lit(None).cast("string").alias("parent_asin"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("main_category"),
        F.col("p_brand").alias("store"),
        F.lit(1.0).alias("average_rating"),
        F.lit(1).alias("rating_number"),
        F.lit("1.50").alias("price"),
    )
    return main.unionByName(copies).unionByName(no_id)


def raw_products_v2(v1: DataFrame, part: DataFrame) -> DataFrame:
    """Second product load: changed titles, nulled brands, a missing key, new keys."""
    k = F.substring(F.col("parent_asin"), 2, 1 << 20).cast("long")
    t = v1.where(F.col("parent_asin").isNotNull()).withColumn("k", k).where(F.col("k") % 20 != 7)
    kept = t.select(
        "parent_asin",
        F.when(F.col("k") % 20 == 3, F.concat(F.col("title"), F.lit(" v2"))).otherwise(F.col("title")).alias("title"),
        "main_category",
        F.when(F.col("k") % 20 == 5, F.lit(None).cast("string")).otherwise(F.col("store")).alias("store"),
        "average_rating",
        (F.col("rating_number") + 1).alias("rating_number"),
        "price",
    )
    pk = F.col("p_partkey")
    new = part.where(pk % 20 == 9).select(
        _pid(pk + 1000000).alias("parent_asin"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("main_category"),
        F.col("p_brand").alias("store"),
        F.lit(1.0).alias("average_rating"),
        F.lit(1).alias("rating_number"),
        F.lit("1.50").alias("price"),
    )
    return kept.unionByName(new)


# --------------------------------------------------------------------------
# FX3 / FX4 — reference data (seeds)
# --------------------------------------------------------------------------

MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("main_category", T.StringType(), False),
        T.StructField("category_group", T.StringType(), False),
        T.StructField("is_premium", T.BooleanType(), False),
    ]
)
RULES_SCHEMA = T.StructType(
    [
        T.StructField("subcategory", T.StringType(), False),
        T.StructField("keyword_pattern", T.StringType(), False),
        T.StructField("priority", T.IntegerType(), False),
    ]
)

# fixed values: fixture category mapping (FX3); PROMO is deliberately absent
FX3_ROWS = [
    ("STANDARD", "Core", False),
    ("ECONOMY", "Core", False),
    ("MEDIUM", "Core", False),
    ("LARGE", "Select", True),
    ("SMALL", "Select", True),
]

# fixed values: fixture subcategory rules (FX4)
FX4_ROWS = [
    ("Fasteners", "bolt|rod", 10),
    ("Machinery", "gear|anvil", 10),
    ("Rings", "ring|gizmo", 10),
    ("Sheet Goods", "plate", 10),
    ("Small Red", "red|small", 5),
]


def category_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FX3_ROWS, MAPPING_SCHEMA)


def subcategory_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FX4_ROWS, RULES_SCHEMA)


# Snapshot times of the two product loads (FX5 instructions)
AS_OF_V1 = dt.datetime(2024, 1, 1)
AS_OF_V2 = dt.datetime(2024, 2, 1)
#: Loads of the same products while reviews are written, for joins by time.
LOADED_V1 = dt.datetime(1997, 1, 1)
LOADED_V2 = dt.datetime(1999, 1, 1)


class Inputs:
    """Lazily built raw inputs for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return load_table(self.spark, self.sf_dir, name)

    def reviews(self) -> DataFrame:
        lineitem = self.table("lineitem")
        tasks = -(-lineitem.count() // ROWS_PER_TASK)  # a count of footers
        tasks = max(tasks, self.spark.sparkContext.defaultParallelism) if tasks > 1 else None
        return raw_reviews(lineitem, self.table("orders"), self.table("part"), tasks)

    def landed_reviews(self) -> DataFrame:
        """The same rows as files, as a warehouse gets them: for queries that read them
        more than once. Tasks read as many rows as one of ``reviews`` makes."""
        path = scratch_path(self.spark, f"landed-reviews-{uuid.uuid4().hex}")
        with freed_shuffles(self.spark):
            self.reviews().write.option("compression", "zstd").parquet(path)
        return read_by_rows(self.spark, path, ROWS_PER_TASK)

    def products(self) -> DataFrame:
        return raw_products(self.table("part"))

    def products_v2(self) -> DataFrame:
        return raw_products_v2(self.products(), self.table("part"))

    def mapping(self) -> DataFrame:
        return category_mapping(self.spark)

    def rules(self) -> DataFrame:
        return subcategory_rules(self.spark)


# --------------------------------------------------------------------------
# The same projections as SQL text (for the DuckDB oracle)
# --------------------------------------------------------------------------

FX1_SQL = """
with moved as (
  select *, case when l_partkey % 50 = 0 or (l_partkey % 7 = 0 and l_linenumber <> 1) or (l_partkey % 11 = 0 and l_linenumber > 3)
                 then case when not ((l_partkey - 1) % 50 = 0 or (l_partkey - 1) % 7 = 0 or (l_partkey - 1) % 11 = 0) then l_partkey - 1
                           when not ((l_partkey - 2) % 50 = 0 or (l_partkey - 2) % 7 = 0 or (l_partkey - 2) % 11 = 0) then l_partkey - 2
                           when not ((l_partkey - 3) % 50 = 0 or (l_partkey - 3) % 7 = 0 or (l_partkey - 3) % 11 = 0) then l_partkey - 3
                           else l_partkey - 4 end
                 else l_partkey end as pk
  from lineitem),
base as (
  select 'P' || cast(pk as string) as parent_asin,
         'P' || cast(pk as string) || '-' || cast(l_suppkey % 3 as string) as asin,
         'U' || cast(case when o_custkey % 10 = 0 then l_orderkey + 1000000 else o_custkey end as string) as user_id,
         cast(least(5, greatest(1, 4 + (o_custkey % 4 - 2)
              + (case pk % 5 when 0 then -2 when 1 then -1 else 1 end)
              + (l_linenumber % 3 - 1))) as double) as rating,
         p_name as title,
         repeat(p_name || ' ', cast(l_quantity as int)) as text,
         l_shipdate as timestamp,
         cast(l_quantity as int) % 4 as helpful_vote,
         not (l_returnflag = 'R' and pk % 3 <> 1) as verified_purchase,
         l_linenumber as ln
  from moved join orders on l_orderkey = o_orderkey join part on pk = p_partkey)
select parent_asin, asin, user_id, rating, title, text, timestamp, helpful_vote, verified_purchase from base
union all
select parent_asin, asin, user_id, rating, title, 'dup', timestamp, 0, verified_purchase from base where ln = 7
union all
select parent_asin, asin, user_id, rating, title, case when helpful_vote = 0 then null else '' end, timestamp, 0, verified_purchase from base where ln = 6
"""

FX2_SQL = """
select 'P' || cast(p_partkey as string) as parent_asin, p_name as title, p_type as main_category,
       case when p_partkey % 13 = 0 then null else p_brand end as store,
       1.0e0 + cast(p_partkey % 41 as double) / 10.0e0 as average_rating,
       p_size * cast(p_partkey % 4 as int) as rating_number,
       case p_partkey % 6 when 0 then 'None' when 1 then '' when 2 then null when 3 then 'from 12.99'
            else cast(p_size * 3 as string) || '.50' end as price
from part
union all
select 'P' || cast(p_partkey as string), p_name || ' copy', p_type, p_brand, 1.0e0, cast(null as int), 'None'
from part where p_partkey % 10 = 0
union all
select cast(null as string), p_name, p_type, p_brand, 1.0e0, 1, '1.50' from part where p_partkey < 3
"""

FX5_SQL = """
select parent_asin, case when k % 20 = 3 then title || ' v2' else title end as title, main_category,
       case when k % 20 = 5 then null else store end as store, average_rating,
       rating_number + 1 as rating_number, price
from (select v1.*, cast(substr(parent_asin, 2) as bigint) as k from v1 where parent_asin is not null) t
where k % 20 <> 7
union all
select 'P' || cast(p_partkey + 1000000 as string), p_name, p_type, p_brand, 1.0e0, 1, '1.50' from part where p_partkey % 20 = 9
"""


def _values_sql(rows, cols) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"select * from (values {body}) t({', '.join(cols)})"


FX3_SQL = _values_sql(FX3_ROWS, ["main_category", "category_group", "is_premium"])
FX4_SQL = _values_sql(FX4_ROWS, ["subcategory", "keyword_pattern", "priority"])
