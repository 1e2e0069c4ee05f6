"""Refresh of review tables by load: only the months that a load touches are rebuilt.

A load's reviews are cleaned, and deduplicated together with the stored reviews of the
same months: the dedup key holds the review's time, so duplicates never lie in two
months. For these months the facts, the daily and monthly rollups, the partial states
of the products (counts, sums, squares, bounds per product and month) and the sets of
their reviewers are written anew, in folders of the load's own. Figures over all time
come from the states, so a load costs what its months hold, not what is stored.

Whole reviews move once: to the task of their month, or of a part of it by product and
reviewer (``MonthSlots``), where they are deduplicated, marked and written. Facts are
stored without the columns that follow from others. States need the marks and no text,
and the monthly rollup and the products of a day follow from states.

A load ends with its list of months: which load holds each month's current files. Only
listed files are read, so a load that fails leaves the earlier state as it was, a
reader sees whole loads only, and the files of other months stay as they are.

    <root>/<table>/load=<load>/review_month=<month>/...
    <root>/reviewer_ids/load=<load>/...
    <root>/lists/run=<n>/...                 (review_month, load) and the loads with ids
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens import functions as RF
from revlens.operators.distinct import distinct_counts, distinct_sets, new_ids
from revlens.operators.products import dim_products
from revlens.operators.rollups import category_rollup, daily_rollup, finish_product_stats, monthly_rollup
from revlens.operators.scd2 import complete_runs
from revlens.operators.staging import DERIVED_COLUMNS, REVIEW_KEY, best_reviews, clean_reviews, derived_facts, fct_reviews
from revlens.session import freed_shuffles, scratch_path
from revlens.sources.io import materialize, read_by_rows

_STARS = [(5, "five"), (4, "four"), (3, "three"), (2, "two"), (1, "one")]
_SENTIMENTS = ("positive", "neutral", "negative")
_SUMS = [
    "review_count", "ratings", "rating_sum", "rating_squares", *[f"{w}_star_count" for _, w in _STARS],
    *[f"{s}_review_count" for s in _SENTIMENTS], "verified_purchase_review_count", "total_helpful_votes",
]

#: Reviews that a task deduplicates.
ROWS_PER_TASK = 200_000
#: Rows without texts that a task reads, sums up or sorts by month.
NARROW_ROWS_PER_TASK = 1_000_000
#: Parts of a month, by product and reviewer, that are dealt to tasks.
BUCKETS = 64


def _month() -> Column:
    return F.trunc("reviewed_date", "month")


def _bucket(*of: str) -> Column:
    return F.pmod(F.xxhash64(*(of or ("product_id", "reviewer_id"))), F.lit(BUCKETS)).cast("int")


def count_buckets(reviews: DataFrame) -> Counter:
    """(month, bucket) -> reviews: at most ``BUCKETS`` entries per calendar month."""
    n = reviews.groupBy(_month().alias("month"), _bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return Counter({(r["month"], r["bucket"]): r["n"] for r in n.collect()})


@dataclass
class MonthSlots:
    """Which task takes which reviews: buckets of a month follow each other until a task
    is full. A crowded bucket (more than a task's rows) has ``splits`` tasks of its own."""

    rows: list[tuple]  # month, bucket, first slot, splits
    slots: int

    @classmethod
    def of(cls, counts: Counter, rows_per_task: int) -> MonthSlots:
        rows, slots, filled = [], 0, rows_per_task
        for (month, bucket), n in sorted(counts.items(), key=lambda x: (str(x[0][0]), x[0][1])):
            splits = -(-n // rows_per_task)
            if splits > 1:
                rows.append((month, bucket, slots, splits))
                slots, filled = slots + splits, rows_per_task
                continue
            if filled + n > rows_per_task:
                slots, filled = slots + 1, 0
            filled += n
            rows.append((month, bucket, slots - 1, 1))
        return cls(rows, slots)

    @property
    def crowded(self) -> bool:
        return any(r[-1] > 1 for r in self.rows)

    @classmethod
    def of_products(cls, counts: Counter, rows_per_task: int) -> MonthSlots:
        """The same for buckets of products alone, each an even share of its month."""
        months = Counter()
        for (month, _), n in counts.items():
            months[month] += n
        return cls.of(Counter({(m, b): -(-n // BUCKETS) for m, n in months.items() for b in range(BUCKETS)}), rows_per_task)

    def _found(self, rows: DataFrame, month: Column, bucket: Column) -> DataFrame:
        of = rows.sparkSession.createDataFrame(self.rows, "__month date, __bucket int, __slot int, __splits int")
        found = rows.join(F.broadcast(of), month.eqNullSafe(F.col("__month")) & (bucket == F.col("__bucket")), "left")
        # what was not counted (reads that differ) has a place too
        found = found.withColumn("__slot", F.coalesce("__slot", F.pmod(F.xxhash64(month, bucket), F.lit(self.slots)).cast("int")))
        return found.withColumn("__splits", F.coalesce("__splits", F.lit(1))).drop("__month", "__bucket")

    def by_product(self, rows: DataFrame) -> DataFrame:
        """Rows with a ``slot``, moved there: a product's rows of a month are in one."""
        found = self._found(rows, F.col("review_month"), _bucket("product_id"))
        split = F.pmod(F.xxhash64(F.lit("split"), "product_id"), F.col("__splits")).cast("int")
        return found.withColumn("slot", F.col("__slot") + split).drop("__slot", "__splits").repartitionById(self.slots, F.col("slot"))

    def dealt(self, reviews: DataFrame) -> DataFrame:
        """Reviews with their ``slot``, and ``whole``: all reviews of their month, product
        and reviewer are in it. Those of crowded buckets are deduplicated before, which
        cuts copies in the tasks that read them, and dealt by the whole key."""
        found = self._found(reviews, _month(), _bucket())
        calm = found.where(F.col("__splits") == 1).withColumns({"slot": F.col("__slot"), "whole": F.lit(True)})
        if not self.crowded:
            return calm.drop("__slot", "__splits")
        split = F.pmod(F.xxhash64(F.lit("split"), *REVIEW_KEY), F.col("__splits")).cast("int")
        crowd = best_reviews(found.where(F.col("__splits") > 1))
        crowd = crowd.withColumns({"slot": F.col("__slot") + split, "whole": F.lit(False)})
        return calm.unionByName(crowd).drop("__slot", "__splits")


def product_states(fct: DataFrame, tasks: MonthSlots, unmarked: bool = True) -> DataFrame:
    """Partial figures per product and month that add up to ``product_review_stats``, the
    month's distinct reviewers, and its days with reviews as bits. ``first_of_month`` marks
    one review of each reviewer, ``unmarked`` says that it may be null: such reviewers
    are told apart by their ids. ``tasks`` deals the months' products."""
    r = F.col("rating").cast("long")
    fct = fct.withColumn("unmarked_id", F.when(F.col("first_of_month").isNull(), F.col("reviewer_id")))
    # narrow rows in the order of products take fewer bytes than their partial sums
    rows = tasks.by_product(fct.select(
        "product_id", "review_month", "rating", "is_verified_purchase", "helpful_vote_count", "reviewed_date",
        "first_of_month", *(["unmarked_id"] if unmarked else []),
    )).withColumn("sentiment_bucket", RF.sentiment_from_rating("rating"))
    reviewers = RF.count_if(F.col("first_of_month"))
    return rows.groupBy("product_id", "review_month", "slot").agg(
        F.count(F.lit(1)).alias("review_count"), F.count(r).alias("ratings"),
        F.sum(r).alias("rating_sum"), F.sum(r * r).alias("rating_squares"),
        F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"),
        *[RF.count_if(F.col("rating") == k).alias(f"{w}_star_count") for k, w in _STARS],
        *[RF.count_if(F.col("sentiment_bucket") == s).alias(f"{s}_review_count") for s in _SENTIMENTS],
        RF.count_if(F.col("is_verified_purchase")).alias("verified_purchase_review_count"),
        F.sum("helpful_vote_count").cast("long").alias("total_helpful_votes"),
        F.min("reviewed_date").alias("first_reviewed_date"), F.max("reviewed_date").alias("last_reviewed_date"),
        (reviewers + F.countDistinct("unmarked_id") if unmarked else reviewers).alias("distinct_reviewer_count"),
        F.bit_or(F.expr("shiftleft(1, day(reviewed_date) - 1)")).alias("days"),
    ).drop("slot")


def products_of_days(states: DataFrame) -> DataFrame:
    """(reviewed_date, products_reviewed) from the days of each product's months."""
    days = F.expr(
        "if(review_month is null, array(cast(null as date)),"
        " transform(filter(sequence(0, 30), d -> (shiftright(days, d) & 1) = 1), d -> date_add(review_month, d)))"
    )
    each = states.where(F.col("product_id").isNotNull()).select(F.explode(days).alias("reviewed_date"))
    return each.groupBy("reviewed_date").agg(F.count(F.lit(1)).alias("products_reviewed"))


def stats_from_states(states: DataFrame, reviewers: DataFrame) -> DataFrame:
    """A1 from the states of all months, and the sets of their reviewers."""
    total = states.groupBy("product_id").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.min("min_rating").alias("min_rating"), F.max("max_rating").alias("max_rating"),
        F.min("first_reviewed_date").alias("first_reviewed_date"), F.max("last_reviewed_date").alias("last_reviewed_date"),
    )
    mean = F.try_divide(F.col("rating_sum").cast("double"), F.col("ratings").cast("double"))
    distinct = distinct_counts(reviewers, ["product_id"], "distinct").withColumnRenamed("product_id", "of")
    total = total.join(distinct, F.col("product_id").eqNullSafe(F.col("of")), "left")
    return finish_product_stats(
        total.withColumns({
            "distinct_reviewer_count": F.coalesce("distinct", F.lit(0).cast("long")),
            "avg_rating": RF.round_half_away(mean, 2),
            "rating_stddev": RF.stddev_from_moments("ratings", "rating_sum", "rating_squares"),
        })
    )


class ReviewStore:
    """Review tables under ``root``, kept up to date load by load. One writer at a time."""

    TABLES = ("facts", "daily", "monthly", "states", "reviewers")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # reading --------------------------------------------------------------
    def _listed(self) -> tuple[dict, list[str]]:
        """(month -> load that holds its current files, all loads so far) of the newest
        complete list: a row per calendar month and per load."""
        done, _ = complete_runs(self.spark, f"{self.root}/lists")
        if not done:
            return {}, []
        rows = self.spark.read.parquet(f"{self.root}/lists/run={done[-1]}").orderBy("place").collect()
        return {r["review_month"]: r["load"] for r in rows if r["of_month"]}, [r["load"] for r in rows if not r["of_month"]]

    def months(self) -> dict:
        """month -> load that holds its current files."""
        return self._listed()[0]

    def table(self, name: str, months=None) -> DataFrame:
        """The current rows of a table, of some months or all; other files are pruned."""
        current = {m: at for m, at in self.months().items() if months is None or m in months}
        if not current:
            raise LookupError(f"no load of {name} under {self.root}")
        rows = self.spark.read.parquet(f"{self.root}/{name}")
        rows = rows.withColumn("review_month", F.col("review_month").cast("date"))
        keep = []
        for load in sorted(set(current.values())):
            of = [m for m, at in current.items() if at == load]
            some = F.col("review_month").isin([m for m in of if m is not None])
            keep.append((F.col("load") == load) & (some | F.col("review_month").isNull() if None in of else some))
        rows = rows.where(reduce(lambda a, b: a | b, keep)).drop("load")
        return derived_facts(rows, "review_month") if name == "facts" else rows

    @property
    def facts(self) -> DataFrame:
        return self.table("facts")

    @property
    def daily(self) -> DataFrame:
        return self.table("daily").drop("review_month").orderBy(F.col("reviewed_date").asc_nulls_last())

    @property
    def monthly(self) -> DataFrame:
        return self.table("monthly").drop("review_month")

    @property
    def product_review_stats(self) -> DataFrame:
        return stats_from_states(self.table("states"), self.table("reviewers"))

    def dim_products(self, stg_products: DataFrame) -> DataFrame:
        newest = self.table("daily").agg(F.max("reviewed_date")).scalar()
        return dim_products(stg_products, self.product_review_stats, anchor=newest)

    def dim_categories(self, stg_products: DataFrame) -> DataFrame:
        return category_rollup(self.dim_products(stg_products))

    def reviewer_ids(self) -> DataFrame | None:
        """(value, id) of all loads; ids are only ever added."""
        loads = self._listed()[1]
        return self.spark.read.parquet(*[f"{self.root}/reviewer_ids/load={x}" for x in loads]) if loads else None

    # writing --------------------------------------------------------------
    def load(self, raw_reviews: DataFrame) -> list:
        """Take in a load of raw reviews; the months it changed. A load without usable
        reviews changes nothing. The raw reviews are read twice, so land them first if
        they are costly to make; reads that differ in their months are an error."""
        spark, load = self.spark, uuid.uuid4().hex
        at = lambda name: f"{self.root}/{name}/load={load}"
        known, loads = self._listed()
        rows = clean_reviews(raw_reviews)
        counts = count_buckets(rows)
        changed = sorted({m for m, _ in counts}, key=str)  # calendar months
        if not changed:
            return []
        again = [m for m in changed if m in known]
        if again:
            stored = self.table("facts", again).select(*rows.columns)
            counts += count_buckets(stored)
            rows = rows.unionByName(stored)
        tasks = MonthSlots.of(counts, ROWS_PER_TASK)
        self._write(fct_reviews(tasks.dealt(rows), slots=tasks.slots).drop(*DERIVED_COLUMNS), at("facts"))
        facts = self._read(at("facts"))
        if {r["review_month"] for r in facts.select("review_month").distinct().collect()} != set(changed):
            raise RuntimeError("the raw reviews of a load changed while they were read")
        facts = derived_facts(facts, "review_month", "first_of_month")

        ids = self.reviewer_ids()
        counted = facts.groupBy(F.col("reviewer_id").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        name = f"reviewers-{load}"
        counted = materialize(counted, name, path=scratch_path(spark, name))
        new_ids(counted, "value", ids).write.option("compression", "zstd").parquet(at("reviewer_ids"))
        new = spark.read.parquet(at("reviewer_ids"))
        ids = new if ids is None else ids.unionByName(new)
        of_products = MonthSlots.of_products(counts, ROWS_PER_TASK)
        self._write(product_states(facts, of_products, tasks.crowded), at("states"))
        states = self._read(at("states"))
        self._write(daily_rollup(facts, False, products_of_days(states)).withColumn("review_month", _month()), at("daily"))
        self._write(monthly_rollup(states, False, True).withColumn("review_month", F.col("month_start_date")), at("monthly"))
        pairs = facts.where(F.coalesce("first_of_month", F.lit(True)))
        self._write(distinct_sets(pairs, "reviewer_id", ["product_id", "review_month"], ids, tasks.crowded, counted), at("reviewers"))

        known |= dict.fromkeys(changed, load)
        _, run = complete_runs(spark, f"{self.root}/lists")
        rows = [(i, True, m, x) for i, (m, x) in enumerate(known.items())] + [(i, False, None, x) for i, x in enumerate([*loads, load])]
        listed = spark.createDataFrame(rows, "place int, of_month boolean, review_month date, load string")
        listed.coalesce(1).write.parquet(f"{self.root}/lists/run={run}")  # from here on the load counts
        return changed

    def _read(self, path: str) -> DataFrame:
        rows = read_by_rows(self.spark, path, NARROW_ROWS_PER_TASK)
        return rows.withColumn("review_month", F.col("review_month").cast("date"))

    @staticmethod
    def _write(df: DataFrame, path: str) -> None:
        with freed_shuffles(df.sparkSession):
            df.write.option("compression", "zstd").partitionBy("review_month").parquet(path)
