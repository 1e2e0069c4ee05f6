"""The whole warehouse as DataFrame calls.

``Warehouse`` wires the operators in dependency order. Each model is built
lazily on first use. With ``materialize="table"`` the models that several
marts read (the review fact table — partitioned by review month —, reviewer
history, staged products, product dimension and the per-product review
aggregates) are written once, under ``output_root`` or the session's shared
checkpoint folder, and re-read, which cuts lineage: a lost executor re-reads
files rather than recomputing joins and dedup windows. ``build`` runs every
model level by level (independent models as concurrent jobs), optionally with
the column tests. With ``materialize="ephemeral"`` everything stays one lazy
plan (what the registered queries use).
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.calendar import SPINE_END, SPINE_START, date_dimension
from revlens.operators.categories import category_performance, tendency_aggregates
from revlens.operators.products import dim_products
from revlens.operators.reviewers import by_product, dim_reviewers, first_of_pair, reviewer_history, with_reviewer_context
from revlens.operators.risk import products_at_risk, recent_sentiment, signal_aggregates, signal_counts
from revlens.operators.rollups import (
    STAT_AGG_COLUMNS, category_rollup, daily_rollup, finish_product_stats, monthly_rollup,
    product_review_stats, product_stat_aggregates,
)
from revlens.operators.scd2 import scd2_apply
from revlens.operators.skew import hot_keys
from revlens.operators.staging import clean_reviews, derived_facts, fct_reviews, reviews_by_reviewer, stg_products
from revlens.plans.refresh import ROWS_PER_TASK, MonthSlots, count_buckets
from revlens.session import freed_shuffles, scratch_path
from revlens.sources.bucketing import PART
from revlens.sources.io import discard, next_folder, publish, recover

# fixed values: columns tracked by the product history (check strategy)
PRODUCT_CHECK_COLS = ["product_title", "brand", "category_group", "subcategory", "price_bucket", "amazon_average_rating"]

# Read by several marts; the review-level context is left lazy because its
# readers need a few columns, which a pruned scan of the fact table supplies.
SHARED_MODELS = ("fct_reviews", "reviewer_history", "stg_products", "dim_products", "product_review_facts")


class Warehouse:
    def __init__(
        self,
        reviews: DataFrame,
        products: DataFrame,
        mapping: DataFrame,
        rules: DataFrame,
        materialize: str = "ephemeral",
        run_id: str | None = None,
        output_root: str | None = None,
    ):
        self.raw_reviews = reviews
        self.raw_products = products
        self.mapping = mapping
        self.rules = rules
        self.materialize = materialize
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self.output_root = output_root.rstrip("/") if output_root else None
        self.spark = reviews.sparkSession
        self._staged: str | None = None  # where a build in progress writes
        self._lock = threading.Lock()
        self._written: dict[str, DataFrame] = {}

    def _path(self, name: str) -> str:
        if self.output_root:
            return f"{self._staged or self.output_root}/{name}"
        return scratch_path(self.spark, f"{self.run_id}/{name}")

    def _keep(self, name: str, df: DataFrame, partition_by: tuple = ()) -> DataFrame:
        if self.materialize != "table" or name not in SHARED_MODELS:
            return df
        path = self._path(name)
        w = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        with freed_shuffles(df.sparkSession):
            w.parquet(path)
        written = self.spark.read.parquet(path)
        with self._lock:
            self._written[name] = written
        return written

    def load(self) -> "Warehouse":
        """Take every model that ``build`` writes from ``output_root``: other models, and
        tests, then derive from those tables, not from the raw inputs."""
        recover(self.spark, self.output_root)
        for cached in [n for n in self.__dict__ if isinstance(getattr(type(self), n, None), cached_property)]:
            del self.__dict__[cached]
        for name in (n for level in self.LEVELS for n in level):
            self.__dict__[name] = self._written[name] = self.spark.read.parquet(self._path(name))
        return self

    def table(self, name: str) -> DataFrame:
        """A model by name: its written table when the build wrote it, else the lazy plan."""
        return self._written.get(name) if name in self._written else getattr(self, name)

    # staging ------------------------------------------------------------
    @cached_property
    def stg_reviews(self) -> DataFrame:
        return clean_reviews(self.raw_reviews)

    @cached_property
    def stg_products(self) -> DataFrame:
        return self._keep("stg_products", stg_products(self.raw_products, self.mapping, self.rules))

    @property
    def _dated_reviews(self) -> DataFrame:
        """Cheapest source of review dates: dedup keeps every date, so staged and
        deduplicated reviews hold the same set; a materialized fact table is a
        one-column scan, otherwise the staged reviews avoid the dedup shuffle."""
        return self.fct_reviews if self.materialize == "table" else self.stg_reviews

    @cached_property
    def latest_review_date(self):
        """Scalar anchor: the latest review date.

        On the month-partitioned fact table a scan without data columns finds the
        newest month, and dates are read from that month's partition only.
        """
        src = self._dated_reviews
        if "review_month" in src.columns:
            last_month = src.agg(F.max("review_month")).scalar()
            src = src.where(F.col("review_month") == last_month)
        return src.agg(F.max("reviewed_date")).scalar()

    # core ---------------------------------------------------------------
    @cached_property
    def fct_reviews(self) -> DataFrame:
        if self.materialize == "table":
            # written partitioned by month: trailing-window reads prune partitions
            return self._keep("fct_reviews", self._reviews_by_month, partition_by=("review_month",))
        return fct_reviews(self.stg_reviews)

    @property
    def _reviews_by_month(self) -> DataFrame:
        """The facts in the tasks that write them: whole reviews move once, to the task of
        their month or of a part of it. The staged reviews are read for their number first."""
        staged = self.stg_reviews
        tasks = MonthSlots.of(count_buckets(staged), ROWS_PER_TASK)
        if not tasks.slots:
            return fct_reviews(staged, cluster_by_month=True)
        return fct_reviews(tasks.dealt(staged), slots=tasks.slots).drop("first_of_month")

    @cached_property
    def product_review_stats(self) -> DataFrame:
        if self.materialize == "table":
            # the review context holds the fact table's rows (a left join to one
            # history row per reviewer), so the statistics come out of the shared
            # per-product aggregate instead of a second pass over the fact table
            return finish_product_stats(self.product_review_facts.select("product_id", *STAT_AGG_COLUMNS))
        return product_review_stats(self.fct_reviews)

    @cached_property
    def reviewer_history(self) -> DataFrame:
        return self._keep("reviewer_history", reviewer_history(self.stg_reviews, in_parts=self.materialize == "table"))

    @cached_property
    def _facts_by_reviewer(self) -> DataFrame:
        """The facts where their reviewers' history is, with the part of a reviewer's reviews."""
        hot = hot_keys(self.reviewer_history, "reviewer_id", "lifetime_review_count")
        return derived_facts(reviews_by_reviewer(self.stg_reviews, hot, PART), PART)

    @cached_property
    def reviews_with_context(self) -> DataFrame:
        if self.materialize != "table":  # nothing is stored: the facts are made where the context is
            return self._keep("reviews_with_context", self._parted_context.drop(PART))
        return self._keep("reviews_with_context", with_reviewer_context(self.fct_reviews, self.reviewer_history, part=PART))

    @property
    def _parted_context(self) -> DataFrame:
        """The review context with the part of its reviewer's reviews that a row is in."""
        if self.materialize != "table":
            return with_reviewer_context(self._facts_by_reviewer, self.reviewer_history, part=PART)
        return self.reviews_with_context

    # marts --------------------------------------------------------------
    @cached_property
    def dim_products(self) -> DataFrame:
        return self._keep("dim_products", dim_products(self.stg_products, self.product_review_stats, anchor=self.latest_review_date))

    @cached_property
    def dim_reviewers(self) -> DataFrame:
        return dim_reviewers(self.reviewer_history)

    @cached_property
    def dim_categories(self) -> DataFrame:
        return category_rollup(self.dim_products)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return date_dimension(self._dated_reviews, floor=SPINE_START, end=SPINE_END)

    @cached_property
    def fct_reviews_daily(self) -> DataFrame:
        return daily_rollup(self.fct_reviews)

    @cached_property
    def fct_reviews_monthly(self) -> DataFrame:
        return monthly_rollup(self.fct_reviews, narrow=self.materialize == "table")

    @cached_property
    def product_review_facts(self) -> DataFrame:
        """Per-product aggregates of the review context shared by the category
        scorecard and the risk mart: one review-grain join + aggregation for both."""
        aggs = tendency_aggregates() + signal_aggregates(self.latest_review_date)
        context = self.reviews_with_context
        if self.materialize == "table":
            context = self._parted_context
            context = by_product(context.withColumn("first_of_pair", first_of_pair(context, PART)))
            aggs += product_stat_aggregates(first=F.col("first_of_pair"))
        return self._keep("product_review_facts", context.groupBy("product_id").agg(*aggs))

    @cached_property
    def mart_category_performance(self) -> DataFrame:
        return category_performance(self.reviews_with_context, self.stg_products, per_product=self.product_review_facts)

    @cached_property
    def signal_counts(self) -> DataFrame:
        return signal_counts(self.reviews_with_context)

    @cached_property
    def recent_sentiment(self) -> DataFrame:
        return recent_sentiment(self.fct_reviews, anchor=self.latest_review_date)

    @cached_property
    def mart_products_at_risk(self) -> DataFrame:
        products = self.dim_products
        if self.materialize != "table":  # over the same facts as the context, which move once
            stats = product_review_stats(self._facts_by_reviewer.drop(PART))
            products = dim_products(self.stg_products, stats, anchor=self.latest_review_date)
        return products_at_risk(
            products, self.reviews_with_context, anchor=self.latest_review_date,
            signals=self.product_review_facts,
        )

    def snapshot_products(self, history: DataFrame | None, as_of: dt.datetime) -> DataFrame:
        return scd2_apply(history, self.stg_products, "product_id", PRODUCT_CHECK_COLS, as_of)

    MARTS = (
        "fct_reviews", "dim_products", "dim_reviewers", "dim_categories", "dim_dates",
        "fct_reviews_daily", "fct_reviews_monthly", "mart_category_performance", "mart_products_at_risk",
    )

    def marts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.MARTS}

    # Models by dependency level: everything in a level only reads models of
    # earlier levels, so a level's models can run as concurrent Spark jobs.
    LEVELS = (
        ("fct_reviews", "reviewer_history", "stg_products"),
        ("product_review_facts", "dim_reviewers", "dim_dates", "fct_reviews_daily", "fct_reviews_monthly"),
        ("dim_products", "mart_category_performance"),
        ("dim_categories", "mart_products_at_risk"),
    )

    # Tests of a model run alongside the level after the one that builds it
    # (inputs and staged reviews with the first level; relationship tests once
    # their parent exists).
    TEST_LEVELS = (
        ("raw_reviews", "raw_products", "category_mapping", "subcategory_rules", "stg_reviews"),
        ("stg_products", "reviewer_history", "reviews_with_context"),
        ("product_review_stats", "dim_reviewers", "dim_dates", "fct_reviews_daily", "fct_reviews_monthly"),
        ("fct_reviews", "dim_products", "mart_category_performance"),
        ("dim_categories", "mart_products_at_risk"),
    )

    def build(self, threads: int = 4, extra: dict | None = None, tests: bool = False) -> dict[str, float]:
        """Run every mart level by level, optionally with the column tests.

        Shared models are materialized (``materialize="table"``); the other
        marts are written to ``output_root/<name>`` when set (and later reads,
        e.g. the tests, use the written tables), else executed through the
        ``noop`` sink. A build under ``output_root`` is written beside it and shown
        when every model and test has run: a build that fails leaves the tables of
        the one before, all of them, and ``load`` reads whole builds only. With ``tests`` each model's column tests run as a job of
        the level after the model is built (``TEST_LEVELS``). ``extra`` maps
        names to callables (wh → DataFrame) run after the last level. Returns
        seconds per model / test group.
        """
        import time
        from concurrent.futures import ThreadPoolExecutor

        timings: dict[str, float] = {}

        def run(name: str, make=None) -> None:
            t0 = time.perf_counter()
            df = make(self) if make else getattr(self, name)
            if not (self.materialize == "table" and name in SHARED_MODELS):
                if self.output_root and make is None:
                    with freed_shuffles(df.sparkSession):
                        df.write.mode("overwrite").option("compression", "zstd").parquet(self._path(name))
                    written = self.spark.read.parquet(self._path(name))
                    with self._lock:
                        self._written[name] = written
                else:
                    df.write.format("noop").mode("overwrite").save()
            with self._lock:
                timings[name] = round(time.perf_counter() - t0, 3)

        from revlens.plans.checks import run_suite

        def test(model: str):
            return (f"tests:{model}", lambda wh: run_suite(wh, [model]))

        jobs = [[(name, None) for name in level] for level in self.LEVELS] + [[]]
        if tests:
            for i, models in enumerate(self.TEST_LEVELS):
                jobs[i] += [test(m) for m in models]
        if extra:
            jobs.append(list(extra.items()))
        def run_levels() -> None:
            with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
                for level in jobs:
                    list(pool.map(lambda job: run(*job), level))

        if not self.output_root:
            run_levels()
            return timings
        recover(self.spark, self.output_root)
        self._staged = next_folder(self.output_root)
        try:
            run_levels()
        except BaseException:
            discard(self.spark, self._staged)
            raise
        finally:
            staged, self._staged = self._staged, None
        publish(self.spark, staged, self.output_root)
        self.load()
        return timings


def build_warehouse(reviews, products, mapping, rules, materialize: str = "table", **kw) -> dict[str, DataFrame]:
    """Every mart of the warehouse as a DataFrame (shared models materialized once)."""
    return Warehouse(reviews, products, mapping, rules, materialize=materialize, **kw).marts()
