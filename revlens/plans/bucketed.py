"""The warehouse over bucketed tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from revlens.operators.reviewers import context_columns, flag_signals
from revlens.operators.staging import derived_facts, reviews_by_reviewer, stg_products
from revlens.plans.warehouse import Warehouse
from revlens.session import scratch_path
from revlens.sources.bucketing import BUCKET_BYTES, PART, Layout, bucket_count, co_join, layout, stored_bytes
from revlens.sources.io import materialize


class BucketedWarehouse(Warehouse):
    """Shared models are stored in buckets: facts and reviewer history by reviewer, the
    product models by product. The review context and the product marts then join what
    is stored without an exchange. Written under the checkpoint folder, by run."""

    def __init__(self, *args, bucket_bytes: int = BUCKET_BYTES, rows_per_split: int | None = None, **kw):
        super().__init__(*args, **{"materialize": "table", **kw})
        self.bucket_bytes = bucket_bytes
        self.splits = {} if rows_per_split is None else {"rows_per_split": rows_per_split}

    def _stored(self, name: str) -> str:
        return scratch_path(self.spark, f"{self.run_id}/bucketed/{name}")

    # by reviewer ---------------------------------------------------------
    @cached_property
    def by_reviewer(self) -> Layout:
        """The bytes of the raw reviews' files give the bucket number, the history the hot reviewers."""
        files = self.raw_reviews.inputFiles()
        least = 1 if files else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        n = bucket_count(sum(stored_bytes(self.spark, f) for f in files), self.bucket_bytes, least)
        history = self.reviewer_history
        return layout(history, "reviewer_id", n, history, "lifetime_review_count", **self.splits)

    @cached_property
    def stored_reviews(self) -> DataFrame:
        # deduplicated in the tasks that write the buckets; what follows from other columns is
        # not moved with the rows; spread by product, as the product marts count a product's
        # reviewers in place
        by = self.by_reviewer
        reviews = reviews_by_reviewer(self.stg_reviews, by.hot, PART, by.buckets)
        return by.write(reviews, self._stored("reviews"), lambda rows: derived_facts(rows, PART), True)

    @cached_property
    def stored_history(self) -> DataFrame:
        return self.by_reviewer.write(self.by_reviewer.dimension(self.reviewer_history), self._stored("history"))

    @cached_property
    def fct_reviews(self) -> DataFrame:
        return self.stored_reviews.drop(PART)

    @cached_property
    def _parted_context(self) -> DataFrame:
        joined = co_join(self.stored_reviews, context_columns(self.stored_history, PART), "reviewer_id", keep_part=True)
        return flag_signals(joined, self.stored_reviews.columns)

    @cached_property
    def reviews_with_context(self) -> DataFrame:
        return self._parted_context.drop(PART)

    # by product ----------------------------------------------------------
    @cached_property
    def by_product(self) -> Layout:
        """Product models have one row per product, so no key is cut."""
        self._products  # noqa: B018 (their bytes give the bucket number)
        return Layout("product_id", bucket_count(stored_bytes(self.spark, self._path("products")), self.bucket_bytes))

    @cached_property
    def _products(self) -> DataFrame:
        staged = stg_products(self.raw_products, self.mapping, self.rules)
        return materialize(staged, "products", path=self._path("products"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return self.by_product.write(self._products, self._stored("stg_products"))

    def _keep(self, name: str, df: DataFrame, partition_by: tuple = ()) -> DataFrame:
        if name in ("product_review_facts", "dim_products"):
            return self.by_product.write(df, self._stored(name))
        return super()._keep(name, df)
