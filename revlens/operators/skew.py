"""Hot-key splitting for fact → dimension joins.

A fact table joined to a one-row-per-key dimension sends every fact row of a
key to one task. When one key holds a large share of the rows (one reviewer
with a third of all reviews), that task does a third of the work. AQE's
skew-join handling only applies when both join inputs are plain shuffles; a
dimension produced by an aggregate on the join key is not, so the split is
done explicitly here:

* hot keys = keys whose (known or counted) row count exceeds
  ``rows_per_split``, all of them: there are fewer than rows / ``rows_per_split``,
  which bounds the broadcast list (60,000 keys for 30 billion rows);
* each hot key gets ``ceil(count / rows_per_split)`` splits; its fact rows pick a split by a deterministic hash of ``spread`` columns and
  its dimension row is replicated once per split;
* the join runs on (key, split).

Every fact row still meets exactly the dimension rows of its key, so the
result equals the plain join for any hot set. Null keys match nothing and are
spread by the same hash. The replicated dimension rows are bounded by
Σ splits ≤ rows / ``rows_per_split`` + hot keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 500_000
NULL_SPLITS = 4096


def hot_keys(counts: DataFrame, key: str, count_col: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """(key, __splits) for the keys above ``rows_per_split`` rows."""
    n = F.col(count_col)
    return counts.where(n > rows_per_split).select(
        F.col(key).alias("__hot_key"), F.ceil(n / F.lit(float(rows_per_split))).cast("int").alias("__splits")
    )


def split_hot_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    spread: Sequence[str] = (),
    counts: DataFrame | None = None,
    count_col: str | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
    part: str | None = None,
) -> DataFrame:
    """Join ``fact`` to a unique-keyed ``dim`` on ``key`` with hot keys split.

    ``counts``/``count_col`` give the rows per key when already known (e.g. the
    dimension's own review count); otherwise they are counted from ``fact``
    (a partial aggregation). ``spread`` columns (default: all fact columns)
    choose a row's split deterministically, so a recomputed task lands each
    row in the same split. ``part`` names a column that keeps a row's split: rows
    that agree in it and in ``key`` are in one task.
    """
    if how not in ("left", "inner", "left_anti", "left_semi"):
        raise ValueError(how)
    if counts is None or count_col is None:
        counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
        count_col = "__rows"
    hot = F.broadcast(hot_keys(counts, key, count_col, rows_per_split))
    spread_cols = [F.col(c) for c in (spread or fact.columns)]
    f = fact.join(hot, fact[key] == F.col("__hot_key"), "left")
    f = f.withColumn("__split", _split(key, spread_cols)).drop("__hot_key", "__splits")
    joined = f.join(per_split(dim, hot, key, "__split"), [key, "__split"], how)
    return joined.withColumnRenamed("__split", part) if part else joined.drop("__split")


def _split(key: str, spread: Sequence[Column]) -> Column:
    splits = F.when(F.col(key).isNull(), F.lit(NULL_SPLITS)).otherwise(F.coalesce(F.col("__splits"), F.lit(1)))
    return F.pmod(F.xxhash64(*spread), splits).cast("int")


def per_split(dim: DataFrame, hot: DataFrame, key: str, part: str) -> DataFrame:
    """A unique-keyed table's rows, once for every split of their key, numbered by ``part``."""
    d = dim.join(F.broadcast(hot), dim[key] == F.col("__hot_key"), "left")
    splits = F.sequence(F.lit(0), F.coalesce(F.col("__splits"), F.lit(1)) - 1)
    return d.withColumn(part, F.explode(splits)).drop("__hot_key", "__splits")


def dealt(fact: DataFrame, hot: DataFrame, key: str, spread: Sequence[str], part: str, thin: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fact`` with the split of each row, a hash of ``spread`` in hot and null keys.
    ``thin`` cuts copies among the rows of these keys before they are dealt to few tasks."""
    found = fact.join(F.broadcast(hot), fact[key] == F.col("__hot_key"), "left").drop("__hot_key")
    crowded = F.col("__splits").isNotNull() | F.col(key).isNull()
    calm = found.where(~crowded).withColumn(part, F.lit(0))
    crowd = thin(found.where(crowded)).withColumn(part, _split(key, [F.col(c) for c in spread]))
    return calm.unionByName(crowd).drop("__splits")
