"""Positions in a total order, without one task that sees all rows.

A window without partition keys sends the whole table to one task. Here the rows are
range partitioned and sorted, and written together with their range and their place in
it (range bounds are sampled, so they must be fixed before they are used twice). A
row's number is then the rows of earlier ranges, a prefix sum over one count per range,
plus its place. Ties of the rank may lie in several ranges; where such a run of equal
keys begins is told by the first and last key of every range.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import scratch_path
from revlens.sources.io import materialize

_PLACE = (1 << 33) - 1


def _key(spec: str) -> tuple[str, bool]:
    name, _, way = spec.partition(" ")
    if way not in ("", "asc", "desc"):
        raise ValueError(f"order {spec!r}")
    return name, way == "desc"


def _sort(spec: str) -> Column:
    name, down = _key(spec)
    c = F.col("row").getField(name)
    return c.desc_nulls_last() if down else c.asc_nulls_last()


def _ranges(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """row, range and place, written in the order ``by``. Rows that it ties are told
    apart by their place in ``df``, so a key that a third of the rows share is split."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("tie"))
    order = [*map(_sort, by), F.col("tie").asc()]
    at = F.monotonically_increasing_id()
    out = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    out = out.select("row", F.shiftrightunsigned(at, 33).alias("range"), at.bitwiseAND(F.lit(_PLACE)).alias("place"))
    name = f"ranges-{uuid.uuid4().hex}"
    return materialize(out, name, path=scratch_path(df.sparkSession, name))


def _numbered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """row, range and number (from 1)."""
    rows = _ranges(df, by)
    # one row per range, that is per task of the write, never per input row
    counts = sorted(tuple(r) for r in rows.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect())
    before = [0, *accumulate(n for _, n in counts)]
    starts = df.sparkSession.createDataFrame([(r, at) for (r, _), at in zip(counts, before)], "range long, start long")
    return rows.join(starts, "range").select("row", "range", (F.col("start") + F.col("place") + 1).alias("number"))


def number_rows(df: DataFrame, by: Sequence[str], name: str = "number") -> DataFrame:
    """``df`` with the position (1, 2, 3 ...) of every row in the order ``by``
    (columns, each followed by `` desc`` where it descends; nulls last).

    Ties get successive positions in the order of the rows in ``df``, which must give
    the same rows in the same order when read again (a table, and row by row operations
    on it). An existing column ``name`` is replaced. No rows give no rows.
    """
    names = [c for c in df.columns if c != name]
    return _numbered(df, by).select(*[F.col("row").getField(c).alias(c) for c in names], F.col("number").alias(name))


def rank_rows(df: DataFrame, by: Sequence[str], ties: int = 1, prefix: str = "queue") -> DataFrame:
    """``df`` with ``<prefix>_position`` as number_rows gives it, and ``<prefix>_rank``
    and ``<prefix>_percent``: SQL's rank() and percent_rank() over the first ``ties``
    columns of ``by`` (nulls are equal). A single row has percent 0.
    """
    rows = _numbered(df, by)
    key = F.struct(*[F.col("row").getField(_key(s)[0]).alias(f"k{i}") for i, s in enumerate(by[:ties])])
    # where each run of equal keys begins inside its range, which bounds the window's rows
    rows = rows.withColumn("peer", key).withColumn("first", F.first("number").over(Window.partitionBy("range", "peer").orderBy("number")))
    # a run that goes on from an earlier range is the last of that one: two keys a range
    ends = [f("at", "number").alias(n) for f, n in ((F.min_by, "a"), (F.max_by, "b"))]
    edges = rows.withColumn("at", F.struct("peer", "first")).groupBy("range").agg(*ends)
    edges = edges.select(F.explode(F.array("a", "b")).alias("at")).groupBy(F.col("at.peer").alias("edge")).agg(F.min("at.first").alias("begin"))
    n = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    rank = F.coalesce("begin", "first")
    return rows.join(F.broadcast(edges), F.col("peer").eqNullSafe(F.col("edge")), "left").select(
        *[F.col("row").getField(c).alias(c) for c in df.columns],
        F.col("number").alias(f"{prefix}_position"),
        rank.alias(f"{prefix}_rank"),
        F.coalesce(F.try_divide((rank - 1).cast("double"), (n - 1).cast("double")), F.lit(0.0)).alias(f"{prefix}_percent"),
    )
