"""Data-quality checks (Q1–Q6).

Each ``check_*`` returns the failing rows as a lazy DataFrame (empty = pass),
with the same failure semantics as the warehouse's column tests: nulls pass
every check except ``not_null``. ``run_checks`` reports a whole suite as
(check, column, failures) rows, fusing all row-local checks into one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens import functions as RF
from revlens.operators.skew import ROWS_PER_SPLIT, split_hot_join


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Duplicated non-null values with their row counts."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


#: Shares of the hash values, of which ``check_unique`` compares those that hold equal ones.
SHARES = 1024


def _suspects(df: DataFrame, col: str) -> DataFrame:
    """Rows among which all duplicated values are: those of the shares of the texts' hash
    values in which one stands twice. Hash values move, texts only where these are equal."""
    if df.schema[col].dataType not in (T.StringType(), T.BinaryType()):
        return df
    h = F.xxhash64(F.col(col))
    twice = df.where(F.col(col).isNotNull()).groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shares = twice.agg(F.collect_set(F.pmod("h", F.lit(SHARES)).cast("int"))).scalar()
    return df.where(F.array_contains(shares, F.pmod(h, F.lit(SHARES)).cast("int")))


def check_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Non-null values outside ``values``, one row per distinct value."""
    return (
        df.groupBy(F.col(col).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("value_field").isNotNull() & ~F.col("value_field").isin(list(values)))
    )


def check_relationship(
    df: DataFrame, col: str, parent: DataFrame, field: str, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Child rows whose non-null ``col`` has no ``field`` match in ``parent`` (anti join).

    Child keys with more than ``rows_per_split`` rows are split across tasks
    (``revlens.operators.skew``); the result is the plain anti join's.
    """
    p = parent.select(F.col(field).alias(col)).distinct()
    return split_hot_join(df.where(F.col(col).isNotNull()), p, col, "left_anti", rows_per_split=rows_per_split)


def check_non_negative(df: DataFrame, col: str) -> DataFrame:
    """Rows with a negative value (nulls allowed)."""
    return df.where(F.col(col) < 0)


@dataclass
class Check:
    kind: str  # not_null | unique | accepted_values | relationship | non_negative
    column: str
    values: Sequence = ()
    parent: DataFrame | None = field(default=None, repr=False)
    parent_field: str | None = None


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Q6: one (check, column, failures) row per check.

    * not_null / non_negative / accepted_values share ONE pass over ``df``: it
      groups by the offending value of each accepted-values check (null for
      good rows) and sums the null / negative counts. Good rows collapse into
      a single all-null group in each map task, so only distinct offending
      combinations reach the shuffle; a final aggregate over that small result
      counts the distinct bad values per check (no ``Expand`` over the input);
    * unique: one aggregation per check, of texts over their hash values first; relationship: child rows pre-counted
      per key, then an anti join at key grain.
    """
    spark = df.sparkSession
    counted, accepted, parts = [], [], []

    def row(i: int, ch: Check, failures) -> list:
        return [F.lit(i).alias("ord"), F.lit(ch.kind).alias("check"), F.lit(ch.column).alias("column"),
                failures.cast("long").alias("failures")]

    for i, ch in enumerate(checks):
        c = F.col(ch.column)
        if ch.kind == "not_null":
            counted.append((i, ch, RF.count_if(c.isNull())))
        elif ch.kind == "non_negative":
            counted.append((i, ch, RF.count_if(c < 0)))
        elif ch.kind == "accepted_values":
            accepted.append((i, ch, F.when(c.isNotNull() & ~c.isin(list(ch.values)), c)))
        elif ch.kind == "unique":
            parts.append(check_unique(_suspects(df, ch.column), ch.column).agg(*row(i, ch, F.count(F.lit(1)))))
        elif ch.kind == "relationship":
            # count child rows per key first: the anti join then runs at key
            # grain, so a key holding a large share of the rows is one row
            per_key = df.where(c.isNotNull()).groupBy(c.alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
            p = ch.parent.select(F.col(ch.parent_field).alias("__pk"))
            orphans = per_key.join(p, F.col("__k") == F.col("__pk"), "left_anti")
            parts.append(orphans.agg(*row(i, ch, F.coalesce(F.sum("__n"), F.lit(0)))))
        else:
            raise ValueError(ch.kind)
    if counted or accepted:
        grouped = df.groupBy(*[bad.alias(f"b{i}") for i, _, bad in accepted]).agg(
            F.count(F.lit(1)).alias("__rows"), *[e.alias(f"f{i}") for i, _, e in counted]
        )
        one = grouped.agg(
            F.lit(0).alias("__dummy"),
            *[F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"r{i}") for i, _, _ in counted],
            *[F.countDistinct(f"b{i}").alias(f"r{i}") for i, _, _ in accepted],
        )
        stack = F.array(*[
            F.struct(F.lit(i).alias("ord"), F.lit(ch.kind).alias("check"), F.lit(ch.column).alias("column"),
                     F.col(f"r{i}").cast("long").alias("failures"))
            for i, ch, _ in sorted(counted + accepted, key=lambda t: t[0])
        ])
        parts.insert(0, one.select(F.explode(stack).alias("r")).select("r.*"))
    if not parts:
        return spark.createDataFrame([], "check string, column string, failures long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("ord").drop("ord")
