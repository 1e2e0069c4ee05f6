"""Calendar dimension around the data's date range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens import functions as RF

# fixed values: the calendar's hard spine [2000-01-01, 2025-12-31), end exclusive
SPINE_START = dt.date(2000, 1, 1)
SPINE_END = dt.date(2025, 12, 31)


def date_dimension(
    df: DataFrame,
    date_col: str = "reviewed_date",
    pad_days: int = 30,
    floor: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """One row per day from (min − pad) to (max + pad), clamped to [floor, end) where given.

    The bounds are one partial/final aggregate; the day list is generated with
    ``sequence`` + ``explode`` (366 rows a year of the data's range). No dates: no rows.
    """
    b = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    lo, hi = F.date_sub("lo", pad_days), F.date_add("hi", pad_days)
    if floor is not None:
        lo = F.greatest(lo, F.lit(floor))
    if end is not None:
        hi = F.least(hi, F.date_sub(F.lit(end), 1))
    days = F.when(F.col("lo").isNotNull() & (lo <= hi), F.sequence(lo, hi)).otherwise(F.array().cast("array<date>"))
    d = b.select(F.explode(days).alias("date"))
    c = F.col("date")
    year, quarter, month = F.year(c).cast("long"), F.quarter(c).cast("long"), F.month(c).cast("long")
    return d.select(
        c.alias("date"),
        year.alias("year"),
        quarter.alias("quarter"),
        month.alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.dayofmonth(c).cast("long").alias("day_of_month"),
        (F.dayofweek(c) - 1).cast("long").alias("day_of_week"),
        F.date_format(c, "EEEE").alias("day_name"),
        F.weekofyear(c).cast("long").alias("week_of_year"),
        RF.is_weekend(c).alias("is_weekend"),
        F.trunc(c, "month").alias("month_start_date"),
        F.trunc(c, "quarter").alias("quarter_start_date"),
        F.trunc(c, "year").alias("year_start_date"),
        F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0")).alias("year_month"),
        F.concat(F.lit("Q"), quarter.cast("string"), F.lit(" "), year.cast("string")).alias("quarter_label"),
    )
