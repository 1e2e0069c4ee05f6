"""Column-level functions (built-in expressions only, no Python UDFs).

Every function takes and returns ``pyspark.sql.Column`` objects (or column
names), so they stay inside whole-stage codegen and can be used on any table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Numeric helpers
# --------------------------------------------------------------------------

def round_half_away(c: ColumnOrName, digits: int = 0) -> Column:
    """Round a double to ``digits`` places: scale, round half away from zero, unscale.

    ``F.round`` rounds the *decimal text* of a double, which differs from
    scaling the binary value first (e.g. 41/40 to 2 places gives 1.03 instead
    of 1.02). Scaling keeps warehouse results identical to engines that round
    the scaled binary value. Nulls stay null.
    """
    c = _c(c).cast("double")
    if digits == 0:
        return F.round(c, 0)
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName, default=None) -> Column:
    """numerator / denominator as double; ``default`` when the denominator is 0 or null."""
    n, d = _c(numerator), _c(denominator)
    fallback = F.lit(default).cast("double")
    return F.when(d.isNull() | (d == 0), fallback).otherwise(n.cast("double") / d.cast("double"))


def pct(part: ColumnOrName, whole: ColumnOrName, digits: int = 1) -> Column:
    """round(100 * part / whole, digits) in double arithmetic (null when whole is null)."""
    return round_half_away(F.lit(100.0) * _c(part).cast("double") / _c(whole).cast("double"), digits)


def to_int(c: ColumnOrName, source_type=None) -> Column:
    """Cast to int, rounding fractional inputs half-to-even first (not truncating)."""
    from pyspark.sql.types import DoubleType, FloatType, DecimalType

    col = _c(c)
    if source_type is not None and isinstance(source_type, (DoubleType, FloatType, DecimalType)):
        return F.bround(col, 0).cast("int")
    return col.cast("int")


def stddev_samp_int(c: ColumnOrName) -> Column:
    """Sample standard deviation of an integer-valued column from exact moments.

    sqrt((n·Σx² − (Σx)²) / (n·(n−1))) with long sums, and decimal(38,0) in the final step: the
    moments are exact, so the result is the correctly rounded value (no
    dependence on summation order or partitioning) and it stays a plain
    partial/final aggregate. Null for fewer than two values.
    """
    x = _c(c).cast("long")
    return stddev_from_moments(F.count(x), F.sum(x), F.sum(x * x))


def stddev_from_moments(n: ColumnOrName, s1: ColumnOrName, s2: ColumnOrName) -> Column:
    """The same from a count, a sum and a sum of squares, which add up over groups."""
    wide = "decimal(38,0)"
    n, s1, s2 = (_c(x).cast(wide) for x in (n, s1, s2))
    num = (n * s2 - s1 * s1).cast("double")
    den = (n * (n - F.lit(1))).cast("double")
    return F.when(n > 1, F.sqrt(num / den))


def count_if(cond: Column) -> Column:
    """sum(case when cond then 1 else 0 end) as bigint (null-safe: null counts 0)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


# --------------------------------------------------------------------------
# Buckets and flags
# --------------------------------------------------------------------------

def bucketize(
    c: ColumnOrName,
    bounds: Sequence[tuple[float, str]],
    else_label: str,
    null_label: str | None = None,
) -> Column:
    """First-match bucket: ``c < bound`` → label for each (bound, label) in order.

    A null input gets ``null_label`` when given; otherwise it falls through to
    ``else_label`` (the comparisons are null, so no branch matches).
    """
    col = _c(c)
    expr = None
    if null_label is not None:
        expr = F.when(col.isNull(), F.lit(null_label))
    for bound, label in bounds:
        cond = col < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(else_label)
    return expr.otherwise(F.lit(else_label))


def sentiment_from_rating(c: ColumnOrName, positive: int = 4, negative: int = 2) -> Column:
    """positive (>= positive), negative (<= negative), else neutral; null → neutral."""
    col = _c(c)
    return (
        F.when(col >= F.lit(positive), F.lit("positive"))
        .when(col <= F.lit(negative), F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def review_length_bucket(c: ColumnOrName, short_below: int = 50, medium_below: int = 300) -> Column:
    return bucketize(c, [(short_below, "short"), (medium_below, "medium")], "long")


def has_votes(c: ColumnOrName) -> Column:
    """False only for an explicit 0; null counts as true."""
    return F.coalesce(_c(c) != F.lit(0), F.lit(True))


def is_null_or_zero(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c) == F.lit(0), F.lit(True))


def price_bucket(c: ColumnOrName) -> Column:
    return bucketize(
        c,
        [(10, "under_10"), (25, "10_to_25"), (50, "25_to_50"), (100, "50_to_100")],
        "over_100",
        null_label="unknown",
    )


def review_volume_bucket(c: ColumnOrName, sparse_below: int = 5, moderate_below: int = 20) -> Column:
    return bucketize(
        c, [(sparse_below, "sparse"), (moderate_below, "moderate")], "well_reviewed", null_label="no_reviews"
    )


def engagement_bucket(c: ColumnOrName) -> Column:
    col = _c(c)
    return (
        F.when(col == 1, F.lit("one_shot"))
        .when(col.between(2, 4), F.lit("occasional"))
        .when(col.between(5, 20), F.lit("regular"))
        .otherwise(F.lit("power_reviewer"))
    )


def rating_consistency(c: ColumnOrName) -> Column:
    return bucketize(
        c,
        [(0.5, "very_consistent"), (1.0, "consistent"), (1.5, "variable")],
        "highly_variable",
        null_label="insufficient_data",
    )


def reviewer_tendency(n: ColumnOrName, diff: ColumnOrName, min_reviews: int = 3, band: float = 0.75) -> Column:
    """insufficient_data below ``min_reviews``; harsh/generous outside ±band; else balanced."""
    n, diff = _c(n), _c(diff)
    return (
        F.when(n < F.lit(min_reviews), F.lit("insufficient_data"))
        .when(diff < F.lit(-band), F.lit("harsh"))
        .when(diff > F.lit(band), F.lit("generous"))
        .otherwise(F.lit("balanced"))
    )


def is_trusted(prolific: ColumnOrName, tendency: ColumnOrName, verified_pct: ColumnOrName, min_verified: float = 50) -> Column:
    cond = _c(prolific) & (_c(tendency) == F.lit("balanced")) & (_c(verified_pct) > F.lit(min_verified))
    return F.coalesce(cond, F.lit(False))


def category_health(avg_rating: ColumnOrName, negative_pct: ColumnOrName) -> Column:
    a, neg = _c(avg_rating), _c(negative_pct)
    return (
        F.when((a >= F.lit(4.3)) & (neg < F.lit(15)), F.lit("healthy"))
        .when((a >= F.lit(3.8)) & (neg < F.lit(25)), F.lit("stable"))
        .when(a >= F.lit(3.3), F.lit("watch"))
        .otherwise(F.lit("struggling"))
    )


def rating_delta(a: ColumnOrName, b: ColumnOrName, digits: int = 2) -> Column:
    """round(a - b, digits); null when either side is null."""
    return round_half_away(_c(a) - _c(b), digits)


def is_weekend(c: ColumnOrName) -> Column:
    """Saturday or Sunday."""
    return F.dayofweek(_c(c)).isin(1, 7)


def flag(cond: Column) -> Column:
    """Boolean with null → false (``case when cond then true else false end``)."""
    return F.coalesce(cond, F.lit(False))


# --------------------------------------------------------------------------
# Text, parsing, keys
# --------------------------------------------------------------------------

def text_length(c: ColumnOrName) -> Column:
    return F.length(_c(c)).cast("long")


def word_count_approx(c: ColumnOrName) -> Column:
    """Spaces + 1 (double spaces count twice, as in the warehouse definition)."""
    col = _c(c)
    return (F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit(""))) + F.lit(1)).cast("long")


def parse_price(c: ColumnOrName) -> Column:
    """Price text → double; null for null/'None'/''/unparseable text.

    Number parsing follows the warehouse engine: Java-style type suffixes
    ('10d', '2.5f') are rejected and digit-group underscores ('1_000') are
    accepted, so the same strings parse on both sides.
    """
    col = _c(c)
    guarded = F.when(col.rlike(r"(?i)[0-9.][df]\s*$"), F.lit(None).cast("string")).otherwise(
        F.regexp_replace(col, r"(?<=\d)_(?=\d)", "")
    )
    return (
        F.when(col.isNull() | (col == F.lit("None")) | (col == F.lit("")), F.lit(None).cast("double"))
        .otherwise(guarded.try_cast("double"))
    )


# fixed value: null marker of the surrogate-key convention the warehouse uses
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 of the '-'-joined string casts, nulls replaced by a fixed marker."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def preview(c: ColumnOrName, n: int = 60) -> Column:
    return F.left(_c(c), F.lit(n))
