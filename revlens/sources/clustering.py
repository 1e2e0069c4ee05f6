"""Layout for filters on several columns: rows clustered by interleaved ranks.

A sorted table lets readers skip row groups for its first column only. Here each column
is replaced by its approximate rank (which of ``1 << BITS`` equal parts of the rows its
value falls in), the bits of the ranks are interleaved, and rows are written in that
order, by range. A row group then spans a small interval of every column, its footer
says so, and a filter on any of them reads few row groups. Nothing is stored but the
columns: readers need not know the layout.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import freed_shuffles

#: Bits of a rank: 64 parts a column.
BITS = 6
#: Error of the rank bounds: a part holds up to 1 / ACCURACY of the rows more than its share.
ACCURACY = 10_000


def order_number(df: DataFrame, name: str) -> Column:
    """A long that ascends with a column: numbers and times themselves, of texts the first
    seven bytes. Null stays null."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.floor(c.cast("double") * 1_000_000).cast("long")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    raise TypeError(f"{name}: no order of {kind.simpleString()}")


def rank_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list[int]]:
    """Per column the least value of each part but the first, from one pass; equal bounds
    (a value that many rows share) stand once. 2^bits numbers a column reach the driver."""
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    row = df.agg(*[F.percentile_approx(order_number(df, c), shares, ACCURACY).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(row[f"b{i}"] or [])) for i in range(len(columns))]


def _rank(value: Column, bounds: list[int]) -> Column:
    """How many of the bounds are at or below a value; none for a null."""
    below = F.filter(F.array(*map(F.lit, bounds)).cast("array<long>"), lambda x: x <= value)
    return F.size(below).cast("long")


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The ranks' bits in turn, highest first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for j, r in enumerate(ranks):
            bit = F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - j))
    return out


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], bits: int = BITS, row_group_bytes: int | None = None, mode: str = "errorifexists", derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write ``df`` clustered by ``columns``; its columns and rows are as before.

    Null values rank first. Rows of one cell are ordered by the columns themselves, and
    rows equal in these by their place in ``df``, which must give the same rows when read
    again (a table); so a value that a third of the rows share is spread over files.
    ``derive`` adds columns, row by row, to what has been moved.
    """
    if not columns or not 0 < bits <= 12 or len(columns) * bits > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits")
    bounds = rank_bounds(df, columns, bits)
    names = [F.col(f"`{c}`") for c in df.columns]
    # step by step: each number, and each rank, is worked out once per row
    rows = df.select(F.struct(*names).alias("row"), F.monotonically_increasing_id().alias("place"), *[order_number(df, c).alias(f"o{i}") for i, c in enumerate(columns)])
    rows = rows.select("row", "place", *[_rank(F.col(f"o{i}"), b).alias(f"r{i}") for i, b in enumerate(bounds)])
    rows = rows.select("row", "place", interleaved([F.col(f"r{i}") for i in range(len(columns))], bits).alias("cell"))
    order = [F.col("cell"), *[F.col("row").getField(c).asc_nulls_first() for c in columns], F.col("place")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")
    out = (derive(rows) if derive else rows).write.mode(mode).option("compression", "zstd")
    if row_group_bytes:
        out = out.option("parquet.block.size", row_group_bytes).option("parquet.block.size.row.check.min", 100)
    with freed_shuffles(df.sparkSession):
        out.parquet(path)
