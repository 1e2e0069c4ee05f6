"""Keep-best-per-key deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(c) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def keep_best(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    tiebreak: Sequence[Column | str] = (),
    drop_null_keys: bool = False,
) -> DataFrame:
    """One row per ``keys``: the first by ``order`` then ``tiebreak``.

    Plans as ``row_number() ... = 1``; Catalyst adds a partial
    ``WindowGroupLimit`` before the shuffle, so a key with millions of copies
    is cut to one row per map task before it is exchanged. String entries in
    ``order``/``tiebreak`` sort ascending with nulls last.

    ``drop_null_keys`` filters rows with a null key *before* the shuffle when
    the caller drops them afterwards anyway (avoids one giant null partition).
    """
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    w = Window.partitionBy(*keys).orderBy(*[_order(c) for c in list(order) + list(tiebreak)])
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)
