"""Type-2 slowly changing history, check strategy (H1–H3).

``scd2_apply`` is a pure DataFrame function (old history + new load → new
history) planned as one full outer join of the *open* versions with the new
load on the key, followed by an ``explode`` of at most two versions per key,
so every key is touched in a single shuffle. ``scd2_snapshot`` stores the
history append-only (closed versions per run + the current open set), never
overwriting a table that is being read; ``scd2_history`` reads it back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

META_COLUMNS = ["scd_id", "updated_at", "valid_from", "valid_to"]


def _ts(as_of) -> F.Column:
    """A naive timestamp literal, independent of the session and process time zones."""
    if isinstance(as_of, dt.datetime):
        as_of = as_of.isoformat(sep=" ")
    elif isinstance(as_of, dt.date):
        as_of = as_of.isoformat() + " 00:00:00"
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _scd_id(key: str, as_of) -> F.Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), _ts(as_of).cast("string")))


def scd2_initial(current: DataFrame, key: str, as_of: dt.datetime) -> DataFrame:
    """First snapshot: every row opens a version valid from ``as_of``."""
    return current.select(
        *current.columns,
        _scd_id(key, as_of).alias("scd_id"),
        _ts(as_of).alias("updated_at"),
        _ts(as_of).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Fail when the new load has a duplicated key (null is one key)."""
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate {key} in the new load: {dup[0][key]!r}")


def assert_newer(history: DataFrame, as_of: dt.datetime) -> None:
    """Fail when a version already starts at or after ``as_of``."""
    late = history.where(F.col("valid_from") >= _ts(as_of)).limit(1).collect()
    if late:
        raise ValueError(f"load of {as_of} is not after the newest version ({late[0]['valid_from']})")


def scd2_apply(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: dt.datetime,
    close_missing: bool = False,
    validate: bool = True,
) -> DataFrame:
    """Close changed open versions at ``as_of`` and open their new versions.

    A version changes when any ``check_cols`` value differs null-safely
    (``NOT a <=> b``), so a value turning null is a change and null → null is
    not. Keys absent from the new load stay open unless ``close_missing``.
    Applying the same load again, later, is a no-op. A null key is a key like any
    other. With ``validate``, duplicate keys and an ``as_of`` that is not after the
    newest version are rejected; so are, always, loads with other columns.
    """
    if validate:
        assert_unique_key(current, key)
    if history is None:
        return scd2_initial(current, key, as_of)
    data_cols = [c for c in history.columns if c not in META_COLUMNS]
    if set(current.columns) != set(data_cols):
        raise ValueError(f"columns of the load and the history differ: {sorted(set(current.columns) ^ set(data_cols))}")
    if validate:
        assert_newer(history, as_of)
    open_h = history.where(F.col("valid_to").isNull())
    closed_h = history.where(F.col("valid_to").isNotNull())
    h = open_h.select(F.lit(True).alias("__h"), *[F.col(c).alias(f"h__{c}") for c in history.columns])
    c = current.select(F.lit(True).alias("__c"), *[F.col(x).alias(f"c__{x}") for x in data_cols])
    j = h.join(c, F.col(f"h__{key}").eqNullSafe(F.col(f"c__{key}")), "full_outer")
    has_h, has_c = F.col("__h").isNotNull(), F.col("__c").isNotNull()
    diff = None
    for col in check_cols:
        d = ~F.col(f"h__{col}").eqNullSafe(F.col(f"c__{col}"))
        diff = d if diff is None else diff | d
    changed = has_h & has_c & diff
    ended = changed | (has_h & ~has_c) if close_missing else changed
    ts = _ts(as_of)
    old_version = F.struct(
        *[F.col(f"h__{x}").alias(x) for x in data_cols],
        F.col("h__scd_id").alias("scd_id"),
        F.col("h__updated_at").alias("updated_at"),
        F.col("h__valid_from").alias("valid_from"),
        F.when(ended, ts).otherwise(F.col("h__valid_to")).alias("valid_to"),
    )
    new_version = F.struct(
        *[F.col(f"c__{x}").alias(x) for x in data_cols],
        F.md5(F.concat_ws("|", F.coalesce(F.col(f"c__{key}").cast("string"), F.lit("")), ts.cast("string"))).alias("scd_id"),
        ts.alias("updated_at"),
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    versions = F.array(
        F.when(has_h, old_version),
        F.when(has_c & (~has_h | changed), new_version),
    )
    out = j.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")
    return closed_h.unionByName(out)


def scd2_as_of(history: DataFrame, ts) -> DataFrame:
    """H3: the version of every key that was valid at ``ts``."""
    t = _ts(ts)
    return history.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def _runs(spark: SparkSession, root: str) -> tuple[list[int], int]:
    """(complete runs, next free number) from the directory listing; a run without its
    _SUCCESS marker was not finished and does not count. A root that is not there has
    none; any other failure to list is an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return [], 0
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("run=")]
    numbers = {int(p.getName().partition("=")[2]): p for p in found}
    marker = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")
    return sorted(n for n, p in numbers.items() if fs.exists(marker(p))), max(numbers, default=-1) + 1


#: The same for other append-only stores.
complete_runs = _runs


def _latest_run(spark: SparkSession, root: str):
    """(stored rows of complete runs, latest run number) or (None, None) when nothing is stored yet."""
    complete, _ = _runs(spark, root)
    if not complete:
        return None, None
    return spark.read.parquet(root).where(F.col("run").isin(complete)), complete[-1]


def scd2_history(spark: SparkSession, root: str) -> DataFrame:
    """The full history stored under ``root``: every closed version plus the open
    versions of the latest run (both read with partition pruning)."""
    stored, latest = _latest_run(spark, root)
    if stored is None:
        raise FileNotFoundError(root)
    keep = (F.col("kind") == "closed") | ((F.col("kind") == "open") & (F.col("run") == latest))
    return stored.where(keep).drop("run", "kind")


def scd2_snapshot(
    spark: SparkSession,
    current: DataFrame,
    root: str,
    key: str,
    check_cols: Sequence[str],
    as_of: dt.datetime,
) -> DataFrame:
    """Apply a load to the history stored under ``root``; return the new full history.

    Storage is append-only and grows with the changes, not with the number of
    runs × history: run ``N`` writes ``run=N/kind=closed`` (only the versions it
    closes) and ``run=N/kind=open`` (the currently open versions). A run reads
    just the previous run's open versions (partition pruning), so its cost is
    proportional to the current table, whatever the length of the history.
    Re-running a load is a no-op apart from a new open set.
    """
    stored, latest = _latest_run(spark, root)
    open_h = None
    if latest is not None:
        open_h = stored.where((F.col("run") == latest) & (F.col("kind") == "open")).drop("run", "kind")
    out = scd2_apply(open_h, current, key, check_cols, as_of)
    run = _runs(spark, root)[1]
    kind = F.when(F.col("valid_to").isNull(), F.lit("open")).otherwise(F.lit("closed"))
    # its own directory, refused if it is there; readers see the run once it is complete
    out.withColumn("kind", kind).write.mode("errorifexists").partitionBy("kind").parquet(f"{root.rstrip('/')}/run={run}")
    return scd2_history(spark, root)
