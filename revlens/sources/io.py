"""Readers, writers and materialization.

Everything here is an executor-side Spark read or write: no input passes
through the driver, and nested columns are turned into JSON text in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import freed_shuffles, scratch_path, split_session


# Raw record layouts of the public review dataset (JSON lines or parquet).
REVIEW_SCHEMA = T.StructType([
    T.StructField("rating", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("images", T.ArrayType(T.StructType([
        T.StructField("small_image_url", T.StringType()),
        T.StructField("medium_image_url", T.StringType()),
        T.StructField("large_image_url", T.StringType()),
        T.StructField("attachment_type", T.StringType()),
    ]))),
    T.StructField("asin", T.StringType()),
    T.StructField("parent_asin", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("helpful_vote", T.IntegerType()),
    T.StructField("verified_purchase", T.BooleanType()),
])
PRODUCT_SCHEMA = T.StructType([
    T.StructField("main_category", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("average_rating", T.DoubleType()),
    T.StructField("rating_number", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("description", T.ArrayType(T.StringType())),
    T.StructField("price", T.StringType()),
    T.StructField("images", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("videos", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("store", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("details", T.StringType()),
    T.StructField("parent_asin", T.StringType()),
    T.StructField("bought_together", T.ArrayType(T.StringType())),
])


def _read(spark: SparkSession, paths, fmt: str, schema: T.StructType | None, merge_schema: bool) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        r = spark.read.option("mergeSchema", str(merge_schema).lower())
        return (r.schema(schema) if schema is not None else r).parquet(*paths)
    if fmt == "json":
        # an explicit schema: no inference pass over the input; numbers read
        # into string fields keep their text (e.g. a numeric price); a malformed
        # line fails the read instead of turning into nulls
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    raise ValueError(f"unsupported format {fmt!r}")


def read_products(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """One scan over every product file (a directory, glob or list).

    ``fmt="json"`` reads JSON lines with ``schema`` (default ``PRODUCT_SCHEMA``);
    ``merge_schema`` reconciles parquet files whose columns differ.
    """
    if fmt == "json" and schema is None:
        schema = PRODUCT_SCHEMA
    return _read(spark, paths, fmt, schema, merge_schema)


def read_reviews(
    spark: SparkSession,
    paths: str | Sequence[str],
    drop: Iterable[str] = ("images",),
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Review records without the nested ``images`` column (pruned from the scan).

    ``fmt="json"`` reads JSON lines with ``schema`` (default ``REVIEW_SCHEMA``,
    timestamps as epoch milliseconds).
    """
    if fmt == "json" and schema is None:
        schema = REVIEW_SCHEMA
    df = _read(spark, paths, fmt, schema, False)
    return df.drop(*[c for c in drop if c in df.columns])


class JsonLines(NamedTuple):
    rows: DataFrame  # the lines that fit the schema
    rejects: DataFrame  # file, line, reason


def read_json_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, max_bad_share: float | None = None
) -> JsonLines:
    """JSON lines split into rows and rejects, instead of failing at the first bad line.

    A line is rejected, whole, when it is no JSON (``malformed``), no object
    (``not an object``), or has a value that its field cannot hold (``wrong type``).
    Fields that a line lacks are null, fields that the schema lacks are ignored, empty
    lines are skipped. With ``max_bad_share``, more rejects than that share of the lines
    raise ValueError before any row is returned (one pass to count them).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    bad = "_corrupt_line"
    while bad in schema.fieldNames():
        bad += "_"
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    parsed = lines.withColumn("row", F.from_json("value", full, options))
    # an array of one object would pass as that object
    fits = F.col("row").isNotNull() & F.col("row").getField(bad).isNull() & F.ltrim("value").startswith("{")
    json = F.try_parse_json("value")
    reason = F.when(json.isNull(), "malformed").when(~F.schema_of_variant(json).startswith("OBJECT"), "not an object").otherwise("wrong type")
    rejects = parsed.where(~fits).select("file", F.col("value").alias("line"), reason.alias("reason"))
    if max_bad_share is not None:
        n, ok = parsed.agg(F.count(F.lit(1)), F.count_if(fits)).first()
        if n - ok > max_bad_share * n:
            raise ValueError(f"{n - ok} of {n} lines are bad")
    return JsonLines(parsed.where(fits).select(*[F.col("row").getField(f).alias(f) for f in schema.fieldNames()]), rejects)


def reject_summary(rejects: DataFrame) -> DataFrame:
    """file, reason, lines, and the first bad line in text order as an example."""
    return rejects.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("lines"), F.min("line").alias("example"))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path, from the file system's own summary."""
    fs, p = _folder(spark, path)
    return fs.getContentSummary(p).getLength()


#: Least bytes of a scan's task in ``read_by_rows``.
LEAST_SPLIT = 1 << 20


def read_by_rows(spark: SparkSession, path: str, rows_per_task: int) -> DataFrame:
    """A stored table whose scan takes about ``rows_per_task`` rows a task, however well
    they compress (a row group is never cut, so write it from tasks of that size)."""
    rows = spark.read.parquet(path).count()  # a count of footers
    split = max(LEAST_SPLIT, stored_bytes(spark, path) * rows_per_task // max(rows, 1))
    return split_session(spark, split).read.parquet(path)


_NESTED = (T.ArrayType, T.StructType, T.MapType)


def stringify_nested(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """S3: array/struct/map columns → JSON text (all nested columns when ``cols`` is None)."""
    wanted = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        nested = isinstance(f.dataType, _NESTED)
        if nested and (wanted is None or f.name in wanted):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV reference data; malformed rows fail the read."""
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(path)
    )


def write_seed(df: DataFrame, path: str) -> None:
    """Reference data as CSV that ``read_seed`` reads back: commas and quotes quoted,
    white space kept. An empty cell is a null, so an empty text reads back as null; a
    line is a row, so a text with a line end does not read back."""
    (
        df.write.option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .mode("errorifexists").csv(path)
    )


def register_sources(spark: SparkSession, tables: Mapping[str, str | DataFrame]) -> dict[str, DataFrame]:
    """Name → parquet path (or DataFrame), each registered as a temp view."""
    out = {}
    for name, src in tables.items():
        df = src if isinstance(src, DataFrame) else spark.read.parquet(src)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


def _folder(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _beside(spark: SparkSession, path: str, kind: str) -> dict[str, str]:
    """Publication id -> sibling folder ``<path>.<kind>-<id>``."""
    fs, p = _folder(spark, path)
    start = f"{p.getName()}.{kind}-"
    if not p.getParent() or not fs.exists(p.getParent()):
        return {}
    found = [s.getPath() for s in fs.listStatus(p.getParent()) if s.getPath().getName().startswith(start)]
    return {f.getName()[len(start):]: f.toString() for f in found}


def next_folder(path: str) -> str:
    """Where the next state of ``path`` is written, beside it."""
    return f"{path.rstrip('/')}.next-{uuid.uuid4().hex}"


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Show the complete folder ``staged`` (from ``next_folder``) as ``path``.

    The old state is moved aside, the new one in, and the old one deleted. A driver lost
    in between leaves both complete states beside ``path``; ``recover`` finishes that.
    """
    fs, p = _folder(spark, path)
    _, new = _folder(spark, staged)
    number = staged.rpartition(".next-")[2]
    _, last = _folder(spark, f"{path.rstrip('/')}.last-{number}")
    if fs.exists(p) and not fs.rename(p, last):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, p):
        raise OSError(f"cannot move {staged} to {path}")
    if fs.exists(last):
        fs.delete(last, True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a publication that a lost driver left half way; nothing else is touched."""
    fs, p = _folder(spark, path)
    if fs.exists(p):
        return
    complete = _beside(spark, path, "next")
    for number, last in _beside(spark, path, "last").items():
        if number in complete:  # written whole before the old state was moved
            publish(spark, complete[number], path)
            fs.delete(_folder(spark, last)[1], True)
        else:
            fs.rename(_folder(spark, last)[1], p)
        return


def discard(spark: SparkSession, staged: str) -> None:
    """Delete a folder that will not be published."""
    fs, p = _folder(spark, staged)
    fs.delete(p, True)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Replace a table directory with the DataFrame's rows, whole or not at all.

    ``overwrite`` writes beside the table and shows the result when it is complete: a
    write that fails leaves the old rows, and ``df`` may read the table it replaces.
    Other modes are Spark's.
    """
    spark = df.sparkSession
    staged = next_folder(path) if mode == "overwrite" else None
    w = df.write.mode("errorifexists" if staged else mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not staged:
        w.parquet(path)
        return
    recover(spark, path)
    try:
        w.parquet(staged)
    except BaseException:
        discard(spark, staged)
        raise
    publish(spark, staged, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``write_table`` keeps; finishes a half-done replacement first."""
    recover(spark, path)
    return spark.read.parquet(path)


def write_sorted(df: DataFrame, cols: Sequence, path: str, mode: str = "overwrite") -> None:
    """Range-partitioned, sorted output (readers must still sort; order helps skipping)."""
    df.orderBy(*cols).write.mode(mode).parquet(path)


def materialize(df: DataFrame, name: str, how: str = "table", path: str | None = None) -> DataFrame:
    """View / ephemeral / table / checkpoint materialization.

    * ``ephemeral`` — return the plan unchanged (inlined by each reader).
    * ``view`` — register a temp view and return the plan.
    * ``table`` — write parquet (default: under the session's shared checkpoint
      folder) and return a fresh scan of it; lineage is cut, so a lost executor
      only re-reads files instead of recomputing the upstream plan.
    * ``checkpoint`` — reliable ``DataFrame.checkpoint()`` into the same folder.
    """
    spark = df.sparkSession
    if how == "ephemeral":
        return df
    if how == "view":
        df.createOrReplaceTempView(name)
        return df
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    if how == "table":
        target = path or scratch_path(spark, name)
        with freed_shuffles(spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(target)
        return spark.read.parquet(target)
    raise ValueError(f"unknown materialization {how!r}")
