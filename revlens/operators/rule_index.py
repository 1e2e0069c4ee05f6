"""Theta (regex) join with a large rule table, by an index of mandatory literals.

A chain of CASE branches tries every rule on every row. Here a rule is looked up: each
alternative of its pattern gives a literal that all its matches hold, a literal gives
one *gram* (a run of 1 to 8 characters), and an equi-join of the grams of a text with
those of the rules finds the rules that may match it. Candidates are then verified,
by ``contains`` where the alternative is a mere literal and else by ``rlike``. Work
grows with the texts and the candidates, not with texts times rules. Of rules that share
a pattern, or an alternative that is a mere literal, one always wins: the index holds
that one alone, so rules that repeat a pattern under other labels add no candidates.

Each distinct text is classified once and written with its key, which cuts lineage.
Gram joins are plain equi-joins: Spark broadcasts a small index and shuffles a large
one, splitting a gram that many texts hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.functions.patterns import mandatory_literals
from revlens.operators.classify import first_match
from revlens.operators.skew import split_hot_join
from revlens.session import importable, scratch_path
from revlens.sources.io import materialize

#: Lengths of grams: a literal gives one of the longest that fits.
GRAMS = (8, 5, 3, 2, 1)
#: Rules without a mandatory literal that the CASE chain takes.
MOST_UNINDEXED = 1000


_FOUND = T.ArrayType(T.StructType([T.StructField("literal", T.StringType()), T.StructField("exact", T.BooleanType())]))


@F.pandas_udf(_FOUND)
def _literals(patterns: pd.Series) -> pd.Series:  # over the rules, never over the texts
    found = (mandatory_literals(p) for p in patterns)
    return pd.Series([None if f is None else [{"literal": a, "exact": b} for a, b in f] for f in found], dtype=object)


#: Characters of a text whose grams are hashed at once, and grams of an Arrow batch.
_CHARACTERS, _BATCH = 1 << 18, 1 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: str, sizes) -> Iterator[np.ndarray]:
    """Hashes of all runs of the given lengths (in code points) in ``text``, each once in
    a piece of the text. Equal runs have equal hashes; others seldom, and are verified."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    for at in range(0, len(codes), _CHARACTERS):
        for n in sizes:
            piece = codes[at : at + _CHARACTERS + n - 1]
            runs = len(piece) - n + 1
            if runs > 0:
                h = np.full(runs, n, np.uint64)
                for i in range(n):
                    h = h * _FACTOR + piece[i : i + runs]
                yield np.unique(h).view(np.int64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _gram_list(texts: pd.Series, sizes: pd.Series) -> pd.Series:  # over the rules' literals
    found = (None if t is None or pd.isna(n) else [int(h) for g in gram_hashes(t, [int(n)]) for h in g] for t, n in zip(texts, sizes))
    return pd.Series(list(found), dtype=object)


def text_grams(texts: DataFrame) -> DataFrame:
    """(key, gram) of the texts (key, text, sizes), in batches of bounded size."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(keys: list, found: list) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), grams], ["key", "grams"])

        keys, found, held = [], [], 0
        for rows in batches:
            for key, text, sizes in zip(rows["key"], rows["text"], rows["sizes"]):
                for grams in gram_hashes(text.as_py(), sizes.as_py() or ()):
                    keys.append(key.as_py())
                    found.append(grams)
                    held += len(grams)
                    if held >= _BATCH:
                        yield batch(keys, found)
                        keys, found, held = [], [], 0
        if found:
            yield batch(keys, found)

    return texts.select("key", "text", "sizes").mapInArrow(lists, "key string, grams array<long>").select("key", F.explode("grams").alias("gram"))


def rule_grams(rules: DataFrame) -> DataFrame:
    """One row per rule (rule, label, pattern, priority) and alternative: the literal,
    whether it is the whole alternative, and one gram (hash and length) of the literal,
    the one that the fewest literals share. Rules without literals have null ones."""
    rows = rules.withColumn("found", _literals("pattern"))
    rows = rows.select("rule", "label", "pattern", "priority", F.explode_outer("found").alias("f"))
    rows = rows.select("rule", "label", "pattern", "priority", F.col("f.literal").alias("literal"), F.col("f.exact").alias("exact"))
    length = F.char_length("literal")
    size = F.coalesce(*[F.when(length >= n, F.lit(n)) for n in GRAMS])
    rows = rows.withColumn("size", size).withColumn("grams", _gram_list("literal", "size"))
    shared = rows.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("shared"))
    each = rows.select("*", F.explode_outer("grams").alias("gram")).drop("grams").join(shared, "gram", "left")
    one = Window.partitionBy("rule", "literal").orderBy(F.col("shared").asc(), F.col("gram").asc())
    return each.withColumn("nth", F.row_number().over(one)).where(F.col("nth") == 1).drop("nth", "shared")


def classify_by_rule_index(
    df: DataFrame,
    text: Column,
    rules: DataFrame,
    out_col: str = "subcategory",
    default: str = "Uncategorized",
    label: str = "subcategory",
    pattern: str = "keyword_pattern",
    priority: str = "priority",
) -> DataFrame:
    """J2/J3/W3 for many rules: the same result as ``classify_by_rules``.

    Among the rules whose pattern occurs in ``text`` the highest priority wins (null
    last), then the alphabetically first label, then pattern; rows without a match, and
    null texts, get ``default``. Repeated rules count once; rules without pattern or
    label are left out; an empty rule table labels nothing.

    Rules in which an alternative has no mandatory literal (``.*``, ``[ab]c?``, flags)
    are tried on every distinct text by the CASE chain, at most ``MOST_UNINDEXED`` of
    them: more raise ValueError, and no result is given.
    """
    spark = df.sparkSession
    importable(spark)
    run = uuid.uuid4().hex
    kept = rules.select(F.col(label).alias("label"), F.col(pattern).alias("pattern"), F.col(priority).cast("double").alias("priority"))
    kept = kept.where(F.col("label").isNotNull() & F.col("pattern").isNotNull()).distinct()
    # the smallest struct wins: highest priority first, null ones last. Rules of one pattern
    # match the same texts, and so do those that have a mere literal in common: one is kept
    order = F.struct(F.col("priority").isNull().alias("a"), (-F.col("priority")).alias("b"), F.col("label").alias("c"), F.col("pattern").alias("d"))
    kept = kept.groupBy("pattern").agg(F.min_by(F.struct("label", "priority"), order).alias("r"))
    kept = kept.select(F.md5("pattern").alias("rule"), "r.label", "pattern", "r.priority")
    by = ["gram", "size", "literal", "exact", F.when(F.col("exact"), F.lit(None)).otherwise(F.col("pattern")).alias("tried")]
    name = f"rule-index-{run}"
    index = materialize(rule_grams(kept).groupBy(*by).agg(F.min(order).alias("rule")), name, path=scratch_path(spark, name))

    key = F.md5(text)
    texts = df.select(key.alias("key"), text.alias("text")).where(F.col("key").isNotNull()).dropDuplicates(["key"])
    name = f"rule-texts-{run}"
    texts = materialize(texts, name, path=scratch_path(spark, name))

    indexed = index.where(F.col("gram").isNotNull())
    sizes = indexed.agg(F.collect_set("size").alias("sizes")).scalar()  # lengths in use, at most five
    grams = text_grams(texts.withColumn("sizes", sizes))
    candidates = grams.join(indexed, "gram").select("key", "literal", "exact", "tried", "rule")
    verified = F.contains("text", "literal") & (F.col("exact") | F.expr("rlike(text, tried)"))
    hits = candidates.join(texts, "key").where(verified)
    best = hits.groupBy("key").agg(F.min("rule").alias("best"))

    ways = [F.col("priority").desc_nulls_last(), F.col("label").asc(), F.col("pattern").asc()]
    unindexed = index.where(F.col("gram").isNull()).select(F.col("rule.c").alias("label"), F.col("rule.d").alias("pattern"), (-F.col("rule.b")).alias("priority"))
    tried = unindexed.orderBy(*ways).limit(MOST_UNINDEXED + 1).collect()
    if len(tried) > MOST_UNINDEXED:
        raise ValueError(f"more than {MOST_UNINDEXED} rules without a mandatory literal")
    if tried:
        null = F.lit(None).cast("double")
        values = [
            (r["pattern"], F.struct(F.lit(r["priority"] is None).alias("a"), (null if r["priority"] is None else F.lit(-r["priority"])).alias("b"), F.lit(r["label"]).alias("c"), F.lit(r["pattern"]).alias("d")))
            for r in tried
        ]
        chain = texts.select("key", F.coalesce(*first_match(F.col("text"), values)).alias("best"))
        best = best.unionByName(chain.where(F.col("best").isNotNull())).groupBy("key").agg(F.min("best").alias("best"))
    found = best.select(F.col("key").alias("__key"), F.col("best.c").alias("__label"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("__key"))
    out = split_hot_join(rows, found, "__key", "left")
    return out.select(*[F.col("row").getField(c).alias(c) for c in df.columns if c != out_col], F.coalesce("__label", F.lit(default)).alias(out_col))
