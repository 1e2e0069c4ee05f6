"""The corpus pipeline: five stages from documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
its result is written as Parquet and read again as the next stage's documents. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import decontam, neardup, packing, quality, secrets
from revlens.llm.common import fresh, read, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores at least 0.7; the others go. Order-free, row by row."""
    names, score = docs.columns, fresh(docs, "score")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = docs.withColumn(score, quality.scores(model)(F.coalesce("text", F.lit(""))))
    return scored.where(F.col(score) >= quality.ACCEPT).select(*names)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, the one with the smallest doc_id."""
    return neardup.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item."""
    names, items = docs.columns, fresh(docs, "found")
    found = decontam.matches(docs, read(spark, sf_dir, "benchmark"), name=items)
    return found.where(F.size(items) == 0).select(*names)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row; secrets in its text are masked, and n_chars follows the text."""
    names, spans = docs.columns, fresh(docs, "spans")
    found = secrets.scan(docs, name=spans)
    masked = secrets.mask(F.col("text"), F.col(spans))
    changed = F.size(spans) > 0
    if "n_chars" in names:
        n_chars = F.char_length(masked).cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(changed, n_chars).otherwise(F.col("n_chars")))
    return found.withColumn("text", F.when(changed, masked).otherwise(F.col("text"))).select(*names)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of every row, as op1 returns them."""
    return packing.op1_best_fit_packing(spark, docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
