"""Every stage of the pipeline on odd, clashing and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revlens.llm import decontam, secrets
from revlens.llm.common import fresh, importable
from tests.conftest import SF_SMALL

CLASHES = ["spans", "found", "score", "__spans", "__found", "__score", "tid", "did", "row", "matches", "n", "x", "h"]


@pytest.fixture(scope="module")
def odd(spark):
    importable(spark)
    rng = random.Random(3)
    words = "the of and sea then her was in that ring shore tide lamp moss".split()
    say = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    base, long = say(120), " ".join(say(12) for _ in range(4000))
    rows = [
        (1, base), (2, base), (2, base), (3, base + " token=abcdef123456"), (None, base), (None, None), (4, None), (5, ""), (5, ""), (6, " \n\t "),
        (7, long), (8, "one"), (9, "AKIA" + "A" * 16 + " " + "0af" * 9), (10, say(30)), (10, say(30)),
    ]
    df = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    return df.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHES])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stage_keeps_columns_that_clash(spark, odd, name, stage):
    out = stage(spark, odd, SF_SMALL)
    assert out.columns == odd.columns and [t for _, t in out.dtypes] == [t for _, t in odd.dtypes]
    for r in out.collect():
        for c in CLASHES:
            assert r[c] == f"{c}:{'-' if r.doc_id is None else r.doc_id}"


def test_what_each_stage_does_with_odd_rows(spark, odd):
    stages = dict(corpus_pipeline.STAGES)
    key = lambda df: sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in df.select("doc_id", "text").collect()))
    every = key(odd)
    once = key(stages["near_dedup"](spark, odd, SF_SMALL))
    # equal and near texts leave one row; empty and null texts are one class
    texts = [t for _, _, t in once]
    assert len([t for t in texts if not t.strip()]) <= 2 and len(set(texts)) == len(texts) and set(once) <= set(every)
    assert key(stages["decontamination"](spark, odd, SF_SMALL)) == every
    masked = {(r.doc_id, r.text, r.n_chars) for r in stages["secrets"](spark, odd, SF_SMALL).collect()}
    assert all(not secrets.reference(t) and (t is None or n == len(t)) for _, t, n in masked) and len(masked) == len(set(every))
    packed = stages["packing"](spark, odd, SF_SMALL)
    assert packed.select("doc_id").where("doc_id is null").count() == 2 and packed.where("piece = 0").count() == len(every)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_table(spark, odd, name, stage):
    assert stage(spark, odd.limit(0), SF_SMALL).count() == 0


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "spans int, SPANS_ int")
    assert fresh(df, "spans") == "spans__" and fresh(df, "other") == "other"


def test_a_benchmark_that_is_too_large_is_refused(spark, odd, monkeypatch):
    items = spark.createDataFrame([(i, f"item number {i} of a test") for i in range(30)], "item_id long, text string")
    whole = sorted(map(str, decontam.op8_benchmark_decontamination(odd, items).collect()))
    monkeypatch.setattr(decontam, "MOST_ITEMS", 20)
    with pytest.raises(ValueError, match="30 items"):
        decontam.op8_benchmark_decontamination(odd, items)
    parts = [decontam.op8_benchmark_decontamination(odd, items.where(f"item_id % 2 = {p}")).collect() for p in (0, 1)]
    assert sorted(map(str, parts[0] + parts[1])) == whole
