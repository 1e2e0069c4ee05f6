"""What bounds the memory of an executor and of its Python workers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm import common, components
from tests.conftest import SF_SMALL


@F.arrow_udf(T.LongType())
def _rows_of_batch(text):
    import pyarrow as pa

    return pa.array([len(text)] * len(text))


@F.arrow_udf(T.LongType())
def _length(text):
    import pyarrow.compute as pc

    return pc.utf8_length(text).cast("int64")


@pytest.fixture()
def own(spark):
    """A session whose settings a test may change."""
    return spark.newSession()


def _largest(docs):
    return docs.select(_rows_of_batch("text").alias("m")).agg(F.max("m")).first()[0]


def _texts(spark, rows, size):
    return spark.range(rows, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), size).alias("text"))


def test_whole_texts_reach_python_in_bounded_batches(own):
    common.read(own, SF_SMALL, "documents")
    size, rows = 4_000, 4_000  # 16 MB
    assert _largest(_texts(own, rows, size)) <= 1.01 * common.BATCH_BYTES / size


def test_written_bounds_batches_of_a_table_that_was_not_read_here(own):
    common.importable(own)
    docs = _texts(own, 4_000, 4_000)
    out = common.written(docs.select(_rows_of_batch("text").alias("m")), "batches")
    assert out.count() == 4_000 and out.agg(F.max("m")).first()[0] <= 1.01 * common.BATCH_BYTES / 4_000


def test_a_text_longer_than_a_batch_is_whole(own):
    common.bounded_batches(own)
    docs = _texts(own, 3, 2 * common.BATCH_BYTES)
    assert [r.n for r in docs.select(_length("text").alias("n")).collect()] == [2 * common.BATCH_BYTES] * 3


def test_a_batch_size_of_the_session_stays(own):
    own.conf.set(common._BATCH, "1000000")
    common.bounded_batches(own)
    assert own.conf.get(common._BATCH) == "1000000"


@pytest.mark.parametrize("edges, most", [([(i, 1) for i in range(2, 40)] + [(51, 50)], 1), ([], 1), ([(i, i - 1) for i in range(2, 40)], 8)])
def test_rounds_end_where_all_classes_are_stars(spark, monkeypatch, edges, most):
    tables = []
    monkeypatch.setattr(components, "written", lambda df, name: tables.append(name) or common.written(df, name))
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 50 if n >= 50 else 1 for e in edges for n in e}
    assert len(tables) <= most
