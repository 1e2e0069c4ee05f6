"""Token files: round trips, single documents, damage, and odd rows."""

import glob
import io
import json
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL

import public_tokenizers
from revlens.llm import token_files as T
from revlens.llm.common import read
from revlens.llm.tokens import part_tokens, word_ids

WORDS = public_tokenizers.path("word_bpe_49k.json")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def expected(docs):
    """(doc_id, start, n_tokens, crc) as the contract says, from the tokenizer itself."""
    out, at, tok = [], 0, tokenizer()
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    for doc, text in order:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_whole_table_equals_the_tokenizer(spark):
    docs = read(spark, SF_SMALL, "documents")
    got = T.op12_token_files(spark, docs).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    """Null and empty texts, null and repeated ids, repeated rows, clashing columns, a long text."""
    long = "word Ünïcode 日本 <|endoftext|> don't! " * 20_000
    rows = [(3, None, 1), (1, "", 2), (None, "no id", 3), (7, "same", 4), (7, "same", 5), (-5, "negative", 6), (7, long, 7), (None, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int").withColumn("tid", F.lit("x")).withColumn("start", F.lit(1))
    got = [tuple(r) for r in T.op12_token_files(spark, docs).orderBy("start").collect()]
    want = expected([(d, t) for d, t, _ in rows])
    # rows of one id stand in any order, so compare ids in order and each row's own figures
    assert [r[0] for r in got] == [r[0] for r in want]
    figure = lambda rs: sorted((r[0] is not None, r[0] or 0, *r[2:]) for r in rs)
    assert figure(got) == figure(want)
    assert [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(len(got))]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.op12_token_files(spark, docs).collect() == []


def test_some_documents_only(spark, tmpdir_path):
    """Only the files and frames that hold the wanted documents are read."""
    ids = [(i, np.arange(i * 10, i * 10 + 100, dtype="<u4").tobytes()) for i in range(200)]
    table = spark.createDataFrame(ids, "doc_id long, token_ids binary").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id")
    T.write_token_files(table, tmpdir_path, frame_bytes=1024)
    got = {r["doc_id"]: (r["start"], bytes(r["token_ids"])) for r in T.read_token_files(spark, tmpdir_path, [5, 120, 999]).collect()}
    assert got == {5: (500, ids[5][1]), 120: (12_000, ids[120][1])}
    listed = json.load(open(f"{tmpdir_path}/{T.LIST}"))
    assert [f["least"] for f in listed] == sorted(f["least"] for f in listed) and sum(f["ids"] for f in listed) == 20_000
    for f in listed:  # files that lack the documents need not be there
        if not any(f["least"] <= d <= f["most"] for d in (5, 120)):
            os.remove(f"{tmpdir_path}/{f['name']}")
    assert T.read_token_files(spark, tmpdir_path, [5, 120]).count() == 2


def packed(documents, frame_bytes=64):
    sink = io.BytesIO()
    out = T.FrameWriter(sink, frame_bytes)
    for doc, ids in documents:
        out.add(np.array([doc or 0]), np.array([doc is None]), np.array([len(ids)]), np.array(ids, "<u4").tobytes())
    return sink, out.close()


def test_frames_are_standard_and_read_alone():
    documents = [(i, list(range(i, i + n))) for i, n in enumerate([3, 0, 500, 1, 16, 15, 17])]
    sink, figures = packed(documents)
    assert figures == {"documents": 7, "ids": 552, "nulls": 0, "least": 0, "most": 6}
    data = sink.getvalue()
    file = T.FrameReader(io.BytesIO(data), len(data))
    for i, (_, ids) in enumerate(documents):
        before = file.unpacked
        assert np.frombuffer(file.ids(int(file.starts[i]), int(file.stops[i])), "<u4").tolist() == ids
        assert file.unpacked - before <= len(ids) * 4 // 64 + 2
    import zstandard

    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).readall() for _ in range(1))
    assert whole[: 552 * 4] == b"".join(np.array(ids, "<u4").tobytes() for _, ids in documents)


@pytest.mark.parametrize("place", ["frame", "table", "end"])
def test_damage_is_seen(place):
    sink, _ = packed([(1, list(range(1000)))])
    data = bytearray(sink.getvalue())
    file = T.FrameReader(io.BytesIO(bytes(data)), len(data))
    at = {"frame": int(file.at[2]) + 20, "table": len(data) - T.FOOTER.size - T.ENTRY.itemsize * 5, "end": len(data) - 1}[place]
    data[at] ^= 0xFF
    with pytest.raises(Exception):  # noqa: B017 (zstandard's own error, or ValueError)
        file = T.FrameReader(io.BytesIO(bytes(data)), len(data))
        file.ids(0, 1000)


def test_files_of_other_attempts_do_not_count(spark, tmpdir_path):
    table = spark.createDataFrame([(1, b"\x01\0\0\0")], "doc_id long, token_ids binary").coalesce(1)
    T.write_token_files(table, tmpdir_path)
    open(f"{tmpdir_path}/ids-lost.zst", "wb").write(b"half a file")
    assert T.read_token_files(spark, tmpdir_path).count() == 1
    with pytest.raises(Exception):  # noqa: B017 (a table is written once)
        T.write_token_files(table, tmpdir_path)
    assert len(glob.glob(f"{tmpdir_path}/ids-*.zst")) == 2


def test_parts_equal_whole_texts():
    """Random texts of letters, marks, punctuation, white space and special tokens."""
    import random

    import pyarrow as pa

    r = random.Random(11)
    alphabet = list("ab 'X\xa0　 \n\t\r\x00\x1c\x85᠎.,;:!?|)\"1 23é中文Σςİıß̸́=<>ǅK\U0001F600▁-_क़") + ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", " the", "can't."]
    texts = ["".join(r.choices(alphabet, k=r.randint(0, 40))) for _ in range(8000)]
    counts, ids = word_ids(pa.array(texts), part_tokens(WORDS))
    ends = np.r_[0, np.cumsum(counts)]
    want = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want


def test_another_tokenizer_is_refused():
    with pytest.raises(ValueError, match="word-end"):
        part_tokens(public_tokenizers.path("byte_bpe_50k.json"))


def test_a_repeated_row_is_packed_in_several_buckets(spark):
    """Rows equal in every column: numbered apart, each once, gapless sequences."""
    from revlens.llm import packing
    from revlens.llm.common import written

    docs = spark.createDataFrame([(1, "the same words again")] * 300 + [(2, "word " * 3000)] * 3, "doc_id long, text string")
    pieces = packing.token_pieces(docs, WORDS).select("doc_id", "piece", "start", "length", F.monotonically_increasing_id().alias("place"))
    out = packing.pack(written(pieces, "test-pieces"), rows_per_bucket=32).collect()
    assert len(out) == 306 and len({r["place"] for r in out}) == 306
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
