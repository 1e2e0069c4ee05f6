"""Importance resampling against plain counting."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import resampling as S

ROWS = [
    (1, "the cat sat on the mat " * 6), (2, "The Cat sat; on-the mat " * 6), (3, "unrelated words about engines " * 8),
    (4, ""), (5, None), (None, "no id but enough words " * 6), (7, "short text"), (8, "same copy of a text " * 5), (8, "same copy of a text " * 5),
    (9, "Ünïcode \x00 wörds 日本 a1 " * 9), (10, "x" * 50_000 + " y" * 30), (-11, "negative ids are fine too " * 4),
]
TARGET = [("The cat sat on a mat",), (None,), ("engines",), ("",)]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, target, buckets=10_000, longest=2, min_words=20, percent=25, seed=7):
    def hashed(text):
        w = words(text)
        runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(x.encode()) % buckets for x in runs]

    docs = [(d, *hashed(t)) for d, t in rows]
    s, t = collections.Counter(b for d in docs for b in d[2]), collections.Counter(b for (x,) in target for b in hashed(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for d, n_words, f in docs:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    can = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(can) * percent // 100
    ranks = {id(r): i + 1 for i, r in enumerate(can[:drawn])}
    return [(*r, ranks.get(id(r))) for r in out]


def key(r):
    return tuple((v is None, v or 0) for v in r)


@pytest.mark.parametrize("sampling", [S.Sampling(), S.Sampling(longest=3, buckets=50, min_words=5, percent=60, seed=1), S.Sampling(longest=1, percent=100)])
def test_equals_plain_counting(spark, sampling):
    docs = spark.createDataFrame([(*r, 1, 2) for r in ROWS], "doc_id long, text string, number int, rank int").repartition(3)
    got = S.resample(docs, spark.createDataFrame(TARGET, "text string"), sampling).collect()
    want = brute(ROWS, TARGET, sampling.buckets, sampling.longest, sampling.min_words, sampling.percent, sampling.seed)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(ROWS, "doc_id long, text string"), spark.createDataFrame([], "text string")
    assert S.resample(docs.limit(0), spark.createDataFrame(TARGET, "text string")).collect() == []
    got = S.resample(docs, none).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(ROWS, []), key=key)


def test_runs_do_not_cross_texts():
    data = "alpha beta|gamma|" .encode()
    offsets = np.array([0, 10, 10, 16, 17])
    n_words, n, hashed = S.batch_features(offsets, np.frombuffer(data, np.uint8), S.Sampling())
    assert n_words.tolist() == [2, 0, 1, 0] and n.tolist() == [3, 0, 1, 0]
    want = [zlib.crc32(x) % 10_000 for x in (b"alpha", b"beta", b"alpha beta", b"|gamma"[1:])]
    assert hashed.tolist() == want


def test_drawn_documents_resemble_the_target(spark):
    near = [(i, "target words appear in this kind of text quite often indeed " * 3) for i in range(40)]
    far = [(100 + i, "completely other matter fills the remaining rows of this table " * 3) for i in range(120)]
    out = S.resample(spark.createDataFrame(near + far, "doc_id long, text string"), spark.createDataFrame([("target words appear in this kind of text",)] * 3000, "text string"))
    drawn = out.where(F.col("rank").isNotNull())
    assert drawn.count() == 40 and drawn.where("doc_id < 100").count() >= 36


@pytest.mark.parametrize("kw", [{"buckets": 0}, {"buckets": 1 << 17}, {"percent": 101}, {"longest": 0}])
def test_wrong_parameters(kw):
    with pytest.raises(ValueError):
        S.Sampling(**kw)
