"""The communication matrix: exact sums, the joint law, and many blocks."""

import itertools
import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.llm import sharding as S


@pytest.mark.parametrize("n_blocks, n_shards", [(1, 3), (2, 1), (5, 4), (64, 7), (130, 3)])
def test_rows_and_columns_sum_exactly(spark, n_blocks, n_shards):
    sizes = {b: (b * 37 % 11) * (b % 3 > 0) for b in range(n_blocks)}  # some blocks have no rows
    total = sum(sizes.values())
    shards = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    df = spark.createDataFrame([(b, n) for b, n in sizes.items() if n] or [(0, 0)], "block int, n long")
    got = {r["block"]: r["sent"] for r in S.communication_matrix(df, n_blocks, shards, seed=5).collect()}
    for b in range(n_blocks):
        assert sum(got.get(b, [0])) == (sizes[b] if n_blocks > 1 else total)
    assert [sum(v[s] for v in got.values()) for s in range(n_shards)] == shards
    assert all(x >= 0 for v in got.values() for x in v)


def test_joint_law_of_a_split(spark):
    """Draws from three shards against the multivariate hypergeometric probabilities."""
    caps, draws, n = [2, 3, 1], 3, 40_000
    rows = spark.range(n).select(S._split(F.array(*[F.lit(float(c)) for c in caps]), F.lit(float(draws)), 7, F.col("id")).alias("x"))
    seen = Counter(tuple(int(v) for v in r["x"]) for r in rows.collect())
    want = {
        k: n * math.prod(math.comb(c, x) for c, x in zip(caps, k)) / math.comb(sum(caps), draws)
        for k in itertools.product(*[range(c + 1) for c in caps]) if sum(k) == draws
    }
    assert set(seen) == set(want)
    assert sum((seen[k] - w) ** 2 / w for k, w in want.items()) < 25  # 5 degrees of freedom, p < 2e-4


def test_sixty_thousand_blocks(spark):
    sizes = spark.range(60_000).select(F.col("id").cast("int").alias("block"), (F.col("id") % 5 + 1).alias("n"))
    total = 60_000 * 3
    start = time.time()
    out = S.communication_matrix(sizes, 60_000, [total // 40] * 40, seed=3)
    sums = out.agg(F.count(F.lit(1)), F.sum(F.aggregate("sent", F.lit(0).cast("long"), lambda a, x: a + x)), F.sum(F.get("sent", F.lit(39)))).first()
    assert tuple(sums) == (60_000, total, total // 40)
    assert time.time() - start < 90


def test_a_row_repeated_over_several_blocks(spark):
    df = spark.range(900).select((F.col("id") % 2).alias("doc_id"), F.lit("same").alias("text"))
    out = S.op3_sharding(df, n_shards=7).collect()
    count = Counter(r["shard"] for r in out)
    assert len(out) == 900 and max(count.values()) - min(count.values()) <= 1
    for s in range(7):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(count[s]))
    rows = S.assign_shards(df, 7, block_rows=100)
    assert rows.groupBy("shard").agg(F.count_distinct("slot").alias("n"), F.max("slot").alias("m")).where("n != m + 1").count() == 0
