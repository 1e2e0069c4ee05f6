"""Uniform shuffle into shards of exact sizes.

Method: hypergeometric communication matrix. The number of rows that each source
block sends to each shard is drawn first, from the multivariate hypergeometric law
that a uniform shuffle has. Blocks then permute their rows locally, deal them out by
those counts (the exchange), and shards permute again. Every shard has its exact
size, and every arrangement is equally likely.

All of it is DataFrame functions. The matrix is drawn by halving: the rows a range
of blocks sends to the shards are split between its two halves, level by level, so
a level's draws are independent rows of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import texts, written

#: Rows that one task permutes, in a source block as in a part of a shard.
BLOCK_ROWS = 1 << 14
#: Levels of halving drawn in one plan; their result is written.
SPREAD_EVERY = 6


def _let(x: Column, body) -> Column:
    """body(x) with x evaluated once."""
    return F.element_at(F.transform(F.array(x), body), 1)


def hypergeometric(total, good, draws, u) -> Column:
    """The number of good rows among ``draws`` from ``total``, by inversion of u in [0, 1).

    Probabilities follow by their ratio from one end of mean +- (12 deviations + 12)
    (what lies beyond has less weight than a double resolves), and are summed twice:
    for their total, then up to u times that.
    """
    mean = draws * good / total
    spread = 12 * F.sqrt(mean * (1 - good / total) * (total - draws) / F.greatest(total - 1, F.lit(1.0))) + 12
    first = F.greatest(F.lit(0.0), draws + good - total, F.floor(mean - spread).cast("double"))
    last = F.least(good, draws, F.ceil(mean + spread).cast("double"))

    def ratio(k: Column) -> Column:
        return (good - k + 1) * (draws - k + 1) / (k * (total - good - draws + k))

    def draw(ends: Column) -> Column:
        a, b = ends["a"], ends["b"]
        ks = F.transform(F.sequence(F.lit(1), (b - a).cast("int")), lambda i: a + i)
        weight = F.aggregate(
            ks, F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum")),
            lambda s, k: _let(s["p"] * ratio(k), lambda p: F.struct(p.alias("p"), (s["sum"] + p).alias("sum"))),
            lambda s: s["sum"],
        )
        found = F.aggregate(
            ks, F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum"), a.alias("x"), (u * weight).alias("aim")),
            lambda s, k: _let(s["p"] * ratio(k), lambda p: F.struct(
                p.alias("p"), (s["sum"] + p).alias("sum"), F.when(s["sum"] < s["aim"], k).otherwise(s["x"]).alias("x"), s["aim"].alias("aim"))),
            lambda s: s["x"],
        )
        return F.when(a >= b, a).otherwise(found)

    return F.when(total <= 0, F.lit(0.0)).otherwise(_let(F.struct(first.alias("a"), last.alias("b")), draw))


def _split(caps: Column, draws: Column, seed: int, *where: Column) -> Column:
    """Rows per shard among ``draws`` rows from ``caps`` (rows per shard), all doubles."""
    def uniform(i: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *where, i), 11).cast("double") / float(1 << 53)

    start = F.struct(
        F.aggregate(caps, F.lit(0.0), lambda a, c: a + c).alias("total"), draws.alias("draws"), F.lit(0).alias("i"),
        F.array().cast("array<double>").alias("out"),
    )
    return F.aggregate(
        caps, start,
        lambda s, c: _let(
            hypergeometric(s["total"], c, s["draws"], uniform(s["i"])),
            lambda x: F.struct((s["total"] - c).alias("total"), (s["draws"] - x).alias("draws"), (s["i"] + 1).alias("i"), F.concat(s["out"], F.array(x)).alias("out")),
        ),
        lambda s: s["out"],
    )


def left_halves(sizes: DataFrame, depth: int) -> DataFrame:
    """level, node, n: the rows of the left half of every range of blocks that has any.

    At level d the 2^depth blocks form 2^d ranges, their nodes; a block adds its rows to
    its range of each level, so the table has fewer than two rows per block.
    """
    d = F.col("level")
    up = F.explode(F.sequence(F.lit(0), F.lit(depth - 1)))
    rows = sizes.select("block", "n", up.alias("level"))
    half = F.floor(F.col("block") / F.pow(F.lit(2.0), F.lit(depth) - d - 1)).cast("int")
    rows = rows.select("level", F.shiftright(half, 1).alias("node"), (half % 2 == 0).alias("is_left"), "n")
    return rows.where("is_left").groupBy("level", "node").agg(F.sum("n").alias("n"))


def communication_matrix(sizes: DataFrame, n_blocks: int, shard_sizes: list[int], seed: int) -> DataFrame:
    """block, sent (array: rows to each shard) for ``sizes`` (block 0..n_blocks-1, n).

    Rows of the matrix sum to n, columns to ``shard_sizes``. Blocks without rows may be
    missing from ``sizes``. Every level of halving joins its nodes with their left
    halves' rows and draws each node on its own: no row holds more than one node's
    counts, and no task more than its nodes.
    """
    depth = max(0, (n_blocks - 1).bit_length())
    level = sizes.sparkSession.range(1).select(F.lit(0).alias("block"), F.lit([float(x) for x in shard_sizes]).alias("sent"))
    if not depth:
        return level.select("block", F.col("sent").cast("array<long>").alias("sent"))
    halves = written(left_halves(sizes, depth), "left-halves")
    for d in range(depth):
        here = halves.where(F.col("level") == d).select(F.col("node").alias("block"), F.col("n").cast("double").alias("left"))
        level = level.join(here, "block", "left").withColumn("left", F.coalesce("left", F.lit(0.0)))
        level = level.withColumn("x", _split(F.col("sent"), F.col("left"), seed, F.col("block"), F.lit(d)))
        level = level.select(F.inline(F.array(
            F.struct((2 * F.col("block")).alias("block"), F.col("x").alias("sent")),
            F.struct((2 * F.col("block") + 1).alias("block"), F.zip_with("sent", "x", lambda a, b: a - b).alias("sent")),
        )))
        if (d + 1) % SPREAD_EVERY == 0 and d + 1 < depth:
            level = written(level, "matrix-level")
    return level.where(F.col("block") < n_blocks).select("block", F.col("sent").cast("array<long>").alias("sent"))


def assign_shards(rows: DataFrame, n_shards: int, seed: int = 17, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with shard (0..n_shards-1) and slot (gapless from 0 in each shard).

    Shard sizes differ by at most one; which rows share a shard, and their order in it,
    is uniformly random in ``seed``. Rows are told apart by their place in the written
    table, so repeated and null rows are rows like any other. No rows give no rows.
    Carry keys, not long columns: rows are written and exchanged three times.
    """
    names = rows.columns
    rows = written(rows.select(F.struct(*names).alias("row"), F.monotonically_increasing_id().alias("rid")), "shard-rows")
    total = rows.count()
    shard_sizes = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    n_blocks = max(1, -(-total // block_rows))

    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "rid"), F.lit(n_blocks)).cast("int"))
    matrix = communication_matrix(rows.groupBy("block").agg(F.count("*").alias("n")), n_blocks, shard_sizes, seed)
    until = F.aggregate(
        "sent", F.array().cast("array<long>"),
        lambda a, c: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + c)),
    )
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "rid"), "rid")
    rows = rows.withColumn("nth", F.row_number().over(local) - 1)
    rows = rows.join(matrix.select("block", until.alias("until")), "block")
    rows = rows.select("row", "rid", F.size(F.filter("until", lambda x: x <= F.col("nth"))).alias("shard"))

    parts = max(1, -(-max(shard_sizes, default=0) // block_rows))
    rows = written(rows.withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 2), "rid"), F.lit(parts)).cast("int")), "sharded")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    skips = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    skips = skips.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    again = Window.partitionBy("shard", "part").orderBy(F.xxhash64(F.lit(seed + 3), "rid"), "rid")
    placed = rows.withColumn("nth", F.row_number().over(again) - 1).join(skips, ["shard", "part"])
    return placed.select("row.*", "shard", (F.col("skip") + F.col("nth")).cast("long").alias("slot"))


def op3_sharding(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """The contract's columns by the law ``rows``. A null text has 16 bytes of size and the
    checksum of nothing; null ids and repeated rows are rows like any other; an empty
    table gives no rows; other columns are left behind."""
    raw = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = raw.select("doc_id", (F.octet_length("text") + 16).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    return assign_shards(rows, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
