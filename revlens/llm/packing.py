"""Best-fit packing of token pieces into fixed-size training sequences.

Method: large-item matching. Pieces above a third of the capacity fit at most
twice in a sequence; they are paired greedily, the longest first with the longest
partner that still fits. Shorter pieces then go, longest first, into the smallest
gap that holds them.

Only lengths matter for a packing, and there are at most ``capacity`` of them, so
the packing is worked out on the histogram of lengths (at most 2048 counts,
whatever the corpus holds): it is a list of *groups* of equal sequences. Pieces
of a length are then numbered, distributed, and a number says which sequence and
place it gets. Nothing that grows with the data meets in a task or the driver.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import blocks, strings, texts, written
from revlens.llm.tokens import part_tokens, word_ids

CAPACITY = 2048
#: Bytes of text whose distinct parts are encoded once.
BLOCK_BYTES = 4 << 20
#: Pieces that one numbering task sorts.
ROWS_PER_BUCKET = 1 << 18

PIECES = "doc_id long, piece int, start long, length long, token_ids binary"


# --- tokens --------------------------------------------------------------------

def encoder(tokenizer_path: str):
    """text -> ids (little-endian uint32 bytes), equal to Tokenizer.encode(text).ids."""
    import pyarrow as pa

    tokens = part_tokens(tokenizer_path)
    return lambda text: word_ids(pa.array([text], pa.string()), tokens)[1].tobytes()


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, token_ids (little-endian uint32).

    A document is its ids and then ``end_id``; only one longer than ``capacity`` is
    cut, into full pieces and a last shorter one. Null and empty texts are the end id
    alone. Repeated rows stay separate documents; a null doc_id stays null.
    """

    def run(batches):
        import pyarrow as pa

        tokens = part_tokens(tokenizer_path)
        for batch in batches:
            text = batch.column(1)
            for a, b in blocks(strings(text)[0], BLOCK_BYTES):
                counts, ids = word_ids(text.slice(a, b - a), tokens)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4", copy=False)
                n = -(-(counts + 1) // capacity)
                doc = np.repeat(np.arange(b - a), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(counts[doc] + 1 - start, capacity)
                ends = np.r_[0, np.cumsum(4 * length)].astype(np.int64)
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                columns = [batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), binary.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "token_ids"])

    return texts(docs).mapInArrow(run, PIECES)


# --- the packing of a histogram ----------------------------------------------------

def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Pack ``counts`` (length -> pieces) into sequences; (slots, sequences).

    A slot (length, first, n, sequence, per, offset) says that the pieces of this
    length numbered from ``first``, n of them, go ``per`` to a sequence, from
    ``sequence`` on, side by side from ``offset``.
    """
    left = {k: n for k, n in counts.items() if n}
    taken = dict.fromkeys(left, 0)
    slots: list[tuple] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)
    sequences = 0

    def put(length: int, n: int, sequence: int, per: int, offset: int) -> None:
        slots.append((length, taken[length], n, sequence, per, offset))
        taken[length] += n
        left[length] -= n

    def open_(gap: int, sequence: int, n: int) -> None:
        if n and gap:
            gaps.setdefault(gap, []).append((sequence, n))

    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - a) - 1
        while at >= 0 and left[large[at]] < (2 if large[at] == a else 1):
            if large[at] != a:
                large.pop(at)
            at -= 1
        if at < 0:
            n, used = left[a], a
            put(a, n, sequences, 1, 0)
        elif large[at] == a:
            n, used = left[a] // 2, 2 * a
            put(a, 2 * n, sequences, 2, 0)
        else:
            b = large[at]
            n, used = min(left[a], left[b]), a + b
            put(a, n, sequences, 1, 0)
            put(b, n, sequences, 1, a)
        open_(capacity - used, sequences, n)
        sequences += n

    sizes = sorted(gaps)
    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                per = capacity // length
                n = -(-left[length] // per)
                gap, first, some = capacity, sequences, n
                sequences += n
            else:
                gap = sizes[at]
                first, some = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
                per = gap // length
            full = min(some, left[length] // per)
            if full:
                put(length, full * per, first, per, capacity - gap)
            rest = left[length] if full < some else 0  # fewer than per: into one more sequence
            if rest:
                put(length, rest, first + full, rest, capacity - gap)
            for new, seq, n in ((gap - per * length, first, full), (gap - rest * length, first + full, bool(rest)), (gap, first + full + bool(rest), some - full - bool(rest))):
                if n and new:
                    if new not in gaps:
                        bisect.insort(sizes, new)
                    gaps.setdefault(new, []).append((seq, n))
    return slots, sequences


def pack(pieces: DataFrame, capacity: int = CAPACITY, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``pieces`` with sequence_id and offset: every piece once, gapless from 0, no
    sequence over ``capacity``. Needs a column length of 1..capacity.

    Pieces of a length are numbered in buckets of a hash of the row, so a length that
    half the corpus has is no hot group. Rows equal in every column share a bucket (give
    them a column that tells them apart); which of them gets which place is arbitrary. ``pieces`` must give the same rows
    when read again (read it from a written table). No pieces give no rows.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    rows = pieces.select(F.struct(*names).alias("row"), F.col("length").cast("int").alias("len"))
    counts = {r["len"]: r["n"] for r in rows.groupBy("len").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    if bad := [k for k in counts if k is None or not 1 <= k <= capacity]:
        raise ValueError(f"lengths outside 1..{capacity}: {bad[:5]}")
    n_buckets = max(1, -(-sum(counts.values()) // rows_per_bucket))
    slots, _ = plan(counts, capacity)

    rows = rows.withColumn("h", F.xxhash64("row")).withColumn("bucket", F.pmod("h", F.lit(n_buckets)).cast("int"))
    sizes = rows.groupBy("len", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("len").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("len", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("len", "bucket").orderBy("h", "row")
    rows = rows.withColumn("nth", F.row_number().over(inside) - 1).join(sizes, ["len", "bucket"])
    rows = rows.select("row", "len", (F.col("skip") + F.col("nth")).alias("number"))

    # one row per length with its slots in order of their first number: at most `capacity` rows
    by_length: dict[int, list] = {}
    for length, *slot in slots:
        by_length.setdefault(length, []).append(tuple(slot))
    table = spark.createDataFrame(sorted(by_length.items()), "len int, slots array<struct<first:long,n:long,sequence:long,per:long,at:long>>")
    slot = F.element_at(F.filter("slots", lambda s: (s["first"] <= F.col("number")) & (F.col("number") < s["first"] + s["n"])), 1)
    rows = rows.join(F.broadcast(table), "len").withColumn("slot", slot).withColumn("i", F.col("number") - F.col("slot.first"))
    return rows.select(
        "row.*",
        (F.col("slot.sequence") + F.floor(F.col("i") / F.col("slot.per"))).alias("sequence_id"),
        (F.col("slot.at") + F.pmod("i", F.col("slot.per")) * F.col("len")).cast("long").alias("offset"),
    )


def op1_best_fit_packing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns of every piece. A null text is the end id alone; null ids and
    repeated rows are documents of their own; an empty table gives no rows; other columns
    are left behind. A piece's place in the table tells repeated rows apart, so a row that
    a third of the table repeats is numbered in many buckets."""
    import public_tokenizers

    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("token_ids").alias("ids_crc32"), F.monotonically_increasing_id().alias("place"))
    return pack(written(digests, "pieces")).drop("place")


def crc(ids) -> int:
    """The digest of a piece, for tests."""
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
