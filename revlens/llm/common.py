"""Helpers shared by the operators: written intermediates, and numpy text hashing."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import ensure_checkpoint_dir, importable

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that go to a Python worker at a time.
BATCH_BYTES = 4 << 20
#: Stands for a null doc_id where rows are matched by key.
NULL_ID = -(2**63)
#: Bytes of text that one numpy pass handles; longer texts go through several passes.
SEGMENT = 1 << 18
#: Bytes of text gathered before a block of documents is processed.
BLOCK = 1 << 20


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or one made of it that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of ``BATCH_BYTES``, unless the session says
    otherwise. Spark's 10,000 rows of whole texts are tens of MB, which the executor and
    the worker of each task hold several times, and a worker keeps what it once took."""
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, and fixes
    the rows, so a lost executor rereads files and never draws them anew. The write's
    shuffle files go when it is done; the disk holds one step's shuffles at a time."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only (null text: empty); every other column is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """texts() with ``did`` (doc_id without null) and ``tid`` (the text's 16-byte md5):
    rows with equal (did, tid) are interchangeable."""
    return texts(docs).select(
        "doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("did"), F.unhex(F.md5("text")).alias("tid"), "text"
    )


# --- numpy hashing of words and shingles inside tasks -------------------------

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole result."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=U) + U(seed) * U(1_000_003)) * U(_BASE))


_BYTE = seeds(256, 11)
_pow = np.ones(1, dtype=U)
_inv = np.ones(1, dtype=U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        n = max(n, SEGMENT * 2)
        _pow = np.cumprod(np.r_[U(1), np.full(n - 1, _BASE, dtype=U)], dtype=U)
        _inv = np.cumprod(np.r_[U(1), np.full(n - 1, pow(_BASE, -1, 2**64), dtype=U)], dtype=U)
    return _pow, _inv


def byte_table(separators: list[tuple[int, int]], fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is_word, folded byte) per byte value; fold maps A-Z to a-z."""
    word = np.ones(256, dtype=bool)
    for a, b in separators:
        word[a : b + 1] = False
    low = np.arange(256, dtype=np.uint8)
    if fold:
        low[65:91] += 32
    return word, _BYTE[low]


#: Words are runs without white space, as they stand.
PLAIN = byte_table([(9, 13), (32, 32)], fold=False)
#: Words are runs of letters and digits (any non-ASCII character counts), A-Z folded.
FOLDED = byte_table([(0, 47), (58, 64), (91, 96), (123, 127)], fold=True)


def word_hashes(data: np.ndarray, table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each word in UTF-8 ``data``; a word's hash depends on its bytes alone."""
    is_word, values = table
    out: list[tuple] = []
    at, n = 0, len(data)
    while at < n:
        stop = min(n, at + SEGMENT)
        while stop < n:  # end a pass between two words
            gaps = np.flatnonzero(~is_word[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
                break
            stop = min(n, stop + SEGMENT)
        part = data[at:stop]
        power, inverse = _powers(len(part) + 1)
        m = is_word[part]
        edge = np.diff(np.r_[False, m, False].astype(np.int8))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(len(part) + 1, dtype=U)
        np.cumsum(values[part] * power[: len(part)], out=total[1:])
        h = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U))
        out.append((s + at, e + at, h))
        at = stop
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    return tuple(np.concatenate(x) for x in zip(*out))  # type: ignore[return-value]


def ngrams(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of the len(words)-n+1 runs of n word hashes (none if there are fewer)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    total = np.zeros(m, dtype=U)
    for j, c in enumerate(seeds(n, 77 + seed)):
        total += words[j : j + m] * (c | U(1))
    return mix(total)


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """n-word shingles; a shorter non-empty text is one shingle of all its words."""
    return ngrams(words, min(n, len(words))) if len(words) else np.zeros(0, U)


def strings(column) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string column without nulls, without copying."""
    import pyarrow as pa

    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return ends, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def blocks(offsets: np.ndarray, size: int = BLOCK):
    """Row ranges of about ``size`` bytes of text each (at least one row)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def apart(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts with a space after each, so that no word crosses two."""
    lengths = np.diff(offsets)
    ends = np.r_[0, np.cumsum(lengths + 1)]
    out = np.full(int(ends[-1]), 32, dtype=np.uint8)
    keep = np.ones(len(out), dtype=bool)
    keep[ends[1:] - 1] = False
    out[keep] = data[int(offsets[0]) : int(offsets[-1])]
    return out, ends
