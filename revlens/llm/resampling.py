"""Importance resampling of documents toward a target distribution.

Documents and target texts are described by hashed counts of their runs of words. A
bucket's *gain* is the log ratio of its shares in the target and in the corpus; a
document's weight is the mean of its features' gains, and adding seeded Gumbel noise
to the weights and keeping the highest scores draws without replacement.

Method, for the features: batch concatenation. The texts of a batch are joined with
a separator sentinel, one regular expression pass finds all words, a search of the
words' offsets among the texts' offsets tells which runs cross two texts, and those
are masked before a bincount counts the rest.

The features are written once, in two bytes each. Corpus counts are one bincount per
task, merged by Spark; there are as many of them as buckets, whatever the corpus
holds. Ranks come from ``operators.ranking``: no task sees all scores.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import blocks, importable, strings, texts, written
from revlens.operators.ranking import number_rows

#: Stands between two texts; it is no letter, so no word crosses it.
SENTINEL = b"\x00"
#: After A-Z are lowered: every byte of a non-ASCII character belongs to a word.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Sampling:
    longest: int = 2  # words in a feature
    buckets: int = 10_000
    min_words: int = 20  # shorter documents are not drawn
    percent: int = 25  # of the others
    seed: int = 7

    def __post_init__(self):
        if not 1 <= self.buckets <= 1 << 16 or self.longest < 1 or not 0 <= self.percent <= 100:
            raise ValueError(str(self))


def batch_features(offsets: np.ndarray, data: np.ndarray, sampling: Sampling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, features per text, buckets of all features text by text) of the
    texts ``data[offsets[i]:offsets[i + 1]]``."""
    raw = data[int(offsets[0]) : int(offsets[-1])].tobytes()
    at = offsets - offsets[0]
    joined = SENTINEL.join([raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]).lower()
    begins = at[:-1] + np.arange(len(at) - 1)  # of the texts, in the joined bytes
    spans = [m.span() for m in WORD.finditer(joined)]
    words = [joined[a:b] for a, b in spans]
    starts = np.fromiter((a for a, _ in spans), dtype=np.int64, count=len(spans))
    owner = np.searchsorted(begins, starts, side="right") - 1
    crcs = list(map(zlib.crc32, words))
    found, owners = [np.array(crcs, dtype=np.uint32)], [owner]
    for n in range(2, sampling.longest + 1):
        # a run's checksum goes on from that of the run one word shorter
        crcs = [zlib.crc32(w, zlib.crc32(b" ", c)) for c, w in zip(crcs, words[n - 1 :])]
        one = owner[: len(crcs)] == owner[n - 1 :]
        found.append(np.array(crcs, dtype=np.uint32)[one])
        owners.append(owner[: len(crcs)][one])
    texts_ = len(at) - 1
    all_owners = np.concatenate(owners)
    order = np.argsort(all_owners, kind="stable")
    hashed = (np.concatenate(found) % np.uint32(sampling.buckets)).astype("<u2")[order]
    return np.bincount(owner, minlength=texts_), np.bincount(all_owners, minlength=texts_), hashed


FEATURES = "doc_id long, n_words long, features binary"


def features(docs: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """doc_id, n_words and the buckets of all features (little-endian uint16) per row.

    A null text, and one without words, has none; repeated rows and null ids stay.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            offsets, data = strings(batch.column(1))
            for a, b in blocks(offsets):
                n_words, n, hashed = batch_features(offsets[a : b + 1], data, sampling)
                ends = np.r_[0, np.cumsum(2 * n)].astype(np.int64)
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(hashed)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n_words.astype(np.int64)), binary.cast(pa.binary())], names=["doc_id", "n_words", "features"])

    return texts(docs).mapInArrow(run, FEATURES)


def bucket_counts(feats: DataFrame, sampling: Sampling = Sampling()) -> np.ndarray:
    """How often each bucket occurs; a task sends one count per bucket it saw."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(sampling.buckets, dtype=np.int64)
        for batch in batches:
            offsets, data = strings(batch.column(0))
            total += np.bincount(data[offsets[0] : offsets[-1]].view("<u2"), minlength=sampling.buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    merged = feats.select("features").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(sampling.buckets, dtype=np.int64)
    for row in merged.collect():  # at most `buckets` rows
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares), per bucket."""
    n, all_corpus, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [((t + 1.0) * (all_corpus + n)) / ((s + 1.0) * (all_target + n)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def weights(feats: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight: the floored mean gain (no features: 0)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            offsets, data = strings(batch.column(2))
            n = np.diff(offsets) // 2
            total = np.r_[0, np.cumsum(gains[data[offsets[0] : offsets[-1]].view("<u2")])]
            ends = (offsets - offsets[0]) // 2
            weight = (total[ends[1:]] - total[ends[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    return feats.select("doc_id", "n_words", "features").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id, seed: int):
    """Seeded Gumbel noise of a document, in whole thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank.

    ``percent`` of the documents with at least ``min_words`` words are drawn, those
    with the highest scores, ties to the smaller doc_id (a null one last); the others'
    rank is null. A null doc_id draws the noise of an empty one. Repeated rows are
    documents of their own with equal scores. ``target`` needs a column text; without
    target texts, gains only compare a bucket with the mean one. No documents: no rows.
    """
    spark = docs.sparkSession
    importable(spark)
    feats = written(features(docs, sampling), "features")
    aim = features(target.select(F.lit(0).cast("long").alias("doc_id"), "text"), sampling)
    gains = bucket_gains(bucket_counts(feats, sampling), bucket_counts(aim, sampling))
    rows = weights(feats, gains).withColumn("score", F.col("weight") + noise(F.col("doc_id"), sampling.seed))
    rows = rows.withColumn("drawable", F.col("n_words") >= sampling.min_words)
    drawn = feats.where(F.col("n_words") >= sampling.min_words).count() * sampling.percent // 100
    rows = number_rows(rows, ["drawable desc", "score desc", "doc_id"])
    rank = F.when(F.col("number") <= drawn, F.col("number"))
    return rows.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def op11_importance_resampling(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns of ``resample``: see there for odd rows."""
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


# --- the same in DuckDB ---------------------------------------------------------------

# CRC-32's table by its rule: eight shifts, with the reflected polynomial where the low bit is 1
_CRC = """
steps(i, k, c) as (
  select i::bigint, 0, i::bigint from range(256) r(i)
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where k < 8),
crc_table as materialized (select list(c order by i) as t from steps where k = 8),
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
with recursive {_CRC}
d as (select row_number() over () as row, doc_id, {_WORDS} as w from documents),
b as ({_WORDS.join(('select ', ' as w from benchmark'))}),
df as materialized (
  select row, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as f from d),
tf as materialized (select unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as f from b),
hashed as materialized (
  select f, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, octet_length(encode(f))), lambda k: ('0x' || substr(hex(encode(f)), 2 * k + 1, 2))::bigint)),
         lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select distinct f from (select f from df union all select f from tf)), crc_table),
corpus as (select bucket, count(*) as s from df join hashed using (f) group by bucket),
target as (select bucket, count(*) as t from tf join hashed using (f) group by bucket),
sums as (select (select count(*) from df) as all_s, (select count(*) from tf) as all_t),
gains as materialized (
  select r.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (all_s + 10000)::double / ((coalesce(s, 0) + 1)::double * (all_t + 10000)::double)))::bigint as gain
  from (select unnest(range(10000)) as bucket) r left join corpus using (bucket) left join target using (bucket), sums),
weighed as (select row, count(*) as n_features, sum(gain)::bigint as total from df join hashed using (f) join gains using (bucket) group by row),
scored as (
  select row, doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::bigint as weight,
         ('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint::double as h
  from d left join weighed using (row)),
final as (select *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::double)))::bigint as score from scored),
ranked as (
  select row, row_number() over (order by score desc, doc_id nulls last) as rank from final where n_words >= 20)
select doc_id, n_features, weight, score,
       case when rank <= (select count(*) from ranked) * 25 // 100 then rank end as rank
from final left join ranked using (row)
"""
