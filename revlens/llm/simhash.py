"""Document fingerprints: SimHash with permuted block tables.

Method: every term (a run of three words; its weight is how often it occurs) votes
with its hash on each of 128 bits, for 1 or against; the signs of the sums are the
fingerprint. To find all fingerprints within a Hamming radius, bits are cut into
radius + 2 blocks: two fingerprints that differ in at most ``radius`` bits agree on
two whole blocks, so one table per pair of blocks, keyed by it, holds them together.

Only DataFrame functions. Votes are counted two to a long (32 bits each), so a
word costs 64 additions in generated code and a document one row per task.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import keyed, written

BITS = 128
#: Words: runs without white space.
_SPACE = r"[\x20\x09-\x0D]+"


def fingerprints(rows: DataFrame, keys: list[str], text: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct ``keys``: keys, carry, fp (two longs).

    Terms are three consecutive words, and the one and two last words of the text, so a
    text of one word has a term. No words: no votes, fp is all zeros. Rows with equal
    keys must have equal texts. Equal texts have equal fingerprints.
    """
    words = F.split(F.trim(F.regexp_replace(F.col(text), _SPACE, " ")), " ")
    terms = (
        rows.select(*keys, *carry, words.alias("w"))
        .select(*keys, *carry, F.explode(F.arrays_zip(F.col("w"), F.slice("w", 2, 2**31 - 1).alias("w2"), F.slice("w", 3, 2**31 - 1).alias("w3"))).alias("t"))
        .select(*keys, *carry, *(F.col("t").getField(n).alias(a) for n, a in (("w", "a"), ("w2", "b"), ("w3", "c"))))
    )
    one = F.xxhash64("a", "b", "c")
    terms = terms.select(*keys, *carry, (F.col("a") != "").cast("long").alias("n"), one.alias("h0"), F.xxhash64(F.lit(1), one).alias("h1"))
    low = 0x0000000100000001
    lanes = [(h, i) for h in (0, 1) for i in range(32)]
    votes = [F.sum(F.shiftrightunsigned(F.col(f"h{h}"), i).bitwiseAND(F.lit(low)) * F.col("n")).alias(f"v{h}_{i}") for h, i in lanes]
    counted = terms.groupBy(*keys, *carry).agg(F.sum("n").alias("n"), *votes)

    def word(h: int) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            v = F.col(f"v{h}_{i}")
            for half, shift in ((v.bitwiseAND(F.lit(0xFFFFFFFF)), i), (F.shiftrightunsigned(v, 32), i + 32)):
                out = out.bitwiseOR(F.shiftleft((half * 2 > F.col("n")).cast("long"), shift))
        return out

    return counted.select(*keys, *carry, F.array(word(0), word(1)).alias("fp"))


def hex_of(fp: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(fp[0]), 16, "0"), F.lpad(F.hex(fp[1]), 16, "0")))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1.0 - distance(a, b) / F.lit(float(BITS))


def near_fingerprints(fps: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs (fp_a < fp_b, distance) of distinct fingerprints in column fp at most
    ``radius`` bits apart. Equal fingerprints are one; null ones are left out."""
    n = radius + 2
    cuts = [BITS * i // n for i in range(n + 1)]
    bits = F.concat(*(F.lpad(F.conv(F.hex(F.col("fp")[k]), 16, 2), 64, "0") for k in (0, 1)))
    keys = [
        F.struct(F.lit(t).alias("table"), *(F.substring("bits", cuts[b] + 1, cuts[b + 1] - cuts[b]).alias(f"b{j}") for j, b in enumerate(pair)))
        for t, pair in enumerate(combinations(range(n), 2))
    ]
    tables = fps.where(F.col("fp").isNotNull()).select("fp").distinct().withColumn("bits", bits).select("fp", F.explode(F.array(*keys)).alias("key"))
    a, b = tables.select(F.col("fp").alias("fp_a"), "key"), tables.select(F.col("fp").alias("fp_b"), "key")
    near = a.join(b, "key").where(F.col("fp_a") < F.col("fp_b")).withColumn("distance", distance(F.col("fp_a"), F.col("fp_b")))
    return near.where(F.col("distance") <= radius).select("fp_a", "fp_b", "distance").distinct()


def successors(keys: DataFrame) -> DataFrame:
    """(did, tid, ...) with ndid, ntid of the next key in descending order; the last
    one's next is the first. One key is its own next.

    Keys are dealt out in ranges, written, and numbered range by range; only the first
    key of each range meets in one place.
    """
    dealt = written(keys.repartitionByRange(F.desc("did"), F.desc("tid")).withColumn("range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("range").orderBy(F.desc("did"), F.desc("tid"))
    key = F.struct("did", "tid")
    heads = dealt.groupBy("range").agg(F.max(key).alias("head"))
    across = Window.orderBy("range")
    heads = heads.select("range", F.coalesce(F.lead("head").over(across), F.first("head").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    linked = dealt.withColumn("next", F.lead(key).over(inside)).join(heads, "range").withColumn("next", F.coalesce("next", "after"))
    return linked.drop("range", "after").withColumn("ndid", F.col("next.did")).withColumn("ntid", F.col("next.tid")).drop("next")


def op4_document_fingerprints(docs: DataFrame) -> DataFrame:
    """Rows with equal doc_id and text share one next document: the next different
    (doc_id, text) in descending order; null doc_ids come last, and texts of one doc_id
    go by descending md5."""
    base = keyed(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    thin = written(base.select("doc_id", "did", "tid", "n_chars"), "fp-keys")
    link = written(successors(thin.select("did", "tid", "n_chars").distinct()), "fp-links")

    need = link.select(F.col("did").alias("pdid"), F.col("tid").alias("ptid"), F.col("ndid").alias("did"), F.col("ntid").alias("tid"), F.floor(F.col("n_chars") / 2).cast("int").alias("half"))
    given = base.drop("doc_id", "n_chars").join(need, ["did", "tid"]).select(
        F.col("pdid").alias("did"), F.col("ptid").alias("tid"), "half", F.expr("left(text, half)").alias("tail")
    ).groupBy("did", "tid").agg(F.first("half").alias("half"), F.first("tail").alias("tail"))  # a repeated next row gives its text once
    given = written(given, "fp-tails")
    edited = base.drop("doc_id").join(given, ["did", "tid"]).select(
        "did", "tid", F.expr("concat(left(text, cast(n_chars - half as int)), tail)").alias("edited")
    ).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    own = written(fingerprints(base, ["did", "tid"], "text"), "fp-own")
    after = fingerprints(edited, ["did", "tid"], "edited", ("edited_sha256",)).withColumnRenamed("fp", "efp")

    out = thin.join(own, ["did", "tid"]).join(after, ["did", "tid"]).join(link.select("did", "tid", "ndid", "ntid"), ["did", "tid"])
    out = out.join(own.select(F.col("did").alias("ndid"), F.col("tid").alias("ntid"), F.col("fp").alias("nfp")), ["ndid", "ntid"])
    return out.select(
        "doc_id", "n_chars", "edited_sha256", hex_of(F.col("fp")).alias("fingerprint"), hex_of(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"),
    )
