"""Near-duplicate documents: DartMinHash over weighted five-word shingles.

Method: darts are thrown, by hash alone, at the plane of (weight, rank): each unit of
an element's weight has its own sequence of darts of rising rank, each with a
coordinate. A document catches the darts in its elements' weight regions, up to a
rank that brings some k ln k + 2k of them, and keeps the earliest per coordinate.
Two documents keep the same dart with probability of their weighted Jaccard
similarity. The work follows the number of elements and darts, not their product.

k = 160 coordinates make 32 bands of 5: at similarity 0.8 a pair shares no band with
probability 3e-6. Exact copies are one text from the start. Texts of a band are linked
to one of them, by their exact similarity: a star, as long as the band. Where that
leaves texts of a band in several classes, all texts that hang together by such bands
(a crowd) are compared exactly, in parts of bounded size; of the links found, only
those that join classes are returned. So no link of a band is lost, and no table of
pairs grows with the square of a group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import PLAIN, U, apart, blocks, keyed, mix, seeds, shingles, strings, word_hashes, written
from revlens.llm.components import components

K, ROWS = 160, 5
#: Texts of a crowd that are compared in one task, at most about twice.
PART = 1024
THRESHOLD = 0.8
SHINGLE = 5


# --- signatures ----------------------------------------------------------------------

def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> U(11)).astype(np.float64) + 0.5) / float(1 << 53)


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int = K, seed: int = 5) -> np.ndarray:
    """(n_docs, k) ids of the earliest dart per coordinate; 0s for a document without elements.

    ``doc`` numbers the documents of the (element, weight) entries; an element is
    listed once per document, weights are positive.
    """
    c_gap, c_at, c_coord, c_next, c_strip = seeds(5, seed)
    out = np.zeros((n_docs, k), dtype=U)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    # one strip per unit of weight
    strips = np.ceil(weight).astype(np.int64)
    e = np.repeat(np.arange(len(doc)), strips)
    strip = np.arange(len(e)) - np.repeat(np.cumsum(strips) - strips, strips)
    base = mix(element[e] ^ mix(strip.astype(U) + c_strip))
    d, room = doc[e], weight[e] - strip
    todo, aim = total > 0, k * np.log(k) + 2 * k
    while todo.any():
        reach = np.where(todo, aim / np.maximum(total, 1e-300), -1.0)
        z, own, space, limit = base, d, room, reach[d]
        rank = np.zeros(len(z))
        ids, ranks, keys = [], [], []
        live = limit > 0
        z, own, space, limit, rank = z[live], own[live], space[live], limit[live], rank[live]
        while len(z):
            z = mix(z + c_next)
            rank = rank - np.log(_uniform(mix(z ^ c_gap)))
            live = rank < limit
            z, own, space, limit, rank = z[live], own[live], space[live], limit[live], rank[live]
            hit = slice(None) if (space >= 1).all() else (_uniform(mix(z ^ c_at)) < space)
            ids.append(z[hit])
            ranks.append(rank[hit])
            keys.append(own[hit] * k + (mix(z[hit] ^ c_coord) % U(k)).astype(np.int64))
        ids_, ranks_, keys_ = np.concatenate(ids), np.concatenate(ranks), np.concatenate(keys)
        best = np.full(n_docs * k, np.inf)
        np.minimum.at(best, keys_, ranks_)
        won = ranks_ == best[keys_]
        flat = np.zeros(n_docs * k, dtype=U)
        flat[keys_[won]] = ids_[won]
        full = todo & np.isfinite(best.reshape(n_docs, k)).all(axis=1)
        out[full] = flat.reshape(n_docs, k)[full]
        todo &= ~full
        aim *= 2  # a coordinate without a dart: reach further
    return out


def weighted_shingles(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, shingle, occurrences) of a block of texts, distinct and sorted within each."""
    docs, hashes = [], []
    text, ends = apart(offsets, data)
    start, _, h = word_hashes(text, PLAIN)
    cuts = np.searchsorted(start, ends)
    for i in range(len(offsets) - 1):
        s = shingles(h[cuts[i] : cuts[i + 1]], SHINGLE)
        docs.append(np.full(len(s), i))
        hashes.append(s)
    doc, x = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((x, doc))
    doc, x = doc[order], x[order]
    first = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])]) if len(x) else np.zeros(0, np.int64)
    return doc[first], x[first], np.diff(np.r_[first, len(x)]).astype(np.float64)


def bands(k: int = K, rows: int = ROWS):
    """A column function: text -> array of band keys (empty for a text without words)."""

    @F.arrow_udf("array<long>")
    def of(text):
        import pyarrow as pa

        offsets, data = strings(text)
        n = k // rows
        parts = []
        for a, b in blocks(offsets):
            doc, x, w = weighted_shingles(offsets[a : b + 1], data)
            sig = dart_signatures(doc, x, w, b - a, k)
            keys = np.zeros((b - a, n), dtype=U)
            for j, c in enumerate(seeds(rows, 9)):
                keys += sig[:, j::rows][:, :n] * (c | U(1))
            keys = mix(keys ^ mix(np.arange(n, dtype=U) + U(1)))
            has = np.bincount(doc, minlength=b - a) > 0
            ends = np.r_[0, np.cumsum(np.where(has, n, 0))]
            parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[has].ravel().view(np.int64))))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return of


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two shingle arrays with repeats."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    ua, na = np.unique(a, return_counts=True)
    ub, nb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    low = int(np.minimum(na[ia], nb[ib]).sum())
    return low / (len(a) + len(b) - low)


def similarity():
    """A column function: (text, text) -> exact weighted Jaccard of five-word shingles."""

    @F.arrow_udf("double")
    def of(left, right):
        import pyarrow as pa

        known: dict[bytes, np.ndarray] = {}

        def get(text: str) -> np.ndarray:
            raw = text.encode()
            if raw not in known:
                if len(known) > 64:
                    known.clear()
                known[raw] = shingles(word_hashes(np.frombuffer(raw, np.uint8), PLAIN)[2], SHINGLE)
            return known[raw]

        return pa.array([_similarity(get(x.as_py()), get(y.as_py())) for x, y in zip(left, right)], pa.float64())

    return of


def _elements(text: str) -> np.ndarray:
    """Shingles of a text, the n-th occurrence of one told from the others: the weighted
    similarity of two texts is the plain one of these sets."""
    x = np.sort(shingles(word_hashes(np.frombuffer(text.encode(), np.uint8), PLAIN)[2], SHINGLE))
    if not len(x):
        return x
    heads = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    nth = np.arange(len(x)) - np.repeat(heads, np.diff(np.r_[heads, len(x)]))
    return mix(x + mix(nth.astype(U)))


def _joined(threshold: float):
    """Compares the texts of a group exactly and returns the links that join its classes."""

    def run(key, table):
        import pyarrow as pa

        tids, side = table["tid"].to_pylist(), table["side"].to_numpy()
        sets = [_elements(x.as_py()) for x in table["text"]]
        _, label = np.unique(np.array([x.hex() for x in table["root"].to_pylist()]), return_inverse=True)
        size = np.array([len(x) for x in sets])
        doc = np.repeat(np.arange(len(sets)), size)
        _, number = np.unique(np.concatenate(sets), return_inverse=True) if size.sum() else (None, np.zeros(0, np.int64))
        order = np.argsort(number, kind="stable")
        holders = doc[order]
        first = np.searchsorted(number[order], np.arange(number.max(initial=-1) + 2))
        ends = np.r_[0, np.cumsum(size)]
        out = []
        two = side.max() > 0  # two parts of a crowd: compare across
        for i in np.flatnonzero(side == 0) if two else range(len(sets)):
            mine = number[ends[i] : ends[i + 1]]
            a, n = first[mine], first[mine + 1] - first[mine]
            at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
            common = np.bincount(holders[at], minlength=len(sets))
            near = common >= threshold * (size[i] + size - common) - 1e-12
            near &= (common > 0) & (label != label[i])
            if two:
                near &= side == 1
            for j in np.flatnonzero(near).tolist():
                if label[j] != label[i]:
                    out.append((tids[i], tids[j]))
                    label[label == label[j]] = label[i]
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return run


def _compared(crowd: DataFrame, roots: DataFrame, body: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between classes within each crowd: parts of PART texts, each against each.

    What a group returns joins classes, so it is shorter than the group, never its square.
    """
    known = roots.select(F.col("node").alias("tid"), "root")
    rows = crowd.join(known, "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    sizes = rows.groupBy("crowd").agg(F.count("*").alias("n"), F.count_distinct("root").alias("classes")).where("classes > 1")
    rows = rows.join(sizes, "crowd").withColumn("parts", F.ceil(F.col("n") / PART).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("tid"), F.col("parts")).cast("int")).join(body, "tid")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.least("part", p).alias("i"), F.greatest("part", p).alias("j"), (F.col("part") > p).cast("int").alias("side")))
    pairs = rows.select("crowd", "tid", "root", "text", F.inline(others))
    return pairs.groupBy("crowd", "i", "j").applyInArrow(_joined(threshold), "a binary, b binary")


# --- classes ---------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, tid (md5 of the text), class_id (the smallest
    doc_id of its class), class_size (rows), keep (the row with that doc_id stays).

    Texts with a weighted Jaccard similarity of ``threshold`` or more on five-word
    shingles (words between white space; a shorter text is one shingle) are linked;
    classes are linked texts. Equal texts are one class, so are empty and null ones. A
    null doc_id counts as the smallest; a class of null ids has a null class_id. Rows
    equal in doc_id and text all have keep; ``deduplicate`` leaves one of them.
    """
    base = keyed(docs)
    seen = written(base.select("did", "tid", bands()("text").alias("bands")), "signatures")
    single = seen.groupBy("tid").agg(F.min("did").alias("did"), F.first("bands").alias("bands"))
    entries = single.select("tid", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.min("tid").alias("hub"), F.count("*").alias("n")).where("n > 1").select("band", "hub")
    member = written(entries.join(shared, "band"), "band-members")  # only bands with two texts or more

    wanted = member.select("tid").distinct().join(seen.groupBy("tid").agg(F.min("did").alias("did")), "tid")
    body = written(base.select("did", "tid", "text").join(wanted, ["tid", "did"]).groupBy("tid", "did").agg(F.first("text").alias("text")).select("tid", "text"), "band-texts")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = body.select(F.col("tid").alias("a"), F.col("text").alias("ta")), body.select(F.col("tid").alias("b"), F.col("text").alias("tb"))
        both = pairs.join(a, "a").join(b, "b")
        return written(both.where(similarity()("ta", "tb") >= threshold).select("a", "b"), "links")

    def labelled(rows: DataFrame, column: str, roots: DataFrame, name: str) -> DataFrame:
        named = roots.select(F.col("node").alias(column), F.col("root").alias(name))
        return rows.join(named, column, "left").withColumn(name, F.coalesce(name, column))

    # first, one hub for each text
    star = member.where("tid <> hub")
    first = star.groupBy("tid").agg(F.min("hub").alias("b")).withColumnRenamed("tid", "a")
    links = verified(first)
    roots = written(components(links), "roots")
    # then its other hubs, where it is not in their class yet
    more = star.select(F.col("tid").alias("a"), F.col("hub").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    more = labelled(labelled(more, "a", roots, "ra"), "b", roots, "rb").where("ra <> rb").select("a", "b")
    links = links.union(verified(more))
    roots = written(components(links), "roots")
    # then all that share bands and are still in several classes, against each other
    mixed = labelled(member, "tid", roots, "root")
    mixed = mixed.join(mixed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high"), "band")
    crowd = written(components(mixed.select(F.col("tid").alias("a"), F.col("hub").alias("b"))), "crowds")
    links = links.union(written(_compared(crowd.select(F.col("node").alias("tid"), F.col("root").alias("crowd")), roots, body, threshold), "links"))
    roots = components(links)

    of_text = labelled(seen.select("did", "tid"), "tid", roots, "root")
    classes = of_text.groupBy("root").agg(F.min(F.struct("did", "tid")).alias("first"), F.count("*").alias("class_size"))
    out = of_text.join(classes, "root")
    known = lambda c: F.when(c != F.lit(-(2**63)), c)
    return out.select(
        known(F.col("did")).alias("doc_id"), "tid", known(F.col("first.did")).alias("class_id"), "class_size",
        (F.struct("did", "tid") == F.col("first")).alias("keep"),
    )


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with their own columns."""
    names = docs.columns
    kept = written(near_duplicates(docs, threshold).where("keep"), "kept").groupBy(F.coalesce("doc_id", F.lit(-(2**63))).alias("did"), "tid").agg(F.count("*").alias("n"))
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("did"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("tid")]
    rows = written(docs.select(F.struct(*names).alias("row"), *key).join(kept, ["did", "tid"]), "kept-rows")
    once = rows.where("n > 1").dropDuplicates(["did", "tid"])
    return rows.where("n = 1").union(once).select("row.*")


def op7_minhash_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "class_id", "class_size", "keep")
