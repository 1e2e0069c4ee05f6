"""Exact substring deduplication with fixed-block anchors.

Method: every document is an index of its non-overlapping blocks of seven words, and
is probed with each of its rolling seven-word windows. Any repeat of 13 words holds a
whole indexed block, so a probe that meets no block of another place needs no further
look. Around the hits, repeats are extended: each 13-word window that holds a hit is
compared by its own hash, and adjacent windows join into the maximal repeat.

Probes are the bulk, so they travel packed (six bytes each, in binary rows dealt by
hash) and each task looks up its part of the hash space with sorted arrays. A block
that recurs in many documents of one task is settled there, and travels three times at
most; hits are judged by minima per window, never in pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import PLAIN, U, apart, blocks, keyed, ngrams, strings, word_hashes, written

WINDOW = 13
#: A window of 2 * ANCHOR - 1 words holds a whole block of ANCHOR words.
ANCHOR = (WINDOW + 1) // 2
#: Bytes of text whose probes meet in one task, and of a block of documents.
SHARD_BYTES, BLOCK_BYTES = 24 << 20, 8 << 20

#: Packed rows. kind 0: hashes and places; 1: the documents of a block (ids, texts' md5, first
#: places); 2: places found. A place is a word's number in its block of documents.
PACKED = "shard int, block long, kind int, a binary, b binary, c binary"
FOUND = "block long, kind int, a binary, b binary, c binary"


def _schema(ddl: str):
    import pyarrow as pa

    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _columns(rows: list[tuple], ddl: str):
    import pyarrow as pa

    schema = _schema(ddl)
    return [pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema


def _rows(rows: list[tuple], ddl: str):
    import pyarrow as pa

    columns, schema = _columns(rows, ddl)
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _table(rows: list[tuple], ddl: str):
    import pyarrow as pa

    columns, schema = _columns(rows, ddl)
    return pa.Table.from_arrays(columns, schema=schema)


def _gaps(places: np.ndarray) -> bytes:
    """Rising places as two-byte steps, or four where one is longer."""
    gaps = np.diff(np.r_[0, places])
    return gaps.astype("<u2" if gaps.max() < 1 << 16 else "<u4").tobytes()


def _ungap(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4"), dtype=np.int64)


def _name(tids: list[bytes], did: np.ndarray) -> int:
    """A block's number: the same whenever it holds the same documents."""
    return int.from_bytes(hashlib.blake2b(b"".join(tids) + did.astype("<i8").tobytes(), digest_size=8).digest(), "little") >> 1


def _block_probes(did, tids, offsets, data, n_shards):
    """The packed rows of one block of documents."""
    # one of equal texts, the one with the smallest id: what the others lose follows from that
    first: dict[bytes, int] = {}
    for i in np.argsort(did, kind="stable").tolist():
        first.setdefault(tids[i], i)
    rows = np.array(sorted(first.values()), dtype=np.int64)
    text, ends = apart(offsets, data)
    start, _, h = word_hashes(text, PLAIN)
    cuts = np.searchsorted(start, ends)
    # places: documents start at multiples of ANCHOR, so a place says whether it is a block's
    lengths = (cuts[1:] - cuts[:-1])[rows]
    room = -(-lengths // ANCHOR) * ANCHOR
    begin = np.r_[0, np.cumsum(room)][:-1]
    hashes, places, owner = [], [], []
    for n, r in enumerate(rows.tolist()):
        g = ngrams(h[cuts[r] : cuts[r + 1]], ANCHOR) if lengths[n] >= WINDOW else h[:0]
        hashes.append(g)
        places.append(begin[n] + np.arange(len(g)))
        owner.append(np.full(len(g), n))
    g, place, own = np.concatenate(hashes), np.concatenate(places), np.concatenate(owner)
    order = np.argsort(g, kind="stable")
    g, place, own = g[order], place[order], own[order]
    name = _name(tids, did)
    table = (did[rows].astype("<i8").tobytes(), b"".join(tids[r] for r in rows.tolist()), begin.astype("<i8").tobytes())
    yield name % n_shards, name, 1, *table
    if not len(g):
        return
    # a hash seen in several documents of this block, once as an indexed block, is a hit already;
    # its first probe and its first indexed block speak for it elsewhere
    change = np.r_[True, g[1:] != g[:-1]]
    group = np.cumsum(change) - 1
    heads = np.flatnonzero(change)
    several = np.maximum.reduceat(place, heads) > np.minimum.reduceat(place, heads)
    indexed = np.logical_or.reduceat(place % ANCHOR == 0, heads)
    hit = (several & indexed)[group]
    if hit.any():
        yield name % n_shards, name, 2, np.sort(place[hit]).astype("<i8").tobytes(), b"", b""
    speaks = change.copy()
    fixed = np.flatnonzero(place % ANCHOR == 0)
    speaks[fixed[np.r_[True, group[fixed][1:] != group[fixed][:-1]]] if len(fixed) else fixed] = True
    send = np.flatnonzero(~hit | speaks)
    shard = (g[send] % U(n_shards)).astype(np.int64)
    send = send[np.lexsort((place[send], shard))]
    shard = (g[send] % U(n_shards)).astype(np.int64)
    edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
    for x, y in zip(edges[:-1], edges[1:]):
        part = send[x:y]
        yield int(shard[x]), name, 0, (g[part] >> U(32)).astype("<u4").tobytes(), _gaps(place[part]), b""


def _probes(n_shards: int, block_bytes: int):
    def run(batches):
        for batch in batches:
            did, tids = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            offsets, data = strings(batch.column(2))
            for a, b in blocks(offsets, block_bytes):
                yield _rows(list(_block_probes(did[a:b], tids[a:b], offsets[a : b + 1], data, n_shards)), PACKED)

    return run


def _lookup(key, table):
    """One part of the hash space: the probes that meet an indexed block elsewhere."""
    block, kind = table["block"].to_numpy(), table["kind"].to_numpy()
    a, b, c = (table[x].to_pylist() for x in "abc")
    out = [(int(block[i]), int(kind[i]), a[i], b[i], c[i]) for i in np.flatnonzero(kind > 0).tolist()]
    probes = np.flatnonzero(kind == 0).tolist()
    if probes:
        part, places, owner = [], [], []
        for i in probes:
            x = np.frombuffer(a[i], "<u4")
            part.append(x)
            places.append(_ungap(b[i], len(x)))
            owner.append(np.full(len(x), i))
        x, place, own = np.concatenate(part), np.concatenate(places), np.concatenate(owner)
        order = np.argsort(x, kind="stable")
        x, place, own = x[order], place[order], own[order]
        heads = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        size = np.diff(np.r_[heads, len(x)])
        indexed = np.logical_or.reduceat(place % ANCHOR == 0, heads)
        hit = np.repeat((size > 1) & indexed, size)
        place, own = place[hit], own[hit]
        order = np.lexsort((place, own))
        place, own = place[order], own[order]
        cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True]) if len(own) else np.zeros(1, np.int64)
        out += [(int(block[own[s]]), 2, place[s:e].astype("<i8").tobytes(), b"", b"") for s, e in zip(cuts[:-1], cuts[1:])]
    return _table(out, FOUND)


def _to_documents(key, table):
    """What was found in one block of documents, by document."""
    import pyarrow as pa

    kind = table["kind"].to_numpy()
    ddl = "did long, tid binary, found binary"
    own = np.flatnonzero(kind == 1).tolist()
    hits = [np.frombuffer(x, "<i8") for x in table["a"].filter(pa.array(kind == 2)).to_pylist()]
    if not own or not hits:
        return _table([], ddl)
    a, b, c = (table[x][own[0]].as_py() for x in "abc")
    did, begin = np.frombuffer(a, "<i8"), np.frombuffer(c, "<i8")
    place = np.unique(np.concatenate(hits))
    doc = np.searchsorted(begin, place, side="right") - 1
    heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True])
    rows = [(int(did[doc[s]]), b[16 * doc[s] : 16 * doc[s] + 16], (place[s:e] - begin[doc[s]]).astype("<i4").tobytes()) for s, e in zip(heads[:-1], heads[1:])]
    return _table(rows, ddl)


def _windows(n_shards: int, block_bytes: int):
    """13-word windows around the hits, packed by block of documents like the probes; c holds
    the ids of a row's windows as runs (id, count)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            did, tids, anchors = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
            offsets, data = strings(batch.column(2))
            for a, b in blocks(offsets, block_bytes):
                text, ends = apart(offsets[a : b + 1], data)
                start, _, h = word_hashes(text, PLAIN)
                cuts = np.searchsorted(start, ends)
                begin = cuts[:-1] + np.arange(b - a)  # so that no two documents begin at one place
                hashes, second, places, ids = [], [], [], []
                for i in range(b - a):
                    words = h[cuts[i] : cuts[i + 1]]
                    n = len(words) - WINDOW + 1
                    if n <= 0:
                        continue
                    at = np.frombuffer(anchors[a + i], "<i4")
                    at = at[at <= len(words) - ANCHOR]
                    near = np.zeros(n + 1, dtype=np.int32)  # window s holds the hit at p: p - 6 <= s <= p
                    np.add.at(near, np.clip(at - (WINDOW - ANCHOR), 0, n), 1)
                    np.add.at(near, np.minimum(at + 1, n), -1)
                    s = np.flatnonzero(np.cumsum(near)[:n] > 0)
                    hashes.append(ngrams(words, WINDOW)[s])
                    second.append(ngrams(words, WINDOW, seed=1)[s])
                    places.append(begin[i] + s)
                    ids.append(np.full(len(s), did[a + i]))
                name = _name(tids[a:b], did[a:b])
                out = [(name % n_shards, name, 1, did[a:b].astype("<i8").tobytes(), b"".join(tids[a:b]), begin.astype("<i8").tobytes())]
                if hashes:
                    g, place, own = np.concatenate(hashes), np.concatenate(places), np.concatenate(ids)
                    shard = (np.concatenate(second) % U(n_shards)).astype(np.int64)
                    order = np.argsort(shard, kind="stable")
                    g, place, own, shard = g[order], place[order], own[order], shard[order]
                    edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else []
                    for x, y in zip(edges[:-1], edges[1:]):
                        runs = np.flatnonzero(np.r_[True, own[x + 1 : y] != own[x : y - 1]])
                        counts = np.diff(np.r_[runs, y - x]).astype("<i8")
                        out.append((int(shard[x]), name, 0, g[x:y].astype("<u8").tobytes(), _gaps(place[x:y]), np.stack([own[x:y][runs].astype("<i8"), counts], axis=1).tobytes()))
                yield _rows(out, PACKED)

    return run


def _repeated(key, table):
    """Windows that also start in a document with a smaller id."""
    block, kind = table["block"].to_numpy(), table["kind"].to_numpy()
    a, b, c = (table[x].to_pylist() for x in "abc")
    out = [(int(block[i]), 1, a[i], b[i], c[i]) for i in np.flatnonzero(kind == 1).tolist()]
    rows = np.flatnonzero(kind == 0).tolist()
    if rows:
        hashes = [np.frombuffer(a[i], "<u8") for i in rows]
        places = np.concatenate([_ungap(b[i], len(x)) for i, x in zip(rows, hashes)])
        runs = np.concatenate([np.frombuffer(c[i], "<i8").reshape(-1, 2) for i in rows])
        did = np.repeat(runs[:, 0], runs[:, 1])
        own = np.repeat(rows, [len(x) for x in hashes])
        _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        least = np.full(int(inverse.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, inverse, did)
        late = did > least[inverse]
        places, own = places[late], own[late]
        cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True]) if len(own) else np.zeros(1, np.int64)
        out += [(int(block[own[s]]), 2, places[s:e].astype("<i8").tobytes(), b"", b"") for s, e in zip(cuts[:-1], cuts[1:])]
    return _table(out, FOUND)


@F.arrow_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]))
def _kept(text, starts, whole):
    """Counts and what is left of a text without its repeated windows (whole: all of it repeats)."""
    import pyarrow as pa
    from itertools import compress

    out = []
    for t, parts, gone in zip(text, starts, whole):
        words = t.as_py().encode().split()
        n = len(words)
        if gone.as_py() and n >= WINDOW:
            out.append({"n_words": n, "n_removed": n, "kept": ""})
            continue
        parts = parts.as_py()
        if not parts:
            out.append({"n_words": n, "n_removed": 0, "kept": b" ".join(words).decode()})
            continue
        s = np.frombuffer(b"".join(parts), "<i4")
        cover = np.zeros(n + 1, dtype=np.int64)
        np.add.at(cover, s, 1)
        np.add.at(cover, s + WINDOW, -1)
        free = np.cumsum(cover)[:n] == 0
        out.append({"n_words": n, "n_removed": int(n - free.sum()), "kept": b" ".join(compress(words, free)).decode()})
    return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))


def remove_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept: each text without the words that lie in a 13-word
    window which also starts in a document with a smaller doc_id.

    Words are runs without ASCII white space, unchanged; kept words are joined by one
    space. Windows are judged on the input. Null text has no words; texts under 13 words
    keep all. A null doc_id counts as the smallest; rows with the same doc_id do not
    remove from each other. One row per row. Every block of documents sends a row to
    every part of the hash space: give both some 256 MB where there are tens of terabytes.
    """
    base = keyed(docs)
    # equal texts: all but the smallest id repeat whole
    seen = written(base.groupBy("tid").agg(F.min("did").alias("first"), F.sum(F.octet_length("text").cast("long")).alias("bytes")), "texts")
    n_shards = max(1, -(-(seen.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes))

    def by_document(rows: DataFrame, settle, name: str) -> DataFrame:
        found = written(rows.groupBy("shard").applyInArrow(settle, FOUND), name)
        found = found.groupBy("block").applyInArrow(_to_documents, "did long, tid binary, found binary")
        return found.groupBy("did", "tid").agg(F.collect_list("found").alias("found"))  # a repeated row is in several blocks

    probes = base.select("did", "tid", "text").mapInArrow(_probes(n_shards, block_bytes), PACKED)
    anchors = by_document(probes, _lookup, "anchor-hits").select("did", "tid", F.expr("aggregate(found, x'', (a, x) -> concat(a, x))").alias("anchors"))
    near = base.select("did", "tid", "text").join(anchors, ["did", "tid"]).select("did", "tid", "text", "anchors")
    repeats = by_document(near.mapInArrow(_windows(n_shards, block_bytes), PACKED), _repeated, "repeats")
    out = base.join(repeats, ["did", "tid"], "left").join(seen.select("tid", "first"), "tid")
    out = out.select("doc_id", _kept("text", F.coalesce("found", F.array().cast("array<binary>")), F.col("did") > F.col("first")).alias("r"))
    return out.select("doc_id", "r.n_words", "r.n_removed", "r.kept")


def op9_substring_dedup(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
with words as (
  select row_number() over () as rid, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), windows as (
  select rid, doc_id, i, hash(array_to_string(w[i : i + 12], ' ')) as h, array_to_string(w[i : i + 12], ' ') as s
  from (select rid, doc_id, w, unnest(range(1, len(w) - 11)) as i from words where len(w) >= 13)
), late as (
  select rid, i from (select rid, i, doc_id, min(doc_id) over (partition by s) as first from windows) where doc_id > first
), gone as (
  select distinct rid, unnest(range(i, i + 13)) as p from late
), spots as (
  select rid, list(p) as ps, count(*) as n from gone group by rid
), flags as (
  select w.rid, w.doc_id, len(w.w) as n_words, coalesce(s.n, 0) as n_removed, w.w, s.ps from words w left join spots s using (rid)
), kept as (
  select f.rid, string_agg(u.word, ' ' order by u.p) as kept
  from flags f, lateral (select unnest(f.w) as word, unnest(range(1, len(f.w) + 1)) as p) u
  where not exists (select 1 from gone g where g.rid = f.rid and g.p = u.p) group by f.rid
)
select f.doc_id, f.n_words::bigint as n_words, f.n_removed::bigint as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from flags f left join kept k using (rid)
"""
