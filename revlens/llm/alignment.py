"""Alignment of two tokenizers' tokens over the bytes of every document.

Method: an Arrow-native pipeline. The documents' token lists are flattened with their
parent indices; segmented cumulative sums of the tokens' bytes give every token's end
in its document; Acero hash joins on document-end keys show where tokens of both
tokenizers end (the groups' borders) and, as a full outer join, all borders, between
which exactly one pair of tokens overlaps (the links). ``Table.group_by`` counts the
pairs of a block of documents, and Spark merges these partial counts.

A text is cut where no token of either tokenizer crosses, and each distinct piece of a
block is encoded once. Every cut is a border of both, so a long document is aligned in
ranges of pieces, in bounded memory.

Corpus counts come back by block: a block asks once for each distinct pair that it
holds, so no row is made per link, and a pair that every document holds is one row
per block.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import blocks, strings, texts, written

#: Bytes of text (one document at least) that share one request for counts.
BLOCK_BYTES = 4 << 20
#: Pieces that one pass of joins aligns.
PIECES = 1 << 16
#: Pieces that A encodes at once: its encodings are large.
ENCODED = 1 << 12

ALIGNED = (
    "block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs binary, times binary, block_pairs array<long>, block_documents array<int>"
)
ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# --- pieces and their tokens ---------------------------------------------------------

def spaced(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts with a space before each."""
    ends = np.r_[0, np.cumsum(np.diff(offsets) + 1)].astype(np.int64)
    out = np.full(int(ends[-1]), 32, dtype=np.uint8)
    keep = np.ones(len(out), dtype=bool)
    keep[ends[:-1]] = False
    out[keep] = data[int(offsets[0]) : int(offsets[-1])]
    return out, ends


#: A piece also begins at these after a Latin letter or digit.
PUNCTUATION = ".,;:!?)\"'"


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin: at every text, at every space after a character that is neither
    white space nor a control character, and at ``PUNCTUATION`` after a Latin letter or
    digit. Words of both tokenizers begin there."""
    begin = np.zeros(len(data), dtype=bool)
    at = np.flatnonzero(data == 32)
    at = at[at >= 3]
    c, b, a = data[at - 1], data[at - 2], data[at - 3]
    # fixed values: white space outside ASCII, by its last bytes in UTF-8
    wide = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    wide |= (a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E)))
    wide |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    wide |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    wide |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    begin[at[((c > 32) & (c < 127)) | ((c >= 128) & ~wide)]] = True
    mark = np.zeros(256, dtype=bool)
    mark[[ord(x) for x in PUNCTUATION]] = True
    at = np.flatnonzero(mark[data])
    at = at[at >= 2]
    c, b = data[at - 1], data[at - 2]
    # fixed values: U+00C0 to U+017F but the signs of multiplication and division
    latin = (b >= 0xC3) & (b <= 0xC5) & (c >= 0x80) & (c < 0xC0) & ~((b == 0xC3) & ((c == 0x97) | (c == 0xB7)))
    low = c | 0x20
    begin[at[((c >= 48) & (c <= 57)) | ((low >= 97) & (low <= 122) & (c < 128)) | latin]] = True
    begin[ends[:-1][np.diff(ends) > 0]] = True
    return np.flatnonzero(begin)


class Tokenizers:
    """Tokens of pieces by both tokenizers, and the bytes of every token."""

    def __init__(self, a_path: str, b_path: str):
        import json
        import os
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        spec = json.loads(self.a.to_str())
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
            raise ValueError("A is not a plain byte-level tokenizer")
        # byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        crosses = re.compile(rf"[^▁]▁|[0-9A-Za-zÀ-ſ][{re.escape(PUNCTUATION)}]")
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if crosses.search(piece):
                raise ValueError(f"a piece of B crosses a cut: {piece!r}")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.space = self.b.piece_to_id("▁")
        self.guard = self.b.encode("\n")  # the space that B adds, and a line end, which no piece joins
        sizes = lambda known: np.array([len(x) for x in known], dtype=np.int64)
        self.a_sizes, self.b_sizes = sizes(self.a_bytes), sizes(self.b_bytes)

    def __call__(self, pieces: list[str]):
        """(A's tokens, B's tokens) as lists of int32 per piece, and which pieces both
        give back byte for byte."""
        import pyarrow as pa

        a: list[list[int]] = []
        for i in range(0, len(pieces), ENCODED):
            a += [e.ids for e in self.a.encode_batch_fast(pieces[i : i + ENCODED], add_special_tokens=False)]
        # B puts a space before what it encodes: the piece's own, or one before a guard
        # that goes again; of nothing it makes no token
        b = self.b.encode([p[1:] if p[0] == " " else "\n" + p for p in pieces], num_threads=1)
        skip = len(self.guard)
        b = [(ids or [self.space]) if p[0] == " " else ids[skip:] for p, ids in zip(pieces, b)]
        raw = "".join(pieces).encode()
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in pieces])
        lists, same = [], np.ones(len(pieces), dtype=bool)
        for ids, known, sizes in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)):
            stops = np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(stops[-1]) if len(stops) else 0)
            lists.append(pa.LargeListArray.from_arrays(np.r_[0, stops], pa.array(flat)))
            if not (np.array_equal(np.r_[0, np.cumsum(sizes[flat])][stops], ends) and b"".join(map(known.__getitem__, flat.tolist())) == raw):
                same &= np.array([b"".join([known[i] for i in x]) == p.encode() for p, x in zip(pieces, ids)], dtype=bool)
        return lists, same


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


# --- the alignment of a range of pieces ------------------------------------------------

def _ends(lists, owners: np.ndarray, sizes: np.ndarray):
    """(document, end in the document, id) of every token of the listed pieces."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ids = pc.list_flatten(lists)
    document = pa.array(owners).take(pc.list_parent_indices(lists))
    total = np.asarray(pc.cumulative_sum(pa.array(sizes).take(ids)))
    of = np.asarray(document)
    first = np.flatnonzero(np.diff(of, prepend=-1))  # each document's first token
    before = np.r_[0, total][first]
    end = total - np.repeat(before, np.diff(np.r_[first, len(of)]))
    return document, end, ids


def align(a_lists, b_lists, owners: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray):
    """Align pieces (lists of ids, with the ascending document numbers of the pieces).

    Returns (links, groups): links is a table (document, pair) in text order, pair being
    A's id * 2^32 + B's; groups a table (document, tokens), tokens as ``1,2|3``.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    sides, ordered = [], []
    for name, lists, sizes in (("a", a_lists, a_sizes), ("b", b_lists, b_sizes)):
        document, end, ids = _ends(lists, owners, sizes)
        key = pa.array((np.asarray(document).astype(np.int64) << 32) | end)  # a document's end: one key
        sides.append(pa.table({"key": key, name: ids}))
        ordered.append((key, ids, document))
    both = sides[0].join(sides[1], "key", join_type="full outer", use_threads=False).sort_by("key")
    # a token covers the borders up to its end: the next end of a side names its token
    a, b = (pc.fill_null_backward(both[n]).combine_chunks() for n in ("a", "b"))
    key = np.asarray(both["key"].combine_chunks())
    pair = (np.asarray(a).astype(np.int64) << 32) | np.asarray(b).astype(np.int64)
    links = pa.table({"document": pa.array(key >> 32), "pair": pa.array(pair)})

    shared = sides[0].select(["key"]).join(sides[1].select(["key"]), "key", join_type="inner", use_threads=False).sort_by("key")
    border = np.asarray(shared["key"].combine_chunks())
    texts_ = []
    for keys, ids, _ in ordered:
        stops = np.searchsorted(np.asarray(keys), border, side="right")
        words = pc.cast(ids, pa.string())
        texts_.append(pc.binary_join(pa.ListArray.from_arrays(np.r_[0, stops].astype(np.int32), words), ","))
    tokens = pc.binary_join_element_wise(texts_[0], texts_[1], "|")
    return links, pa.table({"document": pa.array(border >> 32), "tokens": tokens})


def _block(doc_ids, data: np.ndarray, ends: np.ndarray, coded: Tokenizers):
    """The rows of a block of documents: one per document, and one with its pairs."""
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(ends) - 1
    starts = cuts(data, ends)
    joined = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.r_[starts, ends[-1]].astype(np.int64)), pa.py_buffer(data))
    pieces = joined.dictionary_encode()
    lists, same = coded(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
    at = np.asarray(pieces.indices)
    owner = np.repeat(np.arange(n), np.diff(np.searchsorted(starts, ends)))
    # no tokens: an empty text, or one with a piece whose bytes a side does not give back
    whole = (np.diff(ends) > 1) & (np.bincount(owner, weights=~same[at], minlength=n) == 0)
    kept = whole[owner]
    at, owner = at[kept], owner[kept]
    counts = np.zeros((4, n), dtype=np.int64)
    digests = [hashlib.sha256() if w else None for w in whole]
    begun = np.zeros(n, dtype=bool)
    found = []
    for c in range(0, len(at), PIECES):
        some, owners = pa.array(at[c : c + PIECES]), owner[c : c + PIECES]
        a, b = lists[0].take(some), lists[1].take(some)
        links, groups = align(a, b, owners, coded.a_sizes, coded.b_sizes)
        for row, side in ((0, a), (1, b)):
            counts[row] += np.bincount(owners, weights=np.asarray(pc.list_value_length(side)), minlength=n).astype(np.int64)
        of = np.asarray(groups["document"])
        counts[2] += np.bincount(of, minlength=n)
        counts[3] += np.bincount(np.asarray(links["document"]), minlength=n)
        found.append(links.group_by(["document", "pair"], use_threads=False).aggregate([("pair", "count")]))
        first = np.flatnonzero(np.diff(of, prepend=-1))
        tokens = pa.ListArray.from_arrays(np.r_[first, len(of)].astype(np.int32), groups["tokens"].combine_chunks())
        for d, text in zip(of[first].tolist(), pc.binary_join(tokens, ";")):
            digests[d].update((b";" if begun[d] else b"") + text.as_buffer())
            begun[d] = True
    del lists
    if found:
        held = pa.concat_tables(found).group_by(["document", "pair"], use_threads=False).aggregate([("pair_count", "sum")])
        held = held.sort_by("document")
        partial = held.group_by("pair", use_threads=False).aggregate([("pair", "count")])
        pairs, documents = partial["pair"].combine_chunks(), partial["pair_count"].combine_chunks().cast(pa.int32())
        local = np.asarray(pc.index_in(held["pair"].combine_chunks(), pairs)).astype("<i4")
        times, of = np.asarray(held["pair_count_sum"].combine_chunks()).astype("<i4"), np.asarray(held["document"].combine_chunks())
        stops = np.searchsorted(of, np.arange(n + 1))
    else:
        pairs, documents = pa.array([], pa.int64()), pa.array([], pa.int32())
        local = times = np.zeros(0, "<i4")
        stops = np.zeros(n + 1, dtype=np.int64)
    name = uuid.uuid4().hex
    slices = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(stops[:-1].tolist(), stops[1:].tolist())] + [None], pa.binary())
    one = lambda x, kind: pa.array([None] * n + [x.to_pylist()], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * (n + 1)), pa.concat_arrays([doc_ids, pa.nulls(1, doc_ids.type)]),
            *[pa.array([*c.tolist(), None], pa.int64()) for c in counts],
            pa.array([d.hexdigest() if d else "" for d in digests] + [None], pa.string()),
            slices(local), slices(times), one(pairs, pa.int64()), one(documents, pa.int32()),
        ],
        names=[f.split()[0] for f in ALIGNED.split(",")],
    )


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document with its counts, its groups' digest, its distinct pairs (as
    places in its block's list) and how often it has each; and one row per block with
    that list and in how many of the block's documents each pair is linked."""

    def run(batches):
        coded = tokenizers(a_path, b_path)
        for batch in batches:
            offsets, data = strings(batch.column(1))
            for a, b in blocks(offsets, BLOCK_BYTES):
                yield _block(batch.column(0).slice(a, b - a), *spaced(offsets[a : b + 1], data), coded)

    return texts(docs).mapInArrow(run, ALIGNED)


def pair_counts(block_pairs: DataFrame) -> DataFrame:
    """pair, its documents over the corpus, and whether no pair of its A id has more."""
    totals = block_pairs.groupBy("pair").agg(F.sum("documents").alias("documents"))
    totals = written(totals, "pair-counts")
    a_id = F.shiftright("pair", 32)
    most = totals.groupBy(a_id.alias("a_id")).agg(F.max("documents").alias("most"))
    joined = totals.withColumn("a_id", a_id).join(most, "a_id")
    return joined.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def link_sums(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of ``rows`` with n_best and count_sum. ``counts`` holds, for
    each block (of_block) and place in its list, a pair's documents and whether it is best."""

    def run(documents, known):
        import pyarrow as pa

        place = np.asarray(known["place"].combine_chunks()) if len(known) else np.zeros(0, np.int64)
        count, best = (np.zeros(int(place.max(initial=-1)) + 1, dtype=np.int64) for _ in range(2))
        if len(known):
            count[place] = np.asarray(known["documents"].combine_chunks())
            best[place] = known["best"].combine_chunks().to_numpy(zero_copy_only=False)
        sums: list[np.ndarray] = []
        offsets, data = strings(documents["pairs"])
        local = data[offsets[0] : offsets[-1]].view("<i4")
        _, data = strings(documents["times"])
        start = int(strings(documents["times"])[0][0])
        times = data[start : start + 4 * len(local)].view("<i4").astype(np.int64)
        ends = (offsets - offsets[0]) // 4
        for values in (best, count):
            total = np.r_[0, np.cumsum(times * values[local])]
            sums.append(total[ends[1:]] - total[ends[:-1]])
        keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        columns = [documents[c] for c in keep] + [pa.array(x) for x in sums] + [documents["groups_sha256"]]
        return pa.table(columns, names=[*keep, "n_best", "count_sum", "groups_sha256"])

    return rows.groupBy("block").cogroup(counts.groupBy("of_block")).applyInArrow(run, ROWS)


def op13_cross_tokenizer_alignment(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 per row.

    Null and empty texts, and those that a tokenizer does not give back byte for byte
    (B writes U+2581 as a space), have no tokens: zeros and an empty digest. Null ids
    stay null; repeated rows are documents of their own and count so; an empty table
    gives no rows; other columns are left behind. All ids fit 32 bits.
    """
    import public_tokenizers

    table = written(aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")), "aligned")
    lists = table.where(F.col("block_pairs").isNotNull())
    asked = lists.select("block", F.posexplode(F.arrays_zip("block_pairs", "block_documents")).alias("place", "p"))
    asked = asked.select("block", "place", F.col("p.block_pairs").alias("pair"), F.col("p.block_documents").alias("documents"))
    counts = asked.drop("documents").join(pair_counts(asked), "pair").select(F.col("block").alias("of_block"), "place", "documents", "best")
    rows = table.where(F.col("block_pairs").isNull()).select(*[f.split()[0] for f in ALIGNED.split(",")][:9])
    return link_sums(rows, counts)
