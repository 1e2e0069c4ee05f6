"""Cross-tokenizer alignment against the tokenizers run on whole texts."""

import collections
import hashlib
import random

import numpy as np
import pytest
from tests.conftest import SF_SMALL

import public_tokenizers
from revlens.llm import alignment as M
from revlens.llm.common import read

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def whole_texts(docs):
    """The contract's row of each (doc_id, text), token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    coded = M.tokenizers(A, B)
    rows, links_of, held = [], [], collections.Counter()
    for doc, text in docs:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        raw = f" {text or ''}".encode()
        if not text or b"".join(coded.a_bytes[i] for i in a) != raw or b"".join(coded.b_bytes[i] for i in b) != raw:
            a = b = []
        ends = [np.cumsum([len(known[i]) for i in ids]).tolist() for ids, known in ((a, coded.a_bytes), (b, coded.b_bytes))]
        groups, links, i, j, x, y = [], [], 0, 0, 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            p, q = ends[0][i], ends[1][j]
            i, j = i + (p <= q), j + (q <= p)
            if p == q:
                groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
                x, y = i, j
        held.update(set(links))
        links_of.append(links)
        rows.append((doc, len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = collections.Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [(*r[:5], sum(held[p] == most[p[0]] for p in ls), sum(held[p] for p in ls), r[5]) for r, ls in zip(rows, links_of)]


def key(r):
    return tuple((v is None, v if v is not None else 0) for v in r)


def same(got, docs):
    assert sorted((tuple(r) for r in got), key=key) == sorted(whole_texts(docs), key=key)


def test_whole_table(spark):
    docs = read(spark, SF_SMALL, "documents")
    same(M.op13_cross_tokenizer_alignment(spark, docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def odd_texts(n, seed=3):
    r = random.Random(seed)
    alphabet = list("ab 'x\xa0　 ᠎ \n\t\r\x00\x1c\x85.,1 23é中文\U0001F600▁-_") + ["<|endoftext|>", "<s>", "<0x0A>", "'s", " the", " a", "  ", "” "]
    return ["".join(r.choices(alphabet, k=r.randint(0, 60))) for _ in range(n)]


def test_odd_rows(spark):
    """Random texts, nulls, repeated rows and ids, spaces at both ends, clashing columns."""
    docs = [(i % 700, t) for i, t in enumerate(odd_texts(1500))]
    docs += [(None, None), (None, "no id"), (1, ""), (1, " "), (2, "  "), (3, "a "), (4, " a"), (5, "▁"), (6, "same"), (6, "same"), (7, "word " * 30_000)]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, block string, pair int").repartition(3)
    same(M.op13_cross_tokenizer_alignment(spark, table).collect(), docs)


def test_empty_table(spark):
    assert M.op13_cross_tokenizer_alignment(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []
    only_empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [tuple(r)[1:] for r in M.op13_cross_tokenizer_alignment(spark, only_empty).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


@pytest.mark.parametrize("pieces", [1, 3, 50])
def test_ranges_of_pieces_change_nothing(monkeypatch, pieces):
    """A document that is aligned in many ranges has the rows of one aligned at once."""
    import pyarrow as pa

    texts = [t for t in odd_texts(60, seed=9)] + ["some words in one longer text " * 20]
    raw = [t.encode() for t in texts]
    data, ends = M.spaced(np.r_[0, np.cumsum([len(t) for t in raw])], np.frombuffer(b"".join(raw), np.uint8))
    ids = pa.array(range(len(texts)), pa.int64())

    def rows():
        block = M._block(ids, data, ends, M.tokenizers(A, B)).to_pydict()
        pairs = block["block_pairs"][-1]
        linked = [
            {pairs[p]: k for p, k in zip(np.frombuffer(x, "<i4"), np.frombuffer(y, "<i4"))} for x, y in zip(block["pairs"][:-1], block["times"][:-1])
        ]
        held = dict(zip(pairs, block["block_documents"][-1]))
        return [block[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")], linked, held

    whole = rows()
    monkeypatch.setattr(M, "PIECES", pieces)
    assert rows() == whole


def test_cuts_keep_words_whole():
    data, ends = M.spaced(np.array([0, 16]), np.frombuffer("a\xa0 b  c \n d. e\x7f".encode(), np.uint8))
    pieces = [bytes(p) for p in np.split(data, M.cuts(data, ends)[1:])]
    assert b"".join(pieces) == bytes(data) and pieces == [" a\xa0 b".encode(), b"  c", b" \n d", b".", b" e\x7f"]
