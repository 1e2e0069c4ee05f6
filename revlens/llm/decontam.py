"""Benchmark decontamination by size-partitioned MinHash containment search.

Method: a short item inside a long text has a tiny Jaccard similarity to it, which
MinHash cannot see. So items are partitioned by size (in shingles, up to 4, 8, 16,
32, ...). Those of the first class are looked up by each of their shingles, which misses
none; for each other class a document is searched as windows of two consecutive blocks
of the class's size: an item that stands in the text lies whole in one window, to
which its similarity is at least 0.19 (containment 0.8, the smallest item of its
class). Items and windows meet where one of 64 MinHash values is equal (missed with
probability 1.4e-6 there). Candidates are verified by exact containment of the item's
shingles in the whole document.

Block minima of a class come from those of the class below, so each shingle is hashed
64 times in all. Documents are read once and never shuffled. The items are with every
task: a benchmark is test questions, not a corpus, and one over ``MOST_CHARS`` characters
is refused.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import FOLDED, U, apart, blocks, ngrams, seeds, strings, word_hashes

SHINGLE, THRESHOLD, HASHES = 5, 0.8, 64
#: Items (and characters of items) that one index holds.
ITEMS_AT_ONCE, CHARS_AT_ONCE = 20_000, 1 << 24
#: Items (and characters of items) of a benchmark that every task can hold.
MOST_ITEMS, MOST_CHARS = 200_000, 1 << 26
SMALLEST = 8

_A, _B = seeds(HASHES, 21) | U(1), seeds(HASHES, 22)
#: Items of so many shingles at most are looked up by shingle.
SHORT = SMALLEST // 2
#: Tells the values of one hash from those of another in a common table.
_OWN = seeds(HASHES, 23)
#: Shingles hashed at a time.
AT_ONCE = 1 << 14


class Items:
    """The sketches and shingle sets of some items, by shingle width and size class."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        self.sets: list[np.ndarray] = []
        self.widths: list[int] = []
        short: dict[int, list[int]] = {}  # width -> items
        self.classes: dict[tuple[int, int], list[int]] = {}  # (width, class size) -> items
        for n, (_, text) in enumerate(items):
            words = word_hashes(np.frombuffer((text or "").encode(), np.uint8), FOLDED)[2]
            width = min(SHINGLE, len(words))
            s = np.unique(ngrams(words, width)) if width else np.zeros(0, U)
            self.sets.append(s)
            self.widths.append(width)
            if 0 < len(s) <= SHORT:
                short.setdefault(width, []).append(n)
            elif len(s):
                size = SMALLEST
                while size < len(s):
                    size *= 2
                self.classes.setdefault((width, size), []).append(n)
        self.tables = {}
        for key, members in self.classes.items():
            sketch = np.array([(self.sets[m][:, None] * _A + _B).min(axis=0) for m in members], dtype=U)
            values = (sketch ^ _OWN).ravel()
            order = np.argsort(values, kind="stable")
            self.tables[key] = values[order], np.repeat(members, HASHES)[order]
        self.short = {}
        for width, members in short.items():
            values = np.concatenate([self.sets[m] for m in members])
            order = np.argsort(values, kind="stable")
            self.short[width] = values[order], np.repeat(members, [len(self.sets[m]) for m in members])[order]

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Items that may be contained in a document, and its sorted shingles by width."""
        found: list[np.ndarray] = []
        shingled: dict[int, np.ndarray] = {}
        for width in sorted({w for w, _ in self.tables} | set(self.short)):
            s = ngrams(words, width)
            if not len(s):
                continue
            shingled[width] = np.unique(s)
            if width in self.short:
                values, members = self.short[width]
                x, y = np.searchsorted(values, shingled[width]), np.searchsorted(values, shingled[width], side="right")
                found += [members[i:j] for i, j in zip(x[x < y], y[x < y])]
            sizes = sorted(z for w, z in self.tables if w == width)
            if not sizes:
                continue
            step = max(AT_ONCE, sizes[-1])  # parts begin where blocks do, and overlap by a window
            for low in range(0, len(s), step):
                v = s[low : low + step + 2 * sizes[-1], None] * _A + _B
                size = 1
                for z in sizes:
                    v, size = np.minimum.reduceat(v, np.arange(0, len(v), z // size), axis=0), z
                    window = ((np.minimum(v[:-1], v[1:]) if len(v) > 1 else v) ^ _OWN).ravel()
                    values, members = self.tables[width, z]
                    at = np.searchsorted(values, window)
                    hit = np.unique(window[values[np.minimum(at, len(values) - 1)] == window])
                    x, y = np.searchsorted(values, hit), np.searchsorted(values, hit, side="right")
                    found += [members[i:j] for i, j in zip(x, y)]
        return (np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)), shingled

    def contained(self, words: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """(item id, containment) of the items contained in a document."""
        members, shingled = self.candidates(words)
        out = []
        for m in members.tolist():
            s = self.sets[m]
            share = np.isin(s, shingled[self.widths[m]], assume_unique=True).sum() / len(s)
            if share >= threshold:
                out.append((self.ids[m], float(share)))
        return out


def _found(items: list[tuple[int, str]], threshold: float):
    """A column function: text -> array of (item_id, containment)."""

    @F.arrow_udf("array<struct<item_id:long,containment:double>>")
    def of(text):
        import pyarrow as pa

        index = Items(items)
        offsets, data = strings(text)
        rows: list[list[dict]] = []
        for a, b in blocks(offsets):
            block, ends = apart(offsets[a : b + 1], data)
            start, _, h = word_hashes(block, FOLDED)
            cuts = np.searchsorted(start, ends)
            for i in range(b - a):
                rows.append([{"item_id": k, "containment": v} for k, v in index.contained(h[cuts[i] : cuts[i + 1]], threshold)])
        return pa.array(rows, pa.list_(pa.struct([("item_id", pa.int64()), ("containment", pa.float64())])))

    return of


def _batches(benchmark: DataFrame):
    """The items, a bounded number at a time."""
    part: list[tuple[int, str]] = []
    chars = 0
    items = benchmark.select(F.col("item_id").cast("long").alias("i"), F.coalesce("text", F.lit("")).alias("t")).distinct()
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.char_length("t")), F.lit(0))).first()
    if n > MOST_ITEMS or size > MOST_CHARS:
        raise ValueError(f"a benchmark of {n} items, {size} characters: more than {MOST_ITEMS} or {MOST_CHARS}; search it in parts")
    for r in items.orderBy("i", "t").toLocalIterator():
        if part and (len(part) >= ITEMS_AT_ONCE or chars + len(r["t"]) > CHARS_AT_ONCE):
            yield part
            part, chars = [], 0
        part.append((r["i"], r["t"]))
        chars += len(r["t"])
    yield part


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, name: str = "matches") -> DataFrame:
    """``docs`` with a column: the (item_id, containment) found in each row's text.

    Words are runs of letters, digits and non-ASCII characters, A-Z folded; shingles are
    five words (an item of fewer is one shingle of them all). Containment is the share
    of the item's distinct shingles that the document has. Null or empty texts contain
    nothing; an item without words is in no document. Rows keep their columns; a column
    called ``name`` is replaced. More than ``MOST_ITEMS`` distinct items, or ``MOST_CHARS``
    characters of them, raise ValueError before any document is read: the union of the
    results of parts of a benchmark is the result of the whole.
    """
    text = F.coalesce("text", F.lit(""))
    found = [_found(part, threshold)(text) for part in _batches(benchmark) if part]
    if not found:
        return docs.withColumn(name, F.array().cast("array<struct<item_id:long,containment:double>>"))
    return docs.withColumn(name, found[0] if len(found) == 1 else F.concat(*found))


def op8_benchmark_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of documents and item it contains."""
    found = matches(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("matches").alias("m"))
    return found.select("doc_id", "m.item_id", "m.containment")


#: Exact containment, every document against every item.
ORACLE = r"""
with words as (
  select 0 as kind, rid, doc_id as id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from (select *, row_number() over () as rid from documents)
  union all
  select 1, item_id, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') from benchmark
), shingles as (
  select distinct kind, rid, id, array_to_string(w[i : i + 4], ' ') as s
  from (select kind, rid, id, w, unnest(range(1, len(w) - 3)) as i from words where len(w) >= 5)
), sizes as (select rid, id, count(*) as n from shingles where kind = 1 group by rid, id)
select d.id as doc_id, i.id as item_id, (count(*) / z.n::double) as containment
from shingles d join shingles i on d.s = i.s and d.kind = 0 and i.kind = 1 join sizes z on z.rid = i.rid
group by d.rid, d.id, i.rid, i.id, z.n having count(*) / z.n::double >= 0.8
"""
