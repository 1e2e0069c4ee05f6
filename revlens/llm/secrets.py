"""Secret scan with a trigram index.

Method: a Boolean trigram query is derived from each rule's regular expression
(what every match must hold); each block of documents gets an inverted index of
the queries' trigrams, postings are intersected and united as the query says, and
only the candidates are verified with the expression. A rule without a mandatory
trigram (such as a bare run of hex digits) scans every text.

The index covers a block of rows inside one task, so nothing is shuffled; it holds
only trigrams that some query asks for. Trigrams are of UTF-8 bytes with A-Z folded,
so that a candidate list can only be too long, never too short.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import BLOCK, blocks, strings, texts


@dataclass(frozen=True)
class Rule:
    """``least``: matches whose ``group`` is shorter are dropped after matching."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.A | (re.I if self.ignore_case else 0))


#: The three base rules of the contract.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
#: Published formats of credentials that the base rules do not cover.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google_api", r"AIza[0-9A-Za-z_-]{35}"),
)

# --- Boolean trigram queries ------------------------------------------------------
# A query is True (anything may match), ("tri", bytes), ("and", queries) or ("or", queries).
#: Alternatives that a run of literals is multiplied out to; beyond, the run is cut there.
MOST = 16


def _all_of(queries):
    qs = {q for q in queries if q is not True}
    return True if not qs else next(iter(qs)) if len(qs) == 1 else ("and", frozenset(qs))


def _any_of(queries):
    qs = set(queries)
    return True if True in qs or not qs else next(iter(qs)) if len(qs) == 1 else ("or", frozenset(qs))


def _of_strings(found: set[bytes]):
    """What a text must hold to have one of these strings."""
    return _any_of(_all_of(("tri", s[i : i + 3]) for i in range(len(s) - 2)) for s in found)


def _fold(code: int) -> bytes:
    return chr(code).encode().lower()  # bytes.lower: A-Z only


def trigram_query(pattern: str):
    """The query of a regular expression: every match satisfies it."""

    def walk(nodes):
        """(query, strings): strings are all that the nodes can match, or None if unknown."""
        query, run, whole = True, {b""}, True
        for op, arg in nodes:
            exact = None  # the strings this node matches exactly
            need = True
            if op is sre.LITERAL:
                exact = {_fold(arg)}
            elif op is sre.IN:
                chars: set[bytes] | None = set()
                for kind, x in arg:
                    if kind is sre.LITERAL:
                        chars.add(_fold(x))
                    elif kind is sre.RANGE and x[1] - x[0] < MOST:
                        chars |= {_fold(c) for c in range(x[0], x[1] + 1)}
                    else:
                        chars = None
                        break
                exact = chars if chars and len(chars) <= MOST else None
            elif op is sre.SUBPATTERN:
                need, exact = walk(arg[3])
            elif op is sre.BRANCH:
                branches = [walk(b) for b in arg[1]]
                if all(x is not None for _, x in branches):
                    exact = set().union(*(x for _, x in branches))
                    need = _any_of(q for q, _ in branches)
                else:
                    need = _any_of(q if x is None else _all_of([q, _of_strings(x)]) for q, x in branches)
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
                low, high, inner = arg
                inner_query, inner_exact = walk(inner)
                if (low, high) == (0, 1) and inner_exact is not None and inner_query is True:
                    exact = inner_exact | {b""}
                elif low:
                    if inner_exact is not None:
                        need = _all_of([inner_query, _of_strings(inner_exact)])
                        if low == high and len(inner_exact) ** low <= MOST:
                            exact, need = {b""}, inner_query
                            for _ in range(low):
                                exact = {a + b for a in exact for b in inner_exact}
                    else:
                        need = inner_query
            elif op is sre.AT:
                exact = {b""}
            query = _all_of([query, need])
            if exact is not None and len(exact) * len(run) <= MOST:
                run = {a + b for a in run for b in exact}
            else:  # the literals so far end here
                query, whole = _all_of([query, _of_strings(run)]), False
                run = exact if exact is not None and len(exact) <= MOST else {b""}
        return (query, run) if whole else (_all_of([query, _of_strings(run)]), None)

    query, tail = walk(list(sre_parse.parse(pattern)))
    return _all_of([query, _of_strings(tail)]) if tail is not None else query


def trigrams(query) -> set[bytes]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams, query[1]))


class TrigramIndex:
    """Postings (row numbers) of the wanted trigrams over a block of texts."""

    def __init__(self, wanted: set[bytes]):
        self.names = sorted(wanted)
        self.number = np.full(1 << 24, -1, dtype=np.int16)
        for i, t in enumerate(self.names):
            self.number[t[0] << 16 | t[1] << 8 | t[2]] = i
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def postings(self, offsets: np.ndarray, data: np.ndarray) -> dict[bytes, np.ndarray]:
        base, found = int(offsets[0]), []
        low, high = base, int(offsets[-1])
        for at in range(low, max(low, high - 2), BLOCK):  # a long text in parts that overlap by two bytes
            part = self.fold[data[at : min(high, at + BLOCK + 2)]].astype(np.int32)
            which = self.number[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
            where = np.flatnonzero(which >= 0)
            place = where + at
            row = np.searchsorted(offsets, place, side="right") - 1
            inside = place + 3 <= offsets[row + 1]
            found.append((which[where][inside], row[inside]))
        if not found:
            return {t: np.zeros(0, np.int64) for t in self.names}
        which, row = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(which, kind="stable")
        cuts = np.searchsorted(which[order], np.arange(len(self.names) + 1))
        return {t: np.unique(row[order[cuts[i] : cuts[i + 1]]]) for i, t in enumerate(self.names)}


def candidates(query, postings: dict[bytes, np.ndarray], n_rows: int) -> np.ndarray:
    """Row numbers that satisfy the query."""
    if query is True:
        return np.arange(n_rows)
    if query[0] == "tri":
        return postings[query[1]]
    lists = sorted((candidates(q, postings, n_rows) for q in query[1]), key=len)
    out = lists[0]
    for x in lists[1:]:
        out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
    return out


def find(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Spans (code points) of the rule's matches that are long enough."""
    return [m.span() for m in compiled.finditer(text) if len(m[rule.group]) >= rule.least]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def spans_in(rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES):
    """A column function: text -> spans, ordered by start, then rule."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    wanted = set().union(*map(trigrams, queries.values()))

    @F.arrow_udf(SPANS)
    def of(text):
        import pyarrow as pa

        compiled = {r.kind: r.compiled() for r in rules}
        index = TrigramIndex(wanted) if wanted else None
        offsets, data = strings(text)
        spans: list[list[dict]] = []
        for a, b in blocks(offsets):
            postings = index.postings(offsets[a : b + 1], data) if index else {}
            found: list[list] = [[] for _ in range(b - a)]
            known: dict[int, str] = {}
            for order, rule in enumerate(rules):
                for i in candidates(queries[rule.kind], postings, b - a).tolist():
                    if i not in known:
                        known[i] = text[a + i].as_py()
                    found[i] += [(s, order, e) for s, e in find(rule, compiled[rule.kind], known[i])]
            spans += [[{"kind": rules[o].kind, "start": s, "end": e} for s, o, e in sorted(f)] for f in found]
        return pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))

    return of


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, name: str = "spans") -> DataFrame:
    """``docs`` with the spans (kind, start, end) of each row's text.

    Spans are code points, end exclusive, leftmost non-overlapping per rule; spans of
    different rules may overlap. Null text has the spans of an empty one: none. Rows
    are scanned one by one, so repeated rows and null ids pass through unchanged. A
    column called ``name`` is replaced.
    """
    return docs.withColumn(name, spans_in(rules)(F.coalesce("text", F.lit(""))))


def joined(spans) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(text, spans, filler: str = "[REDACTED]") -> F.Column:
    """``text`` with every span replaced; spans that overlap or touch are replaced once."""
    start = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(
                F.when(s["start"] < acc["at"], acc["out"]).otherwise(
                    F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(filler))
                ).alias("out"),
                s["end"].alias("at"),
            )
        ),
    )
    whole = F.concat(start["out"], F.substring(text, start["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def op2_secret_scans(docs: DataFrame) -> DataFrame:
    base = [r.kind for r in BASE_RULES]
    found = scan(texts(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(joined(own).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def reference(text: str | None, rules=BASE_RULES + MORE_RULES) -> list[tuple[str, int, int]]:
    """Plain scan of one text, for tests."""
    text = text or ""
    found = [(s, o, e) for o, r in enumerate(rules) for s, e in find(r, r.compiled(), text)]
    return [(rules[o].kind, s, e) for s, o, e in sorted(found)]


def sha(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
