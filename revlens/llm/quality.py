"""Quality classifier by positive-unlabelled learning.

Method: a small network is trained to minimise the non-negative unbiased risk from
trusted positives (label 1) and unlabelled web text, given a class prior estimated
from all labels that are not held out. Its output is calibrated to a probability on the
trusted training rows, of both labels. Features describe the text alone (signs, capitals,
repeats, lengths); labels, lang, source and doc_id are never among them.

Trusted rows are a bounded sample, chosen by hash over the whole table. Everything else
covers all rows: the features' mean and deviation, and the unlabelled text of the risk.
Spark reduces the latter in one pass to cells of like features (the signs of fixed random
projections), each with its number of rows and their mean, so a rare kind of text has its
cell, and its weight, at every size of the corpus. Scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import PLAIN, apart, blocks, strings, word_hashes, written

#: Trusted rows of a fit, about.
TRUSTED_ROWS = 12_000
#: Cells that the unlabelled rows, all of them, are reduced to at most.
CELLS = 1 << 14
ACCEPT = 0.7
HIDDEN, STEPS, BATCH = 16, 600, 1024
#: Used where trusted rows all have one label.
DEFAULT_PRIOR = 0.8

_SIGNS = (".,;:", "!", "?", "|", "#$%&*", "0123456789", "\n", " \t", "{}[]<>()=_/\\", "@", "\"'-")
N_FEATURES = 2 * (len(_SIGNS) + 3) + 9


def features(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """(texts, N_FEATURES) of a block of texts."""
    n = len(offsets) - 1
    text, ends = apart(offsets, data)
    size = np.diff(offsets).astype(np.float64)
    low, some = ends[:-1], np.maximum(size, 1)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(mask, dtype=np.int32)]
        return (total[ends[1:] - 1] - total[low]).astype(np.float64)

    after_c3 = np.r_[False, text[:-1] == 0xC3]
    upper = ((text >= 65) & (text <= 90)) | (after_c3 & (text >= 0x80) & (text <= 0x9E))
    kinds = [upper, ((text >= 97) & (text <= 122)), text >= 0x80]
    table = np.zeros(256, dtype=np.int8)
    for i, signs in enumerate(_SIGNS):
        table[list(signs.encode())] = i + 1
    sign = table[text]
    kinds += [sign == i + 1 for i in range(len(_SIGNS))]
    counts = np.stack([count(k) for k in kinds], axis=1)

    start, end, h = word_hashes(text, PLAIN)
    cuts = np.searchsorted(start, ends)
    words = np.diff(cuts).astype(np.float64)
    many = np.maximum(words, 1)
    doc = np.repeat(np.arange(n), np.diff(cuts))
    length = (end - start).astype(np.float64)
    mean = np.bincount(doc, length, n) / many
    square = np.bincount(doc, length**2, n) / many
    same = np.r_[False, (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])] if len(h) else np.zeros(0, bool)
    again = np.bincount(doc[same], minlength=n) / many
    order = np.lexsort((h, doc))
    fresh = np.r_[True, (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])] if len(h) else np.zeros(0, bool)
    distinct = np.bincount(doc[order][fresh], minlength=n) / many
    # words that end in a sign after a sign, and words in capitals
    noisy = sign[end - 1] if len(end) else np.zeros(0, np.int8)
    odd = np.bincount(doc[(noisy >= 2) & (noisy != 3)], minlength=n) / many
    shout = np.bincount(doc[(length > 1) & upper[np.minimum(start + 1, len(text) - 1)]] if len(h) else doc, minlength=n) / many
    rest = np.stack([np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(square - mean**2, 0)), again, distinct, odd, shout, np.sqrt(again)], axis=1)
    return np.concatenate([counts / some[:, None], np.log1p(counts) / np.log1p(some)[:, None], rest], axis=1)


@dataclass
class Model:
    """Standardisation, one hidden layer, calibration."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    slope: float = 1.0
    bias: float = 0.0
    prior: float = DEFAULT_PRIOR

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.clip(x) @ self.w1 + self.b1) @ self.w2 + self.b2

    def clip(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.shift) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.bias, -30, 30)))


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, shift: np.ndarray, scale: np.ndarray, weights: np.ndarray | None = None, seed: int = 3
) -> Model:
    """Minimise prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)]), l the sigmoid loss.

    ``shift`` and ``scale`` are the features' mean and deviation; ``weights`` says how
    many rows each of ``unlabelled`` stands for (one, if not given).
    Where a batch's second term is negative, its gradient is ascended, as the
    non-negative estimator does against overfitting.
    """
    rng = np.random.default_rng(seed)
    m = Model(shift, np.where(scale > 1e-9, scale, 1.0), rng.normal(0, 0.3, (positive.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), 0.0, prior=prior)
    p, u = m.clip(positive), m.clip(unlabelled)
    share = np.cumsum(np.ones(len(u)) if weights is None else weights)
    params = [m.w1, m.b1, m.w2, np.array([m.b2])]
    first, second = [np.zeros_like(q) for q in params], [np.zeros_like(q) for q in params]
    for step in range(1, STEPS + 1):
        a, b = p[rng.integers(0, len(p), BATCH)], u[np.searchsorted(share, rng.random(BATCH) * share[-1], side="right")]
        z = np.concatenate([a, b])
        hidden = np.tanh(z @ params[0] + params[1])
        s = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3][0], -30, 30)))  # l(-g) = s, l(g) = 1 - s
        ds = s * (1 - s)
        sp, su = s[:BATCH], s[BATCH:]
        negative = su.mean() - prior * sp.mean()
        grad = np.zeros(len(z))
        sign = 1.0 if negative >= 0 else -1.0
        grad[BATCH:] = sign * ds[BATCH:] / BATCH
        grad[:BATCH] = -sign * prior * ds[:BATCH] / BATCH
        if sign > 0:
            grad[:BATCH] -= prior * ds[:BATCH] / BATCH
        back = np.outer(grad, params[2]) * (1 - hidden**2)
        grads = [z.T @ back + 1e-5 * params[0], back.sum(axis=0), hidden.T @ grad, np.array([grad.sum()])]
        rate = 0.02 * (1 - 0.9 * step / STEPS)
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = params[0], params[1], params[2], float(params[3][0])
    return m


def calibrate(m: Model, x: np.ndarray, y: np.ndarray) -> Model:
    """Fit slope and bias so that the score is the share of label 1, by Newton steps."""
    g = m.margin(x)
    if len(set(y.tolist())) < 2:
        return m
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    w = np.zeros(2)
    z = np.stack([g, np.ones(len(g))], axis=1)
    for _ in range(30):
        s = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (s * (1 - s))[:, None]).T @ z + 1e-6 * np.eye(2), z.T @ (target - s) - 1e-6 * w)
        w = w + np.clip(step, -2, 2)
    m.slope, m.bias = float(w[0]), float(w[1])
    return m


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _features(text):
    import pyarrow as pa

    offsets, data = strings(text)
    parts = [features(offsets[a : b + 1], data) for a, b in blocks(offsets)]
    x = np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * N_FEATURES, pa.int32()), pa.array(x.ravel()))


def held_out(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def _digits(values) -> np.ndarray:
    """Floats to 9 digits: sums in another order give the same."""
    return np.array([float(f"{v:.9g}") for v in values])


def moments(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature (column x) over all rows."""
    row = table.agg(*(f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(N_FEATURES))).first()
    out = _digits(0.0 if v is None else v for v in row)
    return out[:N_FEATURES], out[N_FEATURES:]


def cells(table: DataFrame, shift: np.ndarray, scale: np.ndarray, most: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """(mean features, rows) of every cell that has rows: at most ``most``, from all rows
    of ``table``. Two rows share a cell where all the projections' signs agree."""
    bits = max(0, most.bit_length() - 1)
    directions = np.random.default_rng(29).normal(size=(N_FEATURES, bits))
    scale = np.where(scale > 1e-9, scale, 1.0)

    def run(batches):
        import pyarrow as pa

        total, n = np.zeros((1 << bits, N_FEATURES)), np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            x = np.asarray(batch.column(0).flatten()).reshape(-1, N_FEATURES)
            z = np.clip((x - shift) / scale, -6, 6)
            cell = ((z @ directions > 0) << np.arange(bits)).sum(axis=1) if bits else np.zeros(len(z), dtype=np.int64)
            order = np.argsort(cell, kind="stable")
            first = np.flatnonzero(np.diff(cell[order], prepend=-1))
            if len(first):
                total[cell[order][first]] += np.add.reduceat(z[order], first, axis=0)
            n += np.bincount(cell, minlength=1 << bits)
        seen = np.flatnonzero(n)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(seen) + 1) * N_FEATURES, pa.int32()), pa.array(total[seen].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen]), sums], names=["cell", "n", "sums"])

    parts = table.select("x").mapInArrow(run, "cell long, n long, sums array<double>")
    rows = parts.groupBy("cell").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(N_FEATURES))).toPandas()
    rows = rows.sort_values("cell", kind="stable")
    n = rows["n"].to_numpy(dtype=np.float64)
    mean = rows.drop(columns=["cell", "n"]).to_numpy(dtype=np.float64) / np.maximum(n, 1)[:, None]
    return _digits(mean.ravel()).reshape(-1, N_FEATURES) * scale + shift, n


def train(docs: DataFrame, labels: DataFrame, trusted_rows: int = TRUSTED_ROWS, most_cells: int = CELLS) -> Model | None:
    """A model from labelled rows that are not held out and all unlabelled texts; the class
    prior is that of all ids so labelled, the features' mean and deviation that of all rows.

    The trusted sample is the distinct (doc_id, text) whose hash is smallest: about
    ``trusted_rows``, all if there are fewer; no more reaches the driver, however many
    rows an id has, and of the unlabelled rows at most ``most_cells`` cells. Rows with a
    null doc_id, or labels other than 0 and 1, teach nothing. None without a positive.
    """
    def share(n: int, wanted: int) -> F.Column:
        return F.pmod("h", F.lit(1 << 30)) < int(min(1.0, wanted / max(n, 1)) * (1 << 30))

    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    every = written(every.select("doc_id", F.xxhash64(F.lit(41), "doc_id", "text").alias("h"), _features("text").alias("x")), "quality-features")
    rows = every.where(F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("doc_id").isNotNull() & ~held_out("doc_id") & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    keys = rows.select("doc_id", "h").distinct().join(known, "doc_id")
    chosen = keys.where(share(keys.count(), trusted_rows))
    sample = rows.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).toPandas()  # about trusted_rows
    if sample.empty or not (sample["quality"] == 1).any():
        return None
    sample = sample.sort_values(["doc_id", "h"], kind="stable")
    x, y = np.stack(sample["x"].to_list()), sample["quality"].to_numpy(dtype=float)
    prior = float(known.agg(F.avg("quality")).first()[0])
    prior = min(prior, 0.98) if prior < 1 else DEFAULT_PRIOR
    shift, scale = moments(every)
    web, weights = cells(rows, shift, scale, most_cells)
    return calibrate(fit(x[y == 1], web, prior, shift, scale, weights), x, y)


def scores(model: Model | None):
    """A column function: text -> score (0 to 1); without a model, 1 for every text."""

    @F.arrow_udf("double")
    def of(text):
        import pyarrow as pa

        if model is None:
            return pa.array(np.ones(len(text)))
        offsets, data = strings(text)
        parts = [model.score(features(offsets[a : b + 1], data)) for a, b in blocks(offsets)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return of


def with_quality(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """``docs`` with a score; null texts count as empty, every row has one, equal texts equal ones."""
    return docs.withColumn(name, scores(train(docs, labels))(F.coalesce("text", F.lit(""))))


def op10_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns of every row. A null text counts as empty; a row with a null
    doc_id is scored and not held out; repeated rows score alike; without labels every
    score is 1; an empty table gives no rows; other columns are left behind."""
    scored = with_quality(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )
