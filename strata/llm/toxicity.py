"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

The presence of each hashed character n-gram (3 to 5 lower-cased code points,
white space as one blank, a blank at either end) is a feature. Its naive
Bayes log-count ratio between the classes scales it, and a logistic
regression with an L2 penalty is fitted on the scaled features. Whole texts
are scored in Arrow batches; a task holds one text's features at a time.

Training reads at most ``max_rows`` labelled documents, taken in hash order of
their ids from those whose crc32 is not a multiple of 5; ``features`` n-grams
with the largest spread between the classes enter the regression, which is
fitted on documents in hash order of their features until these hold ``max_ids``
n-grams in all. Both bounds limit what the driver holds, however long the
labelled texts are; the counts behind the ratios are over all ``max_rows``.

Edge cases: null and empty texts have one feature set, that of a blank, and
so the base score; rows that repeat an id score alike if their texts do;
labels repeated for an id count as toxic if any says so; without training
rows of both classes every score is the share of toxic rows (0 without any);
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import hash_sample, held_out, small_batches, staged

ORDERS = (3, 4, 5)
HASH_BITS = 20
CHUNK = 1 << 18  # features of the rows whose gradient is taken at a time
BLANK = re.compile(r"\s+")


def ngram_buckets(text: str | None) -> np.ndarray:
    """Hash buckets of all character n-grams, repeats included."""
    s = f" {BLANK.sub(' ', (text or '').lower()).strip()} "
    a = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
    out, h = [], a
    for n in range(2, ORDERS[-1] + 1):
        if len(a) < n:
            break
        h = h[:len(a) - n + 1] * np.uint32(0x01000193) + a[n - 1:]
        if n in ORDERS:
            g = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            out.append((g ^ (g >> np.uint32(13))) >> np.uint32(32 - HASH_BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class _Distinct:
    """Distinct values of an array without sorting it: the last writer of a cell speaks for it."""

    def __init__(self, size: int):
        self.at = np.zeros(size, np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        order = np.arange(len(x))
        self.at[x] = order
        return x[self.at[x] == order]


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, toxic): at most ``max_rows`` labelled documents, one row per id."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    chosen = staged(hash_sample(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), max_rows, "doc_id"), "toxic-labels")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def _count(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class, and how many of them hold each n-gram (2 x 2^HASH_BITS)."""

    def run(batches):
        distinct = _Distinct(1 << HASH_BITS)
        holds, n = np.zeros((2, 1 << HASH_BITS), np.int32), np.zeros(2, np.int64)
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                c = int(toxic > 0)
                holds[c, distinct(ngram_buckets(text))] += 1
                n[c] += 1
        if n.sum():
            step = 1 << 14
            for at in range(0, 1 << HASH_BITS, step):
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([holds[:, at:at + step].tobytes()], pa.binary()),
                                                  pa.array([n.tobytes()], pa.binary())], names=["at", "holds", "n"])

    def add(pdf):
        import pandas as pd

        holds = sum(np.frombuffer(x, np.int32) for x in pdf["holds"])
        n = sum(np.frombuffer(x, np.int64) for x in pdf["n"])
        return pd.DataFrame({"at": [pdf["at"].iloc[0]], "holds": [holds.astype(np.int32).tobytes()], "n": [n.tobytes()]})

    holds, n = np.zeros((2, 1 << HASH_BITS), np.int32), np.zeros(2, np.int64)
    schema = "at int, holds binary, n binary"
    for r in small_batches(rows).mapInArrow(run, schema).groupBy("at").applyInPandas(add, schema).toLocalIterator():
        part = np.frombuffer(bytes(r["holds"]), np.int32).reshape(2, -1)
        holds[:, r["at"]:r["at"] + part.shape[1]], n = part, np.frombuffer(bytes(r["n"]), np.int64)
    return n, holds


class Model:
    """Chosen buckets with their weights (ratio times coefficient) and the intercept."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.buckets, self.weights, self.bias = buckets.astype(np.int32), weights.astype(np.float32), float(bias)

    def scorer(self):
        place = np.full(1 << HASH_BITS, len(self.buckets), np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        weights = np.append(self.weights, 0).astype(np.float64)
        seen = np.zeros(len(weights), bool)

        def score(text: str | None) -> float:
            at = place[ngram_buckets(text)]
            seen[at] = True
            z = self.bias + weights[seen].sum()
            seen[at] = False
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score


def _chunks(sizes: np.ndarray):
    """Ranges of rows with about ``CHUNK`` features each."""
    at, ends = 0, np.cumsum(sizes)
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
        yield at, to, int(ends[at - 1]) if at else 0, int(ends[to - 1])
        at = to


def _fit(flat: np.ndarray, sizes: np.ndarray, y: np.ndarray, ratio: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Logistic regression on ratio-scaled presence features: gradient descent with Nesterov momentum.

    ``flat`` holds the features of all rows one after the other, ``sizes`` how many each has.
    Beside it only a chunk of rows is expanded at a time.
    """
    parts, square = list(_chunks(sizes)), ratio.astype(np.float64) ** 2
    norm = sum(square[flat[lo:hi]].sum() for _, _, lo, hi in parts) / len(sizes) + 1
    w, b, prior = np.zeros(len(ratio)), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros(len(ratio))
    rate, b_prior = 8.0 / norm, b
    for t in range(steps):
        momentum = t / (t + 3)
        v, vb = w + momentum * (w - prior), b + momentum * (b - b_prior)
        scaled, grad, b_grad = v * ratio, np.zeros(len(ratio)), 0.0
        for i, j, lo, hi in parts:
            f, of = flat[lo:hi], np.repeat(np.arange(j - i), sizes[i:j])
            z = vb + np.bincount(of, scaled[f], minlength=j - i)
            g = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[i:j]) / len(y)
            grad += np.bincount(f, g[of], minlength=len(ratio))
            b_grad += g.sum()
        prior, b_prior = w, b
        w, b = v - rate * (grad * ratio + penalty * v), vb - rate * b_grad
    return w, b


def _within(bags: DataFrame, max_ids: int) -> DataFrame:
    """``bags`` (hash, row, size, ...) in the order of their hashes as far as ``max_ids`` features go; the first
    always. Bags with one hash are alike, so it does not matter which of them ``row`` puts first."""
    sizes = sorted((r["hash"], r["row"], r["size"]) for r in bags.select("hash", "row", "size").toLocalIterator())  # max_rows of them
    total = 0
    for n, (h, row, size) in enumerate(sizes):
        total += size
        if n and total > max_ids:
            return bags.where((F.col("hash") < h) | (F.col("hash") == h) & (F.col("row") < row))
    return bags


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 16_000, features: int = 1 << 14, penalty: float = 1e-4, steps: int = 150,
          max_ids: int = 1 << 25) -> Model:
    rows = staged(training_rows(docs, labels, max_rows), "toxic-rows")
    n, holds = _count(rows)
    if not n.all():
        share = n[1] / n.sum() if n.sum() else 0.0
        return Model(np.zeros(0), np.zeros(0), np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    p, q = (holds[1] + 0.5) / (n[1] + 1), (holds[0] + 0.5) / (n[0] + 1)
    ratio = np.log(p / q)
    spread = np.abs(p - q) / np.sqrt(p * (1 - p) / n[1] + q * (1 - q) / n[0])
    spread[holds.sum(axis=0) < 3] = 0
    chosen = np.sort(np.argsort(-spread, kind="stable")[:features])
    place = np.full(1 << HASH_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    shared = docs.sparkSession.sparkContext.broadcast(chosen.astype(np.int32))

    def extract(batches):
        distinct, at = _Distinct(1 << HASH_BITS), np.full(1 << HASH_BITS, -1, np.int32)
        at[shared.value] = np.arange(len(shared.value))
        for b in batches:
            found = [at[distinct(ngram_buckets(t))] for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[f >= 0].tobytes() for f in found], pa.binary()), b.column(1)], names=["f", "toxic"])

    bags = small_batches(rows).mapInArrow(extract, "f binary, toxic int")
    bags = staged(bags.select("f", "toxic", F.xxhash64("f", "toxic").alias("hash"), (F.octet_length("f") / 4).cast("long").alias("size"),
                              F.monotonically_increasing_id().alias("row")), "toxic-bags")
    pieces, y = [], []
    for r in _within(bags, max_ids).select("f", "toxic").toLocalIterator():  # about max_ids numbers at most
        pieces.append(np.frombuffer(bytes(r["f"]), np.int32)), y.append(float(r["toxic"] > 0))
    sizes = np.array([len(x) for x in pieces], np.int64)
    w, bias = _fit(np.concatenate(pieces), sizes, np.array(y), ratio[chosen], penalty, steps)
    return Model(chosen, w * ratio[chosen], bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row; the text is the only input of the score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most ``features`` weights

    def run(batches):
        one = shared.value.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([one(t) for t in b.column(1).to_pylist()], pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
