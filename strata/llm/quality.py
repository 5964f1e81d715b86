"""Quality classifier by importance resampling of hashed n-grams.

Two models over the same hash buckets are counted in one pass: the raw model
over every document, the target model over documents labelled as good. The
n-grams are unigrams and bigrams of words and punctuation runs; a bigram of
one word with itself is the same n-gram for all words. An n-gram counts once
a document, and again as an n-gram of its own for every power of two that its
count reaches, so a line repeated a thousand times does not outvote the corpus
and yet shows. Both models get ``PRIOR`` counts a bucket of smoothing in units
of the target (raw counts are scaled to the target's total) and are divided by
their totals, so they are distributions over the buckets. A document's log
importance weight is ``log p_target(x) - log p_raw(x)``, the sum over its
n-grams, its own counts left out of both models.

``Gumbel noise + log weight`` ranks the documents, and the ``k`` largest keys
are a sample without replacement with those weights; ``k`` is the parameter
``share`` of all rows, rounded up. The k-th largest key is found by counting
keys per digit, so nothing is gathered or sorted in one place.

A filter asks something else than a sample: whether one document looks like
the target, however long it is and whatever else there is. ``accepted`` says
so: the log weight per n-gram (``FEW`` neutral n-grams are added, so a text of
ten words is not extreme) reaches the level that best parts the good from the
rest among the labelled documents (a good one lost costs ``KEEP`` times a bad
one kept). No noise takes part in it.

Labels are read from at most ``max_labels`` labelled rows, taken in hash
order (ids whose crc32 is a multiple of 5 stay out, for held-out checks).

Edge cases: null and wordless texts have log weight 0; rows that repeat an id
and a text share key and fate; documents tied with the last key sampled are sampled;
labels repeated for an id count as good if any says so; without labelled
documents every weight is 1, and without labels of both kinds all documents
are accepted; an empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import hash_sample, held_out, plain, small_batches, staged, utf8

TOKEN = re.compile(rb"[a-z0-9_\x80-\xff]+|[^\sa-z0-9_\x80-\xff]+")
HASH_BITS = 18
BUCKETS = 1 << HASH_BITS
WORD_CACHE = 1 << 18      # tokens whose hash a task remembers
MAX_COUNTERS = 8192       # counting tasks: each hands on up to BUCKETS rows
PRIOR = 20.0              # smoothing, in counts of the target
FEW = 20
SHARE = 0.5               # of all rows go into the sample
KEEP = 10.0
MIX = np.uint32(0x9E3779B1)
SCALE = float(1 << 20)    # key units: keys are compared as whole numbers
BITS, DIGIT = 48, 12      # digits of the select


class _Hasher:
    """A text's distinct n-gram buckets; remembers the hash of common tokens."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        tokens = TOKEN.findall(text.lower()) if text else []
        known = self.known
        if len(known) > WORD_CACHE:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = crc32(w)
        one = np.fromiter(map(known.__getitem__, tokens), np.uint32, len(tokens))
        two = np.where(one[:-1] == one[1:], np.uint32(1), (one[:-1] * MIX) ^ (one[1:] + np.uint32(0x7F4A7C15)))
        grams = np.concatenate([one, two])
        grams, tf = np.unique(grams, return_counts=True)
        level, power = [grams], 2
        while (more := tf >= power).any():
            grams, tf = grams[more], tf[more]
            level.append(grams * np.uint32(0x85EBCA6B) + np.uint32(power))
            power *= 2
        grams = np.concatenate(level)
        grams ^= grams >> np.uint32(15)
        grams *= MIX
        return np.unique(grams >> np.uint32(32 - HASH_BITS))  # n-grams that share a bucket are one


def count_ngrams(docs: DataFrame, text_col: str, flag_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all documents, and over those flagged as target."""

    def run(batches):
        raw, target, grams = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), _Hasher()
        for b in batches:
            for text, flag in zip(utf8(b.column(0)), b.column(1).to_pylist(), strict=True):
                g = grams(text)
                raw[g] += 1
                if flag:
                    target[g] += 1
        v = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int32)), pa.array(raw[v]), pa.array(target[v])], names=["bucket", "raw", "target"])

    rows = small_batches(docs.select(F.col(text_col), F.col(flag_col)).coalesce(MAX_COUNTERS)).mapInArrow(run, "bucket int, raw long, target long")
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toLocalIterator():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]  # one row per bucket, however large the corpus
    return raw, target


def log_weight(grams: np.ndarray, flagged: bool, raw: np.ndarray, target: np.ndarray, share: float, totals: tuple[float, float]) -> float:
    """Log of the probability of a document's n-grams under the target model over that under
    the raw model, both without that document. ``share`` is the ratio of the ``totals``
    (raw, target), which brings the raw counts to the scale of the target's."""
    n = len(grams)
    if not n or not share:
        return 0.0
    ratios = np.log((target[grams] - flagged + PRIOR) / ((raw[grams] - 1) * share + PRIOR)).sum()
    smoothing = PRIOR * BUCKETS
    return float(ratios + n * np.log(((totals[0] - n) * share + smoothing) / (totals[1] - n * flagged + smoothing)))


def best_level(weights: np.ndarray, good: np.ndarray) -> float | None:
    """The weight from which on documents count as target-like; None without both kinds."""
    if not good.any() or good.all():
        return None
    order = np.argsort(weights)
    w, g = weights[order], good[order]
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum() * KEEP
    wrong = np.concatenate([np.cumsum((~g)[::-1])[::-1], [0]]) / (~g).sum()
    at = int(np.argmin(lost + wrong))
    return float(w[at] if at == 0 else (w[at - 1] + w[min(at, len(w) - 1)]) / 2)


def gumbel(id_col: str, seed: int):
    """Gumbel noise that depends on the id and the seed alone."""
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, col: str, k: int) -> int | None:
    """The k-th largest of whole numbers in [0, 2^48), by counting one digit a round; None keeps all."""
    prefix, left = 0, k
    for shift in range(BITS - DIGIT, -1, -DIGIT):
        digit = F.shiftright(col, shift)
        rows = keys if shift == BITS - DIGIT else keys.where(F.shiftright(col, shift + DIGIT) == prefix)
        counts = {r["d"]: r["n"] for r in rows.groupBy((digit % (1 << DIGIT)).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for d in sorted(counts, reverse=True):  # 2^12 digits at most
            if counts[d] >= left:
                prefix = (prefix << DIGIT) | d
                break
            left -= counts[d]
        else:
            return None
    return prefix


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labels: int = 20_000,
          share: float = SHARE, seed: int = 8) -> DataFrame:
    """(id, log_weight double, gumbel_key double, kept boolean, accepted boolean) for every document;
    ``kept`` are the ``share`` of the rows that the sample takes."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sample = staged(hash_sample(usable.groupBy("doc_id").agg(F.max("quality").alias("quality")), max_labels, "doc_id"), "quality-labels")
    known = F.broadcast(sample.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality")))  # max_labels rows at most
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(known, rows["id"] == known["_id"], "left").select("id", "text", "_quality")
    raw, target = count_ngrams(rows.select("text", (F.col("_quality") == 1).alias("flag")), "text", "flag")
    totals = float(raw.sum()), float(target.sum())
    part = totals[1] / max(totals[0], 1.0)
    table = docs.sparkSession.sparkContext.broadcast((raw.astype(np.float32), target.astype(np.float32)))  # two floats a bucket

    def run(batches):
        grams, (r, t) = _Hasher(), table.value
        for b in batches:
            weights, levels = [], []
            for text, q in zip(utf8(b.column(1)), b.column(2).to_pylist(), strict=True):
                g = grams(text)
                weights.append(log_weight(g, q == 1, r, t, part, totals))
                levels.append(weights[-1] / (len(g) + FEW))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(weights, pa.float64()), pa.array(levels, pa.float64()), b.column(2)],
                                             names=["id", "log_weight", "per_gram", "quality"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    weights = small_batches(rows).mapInArrow(run, f"id {types['id']}, log_weight double, per_gram double, quality {types['_quality']}")
    key = F.col("log_weight") + gumbel("id", seed)
    half = float(1 << (BITS - 1))
    keyed = staged(weights.withColumn("gumbel_key", key).withColumn(
        "rank_key", F.least(F.greatest(F.floor(F.coalesce("gumbel_key", "log_weight") * SCALE) + half, F.lit(0.0)), F.lit(2 * half - 1)).cast("long")),
        "quality-keys")
    seen = keyed.where("quality is not null").groupBy("id").agg(F.max("per_gram").alias("w"), F.max("quality").alias("q"))
    judged = [(x["w"], x["q"]) for x in seen.toLocalIterator()]  # max_labels rows at most
    level = best_level(np.array([w for w, _ in judged]), np.array([q == 1 for _, q in judged], bool)) if judged else None
    accepted = F.lit(True) if level is None else F.col("per_gram") >= level
    k = math.ceil(share * keyed.count())
    last = kth_largest(keyed, "rank_key", k) if k else None
    kept = F.lit(k > 0) if last is None else F.col("rank_key") >= last
    return keyed.select("id", "log_weight", "gumbel_key", kept.alias("kept"), accepted.alias("accepted"))


def keep_target_like(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000, seed: int = 8) -> DataFrame:
    """``docs`` without those the classifier rejects. Rows without an id stay."""
    rows = plain(docs, "doc_id", "text")
    rejected = staged(score(rows, labels, max_labels=max_labels, seed=seed)
                      .where(F.col("id").isNotNull()).groupBy("id").agg(F.max("accepted").alias("accepted")).where(~F.col("accepted"))
                      .select(F.col("id").alias("doc_id")), "quality-rejected")
    return rows.join(rejected, "doc_id", "left_anti").select(*rows.columns).toDF(*docs.columns)
