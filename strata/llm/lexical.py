"""Ranked lexical search by hybrid term-at-a-time / document-at-a-time evaluation.

1. One pass over whole texts writes, per document, its length and the counts
   of the terms that the queries use; the corpus statistics (documents,
   terms, documents per term) are sums over that table.
2. A second pass inverts blocks of documents, each inside its task: every
   query term gets a list of (document, impact), impacts being whole numbers.
3. Per query the short lists are summed term at a time into accumulators.
   The accumulators, bounded by their largest sum in each range of documents,
   are then one list among the long ones, and documents are visited in order:
   a range whose bounds add up to less than the k-th best score is skipped,
   in the others long lists are opened in order of their bounds, for the
   documents that can still reach that score.
4. A task keeps one best-k list a query over all its blocks, so a threshold
   once reached holds for the rest of the task; the lists of all tasks merge
   per query. No posting is ever shuffled.

Queries come in blocks of bounded text (nearly always one), each a pass of its
own, so what a task holds grows with neither the corpus nor the query set.

Edge cases: null and wordless texts have no terms, count for nothing and are
never found; documents without an id count in the statistics but are not
returned; rows that repeat an id are documents each; queries without an id or
without terms have no results, rows that repeat a query id are one query of
all their terms; equal scores go by the smaller id; an empty table on either
side gives an empty result; extra columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import small_batches, staged, utf8

QUERY_BYTES = 8 << 20       # query text held at a time
SLICE_BYTES = 1 << 20       # text cut into words at a time
BLOCK_DOCS = 16_384         # documents inverted at a time
BLOCK_POSTINGS = 2_000_000
RANGE = 64                  # documents under one bound
STRIDE = 16                 # ranges visited between two looks at the threshold
SHORT_SHARE = 8             # a list is short that holds at most 1/8 of a block

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c in _KEEP or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))

FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def slices(text: bytes, size: int = SLICE_BYTES):
    """``text`` in parts of about ``size`` bytes that end at spaces."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def term_counts(text: bytes | None, known: dict) -> tuple[int, Counter]:
    """All terms of a text with their repeats, and the counts of the known ones by number."""
    n, counts = 0, Counter()
    for part in slices((text or b"").translate(_TABLE)):
        words = part.split()
        n += len(words)
        counts.update(map(known.get, words))
    counts.pop(None, None)
    return n, counts


def forward(docs: DataFrame, known: dict, id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) per document: its length and the counts of the known terms."""

    def run(batches):
        for b in batches:
            n, terms, tfs = [], [], []
            for t in utf8(b.column(1)):
                size, counts = term_counts(t, known)
                n.append(size), terms.append(list(counts)), tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], names=["id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(rows).mapInArrow(run, "id long, n long, terms array<int>, tfs array<long>")


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence list adds to the score, in whole numbers."""
    if int(n.max(initial=0)) * n_docs * 50 >= 1 << 63:
        m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        m = 50 + 50 * n * n_docs // max(n_terms, 1)
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


class Block:
    """Inverted lists of some documents, in order of their ids."""

    def __init__(self, ids, sizes, terms, tfs, n, weights, n_docs, n_terms):
        order = np.argsort(ids, kind="stable")
        position = np.empty(len(ids), np.int64)
        position[order] = np.arange(len(ids))
        owner = np.repeat(np.arange(len(ids)), sizes)
        impact = impacts(tfs, n[owner], weights[terms], n_docs, n_terms)
        doc = position[owner]
        by_term = np.lexsort((doc, terms))
        self.ids, self.docs, self.impacts = ids[order], doc[by_term], impact[by_term]
        self.starts = np.searchsorted(terms[by_term], np.arange(len(weights) + 1))
        self.ranges = -(-len(ids) // RANGE)
        self.dense: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _bounds(self, values: np.ndarray) -> np.ndarray:
        return values.reshape(self.ranges, RANGE).max(axis=1)

    def _long(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """A long list by document, and its bound in each range."""
        if term not in self.dense:
            values = np.zeros(self.ranges * RANGE, np.int64)
            part = slice(self.starts[term], self.starts[term + 1])
            values[self.docs[part]] = self.impacts[part]
            self.dense[term] = values, self._bounds(values)
        return self.dense[term]

    def search(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of this block's documents that may be among the ``k`` best; ``floor`` is a score to reach."""
        sizes = self.starts[terms + 1] - self.starts[terms]
        short = sizes * SHORT_SHARE <= len(self.ids)
        sums = np.zeros(self.ranges * RANGE, np.int64)
        for t in terms[short & (sizes > 0)]:  # term at a time
            part = slice(self.starts[t], self.starts[t + 1])
            sums[self.docs[part]] += self.impacts[part]
        lists = sorted((self._long(t) for t in terms[~short].tolist()), key=lambda x: -int(x[1].max()))
        bound = self._bounds(sums) + sum((b for _, b in lists), np.zeros(self.ranges, np.int64))
        rest = np.cumsum([0] + [int(b.max()) for _, b in reversed(lists)])[::-1]  # what the lists from i on can add

        def scored(docs: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
            total = sums[docs]
            for i, (values, _) in enumerate(lists):
                live = total + rest[i] >= floor
                docs, total = docs[live], total[live]
                total = total + values[docs]
            return docs, total

        floor = max(floor, 1)
        held = np.flatnonzero(sums)
        if len(held) >= k:  # the best accumulators give a first threshold
            first = held[np.argpartition(-sums[held], k - 1)[:k]]
            floor = max(floor, int(scored(first, 0)[1].min()))
        best, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = 0
        while True:  # document at a time, by ranges
            ahead = np.flatnonzero(bound[at:] >= floor)[:STRIDE] + at
            if not len(ahead):
                return self.ids[best], best_scores
            docs, scores = scored((ahead[:, None] * RANGE + np.arange(RANGE)).ravel(), floor)
            keep = scores >= floor
            best, best_scores = np.concatenate([best, docs[keep]]), np.concatenate([best_scores, scores[keep]])
            if len(best) > k:
                order = np.lexsort((best, -best_scores))[:k]
                best, best_scores = best[order], best_scores[order]
            if len(best) == k:
                floor = max(floor, int(best_scores.min()))
            at = int(ahead[-1]) + 1


class Best:
    """The ``k`` best documents of a query over several blocks."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]


def _searcher(queries: list[tuple[int, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    def run(batches):
        best = [Best(k) for _ in queries]

        def search(rows: pa.Table):
            terms, tfs = rows.column("terms").combine_chunks(), rows.column("tfs").combine_chunks()
            block = Block(rows.column("id").to_numpy(), terms.value_lengths().to_numpy(), terms.flatten().to_numpy().astype(np.int64),
                          tfs.flatten().to_numpy(), rows.column("n").to_numpy(), weights, n_docs, n_terms)
            for (_, wanted), top in zip(queries, best, strict=True):
                top.add(*block.search(wanted, k, top.floor()))

        held, docs, postings = [], 0, 0
        for b in batches:
            at = 0
            lengths = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            while at < b.num_rows:
                done = int(ends[at - 1]) if at else 0
                room = int(np.searchsorted(ends, done + BLOCK_POSTINGS - postings, side="right"))
                end = min(b.num_rows, at + BLOCK_DOCS - docs, max(room, at + (docs == 0)))  # at least one document
                if end > at:
                    held.append(b.slice(at, end - at))
                    docs, postings, at = docs + end - at, postings + int(ends[end - 1]) - done, end
                if at < b.num_rows or docs >= BLOCK_DOCS:
                    search(pa.Table.from_batches(held))
                    held, docs, postings = [], 0, 0
        if held:
            search(pa.Table.from_batches(held))
        for (item, _), top in zip(queries, best, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top.ids), item, np.int64)), pa.array(top.ids), pa.array(top.scores)], schema=FOUND)

    return run


def _query_blocks(queries: DataFrame, id_col: str, text_col: str):
    """Blocks of at most about ``QUERY_BYTES`` of query text, each as {id: its terms}."""
    rows = staged(queries.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
                  .where(F.col("id").isNotNull() & F.col("text").isNotNull()), "lexical-queries")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BYTES))
    for i in range(blocks):
        out: dict[int, set[bytes]] = {}
        for r in rows.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).toLocalIterator():
            out.setdefault(r["id"], set()).update(r["text"].encode("utf-8", "surrogatepass").translate(_TABLE).split())
        yield {q: sorted(t) for q, t in sorted(out.items()) if t}


def rank(docs: DataFrame, queries: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id",
         query_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a positive score for every query.

    A term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))``; a document of n
    terms has m = 50 + 50 n N div L; the score sums ``w * (10^9 tf div
    (1000 tf + 20 m))`` over the query's distinct terms, in 64-bit integers.
    """
    spark, parts = docs.sparkSession, []
    for block in _query_blocks(queries, query_id, query_text):
        known = {t: i for i, t in enumerate(sorted({t for ts in block.values() for t in ts}))}
        counted = staged(forward(docs, known, id_col, text_col), "lexical-forward")
        n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(known), np.int64)
        for t, df in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
            weights[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        wanted = [(q, np.array([known[t] for t in ts], np.int64)) for q, ts in block.items()]
        if wanted and n_docs:
            rows = counted.where(F.col("id").isNotNull() & (F.size("terms") > 0))
            found = rows.mapInArrow(_searcher(wanted, weights, n_docs, n_terms, k), "item_id long, doc_id long, score long")
            parts.append(staged(found, "lexical-found"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
