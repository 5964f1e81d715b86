"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are dealt into blocks of bounded size and queries into groups of
bounded size; every pair of block and group meets once. In a block the rows
are sorted by each dimension. A query walks all lists of its non-zero
dimensions in step, from the top where its component is positive and from the
bottom where it is negative, scores each row that turns up for the first time
in full, and stops when the bound (the product of the query with the values
now reached) cannot beat its k-th best score. Ties go to the smaller id, so a
bound equal to the k-th score goes on. The block's best then merge per query.

Components are whole numbers; scores are exact 64-bit integers. Where the largest
components of a block and a group could make a longer score, the job raises.

Edge cases: vectors that are null or hold null or non-finite components, and
rows without an id, take no part; missing trailing components count as 0;
rows that repeat an id are candidates each, and none is compared with a query
of its id; queries that repeat id and vector give one result; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged

BLOCK_ROWS = 8192
GROUP_QUERIES = 2048
FIRST_STEP = 16
EXACT = float(1 << 53)

FOUND = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "query_id long, query_key long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: float, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x array<long>): floor(scale * component) of the usable vectors."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("x"))


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    lists = table.column("x").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Lists:
    """A block of candidates with its lists sorted per dimension (ids ascending, so first rows win ties)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.ascending = np.argsort(self.x, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(self.x, self.ascending.T, axis=0).T.copy()

    def top(self, q: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best for one query, best first."""
        n, active = len(self.ids), np.flatnonzero(q)
        up = active[q[active] < 0]
        down = active[q[active] > 0]
        unseen = self.ids != query_id
        best_rows, best = np.zeros(0, np.int64), np.zeros(0, q.dtype)
        if not len(active):  # every score is 0: the smallest ids
            rows = np.flatnonzero(unseen)[:k]
            return rows, np.zeros(len(rows), q.dtype)
        depth, step = 0, FIRST_STEP
        while depth < n:
            end = min(n, depth + step)
            mark = np.zeros(n, bool)
            mark[self.ascending[up, depth:end].ravel()] = True
            mark[self.ascending[down, n - end:n - depth].ravel()] = True
            new = np.flatnonzero(mark & unseen)
            unseen[new] = False
            if len(new):
                rows = np.concatenate([best_rows, new])
                scores = np.concatenate([best, self.x[new] @ q])
                keep = np.lexsort((rows, -scores))[:k]
                best_rows, best = rows[keep], scores[keep]
            bound = (q[up] * self.sorted[up, end - 1]).sum() + (q[down] * self.sorted[down, n - end]).sum()
            if len(best) == k and bound < best[-1] or not unseen.any():
                break
            depth, step = end, step * 2
        return best_rows, best


def _meet(k: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not candidates.num_rows or not queries.num_rows:
            return FOUND.empty_table()
        width = max(int(t.column("x").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max()) for t in (candidates, queries))
        x, q = _matrix(candidates, width), _matrix(queries, width)
        largest = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(q.astype(np.float64)).max(initial=0)) * max(width, 1)
        if largest >= 2.0**63:
            raise OverflowError("components are too large for scores of 64 bits")
        kind = np.float64 if largest < EXACT else np.int64  # products stay whole either way
        lists = Lists(candidates.column("id").to_numpy(), x.astype(kind))
        out = [], [], [], []
        for query_id, key, row in zip(queries.column("id").to_pylist(), queries.column("key").to_pylist(), q.astype(kind), strict=True):
            rows, scores = lists.top(row, query_id, k)
            out[0].append(np.full(len(rows), query_id)), out[1].append(np.full(len(rows), key))
            out[2].append(lists.ids[rows]), out[3].append(scores.astype(np.int64))
        return pa.Table.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], schema=FOUND)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``vectors`` and ``queries`` (id, x array<long>) -> (query_id, rank, vec_id, score): the k best of every query."""
    vectors = staged(vectors, "topk-vectors")
    queries = staged(queries.groupBy("id", "x").count().select("id", "x", F.xxhash64("id", "x").alias("key")), "topk-queries")
    blocks, groups = max(1, -(-vectors.count() // BLOCK_ROWS)), max(1, -(-queries.count() // GROUP_QUERIES))
    each_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b")
    left = vectors.select("id", "x", F.pmod(F.xxhash64("id", "x", F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("b"), each_group)
    right = queries.select("id", "x", "key", each_block, F.pmod(F.col("key"), F.lit(groups)).cast("int").alias("g"))
    found = left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInArrow(_meet(k), FOUND_DDL)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
