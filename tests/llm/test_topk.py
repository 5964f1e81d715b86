import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import topk

DDL = "vec_id long, embedding array<float>, label int, score double"


def vectors(n=500, width=16, seed=1):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(width)], 0, 0.0) for i in range(n)]
    common = rows[3][1]
    rows += [(1000 + i, common, 0, 0.0) for i in range(120)]
    rows += [(2000, None, 0, 0.0), (2050, [], 0, 0.0), (2100, [0.0] * width, 0, 0.0), (2150, [0.5], 0, 0.0), (2200, [1.0, None], 0, 0.0),
             (2250, [float("nan")] * width, 0, 0.0), (2300, [float("inf")] * width, 0, 0.0), (None, common, 0, 0.0), (2350, [3e4] * width, 0, 0.0),
             (7, rows[8][1], 0, 0.0), (50, rows[50][1], 0, 0.0)]
    return rows


def brute(rows, k=5, scale=256):
    usable = []
    for i, e, *_ in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            usable.append((i, [math.floor(scale * x) for x in e]))
    out = []
    for qid, q in sorted({(i, tuple(x)) for i, x in usable if i % 50 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(q, x, strict=False)), i) for i, x in usable if i != qid)
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=5):
    v = topk.quantised(spark.createDataFrame(rows, DDL), 256.0)
    return sorted(map(tuple, topk.top_k(v, v.where(F.col("id") % 50 == 0), k).collect()))


def test_matches_brute_force(spark, monkeypatch):
    rows = vectors()
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 4)
    assert run(spark, rows, 3) == brute(rows, 3)


def test_few_candidates_and_empty(spark):
    rows = vectors(60, 4)[:3]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_the_bound_stops_early():
    """Skewed components: the best rows lie at the top of the lists, so most rows are never scored."""
    rng = np.random.default_rng(3)
    x = np.floor(rng.pareto(1.2, (5000, 3)) * 100)
    lists = topk.Lists(np.arange(5000), x)
    q = np.array([5.0, 3.0, 2.0])
    scored = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            out = super().__getitem__(key)
            if isinstance(key, np.ndarray) and out.ndim == 2:
                scored.append(len(out))
            return out

    lists.x = lists.x.view(Counted)
    rows, scores = lists.top(q, -1, 5)
    want = np.lexsort((np.arange(5000), -(x @ q)))[:5]
    assert rows.tolist() == want.tolist() and sum(scored) < 1000


def test_whole_number_products_beyond_doubles():
    lists = topk.Lists(np.arange(3), np.array([[2**31, 1], [2**31, 2], [2**31, 0]], np.int64))
    rows, scores = lists.top(np.array([2**31, 1], np.int64), -1, 2)
    assert rows.tolist() == [1, 0] and scores.tolist() == [2**62 + 2, 2**62 + 1]


def test_scores_beyond_64_bits_raise(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(50, [1e18, 1.0], 0, 0.0), (51, [1e18, 1.0], 0, 0.0)])
