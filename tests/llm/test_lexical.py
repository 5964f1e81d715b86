import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import lexical
from tests.llm.fixtures import doc, frame, odd_documents, prose


def terms(t):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k):
    bags = [(r[0], Counter(terms(r[1]))) for r in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df, queries, out = Counter(t for _, b in bags for t in b), {}, []
    for i, t in items:
        if i is not None:
            queries.setdefault(i, set()).update(terms(t))
    for q, wanted in queries.items():
        found = []
        for i, bag in bags:
            n, score = sum(bag.values()), 0
            for t in wanted & bag.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * (50 + 50 * n * n_docs // total)))
            if i is not None and score > 0:
                found.append((-score, i))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_matches_brute_force(spark, k):
    rng = random.Random(5)
    docs = odd_documents(5) + [doc(i, "ka " * rng.randint(1, 9) + prose(rng, rng.randint(1, 30))) for i in range(200, 420)]
    items = [(i, prose(rng, rng.randint(1, 12))) for i in range(15)] + [(20, None), (21, ""), (22, "?!"), (None, "ka"), (3, "lo KA"), (23, "ÄÖ café"), (24, "zz")]
    got = lexical.rank(frame(spark, docs).withColumnRenamed("source", "score"), frame(spark, items, "item_id long, text string"), k)
    assert sorted(map(tuple, got.collect())) == brute(docs, items, k)


def test_empty_sides(spark):
    none = frame(spark, []), frame(spark, [], "item_id long, text string")
    some = frame(spark, [doc(1, "ka lo")]), frame(spark, [(1, "ka")], "item_id long, text string")
    assert lexical.rank(none[0], some[1]).count() == 0 == lexical.rank(some[0], none[1]).count()
    assert lexical.rank(frame(spark, [doc(1, None)]), some[1]).count() == 0


def test_blocks_skip_and_stay_exact():
    """Short and long lists, thresholds handed from block to block, ties at the k-th score."""
    rng = np.random.default_rng(2)
    n_terms = 12
    share = rng.random(n_terms) ** 3
    totals, best, k = {}, lexical.Best(7), 7
    weights = rng.integers(0, 3000, n_terms)
    wanted = np.arange(0, n_terms, 2)
    for start in range(0, 4000, 1000):
        ids = rng.permutation(np.arange(start, start + 1000)).astype(np.int64)
        held = [np.flatnonzero(rng.random(n_terms) < share) for _ in ids]
        tfs = np.concatenate([rng.integers(1, 3, len(h)) for h in held]).astype(np.int64)
        n = np.full(len(ids), 50, np.int64)
        args = (np.array([len(h) for h in held]), np.concatenate(held), tfs, n, weights, 4000, 200_000)
        best.add(*lexical.Block(ids, *args).search(wanted, k, best.floor()))
        impact = lexical.impacts(tfs, np.full(len(tfs), 50, np.int64), weights[args[1]], 4000, 200_000)
        owner = np.repeat(ids, args[0])
        for i, t, x in zip(owner.tolist(), args[1].tolist(), impact.tolist(), strict=True):
            if t % 2 == 0:
                totals[i] = totals.get(i, 0) + x
    want = sorted((-s, i) for i, s in totals.items() if s > 0)[:k]
    assert list(zip((-best.scores).tolist(), best.ids.tolist(), strict=True)) == want


def test_lengths_beyond_64_bits_stay_exact():
    big = np.array([4 * 10**9], np.int64)
    got = lexical.impacts(np.array([3], np.int64), big, np.array([2000], np.int64), 10**11, 10**13)
    assert got[0] == 2000 * (3 * 10**9 // (3000 + 20 * (50 + 50 * 4 * 10**9 * 10**11 // 10**13)))
