import os
import random

import numpy as np
import pytest

from strata.llm import minhash
from tests.llm.fixtures import doc, frame, odd_documents, prose, word


def sets_of(docs, size=3):
    out = []
    for r in docs:
        w = (r[1] or "").encode().lower().split()
        size_ = min(size, len(w))
        out.append({tuple(w[i:i + size_]) for i in range(len(w) - size_ + 1)} if w else set())
    return out


def brute(docs, percent=85):
    sets = sets_of(docs)
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(docs):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0]) for i, r in enumerate(docs)), key=str)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = word(rng)
    return " ".join(words)


def near_copies(seed, n, length=150, base_id=1000):
    rng = random.Random(seed)
    base = prose(rng, length).split()
    return [doc(base_id + i, edited(rng, base, rng.randint(0, 7))) for i in range(n)]


def found(spark, docs, **kw):
    got = minhash.near_duplicates(frame(spark, docs).withColumnRenamed("source", "component_id").repartition(4), **kw)
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str)


def test_matches_brute_force(spark):
    docs = odd_documents(6) + near_copies(1, 60) + near_copies(2, 12, 40, 2000) + near_copies(3, 30, 12, 3000)
    docs += [doc(5000, "ka lo"), doc(5001, "KA  lo"), doc(5002, "ka"), doc(9000, docs[60][1]), (None, docs[61][1], "a", "b", 1)]
    assert found(spark, docs) == brute(docs)


def test_clusters_of_several_blocks(spark, monkeypatch):
    """Blocks of four: representatives meet, and what is still apart meets block by block."""
    monkeypatch.setattr(minhash, "BLOCK_SETS", 4)
    monkeypatch.setattr(minhash, "BUCKET", 8)
    docs = near_copies(4, 50) + near_copies(5, 9, 60, 2000) + [doc(1, "solo text of its own here")]
    assert found(spark, docs) == brute(docs)


def test_empty_and_null_only(spark):
    assert found(spark, []) == []
    docs = [doc(3, None), doc(2, " \n"), doc(None, ""), (None, "ka lo mi ru", None, None, None), (None, "KA lo mi ru", None, None, None)]
    assert found(spark, docs) == brute(docs)


def test_distance_bounds_the_misses():
    d = minhash.max_distance(85)
    rng = np.random.default_rng(1)
    assert (rng.random((200_000, minhash.POSITIONS)) > 0.85).sum(axis=1).max() <= d < minhash.POSITIONS // 2
    assert minhash.max_distance(100) == 0 and minhash.max_distance(95) < d


def test_signatures_differ_as_often_as_sets_do():
    rng = np.random.default_rng(4)
    a, b = minhash._functions()
    differing = []
    for _ in range(300):
        common, own = rng.integers(0, 1 << 63, 340, dtype=np.uint64), rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        x = minhash.signature(np.unique(np.concatenate([common, own[:30]])), a, b)
        y = minhash.signature(np.unique(np.concatenate([common, own[30:]])), a, b)
        differing.append(int((x != y).sum()))
    p = 60 / 400
    mean, sd = minhash.POSITIONS * p, (minhash.POSITIONS * p * (1 - p)) ** 0.5
    assert abs(np.mean(differing) - mean) < 1 and np.std(differing) < 1.2 * sd and max(differing) <= minhash.max_distance(85)


@pytest.mark.parametrize("distance", [0, 1, 5, 12])
def test_every_pair_within_the_distance_shares_a_key(spark, distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 1 << 16, minhash.POSITIONS).astype(np.uint16)
    rows = [(0, bytearray(base.tobytes()))]
    for i in range(1, 40):
        other = base.copy()
        other[rng.choice(minhash.POSITIONS, distance, replace=False)] ^= 1
        rows.append((i, bytearray(other.tobytes())))
    keys = minhash.keys_of(spark.createDataFrame(rows, "uid long, sig binary"), distance).collect()
    mine = {r["key"] for r in keys if r["uid"] == 0}
    assert {r["uid"] for r in keys if r["key"] in mine} == set(range(40))


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_query_matches_brute_force(spark):
    from strata.llm.queries import Q

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = Q["op12_minhash"](spark, SF).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
