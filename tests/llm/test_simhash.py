import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from strata.llm import simhash
from strata.llm.components import connected_components
from tests.llm.fixtures import doc, frame, odd_documents, prose


def plain_fingerprint(text, k=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def brute(rows, max_bits=4):
    fps = [(r[0], plain_fingerprint(r[1])) for r in rows]
    root = roots({f for _, f in fps}, lambda a, b: bin(a ^ b).count("1") <= max_bits)
    least = defaultdict(list)
    for i, f in fps:
        least[root[f]].append(i)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((i, f, least[root[f]]) for i, f in fps), key=str)


def family(rng, base, n):
    """Near copies of a long text: a word or two differ."""
    words = base.split()
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(1, 2)):
            w[rng.randrange(len(w))] = "x" + str(rng.randrange(1000))
        yield " ".join(w)


def test_matches_brute_force(spark):
    rng = random.Random(5)
    rows = odd_documents()
    rows += [doc(500 + i, t) for i, t in enumerate(family(rng, prose(rng, 300), 60))]
    rows += [doc(700 + i, t) for i, t in enumerate(family(rng, prose(rng, 40), 60))]
    got = simhash.near_duplicates(frame(spark, rows).selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS id")).collect()
    assert sorted(((r["id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in got), key=str) == brute(rows)


def clustered(rng, n):
    """Fingerprints with correlated bits, families at 0 to 6 bits, and one family of thousands."""
    out = set()
    centers = [rng.getrandbits(64) & ~0xFFFF | (0xFFFF if rng.random() < 0.5 else 0) for _ in range(n // 6)] + [0, 2**64 - 1]
    for c in centers:
        out.add(c)
        for _ in range(5):
            x = c
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    hub = rng.getrandbits(64)
    for _ in range(n // 3):
        x = hub
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("hot", [simhash.HOT_BUCKET, 20])  # the second parts most buckets before they meet
def test_every_partition_count_finds_all_links(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng = random.Random(11)
    fps = clustered(rng, 600)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(x,) for x in signed], "fp long")
    for max_bits in (0, 1, 3, 4):
        want = roots(set(fps), lambda a, b, m=max_bits: (a ^ b).bit_count() <= m)
        together = simhash.co_occurrence(distinct)
        layouts = [None]
        if max_bits == 4:
            for m in (2, 3, 4, 5):
                lay = simhash.Layout(simhash.group_bits(together, len(fps), m), max_bits)
                lay.set_counts(len(fps), [[np.bincount(simhash._project(np.array(fps, np.uint64), b).astype(np.int64), minlength=1 << len(b)).astype(float)
                                           for b in bs] for bs in lay.blocks])
                layouts.append(lay)
        for lay in layouts:
            links = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.links(distinct, max_bits, lay).collect()]
            assert all((a ^ b).bit_count() <= max_bits for a, b in links)
            root = {x: x for x in fps}

            def find(x, root=root):
                while root[x] != x:
                    x = root[x]
                return x

            for a, b in links:
                root[find(a)] = find(b)
            groups = lambda of: sorted(sorted(v) for v in _by(of).values())
            assert groups({x: find(x) for x in fps}) == groups(want)


def _by(of):
    out = defaultdict(list)
    for k, v in of.items():
        out[v].append(k)
    return out


def test_units_cover_the_budget():
    fp = np.array([1, 2, 2**63, 2**64 - 1], np.uint64)
    lay = simhash.Layout(simhash.group_bits(np.eye(64, dtype=np.int64), 4, 3), 4)
    lay.set_counts(4, [[np.ones(1 << len(b)) for b in bs] for bs in lay.blocks])
    units, _ = lay.allocate(fp)
    assert (units.sum(axis=1) == 5).all() and units.max() <= simhash.MAX_UNITS
    assert sorted(b for p in lay.partitions for b in p) == list(range(64))


def test_large_bucket_is_cut_and_swept(monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT_BUCKET", 64)
    fps = np.array(clustered(random.Random(2), 400), np.uint64)
    root = {int(x): int(x) for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in simhash._bucket_links(fps, 4):
        root[find(int(a))] = find(int(b))
    want = roots(set(map(int, fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    assert len({find(x) for x in root}) == len(set(want.values()))


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    links += [(5000, 5001 + i) for i in range(50)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    adjacent = defaultdict(set)
    for a, b in links:
        if a is not None and a != b:
            adjacent[a].add(b), adjacent[b].add(a)
    want = {}
    for n in sorted(adjacent):
        if n not in want:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = n
                    todo.extend(adjacent[x])
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_per_class_and_empty(spark):
    rows = odd_documents()
    docs = frame(spark, rows).selectExpr("*", "5 AS component_id")
    kept = simhash.one_per_class(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=str)
    want = sorted({c for i, _, c in brute(rows) if i is not None} | set(), key=str) + [None, None]
    assert sorted(got, key=str) == sorted(want, key=str)
    empty = frame(spark, [])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_per_class(empty).count() == 0


def test_buckets_over_many_batches(spark):
    """A bucket that Arrow batches cut at any place is verified whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(21)
        fps = sorted({x ^ (1 << rng.randrange(64)) for x in [rng.getrandbits(64)] for _ in range(60)} | {rng.getrandbits(64) for _ in range(40)})
        distinct = spark.createDataFrame([(x,) for x in np.array(fps, np.uint64).view(np.int64).tolist()], "fp long")
        got = connected_components(simhash.links(distinct, 4)).groupBy("root").count().collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = _by(roots(set(fps), lambda a, b: (a ^ b).bit_count() <= 4))
    assert sorted(r["count"] for r in got) == sorted(len(v) for v in want.values() if len(v) > 1)
