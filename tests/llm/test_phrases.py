import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import phrases
from tests.llm.fixtures import doc, frame, odd_documents


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def pieces(t):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def brute(docs, least, longest, percent=100):
    f, n = Counter(), Counter()
    for r in docs:
        lang = r[2] or "und"
        for w in pieces(r[1]):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
    held = {key for key, c in f.items() if len(key[1]) > 1 and c >= least}
    out = []
    for lang, p in held:
        a = f[lang, p]
        if any(m == lang and len(q) > len(p) and 100 * f[m, q] >= percent * a and inside(p, q) for m, q in held):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), len(p), a, left, right, n[lang], score))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)
    words = ["ka", "LO", "mi", "ru", "é", "ÄÖ", "ten", "x\x00y"]
    out = odd_documents(seed)
    for i in range(300, 360):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "!?", "\r\n"]) for _ in range(rng.randint(1, 60)))
        out.append(doc(i, t + rng.choice(["", " ka lo mi ru ten", " ru ru ru ru ru"]), lang=rng.choice(["aa", "aa", None, "und"])))
    return out


@pytest.mark.parametrize(("least", "longest", "percent"), [(5, 5, 100), (3, 4, 60), (2, 2, 100)])
def test_matches_brute_force(spark, least, longest, percent):
    docs = texts(least)
    got = phrases.collocations(frame(spark, docs).withColumnRenamed("source", "score").repartition(5), least, longest, percent)
    assert sorted(map(tuple, got.select("lang", "phrase", "k", "a", "l", "r", "n", "score").collect())) == brute(docs, least, longest, percent)


def test_top_ranks_by_score_count_and_bytes(spark):
    rows = [("a", "b c", 7, 10), ("a", "é c", 7, 10), ("a", "b d", 8, 10), ("a", "z z", 1, 11), ("b", "q q", 1, 1)]
    found = spark.createDataFrame(rows, "lang string, phrase string, a long, score long")
    got = phrases.top(found, 3).orderBy("lang", "rank").select("lang", "rank", "phrase").collect()
    assert list(map(tuple, got)) == [("a", 1, "z z"), ("a", 2, "b d"), ("a", 3, "b c"), ("b", 1, "q q")]


def test_nothing_to_count(spark):
    for docs in ([], [doc(1, None)], [doc(2, ". , !"), doc(3, "ka lo")]):
        assert phrases.collocations(frame(spark, docs), 2).count() == 0


def test_exact_beyond_64_bits(spark):
    a = spark.createDataFrame([(3 * 10**9, 4 * 10**12, 3 * 10**9, 3 * 10**9 + 1)], "a long, n long, l long, r long")
    whole = {c: f"cast({c} as decimal(20,0))" for c in "anlr"}
    got = a.selectExpr(f"(cast(1000 as decimal(4,0)) * {whole['a']} * {whole['n']}) div ({whole['l']} * {whole['r']}) as s").first()["s"]
    assert got == 1000 * 3 * 10**9 * 4 * 10**12 // (3 * 10**9 * (3 * 10**9 + 1))


def test_trie_bursts_and_spills_whole_subtrees():
    rng = random.Random(1)
    trie, want, out = phrases.HatTrie(depth=2, burst=8), Counter(), Counter()
    for step in range(4000):
        key = tuple(rng.randrange(12) for _ in range(rng.randint(2, 5)))
        trie.add(key, step % 3 + 1)
        want[key] += step % 3 + 1
        if step % 900 == 899:
            for subtree in trie.spill(trie.entries // 2):
                assert len({k[0] for k, _ in subtree}) == 1  # a whole subtree
                out.update(dict(subtree))
            assert type(trie.root) is phrases.Node
    assert trie.entries == sum(1 for _ in trie.walk(trie.root))
    for subtree in trie.spill(0):
        out.update(dict(subtree))
    assert out == want and trie.entries == 0 and list(trie.spill(0)) == []


@pytest.mark.parametrize("size", [1, 7, 40, 10_000])
def test_slices_lose_and_repeat_no_word(monkeypatch, size):
    monkeypatch.setattr(phrases, "SLICE_BYTES", size)
    for r in texts(9):
        text = (r[1] or "").encode()[:3000]
        text = text.decode(errors="ignore").encode()
        for overlap in (0, 2, 4):
            got, joined = [], []
            for part, starts, ends, hashes, follows, carried in phrases.Slicer(overlap).of(text):
                got += [part[s:e] for s, e in zip(starts[carried:], ends[carried:], strict=True)]
                joined += follows[carried:].tolist() if carried else [False, *follows[1:].tolist()]
                assert len(hashes) == len(starts) == len(follows)
            want = list(pieces(text.decode()))
            assert got == [w.encode() for p in want for w in p]
            if overlap:
                assert joined == [i > 0 for p in want for i in range(len(p))]


def test_words_hash_alike_wherever_they_are():
    one = list(phrases.Slicer(0).of(b"ka lo  ka\nlomi ka"))[0]
    assert one[3][0] == one[3][2] == one[3][4] and len(np.unique(one[3])) == 3


def test_counting_rows_do_not_grow_with_the_files(spark):
    docs = [doc(i, "ka lo mi ru ten", lang="aa") for i in range(4000)]
    files = 50 * spark.sparkContext.defaultParallelism
    sieved = phrases.staged(phrases.sieve(frame(spark, docs), 100), "test-sieve")
    marks = phrases.Marks.of(sieved.where("lang is null"))
    triples = phrases.Marks.of(phrases.staged(phrases.sieve_triples(frame(spark, docs), 100, marks), "test-triples"))
    runs = phrases.counted_runs(frame(spark, docs).repartition(files), 5, marks, triples, 20_000)
    assert runs.count() <= 15 * 2 * spark.sparkContext.defaultParallelism  # 15 phrases
    assert {r["f"] for r in runs.groupBy("phrase").sum("n").toDF("phrase", "f").collect()} == {4000}


def test_bit_table_lets_few_rare_hashes_through(spark):
    marks = phrases.Marks.of(phrases.staged(spark.range(20_000).selectExpr("xxhash64(id) as h"), "test-marks"))
    rare = spark.range(10**6, 10**6 + 200_000).selectExpr("xxhash64(id) as h").toPandas()["h"].to_numpy().view(np.uint64)
    assert marks.has(rare).mean() < 0.001
