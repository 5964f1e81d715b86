import hashlib
import random
from collections import defaultdict

import pytest

from strata.llm import mixing
from tests.llm.fixtures import doc, frame, odd_documents, prose


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, stop at the limit, share the excess again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        t = {s: most * sizes[s] if s in capped else rest * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if t[s] > most * sizes[s]}
        if not over:
            return t
        capped |= over


def rows_of(seed=3):
    rng = random.Random(seed)
    rows = odd_documents()
    for i in range(900):
        rows.append(doc(5000 + i, prose(rng, rng.randint(1, 40)), rng.choice(["big"] * 6 + ["mid", "mid", "Zed", "é", "tiny-a"])))
    return rows + [doc(9000, prose(rng, 3), "tiny-b"), doc(9001, "", "blank")]


def test_targets_match_resharing(spark):
    rng = random.Random(0)
    for _ in range(6):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 100, 5000]) for i in range(rng.randint(1, 9))} | {None: 40}
        df = spark.createDataFrame([(k, v, 1) for k, v in sizes.items()], "source string, source_size long, n long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mix(spark):
    rows = rows_of()
    docs = frame(spark, rows).selectExpr("*", "1 AS size", "2 AS copies", "3 AS u", "4 AS mean")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
        assert r["taken"] <= 3 * r["size"] and r["copies"] in (0, 1, 2, 3) and abs(r["copies"] - r["expected"]) <= 1
    want = brute_targets(size)
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    assert all(abs(taken[s] - want[s]) <= most[s] for s in size)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_sample_is_pareto_order(spark):
    """Brute force: rank by random odds over inclusion odds, take until the words are reached."""
    rows = [r for r in rows_of() if r[3] == "big"]
    got = {r["id"]: r for r in mixing.mix(frame(spark, rows + [doc(1, "x " * 3000, "a-other")])).collect()}
    ranked, owed = [], got[rows[0][0]]["target"]
    for r in rows:
        g = got[r[0]]
        whole = int(g["expected"])
        p, digest = g["expected"] - whole, hashlib.md5(f"9:{r[0]}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / 2**52
        owed -= whole * g["size"]
        if p:
            ranked.append(((u / (1 - u)) / (p / (1 - p)), g["size"], r[0], whole))
    before, chosen = 0, set()
    for _, n, i, _ in sorted(ranked):
        if before + n / 2 <= owed:
            chosen.add(i)
        before += n
    assert 0 < len(chosen) < len(rows)
    assert {i for _, _, i, whole in ranked if got[i]["copies"] > whole} == chosen


def test_longer_documents_are_likelier_and_words_keep_their_expectation(spark):
    rows = [r for r in rows_of() if r[3] in ("big", "mid", "Zed")]
    got = mixing.mix(frame(spark, rows)).collect()
    for s in ("big", "mid", "Zed"):
        own = [r for r in got if r["source"] == s]
        assert sum(r["expected"] * r["size"] for r in own) == pytest.approx(own[0]["target"], rel=1e-6)


def test_resample(spark):
    rows = rows_of()
    docs = frame(spark, rows).selectExpr("*", "1 AS size", "2 AS copies")
    out = mixing.resample(docs)
    assert out.columns == docs.columns
    want = sorted((str(r["id"]), r["size"]) for r in mixing.mix(docs).collect() for _ in range(r["copies"]))
    assert sorted((str(r["doc_id"]), len((r["text"] or "").split())) for r in out.collect()) == want


def test_empty(spark):
    assert mixing.mix(frame(spark, [])).count() == 0 and mixing.resample(frame(spark, [])).count() == 0
    blank = mixing.mix(frame(spark, [doc(1, ""), doc(2, None)])).collect()
    assert [(r["taken"], r["target"]) for r in blank] == [(0, 0.0)] * 2
