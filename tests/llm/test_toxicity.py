import random
import zlib

import numpy as np

from strata.llm import toxicity
from tests.llm.fixtures import doc, frame, odd_documents, prose


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(10, 120)).split()
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["Grumf", "zwock", "zwockig", "blarfer"]))
        rows.append(doc(i, " ".join(words)))
        if i % 4:
            labels.append((i, 1, toxic))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_learns_and_never_reads_held_out_labels(spark):
    rows, labels = corpus()
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, lab)
    got = {r["id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    unseen = [i for i in range(400) if held(i) or i % 4 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 5 == 0) for i in unseen]) >= 0.97
    lying = [(i, q, 1 - t) if held(i) else (i, q, t) for i, q, t in labels]
    again = toxicity.train(docs, spark.createDataFrame(lying, "doc_id long, quality int, toxic int"))
    assert np.array_equal(model.buckets, again.buckets) and np.allclose(model.weights, again.weights)


def test_ratio_is_the_naive_bayes_ratio(spark):
    rows, labels = corpus(60)
    kept = [r for r in rows if r[0] % 4 and not held(r[0])]
    n, holds = toxicity._count(frame(spark, kept).selectExpr("text", "CAST(doc_id % 5 = 0 AS INT) AS toxic"))
    want = np.zeros_like(holds)
    for r in kept:
        want[int(r[0] % 5 == 0), np.unique(toxicity.ngram_buckets(r[1]))] += 1
    assert (holds == want).all() and n.sum() == len(kept)


def test_long_texts_are_read_to_the_end(spark):
    rows, labels = corpus()
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rng = random.Random(9)
    calm = prose(rng, 4000)
    a, b = (next(r["score"] for r in toxicity.score(frame(spark, [doc(1, t)]), model).collect()) for t in (calm, calm + " Grumf zwock blarfer"))
    assert b > a


def test_odd_rows_and_empty(spark):
    rows, labels = corpus(80)
    lab = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (6, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(spark, rows + odd_documents()), lab, max_rows=50)
    odd = frame(spark, odd_documents()).selectExpr("*", "0.5 AS score", "1 AS toxic")
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(odd_documents()) and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["id"] in (100, 101, 102)}
    assert len(blank) == 1
    assert toxicity.score(frame(spark, []), model).count() == 0
    nothing = toxicity.train(frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert all(r["score"] < 1e-6 for r in toxicity.score(odd, nothing).collect())
    one_class = toxicity.train(frame(spark, rows), spark.createDataFrame([(i, 1, 1) for i in range(40)], "doc_id long, quality int, toxic int"))
    assert all(r["score"] > 0.99 for r in toxicity.score(odd, one_class).collect())


def test_fit_is_the_regularised_optimum():
    """Against Newton's method on the dense matrix, whatever the chunks."""
    rng = np.random.default_rng(4)
    x = rng.random((120, 15)) < 0.3
    ratio = rng.normal(0, 1, 15)
    y = (x @ ratio + rng.normal(0, 1.5, 120) > 0).astype(float)
    dense = np.hstack([x * ratio, np.ones((120, 1))])
    penalty, w = 0.01, np.zeros(16)
    for _ in range(50):
        p = 1 / (1 + np.exp(-dense @ w))
        ridge = np.array([penalty] * 15 + [0.0])
        hessian = dense.T @ (dense * (p * (1 - p))[:, None]) / 120 + np.diag(ridge)
        w -= np.linalg.solve(hessian, dense.T @ (p - y) / 120 + ridge * w)
    sizes, flat = x.sum(axis=1), np.concatenate([np.flatnonzero(r) for r in x]).astype(np.int32)
    for chunk in (7, 1 << 18):
        toxicity.CHUNK, before = chunk, toxicity.CHUNK
        try:
            got, bias = toxicity._fit(flat, sizes, y, ratio, penalty, 3000)
        finally:
            toxicity.CHUNK = before
        assert np.allclose(np.append(got, bias), w, atol=1e-3)


def test_score_is_the_sum_over_distinct_ngrams(spark):
    rows, labels = corpus(120)
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    weight = dict(zip(model.buckets.tolist(), model.weights.astype(float).tolist(), strict=True))
    got = {r["id"]: r["score"] for r in toxicity.score(frame(spark, rows), model).collect()}
    for r in rows:
        z = model.bias + sum(weight.get(b, 0.0) for b in set(toxicity.ngram_buckets(r[1]).tolist()))
        assert abs(got[r[0]] - 1 / (1 + np.exp(-z))) < 1e-9


def test_fit_holds_a_bounded_number_of_ids(spark, monkeypatch):
    rng = random.Random(3)
    rows, labels = corpus(200)
    rows += [doc(1000 + i, prose(rng, 3000)) for i in range(6)]  # long labelled texts
    labels += [(1000 + i, 1, i % 2) for i in range(6)]
    seen = []
    fit = toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda flat, sizes, *rest: seen.append((len(flat), len(sizes))) or fit(flat, sizes, *rest))
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), max_ids=4000)
    assert seen[0][0] <= 4000 and 1 <= seen[0][1] < len(labels)
    assert len(model.buckets) and toxicity.score(frame(spark, rows), model).count() == len(rows)


def test_copies_cannot_pass_the_bound(spark):
    bags = spark.createDataFrame([(7, r, 10) for r in range(50)] + [(8, 60, 10)], "hash long, row long, size long")
    assert toxicity._within(bags, 100).count() == 10 and toxicity._within(bags, 1).count() == 1 and toxicity._within(bags, 10_000).count() == 51
