import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata.llm import quality
from strata.llm.common import held_out
from tests.llm.fixtures import doc, frame, odd_documents, prose

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=500, seed=4):
    rng = random.Random(seed)
    rows, good = [], {}
    for i in range(n):
        t, kind = prose(rng, rng.randint(20, 120)), i % 6
        good[i] = kind != 0
        if kind == 0:
            t = [" | ".join(t.split()), " ".join(f"{w}***" for w in t.split()), " ".join([t.split()[0]] * 60)][i // 6 % 3]
        rows.append(doc(i, t))
    return rows, good


def test_held_out_accuracy(spark):
    rows, good = corpus()
    labels = [(i, int(g), 0) for i, g in good.items() if i % 5 < 3]
    got = {r["id"]: r["accepted"] for r in quality.score(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    ids = [r["doc_id"] for r in frame(spark, rows).where(held_out()).select("doc_id").collect()] + [i for i in good if i % 5 >= 3]
    assert np.mean([got[i] for i in ids if good[i]]) >= 0.98
    assert np.mean([got[i] for i in ids if not good[i]]) <= 0.1


def test_models_match_brute_force(spark):
    rows, good = corpus(60)
    raw, target = quality.count_ngrams(frame(spark, rows).selectExpr("text", "doc_id % 2 = 0 AS flag").repartition(4), "text", "flag")
    grams = quality._Hasher()
    want = np.zeros((2, quality.BUCKETS), int)
    for r in rows:
        for g in set(grams((r[1] or "").encode()).tolist()):
            want[0, g] += 1
            want[1, g] += r[0] % 2 == 0
    assert (raw == want[0]).all() and (target == want[1]).all()


def test_weights_and_sample_match_brute_force(spark):
    rows, good = corpus(120)
    rows += odd_documents()
    labels = [(i, int(g), 0) for i, g in good.items()]
    usable = {r["doc_id"] for r in frame(spark, rows).where(~held_out() & F.col("doc_id").isNotNull()).collect()}
    target_ids = {i for i, g in good.items() if g and i in usable}
    hasher = quality._Hasher()
    bags = [(r[0], hasher((r[1] or "").encode()).tolist()) for r in rows]
    raw, target = Counter(), Counter()
    for i, bag in bags:
        raw.update(bag)
        if i in target_ids:
            target.update(bag)
    big_r, big_t = sum(raw.values()), sum(target.values())
    share, prior = big_t / big_r, quality.PRIOR

    def weight(i, bag):
        own = i in target_ids
        t_total = big_t - own * len(bag) + prior * quality.BUCKETS
        r_total = (big_r - len(bag)) * share + prior * quality.BUCKETS
        return sum(math.log((target[g] - own + prior) / t_total) - math.log(((raw[g] - 1) * share + prior) / r_total) for g in bag)

    for part in (0.1, 0.5, 1.0):
        got = quality.score(frame(spark, rows), spark.createDataFrame(labels, LABELS), share=part).collect()
        assert np.allclose(sorted(r["log_weight"] for r in got), sorted(weight(i, b) for i, b in bags), atol=1e-4, rtol=1e-4)
        noise = {r["doc_id"]: r["g"] for r in frame(spark, rows).withColumn("g", quality.gumbel("doc_id", 8)).collect()}
        assert all(abs(r["gumbel_key"] - r["log_weight"] - noise[r["id"]]) < 1e-9 for r in got)
        keys = sorted((math.floor(r["gumbel_key"] * quality.SCALE) for r in got), reverse=True)
        last = keys[math.ceil(part * len(rows)) - 1]
        assert all(r["kept"] == (math.floor(r["gumbel_key"] * quality.SCALE) >= last) for r in got)


def test_sample_follows_the_weights(spark):
    ids = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.0).alias("w"))
    keys = ids.withColumn("key", ((F.col("w") + quality.gumbel("doc_id", 5) + 100) * quality.SCALE).cast("long"))
    kept = keys.where(F.col("key") >= quality.kth_largest(keys, "key", 2000))
    heavy = kept.where("w = 1").count() / kept.count()
    assert abs(heavy - math.e / (1 + math.e)) < 0.04  # a few of many: nearly in proportion to the weights


def test_top_k_is_exact(spark):
    rng = random.Random(1)
    keys = [rng.randrange(1 << 48) for _ in range(300)] + [5] * 20 + [0, (1 << 48) - 1]
    df = spark.createDataFrame([(k,) for k in keys], "x long")
    ranked = sorted(keys, reverse=True)
    for k in (1, 2, 150, 305, len(keys)):
        assert quality.kth_largest(df, "x", k) == ranked[k - 1]


def test_noise_is_gumbel(spark):
    x = np.array([r["g"] for r in spark.range(20000).select(quality.gumbel("id", 1).alias("g")).collect()])
    assert abs(x.mean() - 0.5772) < 0.05 and abs(x.std() - 1.2825) < 0.05


def test_odd_rows_and_empty(spark):
    rows, good = corpus(100)
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in good.items()] + [(None, 1, 0), (3, None, 0), (4, 0, 0)], LABELS)
    odd = frame(spark, rows + odd_documents()).selectExpr("*", "1 AS quality", "2 AS kept")
    got = quality.score(odd, labels).collect()
    assert len(got) == 100 + len(odd_documents())
    assert all(r["log_weight"] == 0 for r in got if r["id"] in (101, 102) and r["log_weight"] is not None and r["id"] == 101)
    kept = quality.keep_target_like(odd, labels)
    assert kept.columns == odd.columns and kept.where("doc_id IS NULL").count() == 2
    none = spark.createDataFrame([], LABELS)
    assert quality.keep_target_like(odd, none).count() == odd.count()
    assert quality.score(frame(spark, []), labels).count() == 0
