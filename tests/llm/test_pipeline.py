import random

import pytest

import corpus_pipeline
from strata.llm import mixing, quality
from tests.llm.fixtures import doc, frame, odd_documents, prose
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_simhash import brute as brute_classes
from tests.llm.test_token_output import tokens_of


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = f"file://{tmp_path_factory.mktemp('sf')}"
    rng = random.Random(12)
    items = [(i, prose(rng, 30)) for i in range(4)]
    rows = odd_documents()
    for i in range(200):
        t = prose(rng, rng.randint(20, 90))
        rows.append(doc(2000 + i, " | ".join(t.split()) if i % 8 == 0 else t + " " + items[1][1] if i % 9 == 0 else t, f"s{i % 4}"))
    rows += [doc(3000 + i, rows[60][1], "s1") for i in range(30)]
    labels = [(2000 + i, int(i % 8 != 0), 0) for i in range(0, 200) if i % 3]
    frame(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, rows, items


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_stage_matches_its_brute_force(spark, tables):
    d, rows, items = tables
    docs = frame(spark, rows)
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality classifier", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights",
                           "token-ID / binary output"]
    kept = steps["quality classifier"](spark, docs, d)
    rejected = {r["id"] for r in quality.score(docs, spark.read.parquet(f"{d}/labels.parquet")).where("NOT accepted").collect()}
    accepted = {r["id"] for r in quality.score(docs, spark.read.parquet(f"{d}/labels.parquet")).where("accepted").collect()}
    want = sorted((tuple(r) for r in rows if r[0] is None or r[0] not in rejected - accepted), key=str)
    assert as_rows(kept) == want and kept.columns == docs.columns and len(want) < len(rows)

    one = steps["SimHash near-dedup"](spark, frame(spark, want), d)
    smallest = {c for i, _, c in brute_classes(want) if i is not None}
    got = as_rows(one)
    first = {}
    for r in sorted(want, key=lambda r: [(x is not None, x if x is not None else 0) for x in r]):
        first.setdefault(r[0], r)
    assert [r for r in got if r[0] is not None] == sorted((r for i, r in first.items() if i in smallest), key=str)
    assert [r for r in got if r[0] is None] == [r for r in want if r[0] is None]

    clean = steps["benchmark decontamination"](spark, frame(spark, got), d)
    hit = {h[0] for h in brute_hits(got, items, 10) if h[2]}
    left = [r for r in got if r[0] not in hit]
    assert as_rows(clean) == left and hit

    mixed = steps["mixing sources to target weights"](spark, frame(spark, left), d)
    copies = {(r["id"], r["source"], r["size"]): r["copies"] for r in mixing.mix(frame(spark, left)).collect()}
    repeated = sorted((r for r in left for _ in range(copies[r[0], r[3], len((r[1] or "").split())])), key=str)
    assert as_rows(mixed) == repeated and mixed.columns == docs.columns

    out = steps["token-ID / binary output"](spark, frame(spark, repeated).coalesce(1), d).collect()
    assert sum(r["n_tokens"] for r in out) == sum(len(t) for t in tokens_of(repeated))
    assert {i for r in out for i in r["doc_ids"]} == {r[0] for r in repeated}
    assert sorted(r["slot"] for r in out) == list(range(len(out)))


def test_run_is_the_stages_one_after_another(spark, tables):
    d, rows, _ = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, d)
    pick = lambda df: (sum(r["n_tokens"] for r in df.collect()), {i for r in df.collect() for i in r["doc_ids"]})
    assert pick(corpus_pipeline.run(spark, d)) == pick(docs)


def test_empty_documents_pass(spark, tables):
    d, _, _ = tables
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
    assert docs.count() == 0


def test_stages_keep_columns_of_any_name(spark, tables):
    d, rows, _ = tables
    names = {"lang": "_rank", "n_chars": "N_HIT"}
    odd = frame(spark, rows + rows[60:64]).selectExpr("*", "map('b', doc_id, 'a', 1L) AS `tags.x`", "1 AS size", "2 AS `item_ids`", "3 AS rank")
    odd = odd.withColumnsRenamed(names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, d)
        assert out.columns == odd.columns and out.count() > 0, name
    assert out.select("`tags.x`").first()[0] is not None
