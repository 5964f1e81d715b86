import random
import re
import tracemalloc

from strata.llm import decontaminate
from tests.llm.fixtures import doc, frame, odd_documents, prose


def words(t):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, size):
    pats = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            for s in range(max(1, len(w) - size + 1)):
                pats.setdefault(tuple(w[s:s + size]), set()).add(i)
    out = []
    for r in docs:
        w, hit, ids = words(r[1]), set(), set()
        for n in {len(p) for p in pats}:
            for s in range(len(w) - n + 1):
                found = pats.get(tuple(w[s:s + n]))
                if found:
                    hit |= set(range(s, s + n))
                    ids |= found
        out.append((r[0], len(w), len(hit), tuple(sorted(ids))))
    return sorted(out, key=str)


def bench(rng):
    items = [(i, prose(rng, rng.randint(11, 40))) for i in range(12)]
    items += [(50, "ka lo MI"), (51, "ka"), (52, ""), (53, None), (None, "lo mi"), (50, "ten vor ten vor ten"), (54, items[3][1]), (55, "café ẞ")]
    return items


def test_matches_brute_force(spark):
    rng = random.Random(4)
    items, docs = bench(rng), odd_documents()
    for k in range(10):
        t = items[k][1].split()
        docs.append(doc(900 + k, prose(rng, 20) + "!! " + ", ".join(t[1:9 + k]).upper() + " - " + prose(rng, 20)))
    docs.append(doc(950, " ".join(items[0][1].split() * 3)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size, block in ((10, 32 << 20), (3, 700)):  # the second takes several passes
        got = decontaminate.scan(frame(spark, docs).withColumnRenamed("source", "hits"), benchmark, size, block_bytes=block).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in got), key=str) == brute(docs, items, size)
        assert all(sum(r["hits"]) == r["n_hit"] and len(r["hits"]) == r["n_words"] for r in got)


def test_shift_tables_jump():
    t = decontaminate.Tables([(b"a b c d e f", 1), (b"x y", 2)])
    assert t.jump(6, b"q", b"a") == 5 and t.jump(6, b"e", b"f") == 0 and t.jump(6, b"a", b"b") == 4
    assert [(s, e) for s, e, _ in t.search(b"q a b c d e f x y".split())] == [(7, 9), (1, 7)]


def test_clean_and_empty(spark):
    rng = random.Random(6)
    items = [(1, prose(rng, 30))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = odd_documents() + [doc(800, prose(rng, 5) + " " + items[0][1])]
    docs = frame(spark, rows).withColumnRenamed("n_chars", "n_hit")
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(docs, none).count() == len(rows)
    assert decontaminate.scan(frame(spark, []), benchmark).count() == 0


def test_tables_of_a_full_block_stay_small():
    rng = random.Random(12)
    vocabulary = [f"word{i}".encode() for i in range(20_000)]
    patterns = []
    for item in range(400):
        w = [rng.choice(vocabulary) for _ in range(200)]
        patterns += [(b" ".join(w[i:i + 10]), item) for i in range(191)]
    text = sum(len(p) + 64 for p, _ in patterns)
    tracemalloc.start()
    tables = decontaminate.Tables(patterns)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < text, (held, text)  # 32 MB of patterns take less than 32 MB
    assert all(tables.jump(10, *p.split(b" ")[-2:]) == 0 for p, _ in patterns[:500:50])
    found = {(s, e, i) for s, e, i in tables.search([b"x", *patterns[0][0].split(b" "), b"y"])}
    assert found == {(1, 11, (0,))}


def test_search_against_brute_force_on_a_small_vocabulary():
    rng = random.Random(13)
    for _ in range(60):
        patterns = {(b" ".join(rng.choice([b"a", b"b", b"c"]) for _ in range(rng.choice([1, 2, 3, 5]))), rng.randrange(4)) for _ in range(12)}
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randrange(40))]
        want = {(s, s + len(p.split(b" ")), i) for p, i in patterns for s in range(len(words)) if words[s:s + len(p.split(b" "))] == p.split(b" ")}
        got = [(s, e, i) for s, e, ids in decontaminate.Tables(list(patterns)).search(words) for i in ids]
        assert set(got) == want and len(got) == len(want)
