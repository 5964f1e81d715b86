import base64
import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from strata.llm import secret_scan
from tests.llm.fixtures import doc, frame, odd_documents, prose

BASE = [(0, r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
        (1, r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), (2, r"[0-9a-f]+", lambda m: len(m.group()) >= 32)]


def brute(text):
    out = [(m.start(), k, m.end()) for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m)]
    return sorted(out)


def tricky():
    h = "0123456789abcdef" * 3
    return ["token=secret: abcdefgh12", 'PassWord" : "hunter2hunter2', "api_key='short' apikey=longenough1", "secret=token=abcdefgh12", "xAKIAAKIA" + "A1" * 7,
            "AKIA", "AKIA1234567890A", "AKIA1234567890AB.", h[:31], h[:32], "é\U0001f600 token = " + h + " " + h[:40] + "g", "passwd:=x passwd=  a.b+c/d=e-f",
            "ſecret=abcdefghij toKen=abcdefghij", (h + " ") * 300, "A" * 30_000 + " token=ABCDEFGH1"]


def test_rules_match_brute_force(spark):
    rows = odd_documents() + [doc(2000 + i, t) for i, t in enumerate(tricky())] + [doc(3000, " | ".join(tricky()))]
    got = secret_scan.scan(frame(spark, rows).selectExpr("*", "1 AS base", "2 AS row")).collect()
    have = sorted(((r["id"], [(s["start"], s["kind"], s["end"]) for s in r["base"]]) for r in got), key=str)
    assert have == sorted(((r[0], brute(r[1])) for r in rows), key=str)
    texts = {r[0]: r[1] for r in rows}
    assert all(texts[r["id"]][s["start"]:s["end"]] == s["text"] for r in got for s in [*r["base"], *r["added"]])


def test_random_strings_are_found_and_words_are_not(spark):
    rng = random.Random(1)
    keys = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(40)]
    keys += ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(32)) for _ in range(40)]
    keys += [rng.randbytes(20).hex().upper() for _ in range(40)]
    plain = ["".join(prose(rng, 9).split())[:40] for _ in range(300)] + ["=" * 4 + "-" * 60, "a" * 40, "ab" * 30, "0" * 25, "abcdefghijklmnopqrstuvwxyz0123456789",
                                                                     "/usr/local/share/lib/modules/common", "very_long_snake_case_identifier_name"]
    rows = [doc(i, f"see {k} here") for i, k in enumerate(keys)] + [doc(1000 + i, f"see {k} here") for i, k in enumerate(plain)]
    got = {r["id"]: r["added"] for r in secret_scan.scan(frame(spark, rows)).collect()}
    assert sum(bool(got[i]) for i in range(len(keys))) >= 0.95 * len(keys)
    assert sum(bool(got[1000 + i]) for i in range(len(plain))) <= 0.03 * len(plain)


def test_tests_are_flat_for_random_strings(spark):
    rng = random.Random(7)
    rows = [("".join(rng.choice("0123456789abcdef") for _ in range(64)),) for _ in range(600)]
    got = secret_scan.tested(spark.createDataFrame(rows, "text string")).agg(
        *[F.avg((F.col(c) < 0.05).cast("int")).alias(c) for c in ("chi_p", "runs_p", "serial_p", "p")]).first()
    assert all(0.01 <= got[c] <= 0.09 for c in ("chi_p", "runs_p", "serial_p")) and got["p"] <= 0.1


def test_cut_is_the_step_up_rule(spark):
    rng = random.Random(3)
    ps = [rng.random() for _ in range(200)] + [10 ** -rng.uniform(3, 12) for _ in range(100)]
    rows = [(f"{i:040d}", p) for i, p in enumerate(ps)]
    mean, last = secret_scan.cut(spark.createDataFrame(rows, "text string, p double"), 0.05)
    ranked = sorted(ps)
    k = max((i + 1 for i, p in enumerate(ranked) if p <= 0.05 * (i + 1) / len(ps)), default=0)
    out = spark.createDataFrame(rows, "text string, p double").where(secret_scan._cell(F.col("p"), mean) <= last).count()
    assert mean == 40 and k - 3 <= out <= k


def test_empty(spark):
    assert secret_scan.scan(frame(spark, [])).count() == 0


def test_work_is_linear_in_the_matches(spark):
    n = 200_000
    text = "token=abcdefgh " * (n // 2) + "ABCDEFGHIJKLMNOPQRST0123 " * (n // 2)
    df = frame(spark, [doc(1, text)]).cache()
    df.count()
    start = time.monotonic()
    r = secret_scan.find(df).selectExpr("size(base) AS b", "size(candidates) AS c", "base[99999].start AS s", "candidates[99999].end AS e").first()
    assert tuple(r) == (n // 2, n // 2, 15 * 99_999, len(text) - 1)
    assert time.monotonic() - start < 10


def test_candidates_lie_outside_the_base_spans(spark):
    rng = random.Random(11)
    words = [lambda: "token=" + rng.choice("abXY12") * rng.randint(5, 30), lambda: rng.randbytes(rng.randint(9, 40)).hex(),
             lambda: "AKIA" + "Q7" * rng.randint(4, 20), lambda: base64.b64encode(rng.randbytes(rng.randint(9, 60))).decode(), lambda: "word"]
    rows = [doc(i, rng.choice([" ", "", "+"]).join(rng.choice(words)() for _ in range(rng.randint(0, 700)))) for i in range(40)]
    for r, (_, text, *_) in zip(secret_scan.find(frame(spark, rows)).orderBy("id").collect(), rows, strict=True):
        runs = [(m.start(), m.end()) for m in re.finditer(secret_scan.CANDIDATE, text)]
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == brute(text)
        assert [(s["start"], s["end"]) for s in r["candidates"]] == [x for x in runs if not any(a <= x[0] and x[1] <= b for a, _, b in brute(text))]


def test_query_matches_brute_force(spark):
    from strata.llm import queries

    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.Q["op6_secrets"](spark, d).collect()
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        base = [(s, secret_scan.KINDS[k], e) for s, k, e in brute(texts[r["doc_id"]])]
        said = ",".join(f"{k}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == k for x in base) for k in secret_scan.KINDS[:3]]
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))
