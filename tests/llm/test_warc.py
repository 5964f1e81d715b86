import gzip
import hashlib
import io
import os
import random

from strata.llm import warc
from tests.llm.fixtures import frame, prose

DDL = "page_id long, url string, html string, payload string, key string"


def pages(seed=3):
    rng = random.Random(seed)
    same = prose(rng, 60)
    rows = [(i, f"http://x.test/{i}", prose(rng, rng.randint(0, 80)), "clash", "clash") for i in range(60)]
    rows += [(i, f"http://y.test/{i}", same, None, None) for i in range(200, 180, -1)]
    rows += [(300, None, None, None, None), (301, "http://a b\r\nc", "", None, None), (302, "u", "tiny", None, None), (303, "u", "tiny", None, None),
             (None, "http://n", same, None, None), (304, "l", "x" * 300_000, None, None), (190, "again", same, None, None)]
    return rows


def brute(rows, least=100):
    first, out = {}, []
    for r in rows:
        body = (r[2] or "").encode()
        if r[0] is not None:
            first[body] = min(first.get(body, r[0]), r[0])
    seen = set()
    for r in rows:
        body = (r[2] or "").encode()
        f = first.get(body)
        again = len(body) >= least and r[0] is not None and (f != r[0] or (r[0], body) in seen)
        seen.add((r[0], body))
        out.append((r[0], len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def read_back(manifest, path):
    got = warc.read(manifest, path, with_payload=True).collect()
    return sorted(((r["key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str), got


def test_round_trip_matches_brute_force(spark, tmp):
    rows = pages()
    manifest, path = warc.write(frame(spark, rows, DDL), f"file://{tmp}/w", shard_bytes=4_000, roll_bytes=3_000)
    got, records = read_back(manifest, path)
    assert got == brute(rows)
    by_key = {r[0]: (r[2] or "").encode() for r in rows}
    assert all(bytes(r["payload"]) == by_key[r["key"]] for r in records if r["record_type"] == "response" and r["key"] != 190)
    files = manifest.orderBy("shard", "number").collect()
    assert len(files) > 3 and len({f["file"] for f in files}) == len(files)
    assert all(hashlib.sha256(open(f"{tmp}/w/{f['file']}", "rb").read()).hexdigest() == f["sha256"] for f in files)
    assert not [f for f in os.listdir(f"{tmp}/w") if f.startswith("_temporary-")]


def test_files_depend_on_the_rows_alone(spark, tmp):
    rows = pages()
    one, _ = warc.write(frame(spark, rows, DDL).repartition(7), f"file://{tmp}/a", shard_bytes=4_000)
    two, _ = warc.write(frame(spark, list(reversed(rows)), DDL).coalesce(1), f"file://{tmp}/b", shard_bytes=4_000)
    names = lambda m: {(r["file"], r["sha256"], r["records"]) for r in m.collect()}
    assert names(one) == names(two)


def test_commit_can_run_again(spark, tmp):
    manifest, path = warc.write(frame(spark, pages()[:20], DDL), f"file://{tmp}/w")
    again = spark.read.parquet(f"{path}/_written").mapInArrow(warc._renamer(path), warc.MANIFEST_DDL)
    assert again.count() == manifest.count()


def test_damage_is_noticed(spark, tmp):
    manifest, path = warc.write(frame(spark, [(1, "u", "a" * 200, None, None)], DDL), f"file://{tmp}/w")
    name = f"{tmp}/w/{manifest.first()['file']}"
    data = gzip.decompress(open(name, "rb").read()).replace(b"aaaa", b"aaab", 1)
    with open(name, "wb") as f:
        f.write(gzip.compress(data))
    try:
        warc.read(manifest, path).collect()
        raise AssertionError("the change went unnoticed")
    except Exception as e:  # noqa: BLE001 - Spark wraps the reader's error
        assert "differs" in str(e)


def test_records_are_plain_warc():
    data = warc.record(5, "http://x", b"hello", hashlib.sha256(b"hello").hexdigest())
    [(headers, block)] = list(warc.parse(io.BytesIO(data)))
    assert headers["WARC-Type"] == "response" and block.endswith(b"\r\n\r\nhello") and int(headers["Content-Length"]) == len(block)


def test_empty_table(spark, tmp):
    manifest, path = warc.write(frame(spark, [], DDL), f"file://{tmp}/w")
    assert manifest.count() == 0 and warc.read(manifest, path).count() == 0


def test_record_ids_are_unique(spark, tmp):
    rows = pages() + [(None, "http://n", "n" * 200, None, None)] * 3 + [(190, "again", pages()[70][2], None, None)] * 2 + [(302, "u", "tiny", None, None)]
    manifest, path = warc.write(frame(spark, rows, DDL), f"file://{tmp}/w", shard_bytes=4_000, roll_bytes=3_000)
    ids, refers = [], []
    for f in manifest.collect():
        with gzip.open(f"{tmp}/w/{f['file']}") as s:
            for headers, _ in warc.parse(io.BytesIO(s.read())):
                ids.append(headers["WARC-Record-ID"])
                refers.append((headers["WARC-Record-ID"], headers.get("WARC-Refers-To")))
    assert len(ids) == len(rows) == len(set(ids))
    assert all(to is None or to in ids and to != own for own, to in refers)


def test_files_end_by_rolling_and_shards_hold_equal_bytes(spark, tmp):
    rng = random.Random(6)
    rows = [(i, "u", "".join(chr(rng.randrange(33, 126)) for _ in range(20_000 if i < 40 else 200)), None, None) for i in range(400)]
    manifest, path = warc.write(frame(spark, rows, DDL), f"file://{tmp}/w", shard_bytes=200_000, roll_bytes=50_000)
    files = manifest.collect()
    shards = {f["shard"] for f in files}
    assert len(files) > len(shards) > 1 and sum(f["records"] for f in files) == len(rows)
    per_shard = {s: sum(f["bytes"] for f in files if f["shard"] == s) for s in shards}
    assert max(per_shard.values()) < 2 * sum(per_shard.values()) / len(shards)  # the 40 long pages do not make one long task
    assert all(f["bytes"] < 50_000 + 25_000 for f in files)


def test_payloads_are_shuffled_once_however_many_revisits(spark, tmp, monkeypatch):
    seen = []
    plain = warc.small_batches
    monkeypatch.setattr(warc, "small_batches", lambda df: seen.append(df) or plain(df))
    rows = [(i, "u", f"{i % 7}" * 500, None, None) for i in range(100)]
    manifest, path = warc.write(frame(spark, rows, DDL), f"file://{tmp}/w")
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    got, _ = read_back(manifest, path)
    assert got == brute(rows)
