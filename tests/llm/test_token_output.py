import hashlib
import os

import numpy as np
import pytest

from strata.llm import token_output
from tests.llm.fixtures import frame, odd_documents


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        slots = token_output.feistel_slots(np.arange(n), n, 7)
        assert sorted(slots) == list(range(n))
    a, b = (token_output.feistel_slots(np.arange(1000), 1000, k) for k in (1, 2))
    assert (a != b).mean() > 0.9 and abs(np.corrcoef(np.arange(1000), a)[0, 1]) < 0.15
    assert np.array_equal(token_output.feistel_slots(np.arange(1000)[500:], 1000, 1), a[500:])


def tokens_of(rows):
    enc = token_output.encoding(token_output.VOCABULARY)
    return sorted([*enc.encode_ordinary(r[1] or ""), token_output.END_ID] for r in rows)


def test_round_trip(spark, tmp, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_SEQUENCES", 7)
    rows, stride, per = odd_documents(), 64, 50
    docs = frame(spark, rows).selectExpr("*", "1 AS slot", "2 AS ids").repartition(5)
    sequences, manifest, path = token_output.materialise(docs, f"file://{tmp}/t", stride, per)
    got = sequences.collect()
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    by_slot, records = {r["slot"]: r for r in got}, {}
    for f in manifest.collect():
        data = open(f"{tmp}/t/{f['file']}", "rb").read()
        assert len(data) == f["bytes"] == f["n_sequences"] * 2 * stride and hashlib.sha256(data).hexdigest() == f["sha256"]
        assert f["n_sequences"] == min(per, len(got) - f["first_slot"])
        for k in range(f["n_sequences"]):
            records[f["first_slot"] + k] = data[k * 2 * stride:(k + 1) * 2 * stride]
    assert all(hashlib.sha256(records[s]).hexdigest() == r["sha256"] for s, r in by_slot.items())

    # back in the order of packing the records hold every document's ids, and each sequence names its documents
    ids_of, texts = {}, {}
    for r in rows:
        ids_of.setdefault(r[0], []).append([*token_output.encoding(token_output.VOCABULARY).encode_ordinary(r[1] or ""), token_output.END_ID])
    found = []
    for part in sorted({r["part"] for r in got}):
        at, document = [], []
        for r in sorted((r for r in got if r["part"] == part), key=lambda r: r["chunk"]):
            ids = np.frombuffer(records[r["slot"]], "<u2")[:r["n_tokens"]].tolist()
            named, texts = list(r["ids"]), []
            for k, x in enumerate(ids):
                document.append(x)
                if x == token_output.END_ID:
                    found.append(document)
                    texts.append(document)
                    document = []
            assert len(named) == len(texts) + bool(document)
            assert all(t in ids_of[i] for t, i in zip(texts, named, strict=False))
            at.append(r["chunk"])
        assert not document and at == list(range(len(at)))
    assert sorted(found) == tokens_of(rows)

    s = len(got) // 2  # a fixed stride: the place of a slot follows from its number
    with open(f"{tmp}/t/{token_output.shard_name(s // per)}", "rb") as f:
        f.seek(s % per * 2 * stride)
        assert f.read(2 * stride) == records[s]
    for start in (0, s):
        read = {r["slot"]: r["ids_sha256"] for r in token_output.read_slots(manifest, path, stride, start).collect()}
        assert read == {k: v["sha256"] for k, v in by_slot.items() if k >= start}
    assert not [x for x in os.listdir(f"{tmp}/t") if x.startswith("_temporary-")]


def test_order_depends_on_the_key_alone(spark):
    docs = frame(spark, odd_documents()).coalesce(2)
    order = lambda k: sorted(map(str, token_output.materialise(docs, stride=64, shard_sequences=50, key=k)[0].collect()))
    assert order(1) == order(1) != order(2)


def test_empty(spark):
    sequences, manifest, path = token_output.materialise(frame(spark, []))
    assert sequences.count() == 0 and manifest.count() == 0 and token_output.read_slots(manifest, path, 1024).count() == 0


def test_lost_and_changed_records_raise(spark, tmp):
    docs = frame(spark, odd_documents())
    sequences, manifest, path = token_output.materialise(docs, f"file://{tmp}/t", 64, 50)
    read = token_output.read_back(sequences, manifest, path, 64)
    assert read.count() == sequences.count() and read.where("sha256 <> ids_sha256").count() == 0
    assert "Broadcast" not in read._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="is lost or differs"):
        token_output.read_back(sequences, manifest.where("shard <> 1"), path, 64).collect()
    name = f"{tmp}/t/{token_output.shard_name(0)}"
    data = bytearray(open(name, "rb").read())
    data[5] ^= 1
    with open(name, "wb") as f:
        f.write(data)
    with pytest.raises(Exception, match="is lost or differs"):
        token_output.read_back(sequences, manifest, path, 64).collect()
