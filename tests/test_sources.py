"""Typed and generic scans, schema-evolving batch log, tables and scratch
folders, on invented lighthouse messages."""

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from strata import session
from strata.operators.checks import check_not_null
from strata.sources import evolve, files
from strata.sources.table import Table


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture
def batches(tmp):
    early = write(f"{tmp}/early.csv", "msg,lamp,kind,at\nm-a,17,lit,2031-09-01T19:02:00\n")
    later = write(f"{tmp}/later.csv", "msg,lamp,kind,at,keeper\nm-b,17,dim,2031-09-04T22:40:00,Oda\n")
    arrays = write(f"{tmp}/nested.json", json.dumps([
        {"msg": "m-c", "lamp": 17, "kind": "lit", "at": "2031-09-09T19:10:00", "keeper": "Oda", "link": {"radio": "vhf9", "gain": 4}},
        {"msg": "m-d", "lamp": 23, "kind": "fault", "at": "2031-09-09T19:11:00", "keeper": "Rui", "link": None}], indent=1))
    return [(early, "csv", {"header": True}, "e"), (later, "csv", {"header": True}, "l"), (arrays, "json", {"multiLine": True}, "n")]


CASTS, STAMPS = {"lamp": "string"}, {"at": None}


def test_first_batch_alone_keeps_id_as_string(spark, tmp, batches):
    evolve.ingest_batches(spark, batches[:1], f"{tmp}/log", CASTS, STAMPS)
    assert rows(evolve.BatchLog(spark, f"{tmp}/log").read(), "lamp") == [("17",)]


def test_three_batches_evolve_and_rerun_adds_nothing(spark, tmp, batches):
    log = f"{tmp}/log"
    assert evolve.ingest_batches(spark, batches, log, CASTS, STAMPS) == ["e", "l", "n"]
    assert evolve.ingest_batches(spark, batches, log, CASTS, STAMPS) == []
    df = evolve.BatchLog(spark, log).read()
    assert df.schema["at"].dataType == T.TimestampType()
    out = evolve.select_tolerant(df, {"msg": "msg", "keeper": "keeper", "radio": "link.radio", "missing": "link.mast"})
    got = {r["msg"]: (r["keeper"], r["radio"], r["missing"]) for r in out.collect()}
    assert got == {"m-a": (None, None, None), "m-b": ("Oda", None, None), "m-c": ("Oda", "vhf9", None), "m-d": ("Rui", None, None)}


def test_type_conflict_raises_before_write(spark, tmp, batches):
    log = evolve.BatchLog(spark, f"{tmp}/log")
    evolve.ingest_batches(spark, batches[:1], f"{tmp}/log", CASTS, STAMPS)
    with pytest.raises(evolve.SchemaConflictError):
        log.append(spark.createDataFrame([("m-z", 1)], "msg string, lamp long"), "z")
    assert not log.has("z")


def test_half_written_batch_is_not_read(spark, tmp):
    log = evolve.BatchLog(spark, f"{tmp}/log")
    log.append(spark.createDataFrame([(1, "a")], "id int, v string"), "b1")
    log.append(spark.createDataFrame([(2, "b")], "id int, v string"), "b2")
    os.remove(f"{tmp}/log/batch_id=b2/_SUCCESS")  # the writer died before its commit
    assert not log.has("b2") and rows(log.read(), "id") == [(1,)]
    assert log.append(spark.createDataFrame([(2, "b")], "id int, v string"), "b2")
    assert rows(log.read(), "id") == [(1,), (2,)]
    os.remove(f"{tmp}/log/batch_id=b1/_SUCCESS"), os.remove(f"{tmp}/log/batch_id=b2/_SUCCESS")
    assert log.read().count() == 0


def test_evolve_union_nested_fields(spark):
    a = spark.createDataFrame([(1, (1, "x"))], "id int, s struct<a:int,b:string>")
    b = spark.createDataFrame([(2, (2, "y", 3.0))], "id int, s struct<a:int,b:string,c:double>")
    assert rows(evolve.evolve_union(a, b).select("id", "s.c")) == [(1, None), (2, 3.0)]
    with pytest.raises(evolve.SchemaConflictError):
        evolve.evolve_union(a, spark.createDataFrame([("z",)], "id string"))


def test_read_typed_does_not_enforce_not_null_and_nulls_malformed(spark, tmp):
    p = write(f"{tmp}/s.csv", "id,n\na,1\n,2\nc,x\n")
    df = files.read_typed(spark, p, T.StructType([T.StructField("id", T.StringType(), False), T.StructField("n", T.IntegerType())]))
    assert df.count() == 3 and dict(rows(check_not_null(df))) == {"id": 1, "n": 1}


def test_normalize_safe_timestamps(spark):
    df = spark.createDataFrame([("2031-01-01T00:00:00",), ("garbage",)], "ts string")
    assert [r[0] is None for r in files.normalize(df, timestamps={"ts": None}, safe=True).collect()] == [False, True]


def test_table_snapshots_create_only_and_versions(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    assert not t.exists()
    t.publish(spark.range(3))
    with pytest.raises(FileExistsError):
        t.publish(spark.range(2), if_exists="error")
    t.publish(spark.range(5))
    assert t.versions() == [1, 2] and t.read().count() == 5 and t.read(1).count() == 3


def test_table_ignores_uncommitted_snapshot(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    t.publish(spark.range(3))
    os.makedirs(f"{tmp}/t/snap=000002")  # a crashed writer: no _SUCCESS
    assert t.current_version() == 1
    assert t.publish(spark.range(4)) == 3 and t.read().count() == 4


def test_partitioned_publish_prunes(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    t.publish(spark.range(20).withColumn("day", (F.col("id") % 4).cast("int")), partition_by=["day"], sort_by=["id"])
    q = t.read().where("day = 2")
    assert "PartitionFilters: [isnotnull(day" in q._jdf.queryExecution().executedPlan().toString() and q.count() == 5


def test_batch_log_nested_evolution_and_schema_heal(spark, tmp):
    log = evolve.BatchLog(spark, f"{tmp}/log")
    log.append(spark.createDataFrame([(1, (1,))], "id int, s struct<a:int>"), "b1")
    log.append(spark.createDataFrame([(2, (2, "x"))], "id int, s struct<a:int,b:string>"), "b2")
    assert rows(log.read().select("id", "s.a", "s.b")) == [(1, 1, None), (2, 2, "x")]
    # a crash after the data commit but before the schema update: a re-send heals it
    spark.createDataFrame([(3, 3.5)], "id int, extra double").write.parquet(f"{tmp}/log/batch_id=b3")
    assert "extra" not in log.read().columns
    assert log.append(spark.createDataFrame([(3, 3.5)], "id int, extra double"), "b3") is False
    assert rows(log.read().where("id = 3").select("extra")) == [(3.5,)]


def test_partition_column_type_survives_round_trip(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    t.publish(spark.createDataFrame([("2031-01-03", 1), ("2031-01-04", 2)], "day string, v int"), partition_by=["day"])
    assert t.read().schema["day"].dataType == T.StringType()


def test_sizing_follows_the_shuffled_bytes_up_to_a_bound():
    count = lambda b: int(session.sizing_conf(b)["spark.sql.shuffle.partitions"])
    assert count(10 << 20) == 200 and 8_000 < count(10 << 40) < 9_000 and count(1 << 50) == 50_000


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = spark.sparkContext.getCheckpointDir()
    assert root and session.checkpoint_root(spark) == root
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a.startswith(root.rstrip("/") + "/strata-scratch/") and a != b


def test_cluster_without_a_shared_folder_raises():
    unset = SimpleNamespace(get=lambda key, default=None: default)
    for master, fails in (("yarn", True), ("spark://h:7077", True), ("local-cluster[2,1,1024]", True), ("local[*]", False), ("local", False)):
        made = []
        sc = SimpleNamespace(master=master, getConf=lambda: unset, getCheckpointDir=lambda made=made: made[-1] if made else None,
                             setCheckpointDir=made.append)
        if fails:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                session.checkpoint_root(SimpleNamespace(sparkContext=sc))
        else:
            assert session.checkpoint_root(SimpleNamespace(sparkContext=sc)) == made[0]
