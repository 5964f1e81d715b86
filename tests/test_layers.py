"""Mergeable state, type widening, layered tables, late loads, scans and digests on small invented tables."""

import datetime as dt
import glob
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import checks, dims, facts, metrics, partitions, skew
from strata.operators.register import REGISTER, event_register, merge_registers, register_state
from strata.operators.state import consolidate_state
from strata.sources import evolve
from strata.sources.table import BUCKET, BrokenContract, Table
from tests.conftest import rows

REPORT = "rep long, boat string, berth string, flag string, seen timestamp, via string"


def reports(seed):
    rng = random.Random(seed)
    days = [None] + [dt.datetime(2031, 1, d) for d in range(1, 6)]
    out = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, "b1", "b2", "b3"]), rng.choice([None, "f1", "f2"]),
            rng.choice(days), rng.choice(["gps", "log", None])) for i in range(120)]
    out += [(200 + i, *r[1:]) for i, r in enumerate(out[::7])]  # sent again under a new id
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_registers_merged_in_any_order_give_the_consolidated_state(spark, tmp, seed):
    args = (["boat"], ["berth", "flag"], "seen", "via", ["gps"], "rep")
    events = reports(seed)
    want = rows(consolidate_state(spark.createDataFrame(events, REPORT), *args))
    t = Table(spark, f"{tmp}/state{seed}")
    for i in (2, 0, 3, 1, 0):  # late, then one batch again
        batch = spark.createDataFrame(events[i::4], REPORT)
        t.upsert(event_register(batch, *args), ["boat"], buckets=3, combine={REGISTER: lambda a, b: merge_registers(a, b, 2)})
    assert rows(register_state(t.read(), ["boat"], ["berth", "flag"], "seen", "via", "rep")) == want
    v = t.current_version()
    t.upsert(event_register(spark.createDataFrame(events[1::4], REPORT), *args), ["boat"], combine={REGISTER: lambda a, b: merge_registers(a, b, 2)})
    assert t.current_version() == v  # a replayed batch writes nothing


def test_types_meet_in_the_lattice():
    meet = evolve.merge_schemas
    assert meet(T.IntegerType(), T.LongType()) == T.LongType() == meet(T.LongType(), T.ShortType())
    assert meet(T.LongType(), T.DecimalType(12, 2)) == T.DecimalType(22, 2)
    assert meet(T.DecimalType(10, 4), T.DecimalType(12, 2)) == T.DecimalType(14, 4)
    assert meet(T.DecimalType(38, 0), T.DecimalType(38, 20)) == T.DoubleType() == meet(T.FloatType(), T.IntegerType())
    assert meet(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType() and meet(T.NullType(), T.StringType()) == T.StringType()
    assert meet(T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())).elementType == T.LongType()
    for a, b in ((T.StringType(), T.LongType()), (T.TimestampType(), T.TimestampNTZType()), (T.BooleanType(), T.IntegerType()), (T.DateType(), T.LongType())):
        with pytest.raises(evolve.SchemaConflictError):
            meet(a, b)


def test_batch_log_widens_and_keeps_every_value(spark, tmp):
    log = evolve.BatchLog(spark, f"{tmp}/log")
    log.append(spark.createDataFrame([(5, (1, "x"))], "n int, s struct<a:int,b:string>"), "b1")
    log.append(spark.createDataFrame([(5_000_000_000, (2_500_000_000, "y"), [1])], "n long, s struct<a:long,b:string>, l array<int>"), "b2")
    log.append(spark.createDataFrame([(7,)], "n short"), "b3")  # narrower: cast as it is written
    log.append(spark.createDataFrame([(None, None, [9_000_000_000])], "n long, s struct<a:long,b:string>, l array<long>"), "b4")
    with pytest.raises(evolve.SchemaConflictError):
        log.append(spark.createDataFrame([("z",)], "n string"), "b5")
    assert not log.append(spark.createDataFrame([(5,)], "n int"), "b1") and log.has("b3") and not log.has("b5")
    df = log.read()
    assert (df.schema["n"].dataType, df.schema["l"].dataType) == (T.LongType(), T.ArrayType(T.LongType()))
    got = {r["batch_id"]: (r["n"], r["s"] and r["s"]["a"], r["l"]) for r in df.collect()}
    assert got == {"b1": (5, 1, None), "b2": (5_000_000_000, 2_500_000_000, [1]), "b3": (7, None, None), "b4": (None, None, [9_000_000_000])}
    assert len(log.batches()) == 4


def test_inferred_csv_batches_of_different_width(spark, tmp):
    for name, value in (("d1", "5"), ("d2", "5000000000"), ("d3", "2.5")):
        os.makedirs(f"{tmp}/{name}")
        with open(f"{tmp}/{name}/f.csv", "w") as f:
            f.write(f"id,n\n1,{value}\n")
    batches = [(f"{tmp}/{n}", "csv", {"header": True, "inferSchema": True}, n) for n in ("d1", "d2", "d3")]
    assert evolve.ingest_batches(spark, batches, f"{tmp}/log") == ["d1", "d2", "d3"]
    assert sorted(r["n"] for r in evolve.BatchLog(spark, f"{tmp}/log").read().collect()) == [2.5, 5.0, 5e9]


def test_tolerant_paths_go_through_arrays_and_maps(spark):
    ddl = "id int, items array<struct<Price:double,tags:array<struct<k:string>>>>, meta struct<K:int>, m map<string,struct<v:int>>, `a.b` int"
    df = spark.createDataFrame([(1, [(2.5, [("x",), ("y",)]), (None, None), None], (4,), {"p": (7,), "q": None}, 9), (2, None, None, None, None)], ddl)
    out = evolve.select_tolerant(df, {"id": "ID", "price": "items.price", "tags": "items.tags.k", "k": "meta.k", "p": "m.p.v", "none": "m.zz.v",
                                      "dotted": "a.b", "gone": "items.weight", "deep": "meta.k.z"})
    first, second = out.orderBy("id").collect()
    assert tuple(first) == (1, [2.5, None, None], [["x", "y"], None, None], 4, 7, None, 9, None, None)
    assert tuple(second) == (2, None, None, None, None, None, None, None, None)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert evolve.select_tolerant(df, {"k": "meta.k", "K": "meta.K"}).orderBy("K").collect()[-1] == (None, 4)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    with pytest.raises(evolve.SchemaConflictError):
        evolve.select_tolerant(spark.createDataFrame([((1, 2),)], "s struct<ab:int,AB:int>"), {"x": "s.Ab"})


def files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/snap=*/**/*.parquet", recursive=True)}


def test_bucketed_upsert_writes_its_buckets_only(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    t.upsert(spark.range(400).select("id", F.lit("a").alias("v")), ["id"], buckets=16)
    before = files(f"{tmp}/t")
    assert t.upsert(spark.createDataFrame([(7, "b"), (401, "c"), (None, "n")], "id int, v string"), ["id"]) == 2  # int keys hash as the table's long
    after = files(f"{tmp}/t")
    assert all(after[p] == before[p] for p in before) and len(after) - len(before) <= 3
    got = {r["id"]: r["v"] for r in t.read().collect()}
    assert len(got) == 402 and (got[7], got[8], got[401], got[None]) == ("b", "a", "c", "n") and BUCKET not in t.read().columns
    assert t.upsert(spark.createDataFrame([(None, "n")], "id long, v string"), ["id"]) == 2  # nothing changes
    assert t.read(1).count() == 400 and t.read(1).where("v <> 'a'").isEmpty()
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([("z", 1)], "v string, id long"), ["v"])
    assert t.compact() == 3 and len(t._layers(3)) == 1 and t.read().count() == 402 and t.compact() == 3
    t.upsert(spark.createDataFrame([(1, "a", 5)], "id long, v string, extra int"), ["id"])  # a new column: written as a whole
    assert t.read().count() == 402 and rows(t.read().where("extra is not null"), "id", "extra") == [(1, 5)]


def test_a_crashed_layer_is_ignored(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    t.upsert(spark.range(50).withColumn("v", F.lit(1)), ["id"], buckets=4)
    t.upsert(spark.range(10).withColumn("v", F.lit(2)), ["id"])
    os.remove(f"{tmp}/t/snap=000002/_SUCCESS")
    assert t.versions() == [1] and t.read().where("v = 2").isEmpty()
    assert t.upsert(spark.range(10).withColumn("v", F.lit(2)), ["id"]) == 3 and t.read().where("v = 2").count() == 10


def test_history_times_and_change_feed(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    ddl = "day int, k string, v int"
    t.upsert(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], ddl), ["day", "k"], partition_by=["day"], feed=True, committed_at="2031-01-01 00:00:00")
    t.upsert(spark.createDataFrame([(2, "b", 3), (3, "c", 4)], ddl), ["day", "k"], partition_by=["day"], feed=True, committed_at="2031-01-02T00:00:00+00:00")
    assert rows(t.history(), "version", "operation", "n_inserted", "n_updated") == [(1, "upsert", 2, 0), (2, "upsert", 1, 1)]
    assert t.version_at("2031-01-01 12:00:00") == 1 and t.version_at("2030-12-31 00:00:00") is None
    assert rows(t.read(as_of="2031-01-01 12:00:00").select("day", "k", "v")) == [(1, "a", 1), (2, "b", 2)]
    assert rows(t.read().select("day", "k", "v")) == [(1, "a", 1), (2, "b", 3), (3, "c", 4)]
    assert rows(t.changes(since=1), "day", "k", "v", "_op", "_version") == [(2, "b", 3, "update", 2), (3, "c", 4, "insert", 2)]
    assert t.changes().count() == 4
    with pytest.raises(FileNotFoundError):
        t.read(as_of="2030-01-01 00:00:00")
    with pytest.raises(FileNotFoundError):
        t.changes(since=2)


def test_a_broken_contract_publishes_nothing(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    t.publish(spark.range(5), contracts={"id": "id >= 0"})
    with pytest.raises(BrokenContract, match="'small': 2"):
        t.publish(spark.range(5), contracts={"id": F.col("id").isNotNull(), "small": "id < 3"})
    assert t.versions() == [1] and t.publish(spark.range(2)) == 3


def test_asof_scan_equals_the_range_join(spark):
    rng = random.Random(3)
    ddl = "cust string, level int, valid_from date, valid_to date"
    day = lambda n: dt.date(2031, 1, 1) + dt.timedelta(days=n)
    versions = []
    for c in ("a", "b"):
        cuts = sorted(rng.sample(range(400), 60))
        versions += [(c, i, day(x), day(y)) for i, (x, y) in enumerate(itertools.pairwise(cuts)) if i % 9]  # with gaps
        versions += [(c, 99, day(cuts[-1]), None), (c, 98, day(cuts[0]), day(cuts[0]))]                       # open, and of no length
    versions += [(None, 1, day(0), None), ("c", 5, None, None)]
    jobs = [(i, rng.choice(["a", "a", "a", "b", "c", "d", None]), rng.choice([day(rng.randrange(420)), None])) for i in range(300)]
    dim, fact = spark.createDataFrame(versions, ddl), spark.createDataFrame(jobs, "id int, cust string, on date")
    want = facts.asof_version_join(fact, dim, "cust", "on", ["level"])
    assert rows(facts.asof_scan(fact, dim, "cust", "on", ["level"], partitions=5)) == rows(want)


def test_late_loads_in_any_order_give_one_dimension(spark):
    ddl = "shop string, trade string, quay int"
    loads = {"2031-01-01": [("s1", "fish", 1), ("s2", "rope", 2), ("s3", None, 1)], "2031-02-01": [("s1", "ice", 1), ("s2", "rope", 2)],
             "2031-03-01": [("s1", "fish", 1), ("s2", "rope", 3), ("s4", "tar", 1)]}
    seen = set()
    for order in itertools.permutations(loads):
        dim = None
        for at in order:
            dim = dims.scd2_merge(dim, spark.createDataFrame(loads[at], ddl), "shop", ["trade", "quay"], at)
        got = dim.collect()
        seen.add(tuple(sorted(map(str, got))))
    assert len(seen) == 1
    assert [(r["trade"], str(r["valid_from"]), str(r["valid_to"])) for r in sorted(got, key=lambda r: r["valid_from"]) if r["shop"] == "s1"] == [
        ("fish", "2031-01-01", "2031-02-01"), ("ice", "2031-02-01", "2031-03-01"), ("fish", "2031-03-01", "None")]
    assert checks.check_scd2(spark.createDataFrame(got, dim.schema), "shop").where("n_active <> 1 or n_overlaps > 0 or n_gaps > 0").isEmpty()
    with pytest.raises(dims.NaturalKeyError):
        dims.scd2_merge(None, spark.createDataFrame([("x", "a", 1), ("x", "b", 1)], ddl), "shop", ["trade", "quay"], "2031-01-01")


def test_rerun_digests(spark):
    ddl = "day int, a string, b string, m map<string,int>"
    base = [(1, "x", None, {"k": 1}), (1, "y", "z", None), (2, "x", "x", None), (None, None, None, None)]
    first = spark.createDataFrame(base, ddl)
    same = spark.createDataFrame(base[::-1], ddl).repartition(3).select("m", "b", "a", "day")
    assert checks.check_rerun(first, same, ["day"]).where("not same").isEmpty() and checks.check_rerun(first, same).first()["same"]
    moved = spark.createDataFrame([(1, None, "x", {"k": 1}), *base[1:], base[2], (4, "n", None, None)], ddl)  # a NULL elsewhere, a repeat, a new day
    assert rows(checks.check_rerun(first, moved, ["day"])) == [(1, 2, 2, False), (2, 1, 2, False), (4, 0, 1, False), (None, 1, 1, True)]
    assert not checks.check_rerun(first, moved).first()["same"] and checks.check_rerun(first.limit(0), first.limit(0)).first()["same"]


def test_heavy_hitters_finds_every_key_above_the_share(spark):
    data = [(i % 3 if i % 2 else None, str(i) if i % 5 else "hot") for i in range(5000)]
    df = spark.createDataFrame(data, "k int, w string")
    assert rows(skew.heavy_hitters(df, ["w"], 0.1), "w", "n_rows", "share") == [("hot", 1000, 0.2)]
    assert [r[1] for r in rows(skew.heavy_hitters(df, ["k"], 0.1), "k", "n_rows")] == [sum(1 for d in data if d[0] == k) for k in (0, 1, 2, None)]
    assert skew.heavy_hitters(df, ["k", "w"], 0.09).count() == 1 and skew.heavy_hitters(df.limit(0), ["k"], 0.5).count() == 0


def test_sketches_merge_to_coarser_grains(spark):
    df = spark.range(20_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 2).alias("half"), (F.col("id") % 5000).alias("c"))
    stored = metrics.distinct_sketches(df, ["half", "month"], ["c"])
    got = metrics.sketch_counts(metrics.merge_sketches(stored, ["half"], ["c"]), ["c"]).collect()
    assert [r["n_rows"] for r in got] == [10_000] * 2 and all(abs(r["distinct_c"] - 2500) < 2500 * 0.065 for r in got)


def counted(spark, rows, schema):
    """A frame and a count of how many of its rows were evaluated."""
    seen = spark.sparkContext.accumulator(0)
    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return spark.createDataFrame(rows, schema).mapInArrow(count, schema), seen


def test_loads_and_overwrites_evaluate_their_input_once(spark, tmp):
    base = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    dim = dims.scd2_init(base, "k", ["v"], "t1")
    load, seen = counted(spark, [("a", "z"), ("c", "w")], "k string, v string")
    out = dims.scd2_apply(dim, load, "k", ["v"], "2031-02-01", "t2", close_missing=True)
    assert out.count() == 4 and out.where("is_current").count() == 2 and seen.value == 2
    path = f"file://{tmp}/t"
    partitions.overwrite_table(base, path, ["k"])
    batch, seen = counted(spark, [("a", "1"), ("b", "2"), ("c", "3")], "k string, v string")
    partitions.overwrite_table(batch, path, ["k"])
    assert spark.read.parquet(path).count() == 3 and seen.value == 3
    batch, seen = counted(spark, [("a", "9")], "k string, v string")
    assert partitions.replace_where(base, batch, "k = 'a'").count() == 2 and seen.value == 1


def test_scratch_run_removes_what_it_staged(spark):
    from strata.session import scratch_path, scratch_run, staged

    outside = staged(spark.range(3), "outside")
    with scratch_run(spark) as outer:
        kept = staged(spark.range(5), "inside")
        with scratch_run(spark) as inner:
            assert inner.startswith(outer + "/") and staged(spark.range(7), "nested").count() == 7
        assert not os.path.exists(inner.removeprefix("file:")) and kept.count() == 5
    assert not os.path.exists(outer.removeprefix("file:")) and outside.count() == 3
    try:
        with scratch_run(spark) as failed:
            staged(spark.range(2), "x")
            raise KeyError("stop")
    except KeyError:
        assert not os.path.exists(failed.removeprefix("file:"))
    assert "/run-" not in scratch_path(spark, "after")
