"""Upserts, metrics at a grain and partition replacement, on invented data:
fishing hauls, well readings and ferry departures."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strata.operators import merge, metrics, partitions
from strata.sources.table import Table

HAUL = "haul string, boat string, port string, gear string, fish string, day date, legal boolean, kg int"


def d(s):
    return dt.date.fromisoformat(s)


HAULS = [
    ("h1", "Heron", "Aveiro", "net", "sole", d("2031-03-04"), True, 40),
    ("h2", "Heron", "Aveiro", "net", "sole", d("2031-03-09"), True, 55),
    ("h3", "Gull", "Aveiro", "net", "sole", d("2031-03-30"), False, 10),
    ("h4", "Gull", "Aveiro", "line", "sole", d("2031-03-11"), None, 5),
    ("h5", "Tern", "Vardo", "net", "cod", d("2031-04-01"), False, 300),
    ("h6", "Tern", "Vardo", "net", "cod", d("2031-04-02"), False, 100),
]
GRAIN = ["port", "gear", "fish", "month"]
METRICS = [("hauls", "count", "haul"), ("legal", "count_true", "legal"), ("legal_pct", "rate_pct", "legal"),
           ("mean_kg", "mean", "kg"), ("boats", "count_distinct", "boat")]


def gold(df):
    return metrics.rollup_metrics(df, GRAIN, METRICS, month_of={"month": "day"}, digits=2)


def test_metrics_at_the_grain(spark):
    out = {(r["port"], r["gear"]): r for r in gold(spark.createDataFrame(HAULS, HAUL)).collect()}
    r = out["Aveiro", "net"]
    assert (r["hauls"], r["legal"], r["legal_pct"], r["mean_kg"], r["boats"], r["month"]) == (3, 2, 66.67, 35.0, 2, d("2031-03-01"))
    r = out["Aveiro", "line"]
    assert (r["hauls"], r["legal"], r["legal_pct"]) == (1, None, None)  # a NULL flag leaves the denominator
    r = out["Vardo", "net"]
    assert (r["hauls"], r["legal_pct"], r["mean_kg"], r["boats"]) == (2, 0.0, 200.0, 1)


def test_rerun_and_null_month_do_not_duplicate(spark, tmp):
    t = Table(spark, f"{tmp}/gold")
    one = spark.createDataFrame([HAULS[0], ("x", "Auk", "Wick", "pot", "crab", None, True, 5)], HAUL)
    t.upsert(gold(one), GRAIN)
    t.upsert(gold(one), GRAIN)
    assert t.read().count() == 2 and t.versions() == [1]  # the NULL month matches itself, nothing is written again
    t.upsert(gold(spark.createDataFrame(HAULS[:2], HAUL)), GRAIN)
    assert rows(t.read().where("port = 'Aveiro'"), "hauls") == [(2,)]


def test_plain_equality_reinserts_null_keys(spark):
    t = spark.createDataFrame([(None, 1)], "k string, v int")
    assert merge.upsert(t, t, ["k"], null_safe=False).count() == 2
    assert merge.upsert(t, t, ["k"]).count() == 1


WELL = "well string, probe string, depth double, read_at timestamp"


def test_change_aware_upsert(spark):
    t1, t2 = dt.datetime(2031, 3, 1, 4), dt.datetime(2031, 3, 2, 4)
    target = spark.createDataFrame([("w1", "p", 3.2, t1), ("w2", "p", 8.8, t1), ("w3", "q", 5.0, t1)], WELL)
    batch = spark.createDataFrame([("w2", "p", 8.9, t2), ("w3", "q", 5.0, t2), ("w4", "q", 1.5, t2)], WELL)
    keys = ["well", "probe"]
    assert dict(rows(merge.classify_changes(target, batch, keys, ["depth"]), "well", "action")) == {"w2": "update", "w3": "noop", "w4": "insert"}
    out = {r["well"]: r for r in merge.upsert(target, batch, keys, when_changed=["depth"]).collect()}
    assert len(out) == 4 and out["w2"]["depth"] == 8.9 and out["w3"]["read_at"] == t1 and out["w4"]["depth"] == 1.5
    assert dict(rows(merge.merge_summary(target, batch, keys, ["depth"]))) == {"insert": 1, "update": 1, "noop": 1, "keep": 1}


def test_upsert_options(spark):
    t = spark.createDataFrame([("a", 5, "x")], "k string, v int, note string")
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(t, spark.createDataFrame([("a", 1, "y"), ("a", 2, "z")], "k string, v int, note string"), ["k"])
    stale = spark.createDataFrame([("a", 3, None)], "k string, v int, note string")
    assert rows(merge.upsert(t, stale, ["k"], newer_by="v")) == [("a", 5, "x")]
    fresh = spark.createDataFrame([("a", 7, None)], "k string, v int, note string")
    assert rows(merge.upsert(t, fresh, ["k"], coalesce_existing=True)) == [("a", 7, "x")]
    wider = spark.createDataFrame([("b", 1, "n", True)], "k string, v int, note string, extra boolean")
    assert merge.upsert(t, wider, ["k"]).columns == ["k", "v", "note", "extra"]


def test_upsert_equals_the_plain_full_outer_join(spark):
    t = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("t").alias("note"))
    t = t.unionByName(spark.createDataFrame([(None, 7, "nullkey")], "k long, v long, note string"))
    src = spark.range(480, 520).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"), F.lit(True).alias("extra"))
    src = src.unionByName(spark.createDataFrame([(None, 9, False)], "k long, v long, extra boolean"))
    for kw in [{}, {"newer_by": "v"}, {"when_changed": ["v"]}, {"coalesce_existing": True}]:
        got = merge.upsert(t, src, ["k"], **kw)
        want = merge._keyed_merge(t, src, ["k"], **{"null_safe": True, "newer_by": None, "coalesce_existing": False, "when_changed": None, **kw})
        assert got.columns == want.columns == ["k", "v", "note", "extra"] and rows(got) == rows(want)


def test_source_is_evaluated_once(spark, tmp):
    spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(f"{tmp}/source")
    target = spark.range(100).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    plan = merge.upsert(target, spark.read.parquet(f"{tmp}/source"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp}/source" not in plan and "BroadcastExchange" in plan  # only the staged copy, broadcast by its real size


def test_first_load_is_checked(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    with pytest.raises(merge.DuplicateKeyError):
        t.upsert(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), ["k"])
    assert not t.exists()


def test_identical_resend_writes_no_version(spark, tmp):
    t = Table(spark, f"{tmp}/t")
    rows1 = spark.createDataFrame([(1, "a", None), (None, "b", 2.0)], "k int, v string, x double")
    assert [t.upsert(rows1, ["k"]), t.upsert(rows1, ["k"]), t.upsert(rows1, ["k"], when_changed=["v"])] == [1, 1, 1]
    stamped = rows1.withColumn("x", F.lit(9.0))
    assert t.upsert(stamped, ["k"], when_changed=["v"]) == 1 and t.upsert(stamped, ["k"]) == 2


FERRY = "day date, pier string, sailings int, late int"


def ferries(spark):
    cur = spark.createDataFrame([(d("2031-07-01"), "east", 14, 2), (d("2031-07-01"), "west", 9, 0), (d("2031-07-02"), "east", 15, 4),
                                 (d("2031-07-02"), "west", 9, 1), (d("2031-07-03"), "east", 13, 6)], FERRY)
    batch = spark.createDataFrame([(d("2031-07-03"), "east", 15, 1), (d("2031-07-03"), "west", 8, 3)], FERRY)
    return cur, batch


def check_replaced(df):
    out = rows(df)
    assert [r[3] for r in out] == [2, 0, 4, 1, 1, 3]


def test_three_ways_to_replace_one_day(spark, tmp):
    cur, batch = ferries(spark)
    check_replaced(partitions.replace_partitions(cur, batch, ["day"]))
    check_replaced(partitions.replace_where(cur, batch, F.col("day") == F.lit(d("2031-07-03"))))
    check_replaced(partitions.merge_partitions(cur, batch, ["day", "pier"]))
    cur.write.partitionBy("day").parquet(f"{tmp}/f")
    partitions.write_partitions(batch, f"{tmp}/f", ["day"])
    check_replaced(spark.read.parquet(f"{tmp}/f").select("day", "pier", "sailings", "late"))
    with pytest.raises(partitions.PredicateViolation):
        partitions.replace_where(cur, batch, F.col("day") == F.lit(d("2031-07-02")))


def test_overwrite_impact(spark):
    cur, batch = ferries(spark)
    static = dict(rows(partitions.overwrite_impact(cur, batch, ["day"], "static"), "day", "lost"))
    assert static == {d("2031-07-01"): True, d("2031-07-02"): True, d("2031-07-03"): False}
    assert partitions.overwrite_impact(cur, batch, ["day"], "dynamic").where("lost").count() == 0
    whole = partitions.overwrite_impact(cur, batch, [], "dynamic").first()
    assert (whole["rows_before"], whole["rows_in_batch"], whole["rows_after"], whole["lost"]) == (5, 2, 2, True)
    more = cur.unionByName(batch)
    assert partitions.overwrite_impact(cur, more, [], "static").first()["lost"] is False
    a = spark.createDataFrame([(None, 1), ("x", 2)], "p string, v int")
    b = spark.createDataFrame([(None, 3)], "p string, v int")
    assert rows(partitions.overwrite_impact(a, b, ["p"], "static")) == [("x", 1, 0, 0, True), (None, 1, 1, 1, False)]


def test_overwrite_guard_stops_the_write(spark, tmp):
    cur, batch = ferries(spark)
    path = f"{tmp}/f"
    partitions.overwrite_table(cur, path, ["day"])
    with pytest.raises(partitions.OverwriteLoss):
        partitions.overwrite_table(batch, path, ["day"])
    with pytest.raises(partitions.OverwriteLoss):
        partitions.write_partitions(batch, path, [])
    assert spark.read.parquet(path).count() == 5
    partitions.overwrite_table(batch, path, ["day"], allow_loss=True)
    assert spark.read.parquet(path).count() == 2


def test_files_per_partition_bounds_files_and_spreads_hot_day(spark, tmp):
    df = spark.range(0, 6000, numPartitions=12).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("d"), (F.col("id") % 5).cast("string"))).alias("day"), "id")
    # AQE would merge this tiny shuffle into one task (fine for small data);
    # switch coalescing off to see how a large hot day is spread
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        partitions.write_partitions(df, f"{tmp}/p", ["day"], files_per_partition=3)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert 1 < len(glob.glob(f"{tmp}/p/day=hot/*.parquet")) <= 3
    assert all(len(glob.glob(f"{tmp}/p/day=d{i}/*.parquet")) <= 3 for i in range(5))
    assert spark.read.parquet(f"{tmp}/p").count() == 6000


def test_partitioned_upsert_leaves_other_files_alone(spark, tmp):
    t = Table(spark, f"{tmp}/daily")
    cur = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "a", 20), (3, "a", 30), (None, "n", 1)], "day int, k string, v int")
    t.upsert(cur, ["day", "k"], partition_by=["day"])
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{tmp}/daily/*/day=*/*.parquet")}
    batch = spark.createDataFrame([(2, "a", 21), (2, "c", 22), (4, "a", 40), (None, "n", 2)], "day int, k string, v int")
    assert t.upsert(batch, ["day", "k"], partition_by=["day"]) == 2  # a layer over version 1, which stays as it was
    assert rows(t.read(1).select("day", "k", "v")) == rows(cur.select("day", "k", "v"))
    assert rows(t.read().select("day", "k", "v")) == [(1, "a", 10), (1, "b", 11), (2, "a", 21), (2, "c", 22), (3, "a", 30), (4, "a", 40),
                                                      (None, "n", 2)]
    after = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{tmp}/daily/*/day=*/*.parquet")}
    kept = [p for p in before if "day=1" in p or "day=3" in p]
    assert all(after.get(p) == before[p] for p in kept)
    same = {p: os.stat(p).st_mtime_ns for p in after}
    t.upsert(batch, ["day", "k"], partition_by=["day"])  # a re-send touches no file
    assert {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{tmp}/daily/*/day=*/*.parquet")} == same
