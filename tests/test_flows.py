"""End-to-end layer flows from files, run twice, batch formats and the
streaming entry points, on invented tram and weather-buoy reports."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from strata.operators.dims import scd2_has_changes, scd2_init
from strata.operators.state import consolidate_state
from strata.plans.layered import batch_ingestion_flow, entity_state_flow, grain_metrics_flow
from strata.sources.evolve import BatchLog
from strata.sources.table import Table
from strata.streaming import stream_ingest, stream_upsert

TRAM = T.StructType([T.StructField(c, T.StringType()) for c in ["rep", "tram", "line", "crew", "state", "seen", "via"]])
HEADER = "rep,tram,line,crew,state,seen,via\n"


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_entity_state_flow_twice_then_update(spark, tmp):
    src = write(f"{tmp}/b1.csv", HEADER + "r1,t-40,12,Nils,running,2031-04-01T05:20:00,gps\n"
                "r2,t-40,12,Nils,running,2031-04-01T05:20:00,gps\nr3,t-41,,Asta,depot,2031-04-01T06:00:00,hand\n")
    kw = dict(keys=["tram"], attrs=["line", "crew", "state"], time="seen", source="via", ranked=["gps"], id_col="rep",
              processed_at=F.lit(dt.datetime(2031, 4, 2)))
    entity_state_flow(spark, src, TRAM, f"{tmp}/silver", **kw)
    out = entity_state_flow(spark, src, TRAM, f"{tmp}/silver", **kw)
    assert out.count() == 2 and "processed_at" in out.columns and Table(spark, f"{tmp}/silver").versions() == [1]
    src2 = write(f"{tmp}/b2.csv", HEADER + "r9,t-40,,Nils,broken,2031-04-03T07:00:00,gps\n")
    out = {r["tram"]: r for r in entity_state_flow(spark, src2, TRAM, f"{tmp}/silver", **kw).collect()}
    assert out["t-40"]["state"] == "broken" and out["t-40"]["line"] is None  # the fill is local to a batch
    assert out["t-41"]["state"] == "depot"


TRIP = T.StructType([T.StructField("trip", T.StringType()), T.StructField("tram", T.StringType()), T.StructField("line", T.StringType()),
                     T.StructField("day", T.DateType()), T.StructField("late", T.BooleanType()), T.StructField("riders", T.IntegerType())])


def test_grain_metrics_flow_twice(spark, tmp):
    src = write(f"{tmp}/s.csv", "trip,tram,line,day,late,riders\nx1,a,12,2031-02-01,true,10\nx2,b,12,2031-02-20,false,30\nx3,a,7,2031-03-01,,5\n")
    kw = dict(grain=["line", "month"], metrics=[("n", "count", "trip"), ("late_pct", "rate_pct", "late"), ("riders", "mean", "riders")],
              month_of={"month": "day"}, digits=2)
    grain_metrics_flow(spark, src, TRIP, f"{tmp}/gold", **kw)
    out = grain_metrics_flow(spark, src, TRIP, f"{tmp}/gold", **kw)
    assert rows(out, "line", "n", "late_pct") == [("12", 2, 50.0), ("7", 1, None)]


def test_batch_formats_parquet_orc(spark, tmp):
    spark.createDataFrame([("a", 1)], "rep string, buoy long").write.parquet(f"{tmp}/p")
    spark.createDataFrame([("b", 2)], "rep string, buoy long").write.orc(f"{tmp}/o")
    written = batch_ingestion_flow(spark, [(f"{tmp}/p", "parquet", {}, "b1"), (f"{tmp}/o", "orc", {}, "b2")], f"{tmp}/log", casts={"buoy": "string"})
    assert written == ["b1", "b2"]
    assert rows(BatchLog(spark, f"{tmp}/log").read(), "rep", "buoy") == [("a", "1"), ("b", "2")]


def test_scd2_noop_detection(spark):
    v1 = spark.createDataFrame([("a", "x")], "k string, v string")
    dim = scd2_init(v1, "k", ["v"], "t1")
    assert not scd2_has_changes(dim, v1, "k", ["v"])
    assert scd2_has_changes(dim, spark.createDataFrame([("a", "y")], "k string, v string"), "k", ["v"])


EV = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("buoy", T.LongType()), T.StructField("kind", T.StringType()),
                   T.StructField("wave", T.DoubleType()), T.StructField("ts", T.TimestampType())])


def readings(spark, n):
    base = dt.datetime(2031, 1, 1)
    return spark.createDataFrame([(i, i % 5, "storm" if i % 4 == 0 else "calm", None if i % 3 == 0 else float(i), base + dt.timedelta(hours=i))
                                  for i in range(n)], EV)


def upsert_stream(spark, tmp, checkpoint, **kw):
    return stream_upsert(spark, f"{tmp}/in", EV, f"{tmp}/state", checkpoint, ["buoy"], ["wave"], "ts", "kind", ["storm"], "event_id", **kw)


def batch_state(df):
    return rows(consolidate_state(df, ["buoy"], ["wave"], "ts", "kind", ["storm"], "event_id"))


def test_streaming_ingest_and_upsert_equal_batch(spark, tmp):
    df = readings(spark, 200)
    # land in three files written out of time order: the result must not depend on arrival
    for part in ("event_id >= 120", "event_id < 60", "event_id >= 60 and event_id < 120"):
        df.where(part).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    assert stream_ingest(spark, f"{tmp}/in", EV, f"{tmp}/out", f"{tmp}/ck", max_files_per_trigger=1) == 3
    assert spark.read.parquet(f"{tmp}/out").count() == 200
    assert stream_ingest(spark, f"{tmp}/in", EV, f"{tmp}/out", f"{tmp}/ck") == 0  # the checkpoint has every file
    assert spark.read.parquet(f"{tmp}/out").count() == 200
    assert upsert_stream(spark, tmp, f"{tmp}/ck2", log_path=f"{tmp}/log", max_files_per_trigger=1) == 3
    assert rows(Table(spark, f"{tmp}/state").read()) == batch_state(df)


def test_new_checkpoint_loses_and_repeats_nothing(spark, tmp):
    df = readings(spark, 90)
    df.where("event_id < 60").coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    upsert_stream(spark, tmp, f"{tmp}/ck-a", log_path=f"{tmp}/log")
    df.where("event_id >= 60").coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    upsert_stream(spark, tmp, f"{tmp}/ck-b", log_path=f"{tmp}/log")  # epoch 0 again
    assert rows(Table(spark, f"{tmp}/state").read()) == batch_state(df)


def test_more_batches_than_the_progress_list_holds(spark, tmp):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            readings(spark, 5 * (i + 1)).where(f"event_id >= {5 * i}").coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        assert stream_ingest(spark, f"{tmp}/in", EV, f"{tmp}/out", f"{tmp}/ck", max_files_per_trigger=1) == 5
        assert upsert_stream(spark, tmp, f"{tmp}/ck2", log_path=f"{tmp}/log", max_files_per_trigger=1) == 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_commit_count_beyond_the_files_spark_keeps(spark, tmp):
    from strata.sources.table import committed_epochs
    os.makedirs(f"{tmp}/ck/commits")
    for n in range(180, 280):  # Spark keeps the latest hundred
        write(f"{tmp}/ck/commits/{n}", "v1\n{}")
    assert committed_epochs(spark, f"{tmp}/ck") == 280


def test_incremental_stream_upsert_in_order(spark, tmp):
    df = readings(spark, 90)
    for lo in (0, 30, 60):  # files arrive in time order
        df.where(f"event_id >= {lo} and event_id < {lo + 30}").coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    upsert_stream(spark, tmp, f"{tmp}/ck", max_files_per_trigger=1, mode="incremental")
    assert rows(Table(spark, f"{tmp}/state").read()) == batch_state(df)
    assert glob.glob(f"{tmp}/state/snap=*")
