"""Scenario inputs derived from the driver tables (whole tables, split by
time or value rules), shared by the query catalog and its SQL oracles.

Every frame here is computed by Spark from the given tables, so the work
grows with the scale factor. Each builder has a SQL twin in ``catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Scenario parameters (dates, offsets, labels) shared with the
# SQL oracles in catalog.py.
REPLAY_FROM = "2024-01-11 00:00:00"   # a re-sent batch covers [REPLAY_FROM, REPLAY_TO)
REPLAY_TO = "2024-01-21 00:00:00"
REPLAY_ID_OFFSET = 10_000_000_000     # re-delivered events get a new delivery id
BATCH2_FROM = "2024-01-11 00:00:00"   # evolving batches: day 1-10, 11-20, 21-30
BATCH3_FROM = "2024-01-21 00:00:00"
FIRST_LOAD_BEFORE = "1997-01-01 00:00:00"  # customers known at the first dimension load
SECOND_LOAD_FROM = "1998-01-01 00:00:00"   # second load / SCD2 effective date
EFFECTIVE_DATE = "1998-01-01"
VERSION_TS_1 = "1996-12-31 23:00:00"
VERSION_TS_2 = "1998-01-01 06:00:00"
REWORK_DAY = "2024-01-03"
RUN_DAY = "2024-01-21"            # the daily job runs on this date for the day before
MASK_SALT = "strata"
RISK_THRESHOLD = 150000.0
HISTORY_CUTOFF = 199712


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ntz(s: str):
    return F.expr(f"TIMESTAMP_NTZ '{s}'")


def events_base(spark, d) -> DataFrame:
    """Events as a feed with partial rows: errors carry no value, views no k."""
    ev = table(spark, d, "events")
    return ev.select(
        "event_id", "user_id", "event_type",
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("int"))
        .otherwise(F.get_json_object("props", "$.k").cast("int")).alias("k"),
        "ts")


def events_feed(spark, d) -> DataFrame:
    """The feed plus a re-sent window: same payload, new delivery id."""
    base = events_base(spark, d)
    replay = (base.where((F.col("ts") >= ntz(REPLAY_FROM)) & (F.col("ts") < ntz(REPLAY_TO)))
              .withColumn("event_id", F.col("event_id") + F.lit(REPLAY_ID_OFFSET)))
    return base.unionByName(replay)


def skewed_events(spark, d) -> DataFrame:
    """Anonymous events (click, view, signup) all belong to actor 0: about 60%
    of rows on one key."""
    ev = table(spark, d, "events")
    actor = F.when(F.col("event_type").isin("click", "view", "signup"), F.lit(0).cast("long")).otherwise(F.col("user_id"))
    return ev.select("event_id", actor.alias("actor_id"), "event_type", "value", "ts",
                     F.to_date("ts").alias("day"))


def evolving_batches(spark, d) -> list[DataFrame]:
    """Three batches of events whose schema grows: +value, then +meta struct."""
    ev = table(spark, d, "events")
    b1 = ev.where(F.col("ts") < ntz(BATCH2_FROM)).select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "event_type", "ts")
    b2 = ev.where((F.col("ts") >= ntz(BATCH2_FROM)) & (F.col("ts") < ntz(BATCH3_FROM))).select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "event_type", "ts", "value")
    b3 = ev.where(F.col("ts") >= ntz(BATCH3_FROM)).select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "event_type", "ts", "value",
        F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"),
                 F.col("event_type").alias("kind")).alias("meta"))
    return [b1, b2, b3]


def customers_known_before(spark, d, before: str) -> DataFrame:
    o = table(spark, d, "orders").where(F.col("o_orderdate") < ntz(before)).select(F.col("o_custkey").alias("_ck"))
    c = table(spark, d, "customer")
    return c.join(o, c["c_custkey"] == o["_ck"], "left_semi")


def customers_active_from(spark, d, start: str) -> DataFrame:
    o = table(spark, d, "orders").where(F.col("o_orderdate") >= ntz(start)).select(F.col("o_custkey").alias("_ck"))
    c = table(spark, d, "customer")
    return c.join(o, c["c_custkey"] == o["_ck"], "left_semi")


def customer_load1(spark, d) -> DataFrame:
    return customers_known_before(spark, d, SECOND_LOAD_FROM).withColumn("load_no", F.lit(1))


def customer_load2(spark, d) -> DataFrame:
    """Customers re-sent by the second load; BUILDING balances moved +100."""
    c = customers_active_from(spark, d, SECOND_LOAD_FROM)
    return c.withColumn("c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + F.lit(100.0))
                        .otherwise(F.col("c_acctbal"))).withColumn("load_no", F.lit(2))


def customer_v1(spark, d) -> DataFrame:
    return customers_known_before(spark, d, FIRST_LOAD_BEFORE).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def customer_v2(spark, d) -> DataFrame:
    """Full customer snapshot at the effective date; negative balances moved
    to a COLLECTIONS segment (the tracked change)."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.when(F.col("c_acctbal") < 0, F.lit("COLLECTIONS")).otherwise(F.col("c_mktsegment"))
                    .alias("c_mktsegment"))


def order_flags(spark, d) -> DataFrame:
    """Orders with month/year and an ``urgent`` flag that is NULL when the
    priority is not specified."""
    o = table(spark, d, "orders")
    urgent = (F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("boolean"))
              .otherwise(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")))
    return o.select("*", urgent.alias("urgent"), F.year("o_orderdate").alias("order_year"))


def daily_totals(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.to_date("ts").alias("day"), "event_type")
            .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("total_value")))


def monthly_history(spark, d) -> DataFrame:
    """Change history of customer spending: one row per (customer, month with
    orders), ``batch_seq`` = yyyymm."""
    o = table(spark, d, "orders")
    seq = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long")
    return (o.groupBy("o_custkey", seq.alias("batch_seq"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("monthly_spend"), F.count(F.lit(1)).alias("n_orders"))
            .withColumn("op", F.lit("upsert")))
