"""Incremental ingestion with Structured Streaming.

Both functions run a file-source stream with ``trigger(availableNow=True)``:
every file not yet recorded in the checkpoint is processed, then the query
stops. Re-running with the same checkpoint processes nothing again, so a
scheduled job is idempotent and a crash resumes from the last commit.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.register import REGISTER, event_register, merge_registers, register_state
from strata.operators.state import consolidate_state
from strata.session import staged
from strata.sources.evolve import BatchLog
from strata.sources.table import Table, committed_epochs, read_text


def _source(spark: SparkSession, src_dir: str, schema: T.StructType, fmt: str, options: dict | None,
            max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(src_dir)


def stream_ingest(spark: SparkSession, src_dir: str, schema: T.StructType, out_dir: str, checkpoint: str,
                  fmt: str = "parquet", options: dict | None = None, casts: dict | None = None,
                  partition_by: list[str] | None = None, max_files_per_trigger: int | None = None) -> int:
    """Append new source files to a Parquet directory (exactly-once file
    sink). Returns the number of micro-batches that ran."""
    df = _source(spark, src_dir, schema, fmt, options, max_files_per_trigger)
    if casts:
        df = df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    before = committed_epochs(spark, checkpoint)
    w.start(out_dir).awaitTermination()
    return committed_epochs(spark, checkpoint) - before


def stream_upsert(spark: SparkSession, src_dir: str, schema: T.StructType, table_path: str, checkpoint: str,
                  keys: list[str], attrs: list[str], time: str, source: str, ranked: list, id_col: str,
                  log_path: str | None = None, fmt: str = "parquet", options: dict | None = None,
                  max_files_per_trigger: int | None = None, mode: str = "recompute", buckets: int | None = None) -> int:
    """Keep a per-key state table current from a stream of events.

    Each micro-batch is appended to a bronze batch log (one directory per
    query id and epoch, skipped if already committed) and the state of every key the
    batch touches is recomputed from that key's full history and upserted.
    Recomputing whole keys makes the result independent of arrival order:
    late events cannot regress or mis-fill the state, and the final table
    equals the one-shot ``consolidate_state`` of all events. ``foreachBatch``
    is at-least-once; a replayed epoch finds its log entry committed and
    merges the same state, which writes nothing. A new checkpoint is a new
    query: its epochs get their own entries, and files it reads again are
    exact duplicates, which the consolidation removes. Returns the number of
    micro-batches run.

    Cost: ``recompute`` (default, exact for any arrival order) scans the
    log for the touched keys on every micro-batch. ``mode="incremental"``
    only merges the micro-batch's own consolidation into the state
    (``newer_by=time`` keeps the later winner, ``coalesce_existing`` carries
    attributes the batch lacks): no history scan, exact when each key's
    events arrive in time order, which is what an append-only feed with a
    watermark upstream delivers. ``mode="register"`` needs neither: the table
    holds a mergeable register per key (``operators.register``), so a batch is
    merged into the keys it touches and the result is that of all events at
    once in any order of arrival, with no log. Read it with
    ``read_registers``; ``buckets`` (on the first run) keeps the cost of a
    batch to the buckets of its keys.
    """
    table = Table(spark, table_path)
    if mode not in ("recompute", "incremental", "register"):
        raise ValueError(mode)
    if mode == "recompute" and not log_path:
        raise ValueError("recompute mode needs log_path for the bronze history")
    log = BatchLog(spark, log_path) if log_path else None

    ran = 0

    def apply(batch: DataFrame, epoch_id: int) -> None:
        nonlocal ran
        ran += 1
        # the id in the checkpoint's metadata stays with the checkpoint and is new with a new one
        query_id = json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        entry = f"q{query_id.replace('-', '')}e{epoch_id:09d}"
        events = batch.select(id_col, *keys, *attrs, time, source)
        if mode == "register":
            registers = event_register(events, keys, attrs, time, source, ranked, id_col)
            table.upsert(registers, keys, buckets=buckets, combine={REGISTER: lambda old, new: merge_registers(old, new, len(attrs))})
            return
        if log is not None:
            log.append(events, entry)
        if mode == "incremental":
            state = consolidate_state(events, keys, attrs, time, source, ranked, id_col)
            table.upsert(state, keys, newer_by=time, coalesce_existing=True)
            return
        touched = staged(events.select(*keys).distinct(), "stream-keys")
        history = log.read().drop(log.batch_col)
        cond = [history[k].eqNullSafe(touched[k]) for k in keys]
        state = consolidate_state(history.join(touched, cond, "left_semi"), keys, attrs, time, source, ranked, id_col)
        table.upsert(state, keys)

    df = _source(spark, src_dir, schema, fmt, options, max_files_per_trigger)
    df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return ran


def read_registers(spark: SparkSession, table_path: str, keys: list[str], attrs: list[str], time: str, source: str, id_col: str) -> DataFrame:
    """The state kept by ``stream_upsert(mode="register")``, as ``consolidate_state`` gives it."""
    return register_state(Table(spark, table_path).read(), keys, attrs, time, source, id_col)


def stream_dedup(spark: SparkSession, src_dir: str, schema: T.StructType, out_dir: str, checkpoint: str, keys: list[str], time: str, delay: str,
                 fmt: str = "parquet", options: dict | None = None, partition_by: list[str] | None = None,
                 max_files_per_trigger: int | None = None) -> int:
    """Append new events to a Parquet directory, each of them once, although later files send some again.

    Events are the same that agree on ``keys``; the first to arrive stays. The
    state holds the keys of the last ``delay`` behind the watermark on
    ``time`` (a timestamp) and no others, so it is bounded by the traffic of
    that span; an event sent again within it is dropped. Returns the number
    of micro-batches that ran."""
    df = _source(spark, src_dir, schema, fmt, options, max_files_per_trigger)
    # watermarks need a timestamp with a zone
    once = df.withColumn("_event_time", F.col(time).cast("timestamp")).withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(keys).drop("_event_time")
    w = once.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    before = committed_epochs(spark, checkpoint)
    w.start(out_dir).awaitTermination()
    return committed_epochs(spark, checkpoint) - before
