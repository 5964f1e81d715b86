"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured and the master is local (tests), a
    private folder is created and registered as the checkpoint directory; on
    a cluster every executor would write to its own disk, so that raises.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("STRATA_LOCAL_TMP", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "strata-scratch", *_RUNS, f"{name}-{uuid.uuid4().hex[:12]}"])


_RUNS: list[str] = []  # folders of the runs this driver is in, outermost first


@contextmanager
def scratch_run(spark: SparkSession):
    """One folder for everything staged inside the block, removed at its end,
    also when the block fails. Results that are to outlive it must be written
    elsewhere within the block: a lazy DataFrame that leaves it has lost its
    files. Runs may nest; they belong to the driver's thread that opens them.
    """
    _RUNS.append(f"run-{uuid.uuid4().hex[:12]}")
    path = "/".join([checkpoint_root(spark).rstrip("/"), "strata-scratch", *_RUNS])
    try:
        yield path
    finally:
        _RUNS.pop()
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    plan above it runs once however many readers follow, its lineage is cut
    with files every executor can reach, and the planner knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sizing_conf(shuffled_bytes: int, executor_memory_gb: float = 16.0, executor_cores: int = 4,
                max_partitions: int = 50_000) -> dict:
    """Shuffle and scan sizing for a job whose widest shuffle moves
    ``shuffled_bytes`` -- after projection and map-side combine, not the
    table's size on disk.

    AQE coalesces small shuffle partitions but splits only skewed join
    partitions, so the initial count must follow the data. A partition may
    take half a core's execution memory (executor memory x 0.6 / cores / 2);
    sorts and aggregates beyond that spill. Blocks are map tasks x
    partitions, so scans read large splits (up to 1 GB) and the count stops
    at ``max_partitions``, from where on partitions grow and spill instead.
    E.g. 10 TB shuffled with the defaults: 8 534 partitions of 1.2 GB.
    """
    per_core_mb = executor_memory_gb * 1024 * 0.6 / executor_cores
    target_mb = max(32, int(per_core_mb / 2))
    partitions = min(max_partitions, max(200, int(shuffled_bytes // (target_mb << 20)) + 1))
    scan_mb = max(128, min(1024, target_mb))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{min(target_mb, 256)}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{target_mb * 4}m",
        "spark.sql.files.maxPartitionBytes": f"{scan_mb}m",
    }
