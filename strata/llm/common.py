"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ROWS_PER_TASK = 500_000  # of narrow rows whose number is known


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can reach, evaluates the
    plan once for several readers, and gives the planner a real size: small
    tables are broadcast below Spark's own threshold, larger ones take a
    sort-merge join whose skewed partitions adaptive execution can split.
    Where the number of (narrow) rows is known, the last stage gets a task and
    a file for every ``ROWS_PER_TASK`` of them, however many shuffle partitions
    the session has.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(files: DataFrame, per_task: int = 1, at_most: int = 50_000) -> DataFrame:
    """Rows that each stand for a file, dealt to tasks by their number: by their
    own size adaptive execution would put them all into one."""
    return files.repartition(max(1, min(at_most, -(-files.count() // per_task))))


BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands rows to Python in Arrow batches of
    at most ``BATCH_BYTES`` (or one row), so texts of any length fit a worker."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", conf.get(key))
    if not now or not 0 < int(now[1]) <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def plain(docs: DataFrame, *known: str) -> DataFrame:
    """``docs`` whose columns but the ``known`` ones are named by their position, so
    that no name of a caller's column can clash with one of an operator."""
    return docs.toDF(*[c.lower() if c.lower() in known else f"_{i}" for i, c in enumerate(docs.columns)])


def let(value, use):
    """``use(value)``, where ``value`` is computed once however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


RUN = 256  # values that a running total appends one by one


def running(values, step=lambda a, b: a + b):
    """Array of non-negative longs -> its running totals under ``step`` (addition or greatest).

    Totals within runs of ``RUN`` values and over the runs, so an array costs
    about its length instead of the square of it.
    """
    def totals(xs):
        start = F.array().cast("array<bigint>")
        return F.aggregate(xs, start, lambda a, x: F.concat(a, F.array(step(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("long")), x))))

    def joined(inner):
        return let(F.struct(inner.alias("runs"), totals(F.transform(inner, lambda r: F.element_at(r, -1))).alias("ends")), lambda s: F.flatten(
            F.transform(s["runs"], lambda r, i: let(F.coalesce(F.try_element_at(s["ends"], F.nullif(i, F.lit(0))), F.lit(0).cast("long")),
                                                    lambda before: F.transform(r, lambda x: step(before, x))))))

    def cut(xs):
        starts = F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), F.lit(RUN))
        return let(F.transform(starts, lambda at: totals(F.slice(xs, at, RUN))), joined)

    return F.when(F.size(values) > 0, let(values, cut)).otherwise(F.array().cast("array<bigint>"))


def held_out(id_col: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id's digits mod 5 is 0."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def hash_sample(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``cols``: the same rows on any layout."""
    return df.orderBy(F.xxhash64(*cols), *cols).limit(n)


def utf8(column) -> list:
    """Arrow string column -> list of UTF-8 bytes (None for null), without decoding."""
    import pyarrow as pa

    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()
