"""Partition replacement: dynamic overwrite, predicate replace, impact check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.merge import upsert
from strata.session import staged


class PredicateViolation(ValueError):
    pass


def replace_partitions(target: DataFrame, batch: DataFrame, part_cols: list[str]) -> DataFrame:
    """Logical dynamic overwrite: every partition present in ``batch`` is
    replaced by the batch rows, all other target partitions survive.
    The set of batch partitions is a distinct over the partition columns
    (small: one row per partition) and joins with a left-anti join."""
    parts = batch.select(*part_cols).distinct()
    kept = target.join(parts, [target[c].eqNullSafe(parts[c]) for c in part_cols], "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def spread_for_write(df: DataFrame, part_cols: list[str], files_per_partition: int | None) -> DataFrame:
    """Shuffle so that each partition value is written by at most
    ``files_per_partition`` tasks: hash on (partition columns, salt) with a
    deterministic salt ``pmod(xxhash64(row), k)``. Bounds the file count per
    partition (no per-task file into every partition) and spreads a hot
    partition over k writers instead of one. ``None`` leaves the layout as it is."""
    if not files_per_partition:
        return df
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
    return df.repartition(*[F.col(c) for c in part_cols], salt)


class OverwriteLoss(ValueError):
    pass


def write_partitions(batch: DataFrame, path: str, part_cols: list[str],
                     files_per_partition: int | None = None) -> None:
    """Physical dynamic overwrite of a ``partitionBy`` layout: only the
    partition directories present in the batch are rewritten. Without
    partition columns the write would replace the whole directory whatever
    the mode, so that raises; see ``overwrite_table``."""
    if not part_cols:
        raise OverwriteLoss("a dynamic overwrite without partition columns replaces the whole table")
    (spread_for_write(batch, part_cols, files_per_partition).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*part_cols).parquet(path))


def overwrite_table(batch: DataFrame, path: str, part_cols: list[str] | None = None, allow_loss: bool = False) -> None:
    """Static overwrite of a whole directory. Unless ``allow_loss`` is set it
    is refused when partitions (or, without partition columns, rows) that the
    directory holds would not come back: see ``overwrite_impact``. The batch
    is evaluated once, into a staged copy that the check and the write read."""
    from strata.sources.table import path_exists

    spark = batch.sparkSession
    batch = staged(batch, "overwrite")
    if not allow_loss and path_exists(spark, path):
        lost = overwrite_impact(spark.read.parquet(path), batch, part_cols or [], "static").where("lost")
        if not lost.isEmpty():
            raise OverwriteLoss(f"the overwrite of {path} would lose {lost.count()} partitions it does not replace")
    writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*part_cols) if part_cols else writer).parquet(path)


def replace_where(target: DataFrame, batch: DataFrame, predicate: Column | str,
                  validate: bool = True) -> DataFrame:
    """Delete target rows matching ``predicate`` and insert ``batch``.

    Target rows where the predicate is NULL are kept. With ``validate`` a
    batch row that does not satisfy the predicate raises (it would land
    outside the replaced range); the batch is then evaluated once, into a
    staged copy."""
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    batch = staged(batch, "replace") if validate else batch
    if validate and not batch.where(~F.coalesce(pred, F.lit(False))).isEmpty():
        raise PredicateViolation("batch has rows outside the replaced predicate")
    return target.where(~F.coalesce(pred, F.lit(False))).unionByName(batch.select(*target.columns))


def merge_partitions(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Refresh by keyed merge (e.g. keys = day + entity): rows of the batch
    replace or extend, nothing outside the batch keys is touched."""
    return upsert(target, batch, keys)


def overwrite_impact(target: DataFrame, batch: DataFrame, part_cols: list[str],
                     mode: str = "static") -> DataFrame:
    """Per partition: rows before, rows in the batch, rows after, and
    whether the partition is ``lost`` by the overwrite. NULL is a partition.

    ``static`` replaces the whole table, so every partition absent from the
    batch is lost; ``dynamic`` loses nothing it does not rewrite. Without
    ``part_cols`` either mode replaces the table, one partition as a whole: it
    is lost when rows of it are not in the batch.
    """
    one = F.lit(1).cast("long")
    sides = target.select(*part_cols, one.alias("b"), F.lit(0).cast("long").alias("i")).unionAll(
        batch.select(*part_cols, F.lit(0).cast("long").alias("b"), one.alias("i")))
    j = sides.groupBy(*part_cols).agg(F.sum("b").alias("rows_before"), F.sum("i").alias("rows_in_batch"))
    rb = F.coalesce(F.col("rows_before"), F.lit(0)).cast("long")
    ri = F.coalesce(F.col("rows_in_batch"), F.lit(0)).cast("long")
    if mode == "static" or not part_cols:
        after = ri
    elif mode == "dynamic":
        after = F.when(ri > 0, ri).otherwise(rb)
    else:
        raise ValueError(mode)
    if part_cols:
        lost = (rb > 0) & (after == 0)
    else:
        lost = F.lit(not target.exceptAll(batch.select(*target.columns)).isEmpty())
    return j.select(*part_cols, rb.alias("rows_before"), ri.alias("rows_in_batch"), after.alias("rows_after"), lost.alias("lost"))


def daily_partition_filter(day_col: str, day) -> Column:
    """Equality on the partition column itself, so the scan prunes directories."""
    return F.col(day_col) == F.lit(day)


def read_day(spark: SparkSession, path: str, day_col: str, day) -> DataFrame:
    return spark.read.parquet(path).where(daily_partition_filter(day_col, day))

