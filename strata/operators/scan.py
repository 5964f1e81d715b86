"""Running scans (forward fill, lag) that stay balanced when one key is hot.

A window ``partitionBy(key)`` puts every row of a key into one task. Here the
rows are range-partitioned on (keys, full order) instead, so a key with very
many rows simply covers several ranges, whatever its values are and however
they bunch up. Every row is tagged with the number of its range and the
result is staged once under the checkpoint folder, so all readers (and every
retried task) see the same tags. Each (key, range) is an ordinary window
partition; a carry row passes the state on to the next range of the key.

Only keys that end or begin a range can lie in two of them, so the carry
table has at most two rows per range. There are no thresholds, nothing is
sized by the number of keys, and uniform data takes the same path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ordering import parse_order, sort_columns
from strata.session import staged


def _same_key(keys, prefix):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def by_range(df: DataFrame, keys: list[str], order, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``_range``: ranges follow (keys, order), staged under the checkpoint folder."""
    columns = [F.col(k).asc_nulls_first() for k in keys] + sort_columns(parse_order(order))
    dealt = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return staged(dealt.withColumn("_range", F.spark_partition_id()), "by-range")


def _shared_keys(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that lie in more than one range: at most one per range."""
    key = F.struct(*[F.col(k) for k in keys])
    ends = tagged.groupBy("_range").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    seen = ends.select("_range", F.explode(F.array("lo", "hi")).alias("key")).distinct()
    shared = seen.groupBy("key").count().where("count > 1")
    return staged(shared.select(*[F.col(f"key.{k}").alias(f"_s_{k}") for k in keys]), "shared-keys")


def _carry(tagged: DataFrame, keys: list[str], order, pick, names: list[str]) -> DataFrame:
    """``pick(last-row window)`` per (shared key, range), moved on to the following range."""
    shared = _shared_keys(tagged, keys)
    rows = tagged.join(shared, _same_key(keys, "_s_"), "left_semi")
    per_range = pick(rows)
    after = Window.partitionBy(*keys).orderBy("_range")
    moved = [F.last(n, ignorenulls=True).over(after.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_c_{n}") for n in names]
    return staged(per_range.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_k_range"), *moved), "carry")


def _last_rows(rows: DataFrame, keys: list[str], order, where=None) -> DataFrame:
    """The last row per (key, range); planned with a limit before the shuffle."""
    backwards = [i.reversed() for i in parse_order(order)]
    w = Window.partitionBy(*keys, "_range").orderBy(*sort_columns(backwards))
    rows = rows if where is None else rows.where(where)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def fill_ranges(df: DataFrame, keys: list[str], order, cols: list[str], partitions: int | None = None) -> DataFrame:
    """Forward fill of ``cols`` per key in ``order``; same columns as ``df``."""
    tagged = by_range(df, keys, order, partitions)
    w = (Window.partitionBy(*keys, "_range").orderBy(*sort_columns(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = tagged.withColumns({f"_l_{c}": F.last(c, ignorenulls=True).over(w) for c in cols})

    def last_values(rows):
        found = [_last_rows(rows, keys, order, F.col(c).isNotNull()).select(*keys, "_range", F.col(c).alias(f"v_{c}")) for c in cols]
        every = rows.select(*keys, "_range").distinct()  # a range without a value passes the earlier one on
        parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [every, *found])
        return parts.groupBy(*keys, "_range").agg(*[F.first(f"v_{c}", ignorenulls=True).alias(f"v_{c}") for c in cols])

    carry = _carry(tagged, keys, order, last_values, [f"v_{c}" for c in cols])
    joined = local.join(carry, (F.col("_range") == F.col("_k_range")) & _same_key(keys, "_k_"), "left")
    return joined.select(*[F.coalesce(F.col(f"_l_{c}"), F.col(f"_c_v_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])


def lag_ranges(df: DataFrame, keys: list[str], order, cols: list[str], prefix: str = "prev_", partitions: int | None = None) -> DataFrame:
    """``df`` plus the previous row's ``cols`` per key as ``prev_<col>``."""
    tagged = by_range(df, keys, order, partitions)
    w = Window.partitionBy(*keys, "_range").orderBy(*sort_columns(order))
    local = tagged.withColumns({f"_l_{c}": F.lag(c).over(w) for c in cols}).withColumn("_first", F.row_number().over(w) == 1)

    def last_row(rows):
        return _last_rows(rows, keys, order).select(*keys, "_range", F.struct(*[F.col(c) for c in cols]).alias("row"))

    carry = _carry(tagged, keys, order, last_row, ["row"])
    joined = local.join(carry, (F.col("_range") == F.col("_k_range")) & _same_key(keys, "_k_"), "left")
    prev = [F.when(F.col("_first"), F.col("_c_row")[c]).otherwise(F.col(f"_l_{c}")).alias(f"{prefix}{c}") for c in cols]
    return joined.select(*[F.col(c) for c in df.columns], *prev)
