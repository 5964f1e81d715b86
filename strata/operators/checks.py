"""Data-contract checks. Each returns a DataFrame (evaluated by the caller)
so that several checks can be combined into one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.scan import lag_ranges


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once, with their row count (``n_rows``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One-row summary of a uniqueness contract."""
    d = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return d.agg(
        F.sum("_n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("_n") > 1).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("long").alias("n_extra_rows"),
        F.coalesce(F.max("_n"), F.lit(0)).cast("long").alias("max_rows_per_key"),
    )


def check_not_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column: ``column``, ``n_null``; computed in one pass."""
    cols = cols or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(cols)}, {stack}) as (`column`, n_null)")


def check_scd2(dim: DataFrame, key: str, start: str = "valid_from", end: str = "valid_to",
               current: str = "is_current", skew_safe: bool = True) -> DataFrame:
    """Per key: versions, active versions, and neighbour pairs (in order of
    start, then end with the open end last) that overlap or leave a gap;
    each pair is counted on its later version. A zero-length version
    ``[d, d)`` followed by one starting at ``d`` is neither.

    The previous version comes from a ``lag`` scan over ranges, which splits
    a key with very many versions (``operators.scan``), like ``change_log``.
    """
    v = dim.select(key, start, end, current, F.lit(True).alias("_v"))
    order = [start, f"{end} asc nulls last"]
    if skew_safe:
        prev = lag_ranges(v, [key], order, [end, "_v"])
    else:
        w = Window.partitionBy(key).orderBy(F.col(start).asc_nulls_first(), F.col(end).asc_nulls_last())
        prev = v.withColumns({f"prev_{end}": F.lag(end).over(w), "prev__v": F.lag("_v").over(w)})
    has_prev = F.col("prev__v").isNotNull()
    pe = F.col(f"prev_{end}")
    return prev.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.count_if(F.col(current)).alias("n_active"),
        F.count_if(has_prev & (pe.isNull() | (pe > F.col(start)))).alias("n_overlaps"),
        F.count_if(has_prev & pe.isNotNull() & (pe < F.col(start))).alias("n_gaps"),
    )


def unresolved_keys(fact: DataFrame, key_cols: list[str]) -> DataFrame:
    """One row: NULL count of each surrogate key column (``null_<col>``) and rows."""
    return fact.agg(F.count(F.lit(1)).alias("n_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in key_cols])


def fanout_report(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """What ``left`` inner join ``right`` on ``on`` would do to the rows of
    ``left``: rows before and after, keys after, most rows of one key, and
    whether the join fans out. Each side is counted per key before the
    (one row per key) join, so the joined rows are never built and a hot key
    costs one row per task."""
    per_l = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_l"))
    per_r = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_r"))
    after = per_l.join(per_r, on, "left").select("_l", (F.col("_l") * F.coalesce("_r", F.lit(0))).alias("_n"))
    out = after.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).cast("long").alias("rows_before"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_after"),
        F.count_if(F.col("_n") > 0).cast("long").alias("keys_after"),
        F.coalesce(F.max("_n"), F.lit(0)).cast("long").alias("max_rows_per_key"))
    return out.withColumn("fanout", F.col("rows_after") > F.col("rows_before"))


def table_digest(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per value of ``by`` (or for the whole table): ``n_rows`` and two sums of row hashes, ``digest_1`` and
    ``digest_2``. They do not depend on the order of rows, files or columns; repeated rows count, and NULL
    differs from every value. One aggregate, combined before its shuffle."""
    by, names = by or [], sorted(df.columns)
    parts = []
    for c in names:
        v = F.col(f"`{c}`")
        v = F.to_json(v) if isinstance(df.schema[c].dataType, (T.MapType, T.VariantType)) else v
        parts += [v, v.isNull()]
    hashes = [F.sum(F.xxhash64(F.lit(i), *parts).cast("decimal(20,0)")).alias(f"digest_{i}") for i in (1, 2)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *hashes)


def check_rerun(first: DataFrame, second: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Whether two runs gave the same table: per value of ``by`` (NULL is a value) the rows of either run and
    ``same`` (equal rows, each as often). Only digests meet, so the cost is a scan of each side."""
    by = by or []
    a, b = table_digest(first, by), table_digest(second, by)
    one = F.lit(1)
    a = a.select(*[F.col(c).alias(f"_a_{c}") for c in by], F.struct("n_rows", "digest_1", "digest_2").alias("a"), one.alias("_1"))
    b = b.select(*[F.col(c).alias(f"_b_{c}") for c in by], F.struct("n_rows", "digest_1", "digest_2").alias("b"), one.alias("_2"))
    cond = reduce(lambda x, y: x & y, [F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")) for c in by], F.col("_1") == F.col("_2"))
    n = lambda side: F.coalesce(F.col(f"{side}.n_rows"), F.lit(0)).cast("long")
    key = [F.when(F.col("_1").isNotNull(), F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in by]
    return a.join(b, cond, "full_outer").select(*key, n("a").alias("rows_first"), n("b").alias("rows_second"), F.col("a").eqNullSafe(F.col("b")).alias("same"))
