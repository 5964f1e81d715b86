"""Change history as an ordinary table: point-in-time reads, change log,
per-batch summary and retention candidates.

A history table holds one row per (key, ``batch_seq``) with the full row
image and an ``op`` column (``upsert`` or ``delete``). It replaces a
storage engine's version log: "as of version N" is a filter plus a
latest-row aggregate, which scales like any other aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.scan import lag_ranges
from strata.operators.state import latest_by_key


def append_history(history: DataFrame | None, changes: DataFrame, batch_seq: int, op: str = "upsert",
                   seq_col: str = "batch_seq", op_col: str = "op") -> DataFrame:
    """Stamp ``changes`` with the batch number and operation; union with history."""
    stamped = changes.withColumn(seq_col, F.lit(batch_seq).cast("long")).withColumn(op_col, F.lit(op))
    return stamped if history is None else history.unionByName(stamped, allowMissingColumns=True)


def record_upsert(history: DataFrame | None, before: DataFrame, after: DataFrame, keys: list[str], batch_seq: int,
                  seq_col: str = "batch_seq", op_col: str = "op") -> DataFrame:
    """The change history of a table write: rows of ``after`` that are new or
    differ from ``before`` as ``upsert``, rows of ``before`` whose key is gone
    as ``delete``. Both states are unique on ``keys`` (NULL is a key); NULLs
    compare equal, so an identical re-write records nothing."""
    after = after.select(*before.columns)
    a, b = after.alias("a"), before.alias("b")
    same_key = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    same_row = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in before.columns])
    written = append_history(history, a.join(b, same_key & same_row, "left_anti"), batch_seq, "upsert", seq_col, op_col)
    return append_history(written, b.join(a, same_key, "left_anti"), batch_seq, "delete", seq_col, op_col)


def as_of(history: DataFrame, keys: list[str], seq, seq_col: str = "batch_seq", op_col: str = "op",
          delete_value: str = "delete") -> DataFrame:
    """State of the table as of batch ``seq``: the latest row per key with
    ``seq_col <= seq``; a key whose latest row is a delete marker is absent."""
    upto = history.where(F.col(seq_col) <= F.lit(seq))
    latest = latest_by_key(upto, keys, [f"{seq_col} desc"])
    return latest.where(F.col(op_col).isNull() | (F.col(op_col) != F.lit(delete_value)))


def change_log(history: DataFrame, keys: list[str], attrs: list[str], seq_col: str = "batch_seq",
               skew_safe: bool = True, only_changes: bool = True) -> DataFrame:
    """Per key and batch: each attribute next to its previous value
    (``prev_<attr>``) and ``changed`` (null-safe difference, true for the
    first row of a key). ``skew_safe`` scans ranges, so a hot key is split (see
    ``operators.scan``); the result equals the plain ``lag`` window."""
    base = history.select(*keys, seq_col, *attrs)
    if skew_safe:
        res = lag_ranges(base, keys, [seq_col], attrs)
    else:
        w = Window.partitionBy(*keys).orderBy(F.col(seq_col))
        res = base.withColumns({f"prev_{c}": F.lag(c).over(w) for c in attrs})
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"prev_{c}")) for c in attrs])
    res = res.withColumn("changed", changed)
    return res.where("changed") if only_changes else res


def change_history_summary(history: DataFrame, keys: list[str], seq_col: str = "batch_seq",
                           op_col: str = "op") -> DataFrame:
    """One row per (batch, op): rows and distinct keys (a version listing)."""
    k = F.struct(*[F.col(c) for c in keys]) if len(keys) > 1 else F.col(keys[0])
    return history.groupBy(seq_col, op_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.countDistinct(k).alias("n_keys"))


def retention_candidates(history: DataFrame, keys: list[str], cutoff, seq_col: str = "batch_seq") -> DataFrame:
    """Rows that a retention policy may drop: written at or before ``cutoff``
    and superseded by then. The version current at ``cutoff`` (also a delete
    marker) and everything after it are never candidates. Selects; deletes
    nothing."""
    upto = history.where(F.col(seq_col) <= F.lit(cutoff))
    current = latest_by_key(upto.select(*keys, seq_col), keys, [f"{seq_col} desc"])
    cur = current.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col(seq_col).alias("_c_seq"))
    cond = reduce(lambda a, b: a & b, [upto[k].eqNullSafe(cur[f"_c_{k}"]) for k in keys]) & (
        upto[seq_col] == cur["_c_seq"])
    return upto.join(cur, cond, "left_anti")
