"""Entity-state operators: exact dedup, source priority, forward fill,
latest row per key and their composition ``consolidate_state``.

Scale notes
-----------
* ``dedup_exact`` is a hash aggregate and ``latest_by_key`` a
  ``row_number() = 1`` window that Spark plans with a partial
  ``WindowGroupLimit`` before the shuffle: both reduce a key to one row per
  map task, so a key holding a third of all rows never lands whole in one
  reducer.
* ``forward_fill`` needs every row, so it is a running scan. The default
  range-partitions on (key, order), so a hot key covers several tasks, and a
  carry row joins its ranges (``operators.scan``). ``skew_safe=False`` is the
  plain window partitioned by key: one shuffle less, one task per key, for
  keys known to be small.
* ``consolidate_state`` picks the winner per key with the same pre-limited
  window, joins the rows back to their key's winner (AQE splits a skewed
  join partition) and takes the last non-NULL value per attribute with an
  aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ordering import orderable, parse_order, sort_columns
from strata.operators.scan import fill_ranges


def dedup_exact(df: DataFrame, payload: list[str], id_col: str) -> DataFrame:
    """One row per distinct ``payload`` (NULLs equal); the surviving row is
    the one with the largest ``id_col`` (deterministic, unlike dropDuplicates)."""
    others = [c for c in df.columns if c not in payload and c != id_col]
    if not others:
        agg = df.groupBy(*payload).agg(F.max(id_col).alias(id_col))
    else:
        best = F.max(F.struct(F.col(id_col), *[F.col(c) for c in others])).alias("_best")
        agg = df.groupBy(*payload).agg(best).select(*payload, "_best.*")
    return agg.select(*df.columns)


def source_priority(df: DataFrame, col: str, ranked: list, default: int | None = None,
                    out: str = "priority") -> DataFrame:
    """Add an INT rank: ``ranked[0]`` -> 1, ``ranked[1]`` -> 2, ...; NULL or an
    unlisted source -> ``default`` (len(ranked) + 1 when not given)."""
    default = len(ranked) + 1 if default is None else default
    expr = None
    for i, v in enumerate(ranked, start=1):
        cond = F.col(col) == F.lit(v)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(out, expr.cast("int"))


def forward_fill(df: DataFrame, keys: list[str], order, cols: list[str], skew_safe: bool = True,
                 partitions: int | None = None) -> DataFrame:
    """Replace NULLs in ``cols`` by the last non-NULL value of the same key
    seen up to and including the row, in ``order`` (which should be total).

    ``skew_safe`` (default) scans ranges of (keys, order), so a key with many
    rows is scanned by several tasks (``operators.scan``); the result equals
    the plain per-key window, which ``skew_safe=False`` gives.
    """
    if skew_safe:
        return fill_ranges(df, keys, order, cols, partitions)
    w = (Window.partitionBy(*keys).orderBy(*sort_columns(order))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def latest_by_key(df: DataFrame, keys: list[str], order) -> DataFrame:
    """Exactly one row per key (a NULL key is a key): the first row in
    ``order``. The remaining columns are appended as tie-breakers, so the
    result is reproducible (also when a task is recomputed) even if
    ``order`` is not total.

    Spark plans ``row_number() = 1`` with a partial ``WindowGroupLimit``
    before the shuffle: every map task keeps one row per key, so a hot key
    arrives at its reducer as one row per map task, not as all its rows.
    """
    items = parse_order(order)
    named = {i.name for i in items} | set(keys)
    types = {f.name: f.dataType for f in df.schema.fields}
    ties = [F.col(c).asc_nulls_first() for c in df.columns if c not in named and orderable(types[c])]
    w = Window.partitionBy(*keys).orderBy(*sort_columns(items), *ties)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def consolidate_state(df: DataFrame, keys: list[str], attrs: list[str], time: str, source: str,
                      ranked: list, id_col: str, default_priority: int | None = None,
                      processed_at: Column | None = None, stamp_col: str = "processed_at",
                      fill_ties: bool = False) -> DataFrame:
    """Latest reliable state per key from an event stream (exactly the
    sequence dedup -> source priority -> forward fill -> latest row).

    * exact duplicates (same payload, different ``id_col``) collapse, max id kept;
    * the winner is the latest ``time`` (NULL oldest), then best source rank,
      then the largest id;
    * each attribute is the last non-NULL value at or before the winner in
      fill order (time asc, rank asc, id asc). A tied lower-ranked row after
      the winner does not feed it (same as the reference behaviour);
      ``fill_ties=True`` orders ties by rank descending instead, so rows tied
      with the winner on time do feed its NULL attributes.
    Output: ``last_<id_col>``, keys, attrs, time, source [, stamp].
    """
    payload = keys + attrs + [time, source]
    base = dedup_exact(df.select(id_col, *payload), payload, id_col)
    base = source_priority(base, source, ranked, default_priority, out="_prio")
    # winner per key: first in (time desc, prio asc, id desc); a row_number()=1
    # window that Spark pre-limits per map task, so a hot key ships one row per task
    win = latest_by_key(base.select(*keys, time, "_prio", id_col, source), keys,
                        [f"{time} desc", "_prio", f"{id_col} desc"])
    winners = win.select(*[F.col(k).alias(f"_wk_{k}") for k in keys], F.col(time).alias("_w_time"),
                         F.col("_prio").alias("_w_prio"), F.col(id_col).alias("_w_id"),
                         F.col(source).alias("_w_src"))
    cond = None
    for k in keys:
        c = base[k].eqNullSafe(winners[f"_wk_{k}"])
        cond = c if cond is None else cond & c
    sign = -1 if fill_ties else 1
    pos = F.struct(F.col(time), (F.col("_prio") * sign).alias("_prio"), F.col(id_col))
    wpos = F.struct(F.col("_w_time").alias(time), (F.col("_w_prio") * sign).alias("_prio"),
                    F.col("_w_id").alias(id_col))
    rows = base.join(winners, cond, "inner").where(pos <= wpos)
    # winner columns depend on the key only, so grouping by them adds no groups
    group = [F.col(f"_wk_{k}").alias(k) for k in keys] + [
        F.col("_w_id").alias(f"last_{id_col}"), F.col("_w_time").alias(time), F.col("_w_src").alias(source)]
    aggs = [F.max(F.when(F.col(a).isNotNull(), F.struct(pos.alias("p"), F.col(a).alias("v"))))["v"].alias(a)
            for a in attrs]
    out = rows.groupBy(*group).agg(*aggs).select(f"last_{id_col}", *keys, *attrs, time, source)
    if processed_at is not None:
        out = out.withColumn(stamp_col, processed_at)
    return out
