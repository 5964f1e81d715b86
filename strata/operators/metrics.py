"""Gold metrics at a declared grain and the questions asked of them.

Aggregates are NULL-skipping and built from Spark's algebraic functions, so
they combine map-side. Exact distinct counts plan as a two-level aggregate
that first shuffles on (grain, value): a hot grain key is spread over its
distinct values before the final count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.calendar import month_start


def exact_mean(col: str | Column, scale: int, digits: int) -> Column:
    """Mean of a fixed-scale quantity (e.g. money with 2 decimals) computed
    in DECIMAL: exact sum, one HALF_UP rounding at ``digits``; returned as
    DOUBLE. Unlike a double average it does not depend on summation order,
    so every partitioning (and every engine) gives the same value."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.sum(c.cast(f"decimal(36,{scale})")) / F.count(c), digits).cast("double")


def _metric(kind: str, col: str | None, digits: int | None, scale: int | None = None) -> Column:
    c = F.col(col) if col else None
    rnd = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    if kind == "mean" and scale is not None:
        return exact_mean(c, scale, digits if digits is not None else 6)
    if kind == "count":
        return F.count(c if c is not None else F.lit(1))
    if kind == "count_true":
        return F.sum(c.cast("int")).cast("long")
    if kind == "rate_pct":  # NULL flags leave the denominator
        return rnd(F.avg(c.cast("int")) * F.lit(100))
    if kind == "mean":
        return rnd(F.avg(c))
    if kind == "sum":
        return rnd(F.sum(c)) if digits is not None else F.sum(c)
    if kind == "count_distinct":
        return F.countDistinct(c)
    if kind == "approx_count_distinct":
        return F.approx_count_distinct(c)
    if kind == "min":
        return F.min(c)
    if kind == "max":
        return F.max(c)
    raise ValueError(f"unknown metric kind {kind!r}")


def rollup_metrics(df: DataFrame, grain: list[str], metrics: list[tuple], month_of: dict | None = None,
                   digits: int | None = None, processed_at: Column | None = None,
                   stamp_col: str = "processed_at") -> DataFrame:
    """Group by ``grain`` and compute ``metrics`` = [(out, kind, col[, scale]), ...].

    ``month_of`` = {out_col: date_col} adds month-start grain columns first
    (``trunc(date, 'month')`` as DATE). Kinds: count, count_true, rate_pct,
    mean, sum, count_distinct, approx_count_distinct, min, max. A ``scale``
    on a mean makes it an exact DECIMAL mean (see ``exact_mean``).
    """
    src = df
    for out, dcol in (month_of or {}).items():
        src = src.withColumn(out, month_start(F.col(dcol)))
    aggs = [_metric(m[1], m[2], digits, m[3] if len(m) > 3 else None).alias(m[0]) for m in metrics]
    res = src.groupBy(*grain).agg(*aggs)
    if processed_at is not None:
        res = res.withColumn(stamp_col, processed_at)
    return res


def daily_metrics(df: DataFrame, day_col: str, entity: list[str], metrics: list[tuple],
                  digits: int | None = None) -> DataFrame:
    return rollup_metrics(df, [day_col, *entity], metrics, digits=digits)


def top_groups(df: DataFrame, by: str, k: int, tie_break: list[str], descending: bool = True) -> DataFrame:
    """The k best groups by ``by`` with a total tie-break (a top-k report:
    the limit is the feature). Plans as TakeOrderedAndProject: each task keeps
    k rows, the driver merges k x tasks rows."""
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc_nulls_first() for c in tie_break]).limit(k)


def period_change(df: DataFrame, entity: list[str], period_col: str, p1, p2, measures: dict[str, Column],
                  digits: int | None = None) -> DataFrame:
    """Per entity: each measure in period ``p1`` and ``p2`` and the change
    (p2 - p1), by conditional aggregation in one pass (no self-join).
    ``measures``: name -> aggregate expression over the rows of a period."""
    out = []
    rnd = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    sub = df.where(F.col(period_col).isin(p1, p2))
    for name, agg in measures.items():
        out.append(agg(F.col(period_col) == F.lit(p1)).alias(f"{name}_p1"))
        out.append(agg(F.col(period_col) == F.lit(p2)).alias(f"{name}_p2"))
    res = sub.groupBy(*entity).agg(*out)
    for name in measures:
        res = res.withColumn(f"{name}_change", rnd(F.col(f"{name}_p2") - F.col(f"{name}_p1")))
    return res


def double_decline(changes: DataFrame, measure_a: str, measure_b: str) -> DataFrame:
    """Entities where both measures fell from period 1 to period 2."""
    return changes.where((F.col(f"{measure_a}_change") < 0) & (F.col(f"{measure_b}_change") < 0))


def at_risk(df: DataFrame, entity: list[str], group: list[str], value: str, threshold: float,
            below: bool = True) -> DataFrame:
    """Per ``group``: how many entities have a mean ``value`` under (or over)
    ``threshold``. Two aggregates: entity means, then a conditional count."""
    means = df.groupBy(*group, *entity).agg(F.avg(value).alias("_mean"))
    cond = F.col("_mean") < F.lit(threshold) if below else F.col("_mean") > F.lit(threshold)
    return means.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_entities"), F.count_if(cond).alias("n_at_risk"))


def vs_population(df: DataFrame, entity: list[str], value: str, digits: int | None = 2,
                  scale: int | None = None) -> DataFrame:
    """Entity mean next to the population mean of all rows and the difference.

    The population mean is a scalar subquery (``DataFrame.scalar``): Spark
    runs it as its own one-row aggregate and inlines the value, so there is
    neither a join nor a window over the whole table. ``scale`` computes
    both means exactly in DECIMAL (see ``exact_mean``)."""
    rnd = (lambda x: F.round(x, digits)) if digits is not None else (lambda x: x)
    mean = (lambda: exact_mean(value, scale, digits if digits is not None else 6)) if scale is not None else (
        lambda: F.avg(value))
    pop = df.agg(mean().alias("_pop")).scalar()
    per = df.groupBy(*entity).agg(mean().alias("_m"))
    return per.select(*entity, rnd(F.col("_m")).alias("entity_mean"), rnd(pop).alias("population_mean"),
                      rnd(F.col("_m") - pop).alias("diff_from_population"))


def grain_safe_join(left: DataFrame, right: DataFrame, grain: list[str], left_aggs: dict[str, Column],
                    right_aggs: dict[str, Column], right_grain: list[str] | None = None,
                    how: str = "full_outer") -> DataFrame:
    """Aggregate each side to the shared grain first, then join 1:1.

    ``right_grain`` (default ``grain``) lets a coarser right side (e.g. no
    subject column) be aggregated on its own grain and attached to every
    left row of that coarser key: still no fan-out, because the right side
    is unique on its key after aggregation. NULL grain values are values:
    they group together and match each other, so the result is unique on
    ``grain``; a coarse right row without any left row stands alone with NULL
    in the columns it does not have."""
    rg = right_grain or grain
    l = left.groupBy(*grain).agg(*[v.alias(k) for k, v in left_aggs.items()])
    r = right.groupBy(*[F.col(c).alias(f"_r_{c}") for c in rg]).agg(*[v.alias(k) for k, v in right_aggs.items()])
    l, r = l.withColumn("_in_l", F.lit(True)), r.withColumn("_in_r", F.lit(True))
    cond = reduce(lambda a, b: a & b, [l[c].eqNullSafe(r[f"_r_{c}"]) for c in rg])
    keys = [F.when(F.col("_in_l").isNotNull(), F.col(c)).otherwise(F.col(f"_r_{c}")).alias(c) if c in rg else F.col(c) for c in grain]
    return l.join(r, cond, how).select(*keys, *left_aggs, *right_aggs)


def distinct_sketches(df: DataFrame, grain: list[str], cols: list[str], lg_k: int = 12) -> DataFrame:
    """Per group of ``grain``: ``n_rows`` and for each column a HyperLogLog sketch ``sketch_<col>`` of its
    distinct values (NULL is none), to be stored and merged later without the raw rows. The relative standard
    error is 1.04 / sqrt(2^lg_k): 1.6 % at the default, in 2 kB a group and column."""
    sketches = [F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"sketch_{c}") for c in cols]
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)


def merge_sketches(sketches: DataFrame, grain: list[str], cols: list[str]) -> DataFrame:
    """Stored sketches at a coarser ``grain`` (a subset of theirs), or of further batches at the same."""
    merged = [F.hll_union_agg(f"sketch_{c}").alias(f"sketch_{c}") for c in cols]
    return sketches.groupBy(*grain).agg(F.sum("n_rows").cast("long").alias("n_rows"), *merged)


def sketch_counts(sketches: DataFrame, cols: list[str]) -> DataFrame:
    """Sketches replaced by the estimates ``distinct_<col>``."""
    named = {f"sketch_{c}": F.hll_sketch_estimate(f"sketch_{c}").alias(f"distinct_{c}") for c in cols}
    return sketches.select(*[named.get(c, F.col(c)) for c in sketches.columns])
