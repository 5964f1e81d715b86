"""Skew detection and salted two-stage aggregation.

Spark already pre-aggregates algebraic functions (sum, count, min, max) per
map task, so a hot key costs one row per task after the partial step. The
cases that still concentrate a hot key are exact distinct counts (every
distinct value must meet in one place) and non-combinable work. The salted
form splits those by a deterministic salt (a hash, never ``rand``: a
recomputed task must salt the same row the same way).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import staged


def skew_report(df: DataFrame, keys: list[str], hot_ratio: float = 100.0, digits: int = 6) -> DataFrame:
    """Rows per key, its share of all rows and its ratio to the median rows
    per key; ``is_hot`` when that ratio reaches ``hot_ratio``. The median is
    exact and, like the total, a scalar subquery over the per-key counts; it
    is found among the distinct counts, of which there are at most
    sqrt(2 x rows)."""
    per = staged(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")), "skew-counts")  # read three times
    tot = per.agg(F.sum("n_rows").alias("t")).scalar()
    sizes = per.groupBy("n_rows").agg(F.count(F.lit(1)).alias("k"))
    median = sizes.agg(F.percentile("n_rows", F.lit(0.5), F.col("k")).alias("m")).scalar()
    ratio = F.col("n_rows") / median
    return per.select(*keys, "n_rows", F.round(F.col("n_rows") / tot, digits).alias("share"),
                      F.round(ratio, digits).alias("ratio_to_median"), (ratio >= F.lit(float(hot_ratio))).alias("is_hot"))


def heavy_hitters(df: DataFrame, keys: list[str], share: float, digits: int = 6) -> DataFrame:
    """Every key with at least ``share`` of all rows, its exact ``n_rows`` and ``share``. NULL is a key.

    Each task summarises its rows in a frequent-items sketch of a size set by
    ``share`` alone; the sketches merge to candidates that include every such
    key (the sketch's error is below a quarter of ``share``), and a second
    scan counts the candidates only. No shuffle grows with the number of keys.
    """
    size = 1 << max(6, int(16 / share - 1).bit_length())
    mark = F.xxhash64(*[x for k in keys for x in (F.col(k), F.col(k).isNull())])
    rows = df.select(*keys, mark.alias("_h"))
    found, total = rows.agg(F.expr(f"approx_top_k(_h, {size}, {size})"), F.count(F.lit(1))).first()
    limit = share * total
    marks = [r["item"] for r in found or [] if r["count"] >= limit / 2]  # at most 4 / share of them
    counted = rows.where(F.col("_h").isin(marks) if marks else F.lit(False)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") >= F.lit(limit)).withColumn("share", F.round(F.col("n_rows") / F.lit(max(total, 1)), digits))


def salt_of(cols: list[str], salts: int) -> Column:
    """Deterministic salt in [0, salts)."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)).cast("int")


def salted_aggregate(df: DataFrame, keys: list[str], salts: int, sums: list[str] = (), counts: list[str] = (),
                     distincts: list[str] = (), count_rows: str | None = "n_rows",
                     mins: list[str] = (), maxs: list[str] = ()) -> DataFrame:
    """Equals ``groupBy(keys).agg(count(*), sum(s), count(c), min, max,
    count(DISTINCT d))`` for any ``salts``.

    One scan, two shuffles. Every row counts towards the combinable
    aggregates on a plain row per (key, salt), and each of its distinct
    columns adds a (key, salt of the value, column, value) row; a first
    aggregate makes values unique and combines the rest, a second folds the
    salts. A value always has the same salt, so the distinct counts of the
    salts add up; a hot key's values are spread over ``salts`` tasks.
    Output names: n_rows, sum_<s>, count_<c>, min_<m>, max_<m>, distinct_<d>.
    """
    tags = [F.struct(F.lit(None).cast("int").alias("d"), F.lit(None).cast("string").alias("v"), F.lit(0).alias("salt"))]
    tags += [F.struct(F.lit(i).alias("d"), F.col(c).cast("string").alias("v"), salt_of([c], salts).alias("salt"))
             for i, c in enumerate(distincts)]
    values = list(dict.fromkeys([*sums, *counts, *mins, *maxs]))
    rows = df.select(*keys, *values, F.explode(F.array(*tags)).alias("_t")).select(*keys, *values, "_t.*")
    rows = rows.where(F.col("d").isNull() | F.col("v").isNotNull())
    plain = F.col("d").isNull()
    only = lambda c: F.when(plain, F.col(c))  # noqa: E731 - the tag rows repeat the values
    s1 = [F.sum(only(c)).alias(f"sum_{c}") for c in sums] + [F.count(only(c)).alias(f"count_{c}") for c in counts]
    s1 += [F.min(only(c)).alias(f"min_{c}") for c in mins] + [F.max(only(c)).alias(f"max_{c}") for c in maxs]
    s1.append(F.count_if(plain).alias("_rows"))
    stage1 = rows.groupBy(*keys, "salt", "d", "v").agg(*s1)
    fold = [F.sum("_rows").cast("long").alias(count_rows)] if count_rows else []
    fold += [F.sum(f"sum_{c}").alias(f"sum_{c}") for c in sums]
    fold += [F.sum(f"count_{c}").cast("long").alias(f"count_{c}") for c in counts]
    fold += [F.min(f"min_{c}").alias(f"min_{c}") for c in mins] + [F.max(f"max_{c}").alias(f"max_{c}") for c in maxs]
    fold += [F.count_if(F.col("d") == i).cast("long").alias(f"distinct_{c}") for i, c in enumerate(distincts)]
    return stage1.groupBy(*keys).agg(*fold)


def plain_aggregate(df: DataFrame, keys: list[str], sums: list[str] = (), counts: list[str] = (),
                    distincts: list[str] = (), count_rows: str | None = "n_rows", mins=(), maxs=()) -> DataFrame:
    """The unsalted reference form of ``salted_aggregate`` (same output)."""
    aggs = [F.sum(c).alias(f"sum_{c}") for c in sums] + [F.count(c).alias(f"count_{c}") for c in counts]
    aggs += [F.min(c).alias(f"min_{c}") for c in mins] + [F.max(c).alias(f"max_{c}") for c in maxs]
    if count_rows:
        aggs.append(F.count(F.lit(1)).alias(count_rows))
    aggs += [F.countDistinct(d).alias(f"distinct_{d}") for d in distincts]
    return df.groupBy(*keys).agg(*aggs)
