"""Dimensions: current-state (SCD1), versioned (SCD2) and calendar.

SCD2 tables use half-open validity ``[valid_from, valid_to)``; ``valid_to``
NULL means open; exactly one ``is_current`` row per natural key. The write
timestamp and the effective date are parameters, never ``current_*``, so a
re-run reproduces the same keys and the result can be checked by an oracle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.calendar import (
    BEGINNING_OF_TIME,
    date_sk,
    name_lookup,
    period_of_year,
)
from strata.functions.keys import fingerprint, legacy_fingerprint, surrogate_key, version_key
from strata.operators.merge import split_by_keys
from strata.session import staged


class EffectiveDateError(ValueError):
    pass


class NaturalKeyError(ValueError):
    pass


def require_natural_key(df: DataFrame, key: str) -> None:
    """Raise ``NaturalKeyError`` if ``key`` is NULL or repeated in ``df`` (one
    aggregate): either would leave two current versions of a key, or a new
    one on every run."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    nulls, repeated = per.agg(F.count_if(F.col(key).isNull()), F.count_if(F.col("_n") > 1)).first()
    if nulls or repeated:
        raise NaturalKeyError(f"{key}: {nulls} NULL, {repeated} repeated")


def scd1_dim(df: DataFrame, key: str, attrs: list[str] | None = None, sk_col: str | None = None) -> DataFrame:
    """Current-state dimension: natural key, attributes and a deterministic
    surrogate key ``sha2(key)``; load it with ``upsert`` on ``key``."""
    attrs = attrs if attrs is not None else [c for c in df.columns if c != key]
    sk_col = sk_col or f"{key}_sk"
    return df.select(key, *attrs).withColumn(sk_col, surrogate_key(key))


def with_attr_hash(df: DataFrame, attrs: list[str], hash_col: str = "attributes_hash",
                   legacy_hash: bool = False) -> DataFrame:
    h = legacy_fingerprint(attrs) if legacy_hash else fingerprint(attrs)
    return df.withColumn(hash_col, h)


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(d).cast("date")


def scd2_init(df: DataFrame, key: str, attrs: list[str], version_ts, start=BEGINNING_OF_TIME,
              sk_col: str | None = None, hash_col: str = "attributes_hash", legacy_hash: bool = False,
              valid_from: str = "valid_from", valid_to: str = "valid_to", current: str = "is_current",
              validate: bool = True) -> DataFrame:
    """First load: every row becomes an open, current version starting at
    ``start``. ``validate`` raises on a NULL or repeated natural key."""
    if validate:
        require_natural_key(df, key)
    sk_col = sk_col or f"{key}_sk"
    out = with_attr_hash(df, attrs, hash_col, legacy_hash)
    return (out.withColumn(sk_col, version_key(key, version_ts))
            .withColumn(valid_from, _lit_date(start))
            .withColumn(valid_to, F.lit(None).cast("date"))
            .withColumn(current, F.lit(True)))


def scd2_changes(dim: DataFrame, incoming: DataFrame, key: str, attrs: list[str],
                 hash_col: str = "attributes_hash", legacy_hash: bool = False,
                 current: str = "is_current") -> DataFrame:
    """Incoming rows that need a new version: new key or changed hash.
    Adds ``_had_active`` (the key had a current version)."""
    inc = incoming if hash_col in incoming.columns else with_attr_hash(incoming, attrs, hash_col, legacy_hash)
    active = dim.where(F.col(current)).select(F.col(key).alias("_a_key"), F.col(hash_col).alias("_a_hash"))
    j = inc.join(active, inc[key] == active["_a_key"], "left")
    return (j.where(F.col("_a_hash").isNull() | (F.col(hash_col) != F.col("_a_hash")))
            .withColumn("_had_active", F.col("_a_key").isNotNull())
            .drop("_a_key", "_a_hash"))


def scd2_has_changes(dim: DataFrame, incoming: DataFrame, key: str, attrs: list[str],
                     hash_col: str = "attributes_hash", legacy_hash: bool = False,
                     current: str = "is_current") -> bool:
    """True when ``incoming`` brings a new key or a changed version: callers
    skip publishing a new snapshot when nothing changed (one bounded job:
    the join stops at the first changed row)."""
    return not scd2_changes(dim, incoming, key, attrs, hash_col, legacy_hash, current).isEmpty()


def scd2_apply(dim: DataFrame, incoming: DataFrame, key: str, attrs: list[str], effective_date,
               version_ts, new_key_start=None, close_missing: bool = False, sk_col: str | None = None,
               hash_col: str = "attributes_hash", legacy_hash: bool = False, validate: bool = True,
               valid_from: str = "valid_from", valid_to: str = "valid_to", current: str = "is_current") -> DataFrame:
    """Next state of an SCD2 dimension. ``incoming`` is evaluated once, into a
    staged copy, and compared with ``dim`` once; the (few) changes are staged
    too, so validation and the result read what was found.

    Changed keys: the current version is closed at ``effective_date`` and a
    new current version opens there. New keys open at ``new_key_start``
    (default: ``effective_date``). Unchanged keys are untouched, so an
    unchanged input returns ``dim`` as it was. ``close_missing`` also closes
    current versions whose key is absent from ``incoming``. ``validate``
    (default) raises if ``effective_date`` precedes the start of a current
    version being closed (out-of-order loads are rejected, not repaired), or
    if ``incoming`` repeats a natural key or has a NULL one.
    """
    incoming = staged(incoming, "scd2-load")
    if validate:
        require_natural_key(incoming, key)
    sk_col = sk_col or f"{key}_sk"
    eff = _lit_date(effective_date)
    changes = staged(scd2_changes(dim, incoming, key, attrs, hash_col, legacy_hash, current), "scd2-changes")
    closing = changes.where("_had_active").select(F.col(key).alias("_c_key"))
    if close_missing:
        gone = dim.where(F.col(current)).select(F.col(key).alias("_c_key")).join(
            incoming.select(F.col(key).alias("_c_key")), "_c_key", "left_anti")
        closing = closing.unionByName(gone)
    closing = staged(closing.distinct(), "scd2-closing")  # one row per key: the joins below cannot fan out
    if validate:
        bad = dim.where(F.col(current)).join(closing, dim[key] == closing["_c_key"]).where(F.col(valid_from) > eff)
        if not bad.isEmpty():
            raise EffectiveDateError("effective_date precedes the start of a current version")
    marked = dim.join(closing, (dim[key] == closing["_c_key"]) & F.col(current), "left")
    hit = F.col("_c_key").isNotNull()
    kept = marked.select(*[
        (F.when(hit, eff).otherwise(F.col(valid_to)).alias(c) if c == valid_to else
         F.when(hit, F.lit(False)).otherwise(F.col(current)).alias(c) if c == current else F.col(c))
        for c in dim.columns])
    start = F.when(F.col("_had_active"), eff).otherwise(_lit_date(new_key_start) if new_key_start is not None else eff)
    new_rows = (changes.withColumn(sk_col, version_key(key, version_ts))
                .withColumn(valid_from, start)
                .withColumn(valid_to, F.lit(None).cast("date"))
                .withColumn(current, F.lit(True))
                .select(*dim.columns))
    return kept.unionByName(new_rows)


def scd2_merge(dim: DataFrame | None, incoming: DataFrame, key: str, attrs: list[str], effective_date, sk_col: str | None = None,
               hash_col: str = "attributes_hash", legacy_hash: bool = False, valid_from: str = "valid_from", valid_to: str = "valid_to",
               current: str = "is_current", seen: str = "seen_on") -> DataFrame:
    """``dim`` after one more load, whose ``effective_date`` may lie before, inside or after what is there:
    loads applied in any order give one and the same table.

    A version runs from the first day its attributes were seen to the first
    later day others were; ``seen_on`` holds all days a load confirmed it
    (one per load, so it stays short). A load inside an interval splits it:
    what was seen on later days comes back as a version of its own. Two loads
    of the same day that differ keep the row with the larger hash. The
    surrogate key hashes the natural key and ``valid_from``, so it does not
    depend on the order either. The table has the key, ``attrs`` and the
    columns named above. Only keys of ``incoming`` are rebuilt; ``incoming``
    is evaluated once and may not repeat a key or have a NULL one. Keys that a
    load lacks stay as they are (see ``scd2_apply(close_missing=True)``).
    """
    sk_col = sk_col or f"{key}_sk"
    load = staged(with_attr_hash(incoming.select(key, *attrs), attrs, hash_col, legacy_hash), "scd2-load")
    require_natural_key(load, key)
    columns = [key, *attrs, hash_col, sk_col, valid_from, valid_to, current, seen]
    rows = load.withColumn("_on", _lit_date(effective_date))
    rest = None
    if dim is not None:
        rest, touched = split_by_keys(dim.select(*columns), load, [key])
        rows = touched.select(key, *attrs, hash_col, F.explode(seen).alias("_on")).unionByName(rows)
    per_day = rows.groupBy(key, "_on").agg(F.max(F.struct(hash_col, *attrs)).alias("_row")).select(key, "_on", "_row.*")
    by_day = Window.partitionBy(key).orderBy("_on")  # as many rows as loads
    starts = F.coalesce(F.col(hash_col) != F.lag(hash_col).over(by_day), F.lit(True))
    numbered = per_day.withColumn("_starts", starts).withColumn("_run", F.sum(F.col("_starts").cast("int")).over(by_day))
    runs = numbered.groupBy(key, "_run").agg(F.min("_on").alias(valid_from), F.sort_array(F.collect_set("_on")).alias(seen),
                                            F.max(F.struct(hash_col, *attrs)).alias("_row")).select(key, "_run", valid_from, seen, "_row.*")
    ends = F.lead(valid_from).over(Window.partitionBy(key).orderBy("_run"))
    made = runs.withColumn(valid_to, ends).withColumn(current, F.col(valid_to).isNull()).withColumn(sk_col, version_key(key, F.col(valid_from))).select(*columns)
    return made if rest is None else rest.unionByName(made)


def calendar_dim(spark: SparkSession, start, end, month_names: list[str], day_names: list[str],
                 period_months: int = 2) -> DataFrame:
    """One row per day in [start, end] (inclusive); ``start``/``end`` may be
    dates, ISO strings or columns of a one-row DataFrame (see
    ``calendar_for``). ``month_names`` start with January, ``day_names`` with
    Sunday."""
    days = spark.range(1).select(F.explode(F.sequence(_lit_date(start), _lit_date(end))).alias("date"))
    return calendar_columns(days, month_names, day_names, period_months)


def calendar_for(bounds: DataFrame, start_col: str, end_col: str, month_names: list[str], day_names: list[str],
                 period_months: int = 2, whole_years: bool = True) -> DataFrame:
    """Calendar spanning a range computed by Spark (e.g. ``min``/``max`` of a
    fact date); ``whole_years`` widens it to full calendar years."""
    s, e = F.col(start_col).cast("date"), F.col(end_col).cast("date")
    if whole_years:
        s = F.make_date(F.year(s), F.lit(1), F.lit(1))
        e = F.make_date(F.year(e), F.lit(12), F.lit(31))
    days = bounds.select(F.explode(F.sequence(s, e)).alias("date"))
    return calendar_columns(days, month_names, day_names, period_months)


def calendar_columns(days: DataFrame, month_names: list[str], day_names: list[str], period_months: int = 2) -> DataFrame:
    d = F.col("date")
    return days.select(
        d.alias("date"),
        date_sk(d).alias("date_sk"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        period_of_year(d, period_months).alias("period"),
        F.quarter(d).alias("quarter"),
        name_lookup(month_names, F.month(d)).alias("month_name"),
        name_lookup(day_names, F.dayofweek(d)).alias("weekday_name"),
    )
