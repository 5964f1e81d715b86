"""Keyed upsert and change classification without a MERGE statement.

Plain Parquet has no MERGE, so an upsert is expressed as a full outer join
of target and source on the key followed by a per-column choice. Both
inputs are unique on the key (the source is checked), so the join cannot
fan out and no key can be hot. The source is evaluated once: it is staged
under the checkpoint folder, checked there, and read back with its real size.
The target is first split by the source's keys, so only touched rows enter
the keyed join; where the planner finds the staged keys below its broadcast
threshold that split is map-only and the target is never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.ordering import orderable
from strata.session import staged


class DuplicateKeyError(ValueError):
    pass


def _cond(t: DataFrame, s: DataFrame, keys, null_safe: bool) -> Column:
    parts = [(t[k].eqNullSafe(s[k]) if null_safe else t[k] == s[k]) for k in keys]
    return reduce(lambda a, b: a & b, parts)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = True,
           newer_by: str | None = None, coalesce_existing: bool = False,
           when_changed: list[str] | None = None, validate: bool = True, stage: bool = True) -> DataFrame:
    """Target rows whose key is in ``source`` are replaced by the source row,
    source rows with a new key are inserted, other target rows are kept.

    * ``null_safe`` -- a NULL key matches a NULL key (plain ``=`` never does,
      which silently re-inserts NULL-key groups on every run);
    * ``newer_by`` -- replace only if the source value of this column is not
      older than the target's (protects against stale re-sends);
    * ``coalesce_existing`` -- a NULL in the source keeps the target value;
    * ``when_changed`` -- replace only if one of these columns differs
      (null-safe); identical re-sends keep the target row untouched;
    * ``validate`` -- raise ``DuplicateKeyError`` if the source repeats a key;
    * ``stage`` -- evaluate the source once, into the checkpoint folder; pass
      False for a source that is already a stored table.

    Column order: target columns first, then new source columns.
    """
    if stage:
        source = staged(source, "upsert-source")
    if validate:
        require_unique(source, keys)
    opts = dict(null_safe=null_safe, newer_by=newer_by, coalesce_existing=coalesce_existing,
                when_changed=when_changed)
    untouched, touched = split_by_keys(target, source, keys, null_safe)
    merged = _keyed_merge(touched, source, keys, **opts)
    return untouched.unionByName(merged, allowMissingColumns=True).select(*merged.columns)


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise ``DuplicateKeyError`` if ``df`` repeats a key (one aggregate; NULL is a key)."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1)).first()[0]
    if repeated:
        raise DuplicateKeyError(f"source is not unique on {keys}: {repeated} repeated keys")


def split_by_keys(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = True):
    """``target`` rows whose key is not in ``source``, and those whose key is."""
    tgt, sk = target.alias("_tgt"), source.select(*keys).alias("_srck")
    parts = [(F.col(f"_tgt.{k}").eqNullSafe(F.col(f"_srck.{k}")) if null_safe
              else F.col(f"_tgt.{k}") == F.col(f"_srck.{k}")) for k in keys]
    cond = reduce(lambda x, y: x & y, parts)
    columns = [F.col(f"_tgt.{c}") for c in target.columns]
    return tgt.join(sk, cond, "left_anti").select(*columns), tgt.join(sk, cond, "left_semi").select(*columns)


def _keyed_merge(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool,
                 newer_by: str | None, coalesce_existing: bool, when_changed: list[str] | None,
                 flag: str | None = None, combine: dict | None = None) -> DataFrame:
    """The full outer join of two key-unique inputs with the per-column choice.
    ``combine``: column -> function of (target, source) values where both
    sides have the row. ``flag`` adds whether the row is new or differs from
    the target's (NULLs equal; columns of types without equality count as
    different), and as ``<flag>_new`` whether it is new."""
    t = target.withColumn("_t_present", F.lit(True)).alias("t")
    s = source.withColumn("_s_present", F.lit(True)).alias("s")
    j = t.join(s, _cond(t, s, keys, null_safe), "full_outer")
    in_t, in_s = F.col("t._t_present").isNotNull(), F.col("s._s_present").isNotNull()
    take = in_s
    if newer_by is not None:
        take = take & (~in_t | F.col(f"t.{newer_by}").isNull() | (F.col(f"s.{newer_by}") >= F.col(f"t.{newer_by}")))
    if when_changed:
        changed = reduce(lambda a, b: a | b,
                         [~_same(F.col(f"s.{c}"), F.col(f"t.{c}")) for c in when_changed])
        take = take & (~in_t | changed)
    out_cols = target.columns + [c for c in source.columns if c not in target.columns]
    sel = []
    for c in out_cols:
        tc = F.col(f"t.{c}") if c in target.columns else None
        sc = F.col(f"s.{c}") if c in source.columns else None
        if c in (combine or {}) and tc is not None and sc is not None:
            expr = F.when(in_t & in_s, combine[c](tc, sc)).otherwise(F.coalesce(sc, tc))
        elif sc is None:
            expr = tc
        elif tc is None:
            expr = F.when(take, sc)
        elif coalesce_existing and c not in keys:
            expr = F.when(take, F.coalesce(sc, tc)).otherwise(tc)
        else:
            expr = F.when(take, sc).otherwise(tc)
        sel.append(expr)
    named = [e.alias(c) for c, e in zip(out_cols, sel, strict=True)]
    if flag:
        types = {f.name: f.dataType for f in target.schema}
        same = [e.eqNullSafe(F.col(f"t.{c}")) if c in types and orderable(types[c]) else F.lit(False)
                for c, e in zip(out_cols, sel, strict=True)]
        changed = ~in_t | (take & ~reduce(lambda a, b: a & b, same))
        named += [changed.alias(flag), (~in_t).alias(f"{flag}_new")]
    return j.select(*named)


def classify_changes(target: DataFrame, source: DataFrame, keys: list[str], attrs: list[str],
                     null_safe: bool = True, out: str = "action") -> DataFrame:
    """One row per source row with ``action`` = insert / update / noop
    (attribute comparison is null-safe)."""
    t = target.select(*keys, *attrs).withColumn("_t_present", F.lit(True)).alias("t")
    s = source.alias("s")
    j = s.join(t, _cond(s, t, keys, null_safe), "left")
    changed = reduce(lambda a, b: a | b, [~_same(F.col(f"s.{c}"), F.col(f"t.{c}")) for c in attrs])
    action = (F.when(F.col("t._t_present").isNull(), F.lit("insert"))
              .when(changed, F.lit("update")).otherwise(F.lit("noop")))
    return j.select(*[F.col(f"s.{c}") for c in source.columns], action.alias(out))


def merge_summary(target: DataFrame, source: DataFrame, keys: list[str], attrs: list[str],
                  null_safe: bool = True) -> DataFrame:
    """Row counts per action, plus target rows left untouched (``keep``)."""
    actions = classify_changes(target, source, keys, attrs, null_safe).groupBy("action").agg(
        F.count(F.lit(1)).alias("n_rows"))
    kept = target.join(source, [target[k].eqNullSafe(source[k]) if null_safe else target[k] == source[k]
                                for k in keys], "left_anti")
    keep = kept.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("keep").alias("action"), "n_rows")
    return actions.unionByName(keep)
