"""Entity state as a mergeable register: exact in any order of arrival.

``consolidate_state`` looks at all events of a key. A register keeps, per key,
just what any later merge can need, so the state of a stream is
``merge(state, batch)`` with no history behind it, and a batch that is late,
repeated or out of order changes nothing that it should not.

Per key the register holds the winner ``w`` (latest time, best source rank,
largest id) and per attribute three candidates among its non-NULL values:

* ``best`` -- the largest id at the winner's time and rank: it is the value;
* ``before`` -- the largest (time, rank, id) before the winner's time: the
  value where there is no ``best``;
* ``last`` -- the largest (rank, id) at the winner's time whatever the rank:
  it follows the winner in fill order and does not feed it, but becomes a
  ``before`` once a later winner arrives.

Merging is associative, commutative and idempotent, so exact duplicates need
no removal and a replayed batch is a no-op. NULL times are the oldest, a NULL
key is a key, as in ``consolidate_state``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.state import source_priority

REGISTER = "_register"


def event_register(events: DataFrame, keys: list[str], attrs: list[str], time: str, source: str, ranked: list, id_col: str,
                   default_priority: int | None = None) -> DataFrame:
    """Keys and ``_register`` of the events: two aggregates, the first of them combined before its shuffle."""
    base = source_priority(events.select(id_col, *keys, *attrs, time, source), source, ranked, default_priority, out="_prio")
    place = F.struct(F.col(time).alias("t"), (-F.col("_prio")).alias("r"), F.col(id_col).alias("id"), F.col(source).alias("s"))
    top = base.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max(place).alias("w"))
    rows = base.join(top, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]))
    now = F.col(time).eqNullSafe(F.col("w.t"))
    parts = []
    for a in attrs:
        has, v = F.col(a).isNotNull(), F.col(a).alias("v")
        rank, ident = F.col("_prio").alias("r"), F.col(id_col).alias("id")
        parts += [F.max(F.when(has & ~now, F.struct(F.col(time).alias("t"), rank, ident, v))).alias(f"before_{a}"),
                  F.max(F.when(has & now & (F.col("_prio") == -F.col("w.r")), F.struct(ident, v))).alias(f"best_{a}"),
                  F.max(F.when(has & now, F.struct(rank, ident, v))).alias(f"last_{a}")]
    held = rows.groupBy(*keys, "w").agg(*parts)
    fields = [F.struct(*[F.col(f"{p}_{a}").alias(p) for p in ("before", "best", "last")]).alias(f"a{i}") for i, a in enumerate(attrs)]
    return held.select(*keys, F.struct("w", *fields).alias(REGISTER))


def merge_registers(x: Column, y: Column, n_attrs: int) -> Column:
    """The register of the events of both; a NULL register holds none."""
    tx, ty, rx, ry = x["w"]["t"], y["w"]["t"], x["w"]["r"], y["w"]["r"]
    same = tx.eqNullSafe(ty)
    x_later = ~same & tx.isNotNull() & (ty.isNull() | (tx > ty))

    def past(reg: Column, i: int) -> Column:
        """``before`` once the register's time is over."""
        a = reg[f"a{i}"]
        last = F.when(a["last"].isNotNull(), F.struct(reg["w"]["t"].alias("t"), a["last"]["r"].alias("r"), a["last"]["id"].alias("id"), a["last"]["v"].alias("v")))
        return F.greatest(a["before"], last)

    fields = []
    for i in range(n_attrs):
        a, b = x[f"a{i}"], y[f"a{i}"]
        before = (F.when(same, F.greatest(a["before"], b["before"]))
                  .when(x_later, F.greatest(a["before"], past(y, i))).otherwise(F.greatest(past(x, i), b["before"])))
        tied = F.when(rx == ry, F.greatest(a["best"], b["best"])).when(rx > ry, a["best"]).otherwise(b["best"])
        best = F.when(same, tied).when(x_later, a["best"]).otherwise(b["best"])
        last = F.when(same, F.greatest(a["last"], b["last"])).when(x_later, a["last"]).otherwise(b["last"])
        fields.append(F.struct(before.alias("before"), best.alias("best"), last.alias("last")).alias(f"a{i}"))
    both = F.struct(F.greatest(x["w"], y["w"]).alias("w"), *fields)
    return F.when(x.isNull(), y).when(y.isNull(), x).otherwise(both)


def register_state(registers: DataFrame, keys: list[str], attrs: list[str], time: str, source: str, id_col: str) -> DataFrame:
    """The rows ``consolidate_state`` gives for the same events."""
    w = F.col(REGISTER)["w"]
    values = [F.coalesce(F.col(REGISTER)[f"a{i}"]["best"]["v"], F.col(REGISTER)[f"a{i}"]["before"]["v"]).alias(a) for i, a in enumerate(attrs)]
    return registers.select(w["id"].alias(f"last_{id_col}"), *keys, *values, w["t"].alias(time), w["s"].alias(source))
