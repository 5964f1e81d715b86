"""Order specifications and their encoding into max-comparable structs.

An order is a list of strings ``"col"``, ``"col asc"`` or ``"col desc"``
with Spark's default null placement (ascending: NULLS FIRST, descending:
NULLS LAST).  ``first_by_order`` turns "the first row in this order" into a
``max`` over a struct, which Spark evaluates as a partial (map-side) plus
final aggregate; unlike a ``row_number`` window it never needs all rows of
one key inside one task, so a hot key cannot stall a single executor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class OrderItem:
    name: str
    descending: bool = False
    nulls_last: bool | None = None  # None: Spark's default (asc NULLS FIRST, desc NULLS LAST)

    @property
    def nulls_at_end(self) -> bool:
        return self.descending if self.nulls_last is None else self.nulls_last

    def column(self) -> Column:
        c = F.col(self.name)
        if self.descending:
            return c.desc_nulls_last() if self.nulls_at_end else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_at_end else c.asc_nulls_first()

    def reversed(self) -> "OrderItem":
        return OrderItem(self.name, not self.descending, not self.nulls_at_end)


def parse_order(order) -> list[OrderItem]:
    """``"col"``, ``"col asc|desc"`` or ``"col asc|desc nulls first|last"``."""
    items = []
    for spec in [order] if isinstance(order, str) else order:
        if isinstance(spec, OrderItem):
            items.append(spec)
            continue
        parts = spec.split()
        low = [p.lower() for p in parts[1:]]
        if len(parts) == 1:
            items.append(OrderItem(parts[0]))
        elif len(parts) == 2 and low[0] in ("asc", "desc"):
            items.append(OrderItem(parts[0], low[0] == "desc"))
        elif len(parts) == 4 and low[0] in ("asc", "desc") and low[1] == "nulls" and low[2] in ("first", "last"):
            items.append(OrderItem(parts[0], low[0] == "desc", low[2] == "last"))
        else:
            raise ValueError(f"bad order item {spec!r}; use 'col [asc|desc] [nulls first|last]'")
    return items


def sort_columns(order) -> list[Column]:
    return [i.column() for i in parse_order(order)]


def _negatable(dt: T.DataType) -> bool:
    return isinstance(dt, _NUMERIC + (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))


def _as_number(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.TimestampNTZType):
        # zone-free microseconds since the epoch, from wall-clock parts (a cast
        # to TIMESTAMP would go through the session zone and fold DST gaps)
        day = F.unix_date(c.cast("date")).cast("long")
        secs = F.date_part(F.lit("SECOND"), c)  # seconds with microsecond fraction
        return (day * F.lit(86_400_000_000) + F.hour(c).cast("long") * F.lit(3_600_000_000)
                + F.minute(c).cast("long") * F.lit(60_000_000) + (secs * F.lit(1_000_000)).cast("long"))
    if isinstance(dt, T.BooleanType):
        return c.cast("int")
    return c


def encode_last(df: DataFrame, order) -> list[Column] | None:
    """Struct fields whose ``max`` is the LAST row of ``order`` (in struct
    ordering a NULL field is the smallest value).

    Returns None when an item cannot be encoded (a descending non-numeric
    column); callers then fall back to a window.
    """
    fields = []
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    for i, item in enumerate(parse_order(order)):
        c = F.col(item.name)
        dt = types[item.name]
        if item.descending and not _negatable(dt):
            return None
        value = (-_as_number(c, dt)) if item.descending else c
        if not item.descending and not item.nulls_at_end:
            fields.append(c.alias(f"_o{i}"))  # asc NULLS FIRST: NULL already smallest
            continue
        # NULLs last -> they must compare largest; NULLs first -> smallest
        flag = c.isNull() if item.nulls_at_end else c.isNotNull()
        fields.append(flag.alias(f"_o{i}n"))
        fields.append(value.alias(f"_o{i}"))
    return fields


def orderable(dt: T.DataType) -> bool:
    """Whether ``max`` over a struct holding this type is allowed."""
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(orderable(f.dataType) for f in dt.fields)
    variant = getattr(T, "VariantType", None)
    return not (variant is not None and isinstance(dt, variant))
