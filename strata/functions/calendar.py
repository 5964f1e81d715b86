"""Calendar expressions (pure column functions of a DATE column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portuguese month names, January first (parity with the
# reference calendar's month-name column).
MONTH_NAMES_PT = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
# Portuguese weekday names, Sunday first, matching Spark's
# dayofweek() numbering 1 = Sunday ... 7 = Saturday.
WEEKDAY_NAMES_PT = [
    "Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira",
    "Quinta-feira", "Sexta-feira", "Sábado",
]
# Start date of the first version of an SCD2 dimension.
BEGINNING_OF_TIME = "1900-01-01"


def name_lookup(names: list[str], index: Column) -> Column:
    """1-based name lookup from a literal array (``element_at``)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), index)


def date_sk(d: Column) -> Column:
    """yyyyMMdd as INT."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def period_of_year(d: Column, months: int) -> Column:
    """Period number 1..12/months (2 = two-month period, 3 = quarter)."""
    return F.ceil(F.month(d) / F.lit(months)).cast("int")


def month_start(d: Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(d, "month")
