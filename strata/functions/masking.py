"""Masking rules as column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_with_salt(c: Column, salt: str) -> Column:
    """Pseudonymise: equal inputs stay joinable, raw value is not exposed."""
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def partial(c: Column, keep_start: int = 1, keep_end: int = 0, fill: str = "*") -> Column:
    """Keep the first/last characters, replace the middle by ``fill``."""
    s = c.cast("string")
    n = F.length(s)
    middle = F.greatest(n - F.lit(keep_start + keep_end), F.lit(0))
    head = F.substring(s, 1, keep_start) if keep_start else F.lit("")
    tail = F.substring(s, -keep_end, keep_end) if keep_end else F.lit("")
    return F.when(s.isNull(), F.lit(None).cast("string")).when(
        n <= F.lit(keep_start + keep_end), F.repeat(F.lit(fill), n)
    ).otherwise(F.concat(head, F.repeat(F.lit(fill), middle), tail))


def email_domain_only(c: Column) -> Column:
    """``user@domain`` -> ``***@domain``."""
    return F.regexp_replace(c.cast("string"), r"^[^@]*", "***")


def digits_masked(c: Column, keep_last: int = 2) -> Column:
    """Replace every digit except the last ``keep_last`` ones by ``*``."""
    s = c.cast("string")
    return F.regexp_replace(s, r"\d(?=(?:\D*\d){%d})" % keep_last, "*")


def nullify(c: Column, data_type=None) -> Column:
    """NULL of the column's own type (string when the type is not given)."""
    return F.lit(None).cast(data_type if data_type is not None else "string")
