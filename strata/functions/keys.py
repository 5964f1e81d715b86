"""Key expressions: surrogate keys and attribute hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator of the legacy attribute hash and of the version key.
LEGACY_SEPARATOR = "||"
# Marker for NULL in the null-aware fingerprint (a control
# character that does not occur in ordinary text).
NULL_MARKER = "\u0000"


def surrogate_key(*cols, bits: int = 256) -> Column:
    """Deterministic key of the natural key: sha2 over its string form."""
    if len(cols) == 1:
        return F.sha2(F.col(cols[0]).cast("string") if isinstance(cols[0], str) else cols[0].cast("string"), bits)
    return fingerprint(list(cols), bits=bits)


def legacy_fingerprint(cols, separator: str = LEGACY_SEPARATOR, bits: int = 256) -> Column:
    """sha2 of ``concat_ws(sep, cols)``: NULLs are skipped, so (a,b,NULL) and
    (a,NULL,b) collide; kept for parity with tables hashed that way."""
    return F.sha2(F.concat_ws(separator, *[F.col(c).cast("string") for c in cols]), bits)


def fingerprint(cols, bits: int = 256) -> Column:
    """Null-aware, unambiguous hash of attribute values.

    Each value is written as ``<length>:<text>`` and NULL as the marker, so
    neither NULL position nor separators inside the data can make two
    different tuples hash alike.
    """
    parts = []
    for c in cols:
        s = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.when(s.isNull(), F.lit(NULL_MARKER)).otherwise(F.concat(F.length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat_ws(",", *parts), bits)


def version_key(key_col: str, version_ts, bits: int = 256) -> Column:
    """Key of one SCD2 version: hash of natural key and the write timestamp."""
    ts = version_ts if isinstance(version_ts, Column) else F.lit(str(version_ts))
    return F.sha2(F.concat_ws(LEGACY_SEPARATOR, F.col(key_col).cast("string"), ts.cast("string")), bits)
