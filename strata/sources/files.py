"""File scans: typed, format-generic, and type normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
               options: dict | None = None) -> DataFrame:
    """Scan with a declared schema (no inference pass). CSV defaults to a
    header row. Declared non-null is not enforced by Spark's file sources;
    use ``checks.check_not_null`` for that contract."""
    defaults = {"header": True} if fmt == "csv" else {}
    return spark.read.format(fmt).schema(schema).options(**{**defaults, **(options or {})}).load(path)


def read_batch(spark: SparkSession, path: str, fmt: str, options: dict | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Format-generic scan (csv, json, parquet, orc, text ...). Without a
    schema the source infers one per batch; JSON arrays need
    ``{"multiLine": True}``."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**(options or {})).load(path)


def normalize(df: DataFrame, casts: dict[str, str] | None = None,
              timestamps: dict[str, str | None] | None = None, safe: bool = False) -> DataFrame:
    """Cast columns to declared types and parse timestamp strings.

    ``casts``: column -> Spark type name; ``timestamps``: column -> format
    (None = ISO-8601). ``safe`` turns malformed values into NULL instead of
    failing (ANSI mode raises). Columns absent from the batch are skipped.
    """
    present = set(df.columns)
    exprs = {}
    for c, t in (casts or {}).items():
        if c in present:
            exprs[c] = F.col(c).try_cast(t) if safe else F.col(c).cast(t)
    for c, fmt in (timestamps or {}).items():
        if c in present:
            src = F.col(c).cast("string")
            if safe:
                exprs[c] = F.try_to_timestamp(src, F.lit(fmt)) if fmt else F.try_to_timestamp(src)
            else:
                exprs[c] = F.to_timestamp(src, fmt) if fmt else F.to_timestamp(src)
    return df.withColumns(exprs) if exprs else df
