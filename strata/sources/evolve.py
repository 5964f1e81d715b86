"""Schema-evolving batches: union by name with type widening, an append-only
batch log, and tolerant reads of columns that older batches do not have.

Types of one column in different batches meet in a lattice: byte < short <
int < long < decimal < double, float < double, date < timestamp (with or
without a zone), and a column of NULLs only fits any type. Structs, arrays
and maps meet part by part. Every value of the smaller type is kept exactly,
but where a decimal or a long meets a double. Anything else (text and a
number, the two kinds of timestamp) is refused.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import normalize, read_batch
from strata.sources.table import committed, committed_dirs, path_exists, read_text, write_text


class SchemaConflictError(TypeError):
    pass


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}  # and the digits a decimal needs for them
_STAMPS = (T.TimestampType, T.TimestampNTZType)


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The smallest type of the lattice that holds both (different, atomic) types."""
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType) or isinstance(x, T.DateType) and isinstance(y, _STAMPS):
            return y
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE[type(t)])
    numbers = (*_WHOLE, T.DecimalType, T.FloatType, T.DoubleType)
    if not (isinstance(a, numbers) and isinstance(b, numbers)):
        return None
    if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
        return T.DoubleType()
    parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0) for t in (a, b)]
    whole, scale = max(p[0] for p in parts), max(p[1] for p in parts)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def merge_schemas(a: T.DataType, b: T.DataType, where: str = "") -> T.DataType:
    """Union of two schemas by field name; nested types merge part by part,
    new fields go last, and two types of a field meet in the lattice above."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f for f in b.fields}
        out = [T.StructField(f.name, merge_schemas(f.dataType, theirs[f.name].dataType, f"{where}{f.name}.") if f.name in theirs else f.dataType, True)
               for f in a.fields]
        names = set(a.fieldNames())
        return T.StructType(out + [T.StructField(g.name, g.dataType, True) for g in b.fields if g.name not in names])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_schemas(a.elementType, b.elementType, where), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(merge_schemas(a.keyType, b.keyType, where), merge_schemas(a.valueType, b.valueType, where), True)
    if a != b:
        wider = _wider(a, b)
        if wider is None:
            raise SchemaConflictError(f"type conflict at {where.rstrip('.') or '<root>'}: "
                                      f"{a.simpleString()} vs {b.simpleString()}")
        return wider
    return a


def _converted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return c
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        parts = [(_converted(c[f.name], own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(c, lambda x: _converted(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keys = F.transform(F.map_keys(c), lambda x: _converted(x, have.keyType, want.keyType))
        values = F.transform(F.map_values(c), lambda x: _converted(x, have.valueType, want.valueType))
        return F.map_from_arrays(keys, values)
    return c.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``: wider types are cast, missing columns and fields are NULL."""
    if df.schema == schema:
        return df
    own = {f.name: f.dataType for f in df.schema.fields}
    quoted = lambda n: F.col("`" + n.replace("`", "``") + "`")
    return df.select(*[(_converted(quoted(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def evolve_union(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns or nested fields missing from a batch
    read NULL, a column gets the widest of its types; a type conflict raises
    before anything is computed."""
    if not dfs:
        raise ValueError("nothing to union")
    schema = reduce(merge_schemas, [d.schema for d in dfs])
    return reduce(lambda x, y: x.unionByName(y), [conform(d, schema) for d in dfs])


# -- tolerant reads ---------------------------------------------------------
def _named(names: list[str], part: str, sensitive: bool) -> str | None:
    if part in names or sensitive:
        return part if part in names else None
    found = [n for n in names if n.lower() == part.lower()]
    if len(found) > 1:
        raise SchemaConflictError(f"{part} is ambiguous: {found}")
    return found[0] if found else None


def _descend(c: Column, dt: T.DataType, parts: list[str], sensitive: bool) -> Column | None:
    """``c`` (of type ``dt``) followed along ``parts``: a struct's field, each element of an array, the value
    under a map's key. None where the schema has no such path."""
    if not parts:
        return c
    if isinstance(dt, T.StructType):
        name = _named(dt.fieldNames(), parts[0], sensitive)
        return None if name is None else _descend(c.getField(name), dt[name].dataType, parts[1:], sensitive)
    if isinstance(dt, T.ArrayType):
        if _descend(F.lit(None).cast(dt.elementType), dt.elementType, parts, sensitive) is None:
            return None
        return F.transform(c, lambda x: _descend(x, dt.elementType, parts, sensitive))
    if isinstance(dt, T.MapType) and isinstance(dt.keyType, T.StringType):
        return _descend(F.try_element_at(c, F.lit(parts[0])), dt.valueType, parts[1:], sensitive)
    return None


def select_tolerant(df: DataFrame, columns: dict[str, str], default_type: str = "string") -> DataFrame:
    """Project ``out_name -> "a.b.c"`` paths; a path that the (evolved)
    schema does not have yet yields a typed NULL instead of an error.

    A path goes through structs by field, through arrays into every element
    (``items.price`` is the array of prices) and through maps by key; a NULL
    struct, element or missing key yields NULL. Names match as the session's
    ``spark.sql.caseSensitive`` says; a name that matches exactly comes first,
    one that matches several others raises."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    sel: list[Column] = []
    for out, path in columns.items():
        parts, found = path.split("."), None
        for n in range(len(parts), 0, -1):  # column names may hold dots
            name = _named(df.columns, ".".join(parts[:n]), sensitive)
            if name is not None:
                found = _descend(F.col("`" + name.replace("`", "``") + "`"), df.schema[name].dataType, parts[n:], sensitive)
                break
        sel.append((F.lit(None).cast(default_type) if found is None else found).alias(out))
    return df.select(*sel)


class BatchLog:
    """Append-only table: one sub-directory per batch (``batch_id=<id>``)
    plus the merged schema in ``_schema.json``; reads use that schema, so a
    column or nested field a batch lacks reads NULL. Re-sending a committed
    batch is a no-op, so a re-run after a crash neither loses nor duplicates
    data.

    A batch whose types are narrower than the log's is cast as it is written.
    A batch that widens a type begins a new generation (``types=<n>/``) with a
    schema of its own; reads cast each generation to the log's schema. There
    are as many generations as widenings, however many batches."""

    def __init__(self, spark: SparkSession, path: str, batch_col: str = "batch_id"):
        self.spark, self.path, self.batch_col = spark, path.rstrip("/"), batch_col

    # -- generations of types ---------------------------------------------------
    def _root(self, generation: int) -> str:
        return self.path if not generation else f"{self.path}/types={generation}"

    def _generations(self) -> int:
        n = 1
        while path_exists(self.spark, f"{self._root(n)}/_schema.json"):
            n += 1
        return n

    def _stored(self, generation: int) -> T.StructType | None:
        stored = read_text(self.spark, f"{self._root(generation)}/_schema.json")
        return T.StructType.fromJson(json.loads(stored)) if stored else None

    def _dir(self, batch_id: str, generation: int = 0) -> str:
        return f"{self._root(generation)}/{self.batch_col}={batch_id}"

    def _where(self, batch_id: str) -> int | None:
        return next((g for g in range(self._generations()) if committed(self.spark, self._dir(batch_id, g))), None)

    def has(self, batch_id: str) -> bool:
        return self._where(batch_id) is not None

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def schema(self) -> T.StructType | None:
        """Merged schema of all committed batches, kept in ``_schema.json``
        (updated after each append), so neither an append nor a read has to
        open every batch's footers."""
        return self._stored(self._generations() - 1)

    def _cover(self, batch_id: str) -> None:
        """Heal the stored schema after a crash between a batch's commit and
        the schema update: merge in that one batch's footer schema."""
        g = self._where(batch_id)
        own, current = self.spark.read.parquet(self._dir(batch_id, g)).schema, self._stored(g)
        merged = merge_schemas(current, own) if current is not None else own
        if current is None or merged != current:
            write_text(self.spark, f"{self._root(g)}/_schema.json", merged.json())

    def batches(self) -> list[str]:
        """Directories of the committed batches, found by one glob a generation for their
        ``_SUCCESS`` markers: a batch that died half-way is not among them."""
        return [d for g in range(self._generations()) for d in self._committed(g)]

    def _committed(self, generation: int) -> list[str]:
        return committed_dirs(self.spark, f"{self._root(generation)}/{self.batch_col}=*")

    def read(self) -> DataFrame:
        """Rows of the committed batches."""
        n, schema = self._generations(), self.schema()
        dirs = [self._committed(g) for g in range(n)]
        if schema is None and not any(dirs):
            raise FileNotFoundError(f"batch log {self.path} has no committed batch")
        parts = []
        for g, own in enumerate(dirs):
            reader, stored = self.spark.read.option("basePath", self._root(g)), self._stored(g)
            if not own:
                continue
            if stored is None:
                df = reader.option("mergeSchema", "true").parquet(*own)
            else:
                # Parquet schema evolution by name: a batch lacking a column reads NULL
                df = reader.schema(T.StructType(stored.fields + [T.StructField(self.batch_col, T.StringType())])).parquet(*own)
            parts.append(df.withColumn(self.batch_col, F.col(self.batch_col).cast("string")))
        if schema is None:
            return parts[0]
        full = T.StructType(schema.fields + [T.StructField(self.batch_col, T.StringType())])
        if not parts:
            return self.spark.createDataFrame([], full)
        return reduce(lambda x, y: x.unionByName(y), [conform(p, full) if n > 1 else p for p in parts])

    def append(self, df: DataFrame, batch_id: str) -> bool:
        """Write one batch; returns False when it was already committed.
        A type conflict with earlier batches raises before anything is written."""
        if self.has(batch_id):
            self._cover(batch_id)
            return False
        g, current = self._generations() - 1, self.schema()
        merged = merge_schemas(current, df.schema) if current is not None else df.schema
        if current is not None and _widens(current, merged):
            g += 1
            write_text(self.spark, f"{self._root(g)}/_schema.json", merged.json())  # begins the generation
        own = {f.name for f in df.schema.fields}
        narrowed = conform(df, T.StructType([f for f in merged.fields if f.name in own])) if current is not None else df
        narrowed.write.mode("overwrite").parquet(self._dir(batch_id, g))
        write_text(self.spark, f"{self._root(g)}/_schema.json", merged.json())
        return True


def _widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether ``new`` (merged from ``old``) has another type for something that ``old`` holds."""
    if isinstance(old, T.StructType):
        return any(_widens(f.dataType, new[f.name].dataType) for f in old.fields)
    if isinstance(old, T.ArrayType):
        return _widens(old.elementType, new.elementType)
    if isinstance(old, T.MapType):
        return _widens(old.keyType, new.keyType) or _widens(old.valueType, new.valueType)
    return old != new


def ingest_batches(spark: SparkSession, batches, log_path: str, casts: dict | None = None,
                   timestamps: dict | None = None) -> list[str]:
    """Read each ``(path, fmt, options, batch_id)`` in arrival order,
    normalise its types and append it to the batch log. Returns the ids that
    were written (already committed batches are skipped)."""
    log = BatchLog(spark, log_path)
    written = []
    for path, fmt, options, batch_id in batches:
        if log.has(batch_id):
            log.append(None, batch_id)  # committed: only heals the stored schema
            continue
        df = normalize(read_batch(spark, path, fmt, options), casts, timestamps)
        if log.append(df, batch_id):
            written.append(batch_id)
    return written
