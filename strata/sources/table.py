"""Managed tables over plain Parquet: a directory of immutable snapshots.

``<path>/snap=000001/``, ``snap=000002/`` ... ; a snapshot counts once its
``_SUCCESS`` marker exists (written by Spark's file commit protocol after all
tasks committed), so a job that dies half-way leaves no visible state and a
re-run simply writes the next snapshot. Reading the current table and
publishing its successor never touch the same files, which plain Parquet
needs: overwriting a path that the plan is still reading deletes its input.
Single writer per table; old snapshots are kept (time travel by version).

A partitioned or bucketed table is upserted by layers: a new snapshot holds
only the partitions that the batch touches, and a version reads each partition
from its newest snapshot up to that version. A small batch costs its
partitions whatever the table holds, untouched files stay as they are, and
every version stays readable and unchanged. ``compact`` folds the layers.

``_meta/<version>.json`` holds what a version is (schema, partitioning, time,
operation, counts); it is written before the data and counts with it.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.ordering import orderable
from strata.operators.merge import _keyed_merge, require_unique, split_by_keys
from strata.operators.partitions import spread_for_write
from strata.session import staged

_PREFIX = "snap="


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file through the cluster file system (driver side)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def committed(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a finished Spark write (``_SUCCESS``)."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def committed_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Directories matching ``pattern`` that hold a finished Spark write."""
    fs, p = _fs(spark, pattern + "/_SUCCESS")
    return sorted(st.getPath().getParent().toString() for st in fs.globStatus(p) or [])


def committed_epochs(spark: SparkSession, checkpoint: str) -> int:
    """Micro-batches a streaming checkpoint has committed so far. Spark keeps
    only the latest commit files, so the last number counts, not the files."""
    fs, p = _fs(spark, f"{checkpoint.rstrip('/')}/commits")
    if not fs.exists(p):
        return 0
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return max((int(n) + 1 for n in names if n.isdigit()), default=0)


class BrokenContract(ValueError):
    """A write whose rows break a contract; nothing was published."""


BUCKET = "_bucket"


def bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- metadata -----------------------------------------------------------
    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, self.path)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(_PREFIX):
                v = int(name[len(_PREFIX):])
                if committed(self.spark, self._snap(v)):
                    out.append(v)
        return sorted(out)

    def exists(self) -> bool:
        return bool(self.versions())

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def _snap(self, v: int) -> str:
        return f"{self.path}/{_PREFIX}{v:06d}"

    def _meta(self, v: int) -> dict:
        stored = read_text(self.spark, f"{self.path}/_meta/{v:06d}.json")
        return json.loads(stored) if stored else {}

    def _next(self) -> int:
        v = (self.current_version() or 0) + 1
        while path_exists(self.spark, self._snap(v)):  # skip a crashed attempt's leftovers
            v += 1
        return v

    def history(self) -> DataFrame:
        """One row per committed version: ``version``, ``committed_at``, ``operation``, and the rows it
        inserted and updated (``n_inserted``, ``n_updated``; NULL where they were not counted)."""
        rows = []
        for v in self.versions():
            m = self._meta(v)
            at = m.get("committed_at")
            rows.append((v, dt.datetime.fromisoformat(at) if at else None, m.get("operation"), m.get("n_inserted"), m.get("n_updated")))
        return self.spark.createDataFrame(rows, "version long, committed_at timestamp, operation string, n_inserted long, n_updated long")

    def version_at(self, as_of) -> int | None:
        """The last version committed at or before ``as_of`` (a datetime or ISO text, UTC where it names no zone)."""
        limit = _utc(as_of)
        found = [v for v in self.versions() if (at := self._meta(v).get("committed_at")) and dt.datetime.fromisoformat(at) <= limit]
        return found[-1] if found else None

    # -- read -----------------------------------------------------------------
    def read(self, version: int | None = None, as_of=None) -> DataFrame:
        """The table at ``version``, at a time (``as_of``), or now. Every committed version stays readable and
        unchanged. The schema is the one stored at its write: no footer merging, and partition columns keep
        their types."""
        if as_of is not None:
            version = self.version_at(as_of)
            if version is None:
                raise FileNotFoundError(f"table {self.path} has no snapshot committed by {as_of}")
        df = self._read(version)
        return df.drop(BUCKET) if BUCKET in df.columns else df

    def _read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"table {self.path} has no committed snapshot")
        layers = self._layers(v)
        if len(layers) == 1:
            stored = read_text(self.spark, self._snap(v) + "/_schema.json")
            if stored is None:
                return self.spark.read.option("mergeSchema", "true").parquet(self._snap(v))
            return self.spark.read.schema(T.StructType.fromJson(json.loads(stored))).parquet(self._snap(v))
        meta = self._meta(v)
        schema, depth = T.StructType.fromJson(meta["schema"]), len(meta["partition_by"])
        seen, frames = set(), []
        for layer in layers:
            own = [p for p in self._partitions(layer, depth) if p not in seen]
            seen.update(own)
            if own:
                reader = self.spark.read.schema(schema).option("basePath", self._snap(layer))
                frames.append(reader.parquet(*[f"{self._snap(layer)}/{p}" for p in own]))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def _layers(self, v: int) -> list[int]:
        """The snapshots that make up version ``v``, newest first: layers of partitions, and the whole one below them."""
        out = []
        for s in reversed([x for x in self.versions() if x <= v]):
            out.append(s)
            if not self._meta(s).get("layer"):
                break
        return out

    def _partitions(self, v: int, depth: int) -> list[str]:
        root = self._snap(v)
        fs, p = _fs(self.spark, root + "/*=*" * depth)
        return sorted("/".join(st.getPath().toString().rstrip("/").split("/")[-depth:]) for st in fs.globStatus(p) or [] if st.isDirectory())

    def changes(self, since: int = 0, upto: int | None = None) -> DataFrame:
        """The change feed: the rows that versions after ``since`` (up to ``upto``) inserted or updated, with
        ``_op``, ``_version`` and ``_committed_at``. Written by ``upsert(feed=True)`` from the merge itself."""
        wanted = [v for v in self.versions() if v > since and (upto is None or v <= upto)]
        paths = [f"{self.path}/changes/_version={v}" for v in wanted]
        paths = [p for p in paths if committed(self.spark, p)]
        if not paths:
            raise FileNotFoundError(f"table {self.path} has no change feed for versions after {since}")
        return self.spark.read.option("basePath", f"{self.path}/changes").option("mergeSchema", "true").parquet(*paths).withColumn(
            "_version", F.col("_version").cast("long"))

    # -- write ----------------------------------------------------------------
    def publish(self, df: DataFrame, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, if_exists: str = "new_version", files_per_partition: int | None = None,
                contracts: dict | None = None, committed_at=None, operation: str = "publish") -> int:
        """Write ``df`` as the next snapshot and return its version.

        ``if_exists``: ``new_version`` (default), or ``error`` to refuse when
        the table already has data (create-only write). ``files_per_partition``
        bounds the files per partition value (see ``spread_for_write``).
        ``contracts``: name -> condition that must be true of every row (NULL
        breaks it). They are counted while the rows are written, in the same
        scan, and the snapshot becomes visible only if all of them hold;
        otherwise ``BrokenContract`` names them with their counts.
        """
        if self.current_version() is not None and if_exists == "error":
            raise FileExistsError(f"table {self.path} already exists")
        return self._write(df, self._next(), partition_by or [], sort_by, files_per_partition, contracts,
                           {"operation": operation}, committed_at)

    def _write(self, df: DataFrame, v: int, partition_by: list[str], sort_by, files_per_partition, contracts, meta: dict, committed_at) -> int:
        # data columns first, then partition columns: the order Spark reads back
        fields = [f for f in df.schema.fields if f.name not in partition_by] + [df.schema[c] for c in partition_by]
        schema = T.StructType(fields)
        meta = {"partition_by": partition_by, "schema": json.loads(schema.json()), "committed_at": _utc(committed_at).isoformat(), **meta}
        w = spread_for_write(df, partition_by, files_per_partition) if partition_by else df
        if sort_by:
            # the partitioned writer sorts by the partition columns; lead with
            # them so the requested order survives inside each partition
            w = w.sortWithinPartitions(*partition_by, *sort_by)
        seen = Observation()
        broken = [F.count_if(~F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False))).alias(n) for n, c in (contracts or {}).items()]
        if broken:
            w = w.observe(seen, *broken)
        # before the data: a snapshot counts only once its _SUCCESS exists, and from then on it needs this file
        write_text(self.spark, f"{self.path}/_meta/{v:06d}.json", json.dumps(meta))
        writer = w.write.mode("errorifexists")
        if broken:
            writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._snap(v))
        if broken:
            failed = {n: k for n, k in seen.get.items() if k}
            if failed:
                raise BrokenContract(f"{self.path}: rows that break a contract: {failed}")
        if not meta.get("layer"):
            write_text(self.spark, self._snap(v) + "/_schema.json", schema.json())
        if broken:
            write_text(self.spark, self._snap(v) + "/_SUCCESS", "")
        return v

    def upsert(self, source: DataFrame, keys: list[str], partition_by: list[str] | None = None, null_safe: bool = True,
               newer_by: str | None = None, coalesce_existing: bool = False, when_changed: list[str] | None = None,
               combine: dict | None = None, buckets: int | None = None, feed: bool = False, contracts: dict | None = None,
               committed_at=None) -> int:
        """First load publishes ``source``; later loads merge it by ``keys``
        (see ``merge.upsert`` for the options). Returns the current version.

        ``source`` is evaluated once (staged) and must be unique on ``keys``,
        on the first load too. When no row would change, nothing is written
        and the version stays.

        With ``partition_by`` (part of ``keys``) only partitions present in
        ``source`` are read (the staged partition values prune the scan) and
        written: the new version is a layer of those partitions over the
        versions before, whose files stay as they are. ``buckets``, given on
        the first load, does the same for a table without such a column: a
        hidden column holds the hash of the keys, so a batch reads and writes
        the buckets of its keys only. ``compact`` folds the layers.

        ``combine``: column -> function of (stored, new) for rows of both
        sides, instead of taking the new value. ``feed`` writes the changed
        rows for ``changes``. ``contracts`` as in ``publish``.
        """
        missing = [c for c in partition_by or [] if c not in keys]
        if missing:
            raise ValueError(f"partition columns {missing} must be part of the upsert keys")
        source = staged(source, "upsert-source")
        require_unique(source, keys)
        current = self.current_version()
        if current is None:
            if buckets:
                source, partition_by = source.withColumn(BUCKET, bucket_of(keys, buckets)), [BUCKET]
            v = self._next()
            self._feed(source.drop(BUCKET).withColumn("_op", F.lit("insert")), v, feed, committed_at)
            n = source.count()
            return self._write(source, v, partition_by or [], None, 1 if buckets else None, contracts,
                               {"operation": "upsert", "buckets": buckets, "keys": keys, "n_inserted": n, "n_updated": 0}, committed_at)
        stored = self._meta(current)
        buckets = stored.get("buckets")
        target = inside = self._read(current)
        if buckets:
            if stored["keys"] != keys:
                raise ValueError(f"the table is bucketed by {stored['keys']}, not by {keys}")
            types = {f.name: f.dataType for f in target.schema}
            same = source.withColumns({k: F.col(k).cast(types[k]) for k in keys})  # one type, one hash
            source, partition_by = same.withColumn(BUCKET, bucket_of(keys, buckets)), [BUCKET]
            touched = [r[0] for r in source.select(BUCKET).distinct().collect()]  # at most the number of buckets
            inside = target.where(F.col(BUCKET).isin(touched))
        elif partition_by:
            parts = staged(source.select(*partition_by).distinct(), "upsert-partitions")
            inside = split_by_keys(target, parts, partition_by)[1]
        if not (partition_by or feed or newer_by or coalesce_existing or when_changed or combine):
            rows, inserted, updated = self._replaced(target, source, keys, null_safe)
            if rows is not None:
                return self._write(rows, self._next(), [], None, None, contracts, {
                    "operation": "upsert", "buckets": buckets, "keys": keys, "n_inserted": inserted, "n_updated": updated}, committed_at)
        untouched, touched = split_by_keys(inside, source, keys, null_safe)
        merged = staged(_keyed_merge(touched, source, keys, null_safe, newer_by, coalesce_existing, when_changed, "_changed", combine), "upsert-merged")
        inserted, updated = merged.agg(F.count_if(F.col("_changed") & F.col("_changed_new")), F.count_if(F.col("_changed") & ~F.col("_changed_new"))).first()
        if not inserted + updated:
            return current
        v = self._next()
        op = F.when(F.col("_changed_new"), F.lit("insert")).otherwise(F.lit("update"))
        self._feed(merged.where("_changed").withColumn("_op", op).drop("_changed", "_changed_new", BUCKET), v, feed, committed_at)
        merged = merged.drop("_changed", "_changed_new")
        rows = untouched.unionByName(merged, allowMissingColumns=True).select(*merged.columns)
        meta = {"operation": "upsert", "buckets": buckets, "keys": keys, "n_inserted": inserted, "n_updated": updated}
        if partition_by and set(rows.columns) == set(target.columns):
            return self._write(rows, v, partition_by, None, 1 if buckets else None, contracts, {**meta, "layer": True}, committed_at)
        if partition_by:  # new columns: the layers below lack them, so the table is written as a whole
            rest = target.join(rows.select(*partition_by).distinct(), partition_by, "left_anti") if buckets else split_by_keys(target, parts, partition_by)[0]
            rows = rest.unionByName(rows, allowMissingColumns=True).select(*rows.columns)
        return self._write(rows, v, partition_by or [], None, 1 if buckets else None, contracts, meta, committed_at)

    def _replaced(self, target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool):
        """(rows, inserted, updated) of a whole-table upsert by a batch about as large as the table, in which the
        new row always wins. Then the result is the stored source with the target rows it lacks, and only keys
        and row hashes need to meet; wide rows are neither shuffled nor staged again. (None, 0, 0) where this
        does not hold: a small batch, other columns or types, keys repeated in the target, or no row that
        differs by its hashes (the full comparison then decides)."""
        types = {f.name: f.dataType for f in target.schema}
        if {f.name: f.dataType for f in source.schema} != types or not all(orderable(t) for t in types.values()):
            return None, 0, 0
        n = source.count()
        if 2 * n < target.count():
            return None, 0, 0
        values = [c for k in types for c in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())]
        hashed = F.struct(*[F.xxhash64(F.lit(i), *values) for i in (1, 2)]).alias("_hash")
        t, s = target.select(*keys, hashed).alias("t"), source.select(*keys, hashed).alias("s")
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) if null_safe else F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
        in_t, in_s = F.col("t._hash").isNotNull(), F.col("s._hash").isNotNull()
        both, inserted, updated, kept = t.join(s, same, "full_outer").agg(
            F.count_if(in_t & in_s), F.count_if(in_s & ~in_t), F.count_if(in_t & in_s & (F.col("t._hash") != F.col("s._hash"))), F.count_if(in_t & ~in_s)).first()
        if both + inserted != n or not inserted + updated:
            return None, 0, 0
        rows = source.select(*target.columns)
        return (split_by_keys(target, source, keys, null_safe)[0].unionByName(rows) if kept else rows), inserted, updated

    def _feed(self, changed: DataFrame, v: int, feed: bool, committed_at) -> None:
        if feed:
            at = F.lit(_utc(committed_at).isoformat()).cast("timestamp")
            changed.withColumn("_committed_at", at).write.mode("overwrite").parquet(f"{self.path}/changes/_version={v}")

    def compact(self, committed_at=None) -> int:
        """Fold the layers into one whole snapshot; returns the version (the same where there is nothing to fold)."""
        current = self.current_version()
        if len(self._layers(current)) == 1:
            return current
        stored = self._meta(current)
        keep = {k: stored[k] for k in ("buckets", "keys") if k in stored}
        return self._write(self._read(current), self._next(), stored["partition_by"], None, 1 if stored.get("buckets") else None, None,
                           {**keep, "operation": "compact", "n_inserted": 0, "n_updated": 0}, committed_at)


def _utc(at) -> dt.datetime:
    """A moment in UTC; now if there is none."""
    if at is None:
        return dt.datetime.now(dt.timezone.utc)
    at = dt.datetime.fromisoformat(at) if isinstance(at, str) else at
    return at.replace(tzinfo=dt.timezone.utc) if at.tzinfo is None else at.astimezone(dt.timezone.utc)
