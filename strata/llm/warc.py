"""Deterministic sharded WARC writer and reader.

Writer:
1. Payload digests are grouped (pre-aggregated) to find payloads that occur
   more than once; the smallest key of each is the response, the others are
   revisits that refer to it. All this happens on (key, digest, size).
2. Shards are key ranges of about equal bytes. The keys whose hash falls in a
   fixed class part the keys into cells, whose bytes are summed exactly;
   bounds lie between cells, so they depend on the keys and payloads alone,
   not on how the table is laid out.
3. The payloads are shuffled once, straight to their range, whatever the
   number of revisits: for a key and digest that revisit, a note with the
   response's key travels to the same range and sorts before the record.
4. A task sorts its range, regenerates every header and digest, writes one
   gzip member per record and begins a new file when the compressed size
   reaches ``roll_bytes``, the normal end of a file.
5. Files are written under temporary names; the rows of finished tasks form
   the manifest. A commit job then gives the files of the manifest their final
   names (again and again with the same outcome) and publishes it.

The same rows give the same files, byte for byte.

Edge cases: null payloads are empty and null addresses become ``urn:key:KEY``;
control characters and blanks in addresses are percent-coded; rows without a
key are written as responses, never referred to and dealt to the shards by
their digest; every record has an id of its own; of rows that repeat key
and payload the first is the response and the others revisit it; payloads
below ``min_dedup`` bytes are always responses; an empty table leaves an empty
manifest; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches, spread, staged
from strata.session import scratch_path

SHARD_BYTES = 128 << 20  # payload bytes a shard, the work of a task, aims at
MAX_SHARDS = 20_000      # beyond it shards grow and roll more files instead
KEYS_PER_SHARD = 16      # cells that a shard consists of, so at most 320,000 reach the driver
HEAD_BYTES = 512         # what a record counts beside its payload
ROLL_BYTES = 16 << 20    # compressed
DATE = "2000-01-01T00:00:00Z"  # records carry no clock

MANIFEST = pa.schema([("shard", pa.int64()), ("number", pa.int64()), ("temporary", pa.string()), ("file", pa.string()),
                      ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
MANIFEST_DDL = "shard long, number long, temporary string, file string, records long, bytes long, sha256 string"


# -- records ----------------------------------------------------------------
def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def _record_id(key, digest: str, nth: int = 0) -> str:
    """Id of the ``nth`` record with this key and payload."""
    name = f"{key}/{digest}" + (f"/{nth}" if nth else "")
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=5)}>"


def _address(url: str | None, key) -> str:
    if not url:
        return f"urn:key:{key}"
    return "".join(c if ord(c) > 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in url)


def record(key, url: str | None, payload: bytes, digest: str, first_key=None, nth: int = 0) -> bytes:
    """One WARC/1.1 record; a revisit of ``first_key``'s response if that is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first_key is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first_key is None else 'revisit'}", f"WARC-Record-ID: {_record_id(key, digest, nth)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {_address(url, key)}", "Content-Type: application/http; msgtype=response"]
    if first_key is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(first_key, digest)}", f"X-Refers-To-Key: {first_key}"]
    if key is not None:
        head.append(f"X-Key: {key}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: {_digest(block)}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(stream):
    """Yields (headers, block) of every record in an uncompressed stream."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('WARC-Record-ID')} has a wrong length")
        yield headers, block


# -- writer -----------------------------------------------------------------
def _bounds(records: DataFrame, shard_bytes: int) -> np.ndarray:
    """Upper bounds (exclusive) of all shards but the last: the cell limits next to equal parts of the bytes."""
    weight = F.col("size") + HEAD_BYTES
    total, n = records.agg(F.sum(weight), F.count("key")).first()
    shards = min(MAX_SHARDS, max(1, -(-(total or 0) // shard_bytes)), max(1, n))
    if shards == 1:
        return np.array([], np.int64)
    every = max(1, n // (shards * KEYS_PER_SHARD))
    keyed = records.where(F.col("key").isNotNull())
    limits = np.array([r["key"] for r in keyed.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0)
                       .select("key").distinct().orderBy("key").collect()], np.int64)

    @F.pandas_udf("int")
    def cell(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, key.to_numpy(np.int64), side="right").astype(np.int32))

    held = np.zeros(len(limits) + 1, np.int64)
    for r in keyed.groupBy(cell("key").alias("cell")).agg(F.sum(weight).alias("bytes")).collect():  # a row per cell
        held[r["cell"]] = r["bytes"]
    filled = np.cumsum(held)
    at = np.searchsorted(filled, filled[-1] * np.arange(1, shards) / shards)
    return np.unique(limits[at[at < len(limits)]])


def _writer(path: str, roll_bytes: int):
    def run(batches):
        from pyarrow import fs as pafs

        store, root = pafs.FileSystem.from_uri(path)
        state, done, last, nth, noted = None, [], None, 0, None

        def begin(shard, number):
            temporary = f"_temporary-{shard:08d}-{number:04d}-{uuid.uuid4().hex}"
            return {"shard": shard, "number": number, "temporary": temporary, "file": f"part-{shard:08d}-{number:04d}.warc.gz", "records": 0,
                    "bytes": 0, "out": store.open_output_stream(f"{root}/{temporary}", compression=None), "sha": hashlib.sha256()}

        def close(s):
            s.pop("out").close()
            done.append(s | {"sha256": s.pop("sha").hexdigest()})

        for b in batches:
            for r in b.to_pylist():
                if r["note"]:
                    noted = r["key"], r["digest"], r["first_key"]
                    continue
                if state and state["shard"] != r["shard"]:
                    close(state)
                    state = None
                if state is None:
                    state = begin(r["shard"], 0)
                elif state["bytes"] >= roll_bytes:
                    number = state["number"] + 1
                    close(state)
                    state = begin(r["shard"], number)
                key, first = r["key"], noted[2] if noted and noted[:2] == (r["key"], r["digest"]) else None
                nth = nth + 1 if last == (key, r["digest"]) else 0  # equal keys lie together, wherever a file ends
                refers = first if first is not None and (first != key or nth) else None
                last = key, r["digest"]
                squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = squeeze.compress(record(key, r["url"], r["payload"], r["digest"], refers, nth)) + squeeze.flush()
                state["out"].write(data), state["sha"].update(data)
                state["records"], state["bytes"] = state["records"] + 1, state["bytes"] + len(data)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=MANIFEST)
                done.clear()
        if state:
            close(state)
            yield pa.RecordBatch.from_pylist(done, schema=MANIFEST)

    return run


def _renamer(path: str):
    def run(batches):
        from pyarrow import fs as pafs

        store, root = pafs.FileSystem.from_uri(path)
        for b in batches:
            for r in b.to_pylist():
                old, new = (store.get_file_info(f"{root}/{r[k]}").type for k in ("temporary", "file"))
                if old != pafs.FileType.NotFound:
                    store.move(f"{root}/{r['temporary']}", f"{root}/{r['file']}")
                elif new == pafs.FileType.NotFound:
                    raise FileNotFoundError(f"{r['temporary']} of the manifest is missing")
            yield b

    return run


def write(pages: DataFrame, path: str | None = None, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_dedup: int = 100, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> tuple[DataFrame, str]:
    """Write every row of ``pages`` as a record; returns (manifest, path)."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    spark.createDataFrame([], "x int").write.parquet(f"{path}/_created")  # makes the folder in any store
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key_col).cast("long").alias("key"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"))
    narrow = staged(rows.select("key", "digest", "size"), "warc-digests")
    winners = staged(narrow.where(F.col("size") >= min_dedup).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"))
                     .where("n > 1 AND first_key IS NOT NULL").select("digest", "first_key"), "warc-winners")
    notes = narrow.where(F.col("key").isNotNull()).join(winners, "digest").groupBy("key", "digest").agg(F.min("first_key").alias("first_key"))
    bounds = _bounds(narrow, shard_bytes)

    @F.pandas_udf("long")
    def shard_of(key: pd.Series, spread_over: pd.Series) -> pd.Series:
        return pd.Series(np.where(key.isna(), spread_over, np.searchsorted(bounds, key.fillna(0).to_numpy(np.int64), side="right")))

    def dealt(df, note, url, payload, first_key):
        shard = shard_of("key", F.pmod(F.xxhash64("digest"), F.lit(len(bounds) + 1))).alias("shard")
        return df.select(shard, "key", "digest", F.lit(note).alias("note"), url.alias("url"), payload.alias("payload"), first_key.alias("first_key"))

    none = F.lit(None)
    records = dealt(rows, False, F.col("url"), F.col("payload"), none.cast("long")).unionByName(
        dealt(notes, True, none.cast("string"), none.cast("binary"), F.col("first_key")))
    records = records.repartitionById(len(bounds) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "key", "digest", F.desc("note"), "url")
    written = small_batches(records).mapInArrow(_writer(path, roll_bytes), MANIFEST_DDL)
    written.write.parquet(f"{path}/_written")
    written = spark.read.parquet(f"{path}/_written")
    spread(written, per_task=100).mapInArrow(_renamer(path), MANIFEST_DDL).write.parquet(f"{path}/_manifest")
    return spark.read.parquet(f"{path}/_manifest"), path


# -- reader -----------------------------------------------------------------
READ = pa.schema([("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("payload", pa.binary())])
READ_DDL = ("key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, file string, payload binary")


def _reader(path: str, with_payload: bool, checked: bool):
    def run(batches):
        from pyarrow import fs as pafs

        store, root = pafs.FileSystem.from_uri(path)
        for b in batches:
            for r in b.to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{root}/{r['file']}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for headers, block in parse(stream):
                        http, _, body = block.partition(b"\r\n\r\n")
                        fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
                        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"]
                        if checked and (_digest(block) != headers["WARC-Block-Digest"] or kind == "response" and _digest(body) != digest):
                            raise ValueError(f"digest of {headers['WARC-Record-ID']} in {r['file']} differs")
                        key, first = headers.get("X-Key"), headers.get("X-Refers-To-Key")
                        rows.append({"key": key and int(key), "url": headers["WARC-Target-URI"], "record_type": kind,
                                     "payload_bytes": int(fields["Content-Length"]), "payload_digest": digest.removeprefix("sha256:"),
                                     "refers_to": first and int(first), "file": r["file"],
                                     "payload": body if with_payload and kind == "response" else None})
                        held += len(body) if with_payload else 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=READ)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=READ)

    return run


def read(manifest: DataFrame, path: str, with_payload: bool = False, checked: bool = True) -> DataFrame:
    """Every record of the files in the manifest, one file a time per task; digests are checked on the way."""
    return small_batches(spread(manifest.select("file"))).mapInArrow(_reader(path, with_payload, checked), READ_DDL)
