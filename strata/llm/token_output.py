"""Training-order token shards: fixed-stride sequences at keyed random slots.

1. Texts become token ids with a public tokenizer (its file is a parameter).
   The ids of a scan task's documents, each ended by the end-of-text id, are
   packed one after another into sequences of ``stride`` ids; the last one of
   the task is padded. The token table is written once, in compressed blocks.
2. Sequences are numbered 0..n-1 in the order of the written table: the
   task's offset plus the running count inside it.
3. A keyed Feistel network permutes the smallest even-width power of two that
   holds n; walking the cycle until the value is below n makes it a
   permutation of 0..n-1. The value is the sequence's global slot.
4. Slot ranges are shards: a shard is one file of ``shard_sequences`` records
   of ``2 * stride`` bytes (little-endian uint16), so a reader finds slot s in
   file ``s // shard_sequences`` at byte ``(s % shard_sequences) * 2 * stride``
   and can go on from any step without an index.
5. A shard is written under a temporary name, then renamed; the rows of the
   manifest (with the SHA-256 of each file) are published last.

Token ids travel compressed between stages; neither a shard nor a task's
documents are ever held in memory together.

Edge cases: null and empty texts yield only the end id; rows that repeat an
id or a text are separate documents; an empty table gives no shards and an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import small_batches, spread, staged
from strata.session import scratch_path

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed value of the vocabulary
END_ID = 50256
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
ROUNDS = 6
BLOCK_SEQUENCES = 512    # sequences compressed together in the token table
MAX_PARTITIONS = 20_000  # write tasks; beyond it a task writes several shards


# -- tokenizer --------------------------------------------------------------
_encodings: dict[str, object] = {}


def encoding(path: str):
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("shards", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


# -- the permutation --------------------------------------------------------
def _round(x: np.ndarray, key: int, r: int, half: int) -> np.ndarray:
    z = (x + np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) & (2**64 - 1)))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) & np.uint64((1 << half) - 1)


def feistel_slots(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1, applied to ``index``."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def once(v):
        left, right = v >> shift, v & mask
        for r in range(ROUNDS):
            left, right = right, left ^ _round(right, key, r, half)
        return (left << shift) | right

    v = once(index.astype(np.uint64))
    while (out := v >= np.uint64(n)).any():
        v[out] = once(v[out])
    return v.astype(np.int64)


# -- tokens -----------------------------------------------------------------
TOKENS = "part int, first long, n_sequences long, n_tokens long, doc_ids array<long>, doc_starts array<long>, ids binary"
SEQUENCES = "slot long, shard long, part int, chunk long, ids array<long>, n_tokens long, tokens binary"


def tokenize(docs: DataFrame, stride: int, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of packed token ids as compressed uint16, with the scan task, the number of its sequences before the
    block, and the documents in the block with their starts (a document that began earlier starts below 0)."""

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        part, first, size = TaskContext.get().partitionId(), 0, BLOCK_SEQUENCES * stride
        enc, squeeze = encoding(vocabulary), zstandard.ZstdCompressor(level=6)
        held, n, doc_ids, starts = [], 0, [], []

        def block(stream, sequences):
            inside = sum(s < len(stream) for s in starts)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([sequences], pa.int64()), pa.array([len(stream)], pa.int64()),
                 pa.array([doc_ids[:inside]], pa.list_(pa.int64())), pa.array([starts[:inside]], pa.list_(pa.int64())),
                 pa.array([squeeze.compress(stream.tobytes())], pa.binary())],
                names=["part", "first", "n_sequences", "n_tokens", "doc_ids", "doc_starts", "ids"])

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.array([*(enc.encode_ordinary(text) if text else ()), END_ID], np.uint16)
                doc_ids.append(i), starts.append(n)
                held.append(ids)
                n += len(ids)
                while n >= size:
                    stream = np.concatenate(held)
                    yield block(stream[:size], BLOCK_SEQUENCES)
                    first, n, held = first + BLOCK_SEQUENCES, n - size, [stream[size:]]
                    over = [k for k, s in enumerate(starts) if s < size]
                    last = over[-1]  # the document that the cut goes through, unless it ends there
                    keep = last if (starts[last + 1] if last + 1 < len(starts) else size + n) > size else last + 1
                    doc_ids, starts = doc_ids[keep:], [s - size for s in starts[keep:]]
        if n:
            yield block(np.concatenate(held), -(-n // stride))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(rows).mapInArrow(run, TOKENS)


def place(tokens: DataFrame, stride: int, shard_sequences: int, key: int) -> tuple[DataFrame, int]:
    """One row per sequence (``SEQUENCES``; ``ids`` are its documents), and their number."""
    counts = tokens.groupBy("part").agg(F.sum("n_sequences").alias("n")).collect()  # one number per scan task
    offsets, n = {}, 0
    for r in sorted(counts, key=lambda r: r["part"]):
        offsets[r["part"]], n = n, n + r["n"]
    shared = tokens.sparkSession.sparkContext.broadcast(offsets)

    def run(batches):
        import zstandard

        squeeze, expand, start = zstandard.ZstdCompressor(level=6), zstandard.ZstdDecompressor(), shared.value
        for b in batches:
            for r in (x for k in range(b.num_rows) for x in b.slice(k, 1).to_pylist()):
                stream = np.frombuffer(expand.decompress(r["ids"]), np.uint16)
                chunk = r["first"] + np.arange(r["n_sequences"])
                slot = feistel_slots(start[r["part"]] + chunk, n, key)
                starts, docs = np.array(r["doc_starts"]), r["doc_ids"]
                cuts = np.arange(0, len(stream), stride)
                lo = np.searchsorted(starts, cuts, side="right") - 1       # the document a sequence begins in
                hi = np.searchsorted(starts, cuts + stride, side="left")   # the first that begins behind it
                pieces = [stream[c:c + stride] for c in cuts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(slot // shard_sequences), pa.array(np.full(len(chunk), r["part"], np.int32)), pa.array(chunk),
                     pa.array([docs[x:y] for x, y in zip(lo, hi, strict=True)], pa.list_(pa.int64())), pa.array([len(p) for p in pieces], pa.int64()),
                     pa.array([squeeze.compress(p.tobytes()) for p in pieces], pa.binary())],
                    names=["slot", "shard", "part", "chunk", "ids", "n_tokens", "tokens"])

    return small_batches(tokens).mapInArrow(run, SEQUENCES), n


# -- shards -----------------------------------------------------------------
RECORD = pa.schema([("kind", pa.string()), ("slot", pa.int64()), ("shard", pa.int64()), ("part", pa.int32()), ("chunk", pa.int64()),
                    ("ids", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("sha256", pa.string()), ("file", pa.string()),
                    ("n_sequences", pa.int64()), ("bytes", pa.int64())])
RECORD_DDL = ("kind string, slot long, shard long, part int, chunk long, ids array<long>, n_tokens long, sha256 string, file string, "
              "n_sequences long, bytes long")


def shard_name(shard: int) -> str:
    return f"tokens-{shard:08d}.bin"


def write_shards(sequences: DataFrame, path: str, stride: int, shard_sequences: int, n: int) -> DataFrame:
    """Write the shard files below ``path``; a row of kind ``sequence`` per record and of kind ``shard`` per file.

    The rows of one shard are a range of slots, sorted in their task and
    streamed to one temporary file; a finished file gets its name by rename,
    so a task that runs again replaces it with the same bytes.
    """

    def run(batches):
        import uuid

        import zstandard
        from pyarrow import fs as pafs

        store, root = pafs.FileSystem.from_uri(path)
        expand, size = zstandard.ZstdDecompressor(), 2 * stride
        state: dict = {}

        def close():
            state["out"].close()
            name = shard_name(state["shard"])
            store.move(state["temporary"], f"{root}/{name}")
            return {"kind": "shard", "slot": state["shard"] * shard_sequences, "shard": state["shard"], "sha256": state["sha"].hexdigest(),
                    "file": name, "n_sequences": state["n"], "bytes": state["n"] * size}

        def begin(shard):
            temporary = f"{root}/_temporary-{shard:08d}-{uuid.uuid4().hex}"
            state.update(shard=shard, n=0, temporary=temporary, out=store.open_output_stream(temporary), sha=hashlib.sha256())

        for b in batches:
            rows, done = b.to_pylist(), []
            for r in rows:
                if state.get("shard") != r["shard"]:
                    if state:
                        done.append(close())
                    begin(r["shard"])
                if r["slot"] != r["shard"] * shard_sequences + state["n"]:
                    raise ValueError(f"slot {r['slot']} is not the next of shard {r['shard']}")
                ids = expand.decompress(r.pop("tokens"))
                data = ids + END_ID.to_bytes(2, "little") * ((size - len(ids)) // 2)
                state["out"].write(data), state["sha"].update(data)
                state["n"] += 1
                r.update(kind="sequence", sha256=hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_pylist(rows + done, schema=RECORD)
        if state:
            yield pa.RecordBatch.from_pylist([close()], schema=RECORD)

    shards = max(1, -(-n // shard_sequences))
    tasks = min(shards, MAX_PARTITIONS)
    dealt = sequences.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int"))
    return small_batches(dealt.sortWithinPartitions("shard", "slot")).mapInArrow(run, RECORD_DDL)


def read_slots(manifest: DataFrame, path: str, stride: int, start: int = 0) -> DataFrame:
    """(slot, ids_sha256) of every record from slot ``start`` on, read sequentially from the shards."""

    def run(batches):
        from pyarrow import fs as pafs

        store, root = pafs.FileSystem.from_uri(path)
        size = 2 * stride
        for b in batches:
            for r in b.to_pylist():
                skip = max(0, start - r["first_slot"])
                with store.open_input_file(f"{root}/{r['file']}") as f:
                    f.seek(skip * size)
                    for at in range(skip, r["n_sequences"], 1024):
                        data = f.read(min(1024, r["n_sequences"] - at) * size)
                        slots = [r["first_slot"] + at + k for k in range(len(data) // size)]
                        digests = [hashlib.sha256(data[k * size:(k + 1) * size]).hexdigest() for k in range(len(slots))]
                        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(digests, pa.string())], names=["slot", "ids_sha256"])

    wanted = manifest.where(F.col("first_slot") + F.col("n_sequences") > start)
    return spread(wanted).mapInArrow(run, "slot long, ids_sha256 string")


def read_back(sequences: DataFrame, manifest: DataFrame, path: str, stride: int) -> DataFrame:
    """``sequences`` with ids_sha256, the digest of the record as read from its shard.

    A sequence without a record, a record without a sequence and a record that
    differs from what was written raise. Both sides are shuffled by slot: the
    size of what is read cannot be told from that of the manifest, and a full
    join broadcasts neither.
    """
    rows = sequences.join(read_slots(manifest, path, stride), "slot", "full")
    same = F.col("sha256").eqNullSafe(F.col("ids_sha256"))
    wrong = F.raise_error(F.concat(F.lit("the record of slot "), F.col("slot").cast("string"), F.lit(" is lost or differs"))).cast("string")
    return rows.withColumn("ids_sha256", F.when(same, F.col("ids_sha256")).otherwise(wrong))


def materialise(docs: DataFrame, path: str | None = None, stride: int = 1024, shard_sequences: int = 16_384, key: int = 7,
                vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, str]:
    """Write the shards of ``docs``; returns (sequences, manifest, path).

    ``sequences`` has (slot, shard, part, chunk, ids, n_tokens, sha256) for
    every sequence, ``ids`` being its documents; ``manifest`` (shard, file, first_slot, n_sequences,
    bytes, sha256) for every file. Both are published by one commit after the
    last shard has its name.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-shards")
    spark.createDataFrame([], "x int").write.parquet(f"{path}/_created")  # makes the folder in any store
    tokens = staged(tokenize(docs, stride, vocabulary, id_col, text_col), "token-table")
    placed, n = place(tokens, stride, shard_sequences, key)
    write_shards(placed, path, stride, shard_sequences, n).write.parquet(f"{path}/_records")
    records = spark.read.parquet(f"{path}/_records")
    sequences = records.where("kind = 'sequence'").select("slot", "shard", "part", "chunk", "ids", "n_tokens", "sha256")
    manifest = records.where("kind = 'shard'").select("shard", "file", F.col("slot").alias("first_slot"), "n_sequences", "bytes", "sha256")
    return sequences, manifest, path
