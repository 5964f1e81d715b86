"""Near-duplicates by shingle similarity: b-bit MinHash and a multi-index Hamming join.

1. One pass turns each text into its set size, a digest of the set and a
   signature of ``POSITIONS`` MinHash values of 16 bits. Equal sets collapse.
2. Two sets that share ``percent`` of their union differ in at most
   ``max_distance`` positions, but for one pair in 10^8 at the very threshold
   and far fewer above it.
3. The positions are cut into ``max_distance // 2 + 1`` chunks. By pigeonhole
   two signatures within the distance have a chunk with at most one error, so
   each chunk is indexed and probed once per position left out: no pair
   within the distance is lost, however large the corpus.
4. Keys with one set fall away, keys with the same sets count once. In each
   key's bucket the signatures are compared by distance, which leaves links
   that span the bucket, never its pairs; components of all links are clusters
   that hold every pair within the distance.
5. Clusters are cut into blocks of bounded size, to which the texts of the
   clustered documents travel, and only theirs, once per set. A block compares the pairs within the distance that no confirmed link joins
   yet on their full sets. Where a cluster has several blocks, representatives
   of what is joined so far meet next, and at last the blocks of what is still
   apart, pair by pair.
6. Components of the confirmed links are the classes.

Sets are compared as 64-bit hashes of their shingles.

Edge cases: a null or blank text has the empty set, which is linked with
nothing; fewer words than a shingle are one shingle; rows that repeat a text
or an id share what they share; a null id takes part but is never the smallest
id; a class of null ids only has a null component; an empty table gives an
empty result; further columns are ignored whatever their names.
"""

from __future__ import annotations

import re
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import small_batches, staged, utf8
from strata.llm.components import connected_components

POSITIONS = 96              # MinHash values of a signature, 16 bits each
MISS = 1e-8                 # share of pairs at the threshold whose signatures may lie further apart
SEED = 42
SLICE_BYTES = 4 << 20       # text cut into words at a time
WORDS = 400_000             # remembered word hashes of a task
BUCKET = 2048               # signatures of a bucket compared in one piece
BLOCK_SETS, BLOCK_SHINGLES = 512, 1_000_000  # sets and shingles compared in one piece
REPRESENTATIVES = 4

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_SIGNED = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary())])


def max_distance(percent: int, positions: int = POSITIONS) -> int:
    """The fewest differing positions that all but ``MISS`` of the pairs at ``percent`` similarity stay within."""
    p = 1 - percent / 100
    tail, d = 1.0, -1
    while tail > MISS and d < positions:
        d += 1
        tail = sum(comb(positions, i) * p**i * (1 - p) ** (positions - i) for i in range(d + 1, positions + 1))
    return d


# -- sets and signatures ----------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        self[word] = h = xxh64_intdigest(word, SEED)
        return h


class Sets:
    """Texts -> sorted arrays of shingle hashes, in one task."""

    def __init__(self, shingle_words: int):
        self.size, self.hashes = shingle_words, _WordHashes()

    def of(self, text: bytes | None) -> np.ndarray:
        parts, at, text = [], 0, (text or b"").lower()
        while at < len(text):
            gap = _GAP.search(text, at + SLICE_BYTES)
            end = gap.start() if gap else len(text)
            words = text[at:end].split()
            parts.append(np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words)))
            if len(self.hashes) > WORDS:
                self.hashes.clear()
            at = end
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        size = min(self.size, len(words))
        if not size:
            return words
        shingles = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            shingles = _mix(shingles * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - size + 1 + i] + np.uint64(1))
        return np.unique(shingles)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 31, POSITIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, POSITIONS, dtype=np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The low 16 bits of a mix of each function's smallest value over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(POSITIONS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        least = np.minimum(least, (x[at:at + 1024, None] * a + b).min(axis=0))
    return (_mix(least.astype(np.uint64) + np.uint64(1)) & np.uint64(0xFFFF)).astype(np.uint16)


def signatures(docs: DataFrame, shingle_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, digest, sig) of every row: set size, 128-bit digest of the set, signature."""

    def run(batches):
        from xxhash import xxh3_128_digest

        sets, (a, b) = Sets(shingle_words), _functions()
        for batch in batches:
            n, digest, sig = [], [], []
            for text in utf8(batch.column(1)):
                s = sets.of(text)
                n.append(len(s)), digest.append(xxh3_128_digest(s.tobytes())), sig.append(signature(s, a, b).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], schema=_SIGNED)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(rows).mapInArrow(run, "id long, n long, digest binary, sig binary")


# -- rows in groups ---------------------------------------------------------
def _groups(batches, keys: int):
    """Sorted batches -> (rows, starts): whole groups of equal first ``keys`` columns. A group over
    many batches is put together once."""
    held, last = [], None

    def done(parts):
        rows = pa.Table.from_batches(parts).combine_chunks()
        k = [rows.column(i).to_numpy() for i in range(keys)]
        return rows, np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in k], axis=0)]) if len(k[0]) > 1 else [True])

    for b in batches:
        if not b.num_rows:
            continue
        k = [b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in k], axis=0)) + 1
        if held and last != tuple(x[0] for x in k):
            change = np.concatenate([[0], change])
        if len(change):
            cut = int(change[-1])
            parts = [*held, b.slice(0, cut)] if cut else held
            if parts:
                yield done(parts)
            held = [b.slice(cut)]
        else:
            held.append(b)
        last = tuple(x[-1] for x in k)
    if held:
        yield done(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    start = column.offset * POSITIONS
    return np.frombuffer(column.buffers()[2], np.uint16)[start:start + len(column) * POSITIONS].reshape(-1, POSITIONS)


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ab = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])


# -- the join on signatures -------------------------------------------------
def keys_of(distinct: DataFrame, distance: int) -> DataFrame:
    """(key, uid): for every chunk and every position of it left out, a hash of the chunk's other values."""

    def run(batches):
        chunks = np.array_split(np.arange(POSITIONS, dtype=np.uint64), distance // 2 + 1)
        place = np.arange(POSITIONS, dtype=np.uint64) << np.uint64(16)
        salt = _mix(place + np.uint64(1))
        for b in batches:
            sig = _matrix(pa.chunked_array([b.column(1)])) if b.num_rows else np.zeros((0, POSITIONS), np.uint16)
            uid = b.column(0)
            mixed = _mix(_mix(sig.astype(np.uint64) | place) + np.uint64(SEED))
            for chunk in chunks:
                whole = mixed[:, chunk].sum(axis=1, dtype=np.uint64)
                for j in chunk:
                    key = _mix(whole - mixed[:, j] + salt[j])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), uid], names=["key", "uid"])

    return distinct.select("uid", "sig").mapInArrow(run, "key long, uid long")


def _sweep(uid: np.ndarray, sig: np.ndarray, distance: int):
    """Links that span what is within ``distance``; a linked set leaves those it is compared with."""
    left = np.arange(len(uid))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = (sig[left] != sig[x]).sum(axis=1) <= distance
            found, left = left[near], left[~near]
            queue.extend(found.tolist())
            yield from ((int(uid[x]), int(uid[y])) for y in found)


def cluster_links(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b): links that span all sets whose signatures reach each other by steps within ``distance``."""
    shared = staged(keys_of(distinct, distance).groupBy("key").count().where("count > 1").select("key"), "minhash-shared")
    rows = staged(keys_of(distinct, distance).join(shared, "key"), "minhash-keys")
    per_key = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("lo"), F.max("uid").alias("hi"), F.bit_xor(F.xxhash64("uid")).alias("x"))
    buckets = staged(per_key.groupBy("n", "lo", "hi", "x").agg(F.min("key").alias("key")).select("key", "n"), "minhash-buckets")
    rows = rows.join(buckets, "key").withColumn("parts", F.ceil(F.col("n") / F.lit(BUCKET)).cast("int"))
    own = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")
    dealt = rows.select("key", "uid", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "uid")
    dealt = dealt.join(distinct.select("uid", "sig"), "uid").select("key", "i", "j", "uid", "sig")

    def run(batches):
        for rows, starts in _groups(batches, 3):
            uid, sig = rows.column("uid").to_numpy(), _matrix(rows.column("sig"))
            sizes = np.diff(np.concatenate([starts, [len(uid)]]))
            twos = starts[sizes == 2]
            near = twos[(sig[twos] != sig[twos + 1]).sum(axis=1) <= distance]
            links = list(zip(uid[near].tolist(), uid[near + 1].tolist(), strict=True))
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                links.extend(_sweep(uid[s:s + n], sig[s:s + n], distance))
            yield _link_batch(links)

    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long")


# -- confirmation on full sets ----------------------------------------------
def _confirmed(uid, joined, side, sig, sets, distance: int, percent: int):
    """Links among some sets: pairs of different ``joined`` (and, with two sides, of different sides) within
    ``distance`` whose full sets share ``percent`` of their union. A link joins what it links."""
    n = np.array([len(s) for s in sets])
    ends = np.cumsum(n)
    starts = ends - n
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    joined, inside, two = joined.copy(), np.zeros(len(values), bool), side.max() > 0
    for x in range(len(uid) - 1):
        y = np.arange(x + 1, len(uid))
        ok = (joined[y] != joined[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))
        if two:
            ok &= side[y] != side[x]
        y = y[ok]
        y = y[(sig[y] != sig[x]).sum(axis=1) <= distance]
        if not len(y):
            continue
        mine = codes[starts[x]:ends[x]]
        inside[mine] = True
        if len(y) * 8 < len(uid) - x:
            common = np.array([inside[codes[starts[i]:ends[i]]].sum() for i in y])
        else:
            common = np.add.reduceat(inside[codes[starts[y[0]]:]].astype(np.int64), starts[y[0]:] - starts[y[0]])[y - y[0]]
        inside[mine] = False
        for i in y[100 * common >= percent * (n[x] + n[y] - common)].tolist():
            if joined[i] != joined[x]:
                joined[joined == joined[i]] = joined[x]
                yield int(uid[x]), int(uid[i])


class Texts:
    """The documents of clustered sets: where blocks get their sets from."""

    def __init__(self, docs: DataFrame, ids: DataFrame, distance: int, percent: int, shingle_words: int, repeats: bool, id_col: str, text_col: str):
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        self.rows = staged(rows.join(ids, rows["id"].eqNullSafe(ids["first_id"]), "left_semi"), "minhash-texts")  # they are read several times
        self.distance, self.percent, self.shingle_words, self.repeats = distance, percent, shingle_words, repeats

    def confirm(self, members: DataFrame, block: list[str]) -> DataFrame:
        """``members`` (block columns..., side, uid, joined, first_id, digest) -> confirmed links (a, b) within each block.

        The text of ``first_id`` goes to the block as it is; sets and signatures are made there. Texts of the
        same id with another set fall away by their digest.
        """
        distance, percent, shingle_words = self.distance, self.percent, self.shingle_words
        members = staged(members, "minhash-blocks")

        def run(batches):
            from xxhash import xxh3_128_digest

            made, (a, b) = Sets(shingle_words), _functions()
            for rows, starts in _groups(batches, len(block)):
                uid, joined, side = (rows.column(c).to_numpy() for c in ("uid", "joined", "side"))
                digest, links = rows.column("digest"), []
                for s, e in zip(starts.tolist(), [*starts[1:].tolist(), rows.num_rows], strict=True):
                    if e - s < 2:
                        continue
                    sets, real = [], []
                    for i, text in enumerate(utf8(rows.column("text").slice(s, e - s)), s):
                        x = made.of(text)
                        if xxh3_128_digest(x.tobytes()) == digest[i].as_py():
                            sets.append(x), real.append(i)
                    if len(real) > 1:
                        sig = np.stack([signature(x, a, b) for x in sets])
                        links.extend(_confirmed(uid[real], joined[real], side[real], sig, sets, distance, percent))
                yield _link_batch(links)

        read = self.rows.join(members, self.rows["id"].eqNullSafe(members["first_id"])).select(*block, "side", "uid", "joined", "digest", "text")
        if self.repeats:  # rows that repeat an id and a text
            read = read.dropDuplicates([*block, "side", "uid", "text"])
        return staged(small_batches(read).repartition(*block).sortWithinPartitions(*block, "side").mapInArrow(run, "a long, b long"), "minhash-links")


def _pieces(count: str, size: str):
    return F.greatest(F.ceil(F.col(count) / F.lit(BLOCK_SETS)), F.ceil(F.col(size) / F.lit(BLOCK_SHINGLES))).cast("int")


def _within_blocks(sets: DataFrame, texts: Texts) -> tuple[DataFrame, DataFrame]:
    """Links within hashed blocks of each cluster, and the clusters that have several blocks."""
    sized = staged(sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
                   .select("cluster", _pieces("m", "s").alias("pieces")), "minhash-clusters")
    members = sets.join(sized, "cluster").select("cluster", F.pmod(F.xxhash64("uid"), F.col("pieces")).cast("int").alias("piece"), F.lit(0).alias("side"),
                                                 "uid", "joined", "first_id", "digest")
    return texts.confirm(members, ["cluster", "piece"]), sized.where("pieces > 1").select("cluster")


def _join_up(sets: DataFrame, links: DataFrame) -> DataFrame:
    """``sets`` with ``joined``: the smallest uid that confirmed links reach."""
    found = staged(connected_components(links), "minhash-joined")
    return staged(sets.drop("joined").join(found.withColumnRenamed("node", "uid"), "uid", "left")
                  .select("cluster", "uid", F.coalesce("root", "uid").alias("joined"), "n", "first_id", "digest"), "minhash-apart")


def _across_blocks(sets: DataFrame, texts: Texts) -> DataFrame:
    """Links between what is still apart: what has many members has blocks of its own, the rest shares blocks;
    all pairs of blocks meet but those of one and the same."""
    parts = sets.groupBy("cluster", "joined").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    parts = staged(parts.withColumn("own", F.when(F.col("m") * 2 > BLOCK_SETS, F.col("joined")).otherwise(F.lit(-1)).cast("long")), "minhash-parts")
    per = staged(parts.groupBy("cluster", "own").agg(F.sum("m").alias("m"), F.sum("s").alias("s"))
                 .select("cluster", "own", _pieces("m", "s").alias("pieces")), "minhash-own")
    block = per.select("cluster", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), "own").select("cluster", F.struct("own", "piece").alias("left"))
    tiles = block.join(block.withColumnRenamed("left", "right"), "cluster").where(
        (F.col("left") <= F.col("right")) & ((F.col("left.own") != F.col("right.own")) | (F.col("left.own") == -1)))
    ends = F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("at")), F.struct(F.lit(1).alias("side"), F.col("right").alias("at")))
    ends = F.when(F.col("left") == F.col("right"), F.slice(ends, 1, 1)).otherwise(ends)
    ends = tiles.select("cluster", F.xxhash64("left", "right").alias("tile"), F.explode(ends).alias("e"))
    ends = staged(ends.select("cluster", "tile", "e.side", "e.at.own", "e.at.piece"), "minhash-tiles")
    by = F.when(F.col("own") == -1, F.xxhash64("joined")).otherwise(F.xxhash64("uid"))
    placed = sets.join(parts.select("cluster", "joined", "own"), ["cluster", "joined"]).join(per, ["cluster", "own"]).withColumn(
        "piece", F.pmod(by, F.col("pieces")).cast("int"))
    members = placed.join(ends, ["cluster", "own", "piece"]).select("cluster", "tile", "side", "uid", "joined", "first_id", "digest")
    return texts.confirm(members, ["cluster", "tile"])


def confirmed_links(sets: DataFrame, texts: Texts) -> DataFrame:
    """``sets`` (cluster, uid, n, first_id, digest), stored -> links (a, b) that span the true classes."""
    sets = sets.withColumn("joined", F.col("uid"))
    links, several = _within_blocks(sets, texts)
    if several.isEmpty():
        return links
    now = _join_up(sets.join(several, "cluster", "left_semi"), links)
    order = Window.partitionBy("cluster", "joined").orderBy(F.xxhash64("uid"), "uid")
    ranked = now.select("cluster", "joined", "uid").withColumn("r", F.row_number().over(order)).where(F.col("r") <= REPRESENTATIVES)
    joined = now.groupBy("cluster", "joined").count().where("count > 1").select("cluster", "joined")
    chosen = staged(ranked.join(joined, ["cluster", "joined"], "left_semi").select("uid"), "minhash-chosen")
    links = links.unionAll(_within_blocks(now.join(chosen, "uid", "left_semi").select(*now.columns), texts)[0])
    return links.unionAll(_across_blocks(_join_up(now, links), texts))


def near_duplicates(docs: DataFrame, shingle_words: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    Sets of shingles are linked that share at least ``percent`` of their
    union; ``component_id`` is the smallest id that links reach.
    """
    distance = max_distance(percent)
    signed = staged(signatures(docs, shingle_words, id_col, text_col), "minhash-signatures")
    distinct = signed.where("n > 0").groupBy("digest", "n", "sig").agg(F.min("id").alias("first_id"))
    distinct = staged(distinct.withColumn("uid", F.monotonically_increasing_id()), "minhash-distinct")
    clusters = staged(connected_components(cluster_links(distinct, distance)), "minhash-members")
    sets = distinct.join(clusters.withColumnRenamed("node", "uid"), "uid").select(F.col("root").alias("cluster"), "uid", "n", "first_id", "digest")
    repeats = not signed.where("n > 0").groupBy("id", "digest").count().where("count > 1").isEmpty()
    sets = staged(sets, "minhash-sets")
    texts = Texts(docs, staged(sets.select("first_id").distinct(), "minhash-ids"), distance, percent, shingle_words, repeats, id_col, text_col)
    classes = staged(connected_components(confirmed_links(sets, texts)), "minhash-classes")
    rooted = distinct.select("uid", "digest", "first_id").join(classes.withColumnRenamed("node", "uid"), "uid")
    least = staged(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "minhash-least")
    of = staged(rooted.join(least, "root").select("digest", "component_id"), "minhash-of")
    alone = distinct.join(of, "digest", "left_anti").select("digest", F.col("first_id").alias("component_id"))
    every = staged(of.unionAll(alone), "minhash-map")
    out = signed.join(every, "digest", "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
