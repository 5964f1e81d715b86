"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Every text gets a 64-bit fingerprint (Arrow batches, one pass).
2. Equal fingerprints collapse to one row before anything is compared.
3. The 64 bits are dealt into ``m`` partitions; correlated bits go together.
   With ``max_bits`` allowed differences, ``max_bits + 1`` units are dealt over
   the partitions; a partition that gets ``a`` units is probed within ``a - 1``
   differing bits. Two fingerprints within ``max_bits`` differ by fewer bits
   than units in at least one partition, so no pair is lost.
4. The units are dealt per fingerprint by dynamic programming on the
   estimated candidate counts, taken from histograms over all fingerprints
   (their size is fixed by the bit widths, not by the data). ``m`` is the
   count with the least estimated cost, so wider and fewer partitions take
   over as the corpus grows and candidates a probe stay few.
5. Probes meet index rows by key; each bucket is verified by the full bit
   distance and leaves a spanning forest of its links, not its pairs. Buckets
   are counted first, and large ones parted by exact blocks of all bits, so
   that none has to meet in one task.
6. Components of the forest give the classes.

Edge cases: a null or blank text has no words and fingerprint zero, which
links like any other; fewer words than a shingle hash as one shingle; rows
that repeat an id or a text share a class; a null id takes part but is never
the smallest id; an empty table gives an empty result; further columns are
ignored whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import plain, small_batches, staged, utf8
from strata.llm.components import connected_components

SEED = 42
SUB_BITS = 11          # histogram blocks of at most 2^11 cells
MAX_UNITS = 3          # a partition is probed within at most two flipped bits
PROBE_COST, CANDIDATE_COST = 1.0, 0.2
SMALL_BUCKET, SPLIT_BUCKET = 32, 8192
HOT_BUCKET = 1 << 16   # rows beyond which a bucket is parted before the shuffle
SAMPLE_FOR_COST = 2000  # fingerprints on which the partition counts are compared (a cost choice only)


# -- fingerprints -----------------------------------------------------------
def fingerprint(text: bytes | None, shingle_words: int) -> int:
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < shingle_words:
        return xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - shingle_words + 1].tolist()
    hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle_words - 1:].tolist(), strict=True)),
                         np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) for every row; the 64 bits of ``fp`` read as unsigned are the fingerprint."""

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle_words) for t in utf8(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return small_batches(rows).mapInArrow(run, "id long, fp long")


# -- statistics over all fingerprints ---------------------------------------
def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _project(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _fp_batches(batches, column: int = 0):
    for b in batches:
        if b.num_rows:
            yield b.column(column).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def co_occurrence(distinct: DataFrame) -> np.ndarray:
    """64 x 64 counts of bits set together, over every fingerprint."""

    def run(batches):
        total = np.zeros((64, 64), np.int64)
        for fp in _fp_batches(batches):
            for at in range(0, len(fp), 65536):
                x = _bits(fp[at:at + 65536]).astype(np.float32)
                total += (x.T @ x).astype(np.int64)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((i * 64 + j).astype(np.int32)), pa.array(total[i, j])], names=["cell", "n"])

    out = np.zeros((64, 64), np.int64)
    for r in distinct.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"] // 64, r["cell"] % 64] = r["n"]
    return out


def group_bits(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Deal the 64 bits into ``m`` partitions; each grows by the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = list(range(64)), []
    for k in range(m):
        size = 64 // m + (k < 64 % m)
        first = max(free, key=lambda b: (corr[b, free].sum(), -b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            nxt = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(nxt)
            free.remove(nxt)
        out.append(group)
    return out


def _blocks(bits: list[int]) -> list[list[int]]:
    parts = -(-len(bits) // SUB_BITS)
    return [list(map(int, x)) for x in np.array_split(np.array(bits), parts)]


class Layout:
    """Partitions, and for each the shares of all fingerprints at 0, 1, 2 differing bits per block value."""

    def __init__(self, partitions: list[list[int]], max_bits: int):
        self.partitions, self.max_bits, self.n = partitions, max_bits, 0
        self.blocks = [_blocks(p) for p in partitions]
        self.tables: list[list[np.ndarray]] = []

    def set_counts(self, n: int, counts: list[list[np.ndarray]]) -> None:
        self.n, self.tables = n, []
        for hists in counts:
            row = []
            for h in hists:
                w, v = int(len(h)).bit_length() - 1, np.arange(len(h))
                one = sum(h[v ^ (1 << b)] for b in range(w))
                two = sum((h[v ^ ((1 << a) | (1 << b))] for a, b in combinations(range(w), 2)), np.zeros(len(h)))
                row.append(np.stack([h, one, two], axis=1) / max(n, 1))
            self.tables.append(row)

    def estimate(self, fp: np.ndarray, i: int) -> np.ndarray:
        """Estimated candidates of partition ``i`` within 0, 1, 2 bits; its blocks count as independent."""
        total = None
        for block, t in zip(self.blocks[i], self.tables[i], strict=True):
            s = t[_project(fp, block).astype(np.int64)]
            if total is None:
                total = s
            else:
                total = np.stack([sum(total[:, a] * s[:, e - a] for a in range(e + 1)) for e in range(3)], axis=1)
        return np.cumsum(total, axis=1) * self.n

    def allocate(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units per fingerprint and partition with the least estimated cost, and that cost."""
        goal = self.max_bits + 1
        best = np.full((len(fp), goal + 1), np.inf)
        best[:, 0] = 0
        choice = []
        for i, bits in enumerate(self.partitions):
            w = len(bits)
            probes = np.cumsum([1, w, w * (w - 1) // 2])
            cost = np.concatenate([np.zeros((len(fp), 1)), probes * PROBE_COST + self.estimate(fp, i) * CANDIDATE_COST], axis=1)
            new, took = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
            for u in range(goal + 1):
                for a in range(min(MAX_UNITS, u) + 1):
                    c = best[:, u - a] + cost[:, a]
                    better = c < new[:, u]
                    new[better, u], took[better, u] = c[better], a
            best = new
            choice.append(took)
        units = np.zeros((len(fp), len(self.partitions)), np.int8)
        left, at = np.full(len(fp), goal), np.arange(len(fp))
        for i in reversed(range(len(self.partitions))):
            units[:, i] = choice[i][at, left]
            left = left - units[:, i]
        return units, best[:, goal]


def plan_layout(distinct: DataFrame, max_bits: int) -> Layout:
    """Count over all fingerprints, group the bits, and take the partition count of least cost."""
    together = co_occurrence(distinct)
    n = distinct.count()
    # with as many partitions as units each would get one; fewer, and the units can be dealt unequally
    counts = range(max(2, -(-(max_bits + 1) // MAX_UNITS)), max(2, max_bits) + 1) if max_bits else [1]
    layouts = [Layout(group_bits(together, n, m), max_bits) for m in counts]
    flat = [(k, i, b, block) for k, lay in enumerate(layouts) for i, bs in enumerate(lay.blocks) for b, block in enumerate(bs)]

    def run(batches):
        hist = [np.zeros(1 << len(block), np.int64) for *_, block in flat]
        for fp in _fp_batches(batches):
            for h, (*_, block) in zip(hist, flat, strict=True):
                h += np.bincount(_project(fp, block).astype(np.int64), minlength=len(h))
        for k, h in enumerate(hist):
            v = np.flatnonzero(h)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), k, np.int32)), pa.array(v.astype(np.int32)), pa.array(h[v])],
                                             names=["block", "value", "n"])

    hists = [np.zeros(1 << len(block)) for *_, block in flat]
    cells = distinct.select("fp").mapInArrow(run, "block int, value int, n long").groupBy("block", "value").agg(F.sum("n").alias("n"))
    for r in cells.collect():  # at most 2^11 cells for each of a fixed number of blocks
        hists[r["block"]][r["value"]] = r["n"]
    at = 0
    for lay in layouts:
        grouped = []
        for bs in lay.blocks:
            grouped.append(hists[at:at + len(bs)])
            at += len(bs)
        lay.set_counts(n, grouped)
    sample = distinct.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE_FOR_COST).collect()
    fp = np.array([r["fp"] for r in sample], np.int64).view(np.uint64)
    if not len(fp):
        return layouts[0]
    return min(layouts, key=lambda lay: lay.allocate(fp)[1].mean() + len(lay.partitions))


# -- probe and verify -------------------------------------------------------
def _probe_rows(fp: np.ndarray, layout: Layout):
    """Index rows (flag 1, also the exact probe) and flipped probes (flag 0) of some fingerprints."""
    units, _ = layout.allocate(fp)
    for i, bits in enumerate(layout.partitions):
        own = _project(fp, bits).astype(np.int64)
        base = np.int64(i) << np.int64(56)
        yield base | own, fp, 1
        w = len(bits)
        flips = {2: [1 << b for b in range(w)], 3: [(1 << a) | (1 << b) for a, b in combinations(range(w), 2)]}
        for at_least, masks in flips.items():
            sel = units[:, i] >= at_least
            if sel.any():
                for mask in masks:
                    yield base | (own[sel] ^ np.int64(mask)), fp[sel], 0


class _Forest:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        p = self.parent
        while p.setdefault(x, x) != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _sweep(fp: np.ndarray, max_bits: int):
    """Links that span the classes of ``fp`` (distinct): a linked fingerprint leaves the set it is compared with."""
    left = fp
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                for y in found:
                    yield x, y
                queue.extend(found)


def _bucket_links(fp: np.ndarray, max_bits: int):
    """Links that span a large bucket; a very large one is cut by exact blocks of the whole fingerprint first."""
    fp = np.unique(fp)
    if len(fp) <= SPLIT_BUCKET:
        yield from _sweep(fp, max_bits)
        return
    for bits in np.array_split(np.arange(64), max_bits + 1):
        v = _project(fp, [int(b) for b in bits])
        order = np.argsort(v, kind="stable")
        cuts = np.flatnonzero(np.diff(v[order])) + 1
        for part in np.split(fp[order], cuts):
            if len(part) > 1:
                yield from _sweep(part, max_bits)


def _links_of(key: np.ndarray, fp: np.ndarray, index: np.ndarray, max_bits: int):
    """Spanning links of the buckets in sorted rows."""
    starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    useful = (np.add.reduceat(index, starts) > 0) & (sizes > 1)
    forest, out = _Forest(), []
    keep = np.repeat(useful & (sizes <= SMALL_BUCKET), sizes)
    k, f, x = key[keep], fp[keep], index[keep]
    for d in range(1, int(sizes[useful & (sizes <= SMALL_BUCKET)].max(initial=1))):
        a = np.flatnonzero((k[:-d] == k[d:]) & ((x[:-d] | x[d:]) > 0)) if d < len(k) else np.array([], np.int64)
        if not len(a):
            break
        a = a[np.bitwise_count(f[a] ^ f[a + d]) <= max_bits]
        pairs = np.unique(np.stack([np.minimum(f[a], f[a + d]), np.maximum(f[a], f[a + d])], axis=1), axis=0)
        out.extend((p, q) for p, q in pairs.tolist() if forest.link(p, q))
    for s, n in zip(starts[useful & (sizes > SMALL_BUCKET)].tolist(), sizes[useful & (sizes > SMALL_BUCKET)].tolist(), strict=True):
        out.extend((int(p), int(q)) for p, q in _bucket_links(fp[s:s + n], max_bits) if forest.link(int(p), int(q)))
    return out


def links(distinct: DataFrame, max_bits: int, layout: Layout | None = None) -> DataFrame:
    """``distinct`` (fp long, no repeats) -> links (a, b) that span every class of fingerprints
    within ``max_bits`` differing bits of each other."""
    layout = layout or plan_layout(distinct, max_bits)

    def probe(batches):
        for whole in _fp_batches(batches):
            for at in range(0, len(whole), 2048):
                keys, fps, flags = [], [], []
                for key, fp, flag in _probe_rows(whole[at:at + 2048], layout):
                    keys.append(key), fps.append(fp), flags.append(np.full(len(fp), flag, np.int8))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(fps).view(np.int64)),
                                                  pa.array(np.concatenate(flags))], names=["key", "fp", "own"])

    def verify(batches):
        held = []  # pieces of the bucket that the batches so far end with

        def emit():
            key, fp, own = (np.concatenate(x) for x in zip(*held, strict=True))
            ab = np.array(_links_of(key, fp, own, max_bits), np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            rows = [b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy()]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last bucket may go on
            if cut or held and held[-1][0][-1] != rows[0][0]:
                if cut:
                    held.append([x[:cut] for x in rows])
                yield emit()
                held.clear()
            held.append([x[cut:] for x in rows])
        if held:
            yield emit()

    probes = distinct.select("fp").mapInArrow(probe, "key long, fp long, own byte")
    return _split(probes, max_bits).repartition("key").sortWithinPartitions("key").mapInArrow(verify, "a long, b long")


def _split(probes: DataFrame, max_bits: int) -> DataFrame:
    """``probes`` whose buckets of more than ``HOT_BUCKET`` rows are parted before they meet.

    Two fingerprints within ``max_bits`` agree in one of ``max_bits + 1`` blocks of their bits at
    least, so a row of a large bucket goes to one smaller bucket for each block, and no link is lost.
    """
    large = staged(probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_BUCKET).select("key"), "simhash-large")
    if large.isEmpty():
        return probes
    blocks = [int(sum(1 << int(b) for b in bits)) for bits in np.array_split(np.arange(64), max_bits + 1)]
    parts = [F.xxhash64("key", F.lit(i), F.col("fp").bitwiseAND(F.lit(int(np.uint64(m).view(np.int64))))) for i, m in enumerate(blocks)]
    marked = probes.join(large.withColumn("large", F.lit(True)), "key", "left")
    return marked.select(F.explode(F.when(F.col("large"), F.array(*parts)).otherwise(F.array("key"))).alias("key"), "fp", "own")


def classes(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fps`` (id, fp) -> (fp, component_id): one row per distinct fingerprint."""
    distinct = staged(fps.groupBy("fp").agg(F.min("id").alias("first_id")).select("fp", "first_id"), "simhash-distinct")
    member = staged(connected_components(links(distinct, max_bits)), "simhash-members")
    n = member.count()
    linked = distinct.join(member, distinct["fp"] == member["node"]).select("fp", "first_id", "root")
    least = staged(linked.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-roots", n)
    of = staged(member.join(least, "root").select(F.col("node").alias("fp"), "component_id"), "simhash-classes", n)
    return staged(distinct.join(of, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "simhash-map")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id whose fingerprint can be reached by
    steps of at most ``max_bits`` differing bits (null if only null ids can).
    """
    fps = staged(fingerprints(docs, shingle_words, id_col, text_col), "simhash-fps")
    return fps.join(classes(fps, max_bits), "fp").select("id", "fp", "component_id")


def one_per_class(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` without near copies: of every class the document with the smallest id stays.

    Of rows that repeat an id the first by its columns stays. Rows without an id cannot be told
    apart from others and stay.
    """
    rows = plain(docs, "doc_id", "text")
    found = staged(near_duplicates(rows, shingle_words, max_bits).where(F.col("id").isNotNull()), "simhash-found")
    dropped = staged(found.where(F.col("id") != F.col("component_id")).select(F.col("id").alias("doc_id"))
                     .unionAll(_repeats(found)).distinct(), "simhash-dropped")
    kept = rows.join(dropped, "doc_id", "left_anti")
    again = staged(_repeats(found).join(found.where(F.col("id") == F.col("component_id")).select(F.col("id").alias("doc_id")).distinct(),
                                        "doc_id", "left_semi"), "simhash-repeats")
    first = Window.partitionBy("doc_id").orderBy(*[_ordered(f).asc_nulls_first() for f in rows.schema])
    repeated = rows.join(again, "doc_id", "left_semi").withColumn("rank", F.row_number().over(first)).where("rank = 1").drop("rank")
    return kept.unionByName(repeated).select(*rows.columns).toDF(*docs.columns)


def _ordered(field):
    """A column as it can be sorted: maps, and what holds them, as JSON with the keys in order."""
    if "map<" not in field.dataType.simpleString():
        return F.col(field.name)
    return F.to_json(F.struct(field.name), {"spark.sql.mapKeySorted": "true"})


def _repeats(found: DataFrame) -> DataFrame:
    return found.groupBy(F.col("id").alias("doc_id")).count().where("count > 1").select("doc_id")
