"""Phrase collocations, counted in HAT-tries.

Sieve. One scan of whole texts counts 64-bit hashes of all words and of all
pairs of neighbouring words, a second one of all triples whose pairs passed:
per task as sorted arrays, then per hash. No phrase can reach the minimum
count that holds a word, pair or triple below it. The hashes that reach it go
to the tasks of the next scan as a bit table of bounded size, which may let a
rare phrase through (it is counted and dropped) but never loses one.

Counting. The last scan counts the phrases that the sieve lets through by
their words, in a HAT-trie: a shallow trie over word numbers whose leaves are
hash containers. A container that outgrows ``BURST`` entries bursts into a
trie node with a container for every next word. When a task holds more than
``ENTRIES`` phrases it spills whole subtrees, largest first, each as a sorted
run; runs carry the partition of their first two words, to which they are
shuffled and merged there. A phrase costs one row per task and spill however
often it occurs, and a hot first word is spread over its second words.

Scores are exact: products are 38-digit decimals.

Edge cases: null and empty texts have no words, a null language is ``und``
(together with a language of that name); punctuation and line ends part
pieces, and no phrase crosses them; a piece of any length is read in slices
that overlap by the longest phrase; rows that repeat a document count again;
equal scores go by the larger count, then by the phrase's bytes; an empty
table gives an empty result; further columns are ignored whatever their names.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import small_batches, staged, utf8

BURST = 4096            # entries of a container before it bursts
ENTRIES = 400_000       # phrases a task holds before it spills
WORDS = 400_000         # distinct words a task numbers before it starts afresh
SLICE_BYTES = 1 << 20   # text cut into words at a time
HASHES = 2_000_000      # hashes of the sieve a task holds before it hands them on
MAX_BITS = 26           # a bit table of at most 8 MB
SEED = 42
RANK_ROWS = 100_000     # phrases of a language ranked in one task
TASK_WORDS = 10_000_000  # words a task counts, once all cores have their tasks

_TABLE = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n" * 10 + b" ")
_GAP = re.compile(rb"[ \n]")
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64

HASH_SCHEMA = pa.schema([("h", pa.int64()), ("lang", pa.binary()), ("n", pa.int64())])
RUN_SCHEMA = pa.schema([("lang", pa.binary()), ("part", pa.int64()), ("k", pa.int32()), ("phrase", pa.binary()), ("n", pa.int64())])


# -- the trie ---------------------------------------------------------------
class Node(dict):
    """A trie node: next word -> node or container (a plain dict: rest of the key -> count)."""


class HatTrie:
    def __init__(self, depth: int, burst: int = BURST):
        self.root: dict = {}
        self.depth, self.burst, self.entries = depth, burst, 0

    def add(self, key: tuple, n: int) -> None:
        parent, node, d = None, self.root, 0
        while type(node) is Node:
            parent, child = node, node.get(key[d])
            if child is None:
                child = node[key[d]] = {}
            node, d = child, d + 1
        rest = key[d:]
        if rest in node:
            node[rest] += n
            return
        node[rest] = n
        self.entries += 1
        if len(node) > self.burst and d < self.depth:
            grown = Node()
            for r, c in node.items():
                grown.setdefault(r[0], {})[r[1:]] = c
            if parent is None:
                self.root = grown
            else:
                parent[key[d - 1]] = grown

    @staticmethod
    def walk(node: dict, prefix: tuple = ()):
        """(key, count) of a subtree."""
        if type(node) is not Node:
            for rest, n in node.items():
                yield prefix + rest, n
            return
        for word, child in node.items():
            yield from HatTrie.walk(child, (*prefix, word))

    def spill(self, keep: int):
        """Takes whole subtrees out, largest first, until ``keep`` entries are left; one list of (key, count) each."""
        if type(self.root) is not Node or not keep:
            out, self.root, self.entries = list(self.walk(self.root)), {}, 0
            if out:
                yield out
            return
        sizes = sorted(((sum(1 for _ in self.walk(c)), w) for w, c in self.root.items()), reverse=True)
        for size, word in sizes:
            if self.entries <= keep:
                return
            yield list(self.walk(self.root.pop(word), (word,)))
            self.entries -= size


# -- words of a text --------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Slicer:
    """Cuts texts into words and hashes them, a slice at a time."""

    def __init__(self, overlap: int):
        self.overlap = overlap  # words of a slice that the next one begins with
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, SLICE_BYTES + 1)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def of(self, text: bytes):
        """(slice, starts, ends, hashes, follows, carried): ``follows`` tells of each word whether it goes on
        the piece of the word before; the first ``carried`` words belonged to the slice before."""
        text, at, done, carried = text.lower().translate(_TABLE), 0, 0, 0
        while done < len(text):
            gap = _GAP.search(text, max(at + SLICE_BYTES, done + 1))  # beyond the slice before, whatever it carries
            end = gap.start() if gap else len(text)
            part = text[at:end]
            b = np.frombuffer(part, np.uint8)
            inside = np.concatenate([[False], (b != 32) & (b != 10), [False]])
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            starts, ends = edges[::2], edges[1::2]
            self._powers(len(b) + 1)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[:len(b)], dtype=np.uint64)])
            hashes = _mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
            piece = np.cumsum(b == 10)[starts] if len(starts) else starts
            follows = np.concatenate([[False], piece[1:] == piece[:-1]])[:len(starts)]
            if len(starts) > carried:
                yield part, starts, ends, hashes, follows, carried
            carried, done = min(self.overlap, len(starts)), end
            at = at + int(starts[-carried]) if carried else end


def _lang_hash(lang: bytes) -> np.uint64:
    from xxhash import xxh64_intdigest

    return np.uint64(xxh64_intdigest(lang, SEED))


def _word_keys(lang: np.uint64, hashes: np.ndarray) -> np.ndarray:
    return _mix(hashes ^ lang)


def _pair_keys(lang: np.uint64, hashes: np.ndarray) -> np.ndarray:
    """Of each word and the next."""
    return _mix(hashes[:-1] * np.uint64(_BASE) + hashes[1:] + lang)


def _triple_keys(lang: np.uint64, hashes: np.ndarray) -> np.ndarray:
    """Of each word and the next two."""
    return _mix((hashes[:-2] * np.uint64(_BASE) + hashes[1:-1]) * np.uint64(_BASE) + hashes[2:] + lang)


def _by_lang(batch):
    out: dict[bytes, list[bytes]] = {}
    for lang, text in zip(utf8(batch.column(0)), utf8(batch.column(1)), strict=True):
        if text:
            out.setdefault(lang, []).append(text)
    return {lang: b"\n".join(texts) for lang, texts in out.items()}


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return small_batches(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")))


# -- the sieve --------------------------------------------------------------
class Marks:
    """Which hashes may be frequent: two bits each in a table of bounded size."""

    def __init__(self, bits: int, table: np.ndarray):
        self.mask, self.table = (1 << bits) - 1, table

    @classmethod
    def of(cls, frequent: DataFrame) -> Marks:
        """``frequent``: stored rows (h long)."""
        bits = min(MAX_BITS, max(16, (64 * frequent.count()).bit_length()))
        low, high = F.col("h"), F.shiftrightunsigned("h", 32)
        at = F.explode(F.array(*[x.bitwiseAND(F.lit((1 << bits) - 1)) for x in (low, high)])).alias("at")
        cells = frequent.select(at).groupBy(F.shiftright("at", 6).alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("word"))
        table = np.zeros(1 << (bits - 6), np.uint64)
        for r in cells.toLocalIterator():  # at most 2^(bits - 6) cells, whatever the corpus
            table[r["cell"]] = r["word"] & 0xFFFFFFFFFFFFFFFF
        return cls(bits, table)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in (h, h >> np.uint64(32)):
            at = at & np.uint64(self.mask)
            out &= (self.table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return out


class _Hashes:
    """Counts of hashes in one task, as arrays."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, h: np.ndarray):
        h, n = np.unique(h, return_counts=True)
        self.held.append((h, n))
        self.size += len(h)
        if self.size > HASHES:
            self.merge()
            if self.size > HASHES // 2:
                yield from self.hand_on()

    def merge(self) -> None:
        if not self.held:
            return
        h, n = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        self.held, self.size = [(h[first], np.add.reduceat(n, first))], len(first)

    def hand_on(self):
        self.merge()
        for h, n in self.held:
            for at in range(0, len(h), 1 << 18):
                part = h[at:at + (1 << 18)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.nulls(len(part), pa.binary()), pa.array(n[at:at + (1 << 18)])], schema=HASH_SCHEMA)
        self.held, self.size = [], 0


def sieve(docs: DataFrame, min_count: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(h, lang, n): hashes of the words and neighbouring pairs that occur at least ``min_count`` times, counted
    with whatever else has their hash; and, where ``lang`` is not null, all words of that language."""

    def run(batches):
        slicer, counts, total = Slicer(1), _Hashes(), {}

        def totals():
            langs, n = list(total), list(total.values())
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([0] * len(n), pa.int64()), pa.array(langs, pa.binary()), pa.array(n, pa.int64())], schema=HASH_SCHEMA)

        for b in batches:
            for lang, text in _by_lang(b).items():
                seed = _lang_hash(lang)
                for _, _, _, hashes, follows, carried in slicer.of(text):
                    total[lang] = total.get(lang, 0) + len(hashes) - carried
                    yield from counts.add(_word_keys(seed, hashes[carried:]))
                    yield from counts.add(_pair_keys(seed, hashes)[follows[1:]])
            if len(total) > 10_000:
                yield totals()
        yield totals()
        yield from counts.hand_on()

    hashed = _rows(docs, lang_col, text_col).mapInArrow(run, "h long, lang binary, n long")
    counted = hashed.repartition("h").groupBy("h", "lang").agg(F.sum("n").alias("n"))
    return counted.where(F.col("lang").isNotNull() | (F.col("n") >= min_count)).select("h", F.col("lang").cast("string").alias("lang"), "n")


def _may_be(marks: Marks, seed: np.uint64, hashes: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word: may it be frequent, and may it and the word before be a frequent pair."""
    keep, pair = marks.has(_word_keys(seed, hashes)), follows.copy()
    pair[1:] &= keep[:-1] & keep[1:]
    at = np.flatnonzero(pair)
    pair[at] = marks.has(_pair_keys(seed, hashes)[at - 1])
    return keep, pair


def sieve_triples(docs: DataFrame, min_count: int, marks: Marks, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(h): as ``sieve``, of the three neighbouring words both of whose pairs passed it."""

    def run(batches):
        slicer, counts = Slicer(2), _Hashes()
        for b in batches:
            for lang, text in _by_lang(b).items():
                seed = _lang_hash(lang)
                for _, _, _, hashes, follows, _ in slicer.of(text):
                    if len(hashes) > 2:  # the overlap is two words, so no triple comes twice
                        pair = _may_be(marks, seed, hashes, follows)[1]
                        yield from counts.add(_triple_keys(seed, hashes)[pair[1:-1] & pair[2:]])
        yield from counts.hand_on()

    hashed = _rows(docs, lang_col, text_col).mapInArrow(run, "h long, lang binary, n long")
    return hashed.select("h", "n").repartition("h").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("h")


# -- counting in a task -----------------------------------------------------
class Counter:
    """Counts the phrases of 1 to ``longest`` words that the sieve lets through, in the texts of one task."""

    def __init__(self, longest: int, marks: Marks, triples: Marks):
        self.longest, self.marks, self.triples, self.slicer = longest, marks, triples, Slicer(longest - 1)
        self._start()

    def _start(self) -> None:
        self.numbers, self.names, self.tries = {}, [], {}

    def add(self, lang: bytes, text: bytes) -> None:
        trie, seed = self.tries.setdefault(lang, HatTrie(1)), _lang_hash(lang)
        for part, starts, ends, hashes, follows, carried in self.slicer.of(text):
            keep, pair = _may_be(self.marks, seed, hashes, follows)
            triple = np.zeros(len(hashes), bool)                    # triple[i]: words i - 2 to i may be frequent
            if len(hashes) > 2:
                triple[2:] = pair[1:-1] & pair[2:]
                at = np.flatnonzero(triple)
                triple[at] = self.triples.has(_triple_keys(seed, hashes)[at - 2])
            at = np.flatnonzero(keep)
            if not len(at):
                continue
            _, first, rank = np.unique(hashes[at], return_index=True, return_inverse=True)
            ids = np.zeros(len(hashes), np.int64)                   # of the words kept
            ids[at] = np.array([self._number(part[s:e]) for s, e in zip(starts[at[first]].tolist(), ends[at[first]].tolist(), strict=True)], np.int64)[rank]
            for length in range(1, self.longest + 1):               # at: where phrases of this length begin
                if length > 1:                                      # extend by a word: rank of the shorter phrase, and the word
                    more = at + length - 1 < len(ids)
                    more[more] = (pair if length == 2 else triple)[at[more] + length - 1]
                    at, rank = at[more], rank[more]
                    if not len(at):
                        break
                    _, rank = np.unique((rank.astype(np.int64) << 32) | ids[at + length - 1], return_inverse=True)
                n = np.bincount(rank[at + length > carried], minlength=int(rank.max()) + 1)
                begins = np.zeros(len(n), np.int64)
                begins[rank] = at
                seen = np.flatnonzero(n)
                for key, c in zip(zip(*(ids[begins[seen] + j].tolist() for j in range(length)), strict=True), n[seen].tolist(), strict=True):
                    trie.add(key, c)

    def _number(self, word: bytes) -> int:
        n = self.numbers.get(word)
        if n is None:
            n = self.numbers[word] = len(self.names)
            self.names.append(word)
        return n

    # -- runs ---------------------------------------------------------------
    def spill(self, all_of_it: bool = False):
        """Sorted runs: everything at the end or with too many words, else the largest subtrees."""
        fresh = all_of_it or len(self.names) > WORDS
        if not fresh and sum(t.entries for t in self.tries.values()) <= ENTRIES:
            return
        for lang, trie in self.tries.items():
            for subtree in trie.spill(0 if fresh else trie.entries // 2):
                yield from self._run(lang, subtree)
        if fresh:
            self._start()

    def _run(self, lang: bytes, subtree: list):
        names = self.names
        rows = sorted((b" ".join([names[w] for w in key]), len(key), n, crc32(b" ".join([names[w] for w in key[:2]]))) for key, n in subtree)
        for at in range(0, len(rows), 65_536):
            phrase, k, n, part = zip(*rows[at:at + 65_536], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrase), pa.binary()), pa.array(part, pa.int64()), pa.array(k, pa.int32()),
                                              pa.array(phrase, pa.binary()), pa.array(n, pa.int64())], schema=RUN_SCHEMA)


def counted_runs(docs: DataFrame, max_words: int, marks: Marks, triples: Marks, words: int, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """(lang, part, k, phrase, n): counts of the phrases that the sieve lets through, one row per phrase and task
    or spill. So the scan of ``words`` words gets no more tasks than the cores or ``TASK_WORDS`` ask for: over many
    small files each common phrase would come once from every one of them."""

    def run(batches):
        counter = Counter(max_words, marks, triples)
        for b in batches:
            for lang, text in _by_lang(b).items():
                counter.add(lang, text)
                yield from counter.spill()
        yield from counter.spill(all_of_it=True)

    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-words // TASK_WORDS))
    return _rows(docs.coalesce(tasks), lang_col, text_col).mapInArrow(run, "lang binary, part long, k int, phrase binary, n long")


def frequent_phrases(docs: DataFrame, min_count: int, max_words: int, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f): all phrases of 1 to ``max_words`` words that occur at least ``min_count`` times;
    and (lang, n): all words of each language."""
    sieved = staged(sieve(docs, min_count, lang_col, text_col), "phrases-sieve")
    marks = Marks.of(sieved.where("lang is null"))
    triples = Marks.of(staged(sieve_triples(docs, min_count, marks, lang_col, text_col), "phrases-triples"))

    words = sieved.where("lang is not null").select("lang", "n")
    runs = counted_runs(docs, max_words, marks, triples, words.agg(F.sum("n")).first()[0] or 0, lang_col, text_col).repartition("part")
    merged = runs.groupBy("part", "lang", "k", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    found = merged.select(F.col("lang").cast("string").alias("lang"), "k", F.col("phrase").cast("string").alias("phrase"), "f")
    return staged(found, "phrases-all"), words


# -- collocations -----------------------------------------------------------
def _part(first, length):
    return F.array_join(F.slice("w", first, length), " ")


def collocations(docs: DataFrame, min_count: int = 100, max_words: int = 5, absorb_percent: int = 100, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of the phrases of 2 to ``max_words`` words with at least ``min_count`` occurrences.

    A cut gives the score ``floor(1000 a n / (l r))``; the cut of the lowest
    counts, ties to the earlier one. A phrase is dropped that lies inside a
    longer frequent phrase with ``absorb_percent`` of its occurrences.
    """
    found, words = frequent_phrases(docs, min_count, max_words, lang_col, text_col)
    parts = found.select("lang", "phrase", "f")
    longer = found.where("k > 2").select("lang", "f", "k", F.split("phrase", " ").alias("w"))
    # an extension by one word occurs at least as often as any longer one, so it decides
    inside = longer.select("lang", "f", F.explode(F.array(_part(F.lit(1), F.col("k") - 1), _part(F.lit(2), F.col("k") - 1))).alias("phrase"))
    inside = staged(inside.groupBy("lang", "phrase").agg(F.max("f").alias("held")), "phrases-inside")
    mine = found.where("k > 1").join(inside, ["lang", "phrase"], "left").where(
        F.col("held").isNull() | (F.col("held") * 100 < F.col("f") * absorb_percent)).select("lang", "phrase", "k", F.col("f").alias("a"))
    cuts = mine.withColumn("w", F.split("phrase", " ")).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "k", "a", "cut", _part(F.lit(1), F.col("cut")).alias("head"),
                       _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    side = lambda name, out: parts.select("lang", F.col("phrase").alias(name), F.col("f").alias(out))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"]).join(words, "lang")
    whole = {c: f"cast({c} as decimal(20,0))" for c in ("a", "n", "l", "r")}
    score = F.expr(f"(cast(1000 as decimal(4,0)) * {whole['a']} * {whole['n']}) div ({whole['l']} * {whole['r']})")
    best = cuts.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "k", "a", "b.l", "b.r", "n", "b.score")


def top(found: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of each language by score, count and phrase, with their ``rank``."""
    found = staged(found, "phrases-scored")
    salts = max(1, -(-found.count() // RANK_ROWS))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    near = Window.partitionBy("lang", "_salt").orderBy(*order)
    some = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= limit)
    return some.drop("_salt", "rank").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= limit)
