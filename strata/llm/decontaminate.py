"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items. For each pattern length a
table of two-word blocks says how far the search may jump: a block that ends
no pattern moves the window on by its distance to the nearest pattern
position, an unknown block by the whole length less one. A block with shift
zero names a bucket of patterns with that suffix, narrowed by their first
block, and a direct comparison of all words confirms the occurrence.

The documents are read once per block of patterns, with no shuffle. Patterns
are dealt into blocks of bounded size by hash, so what a task holds does not
grow with the benchmark; nearly always there is one block.

Edge cases: null and wordless texts have no words and no hits; items without
words or without an id take no part; rows that repeat an item id add their
windows to it; an item shorter than a window is one pattern by itself; an
empty benchmark leaves every document clean; the documents keep all their
columns, and clashing names belong to the result.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import plain, small_batches, staged, utf8

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # UTF-8 bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]
BLOCK_BYTES = 32 << 20                     # pattern text held by a task at a time

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hits", T.BinaryType()),
    T.StructField("item_ids", T.ArrayType(T.LongType())),
])


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


def windows(words: list[bytes], size: int) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


class Tables:
    """Shift and bucket tables, one set per pattern length, in sorted arrays.

    Words are numbered, so a pattern takes four bytes a word. A block of two
    words is one number; ``blocks`` holds those of the patterns in order,
    ``shift`` how far each lets the search jump, and ``first`` where the
    bucket of patterns that end with it begins. A bucket is in the order of
    the patterns' first blocks, their prefixes.
    """

    def __init__(self, patterns: list[tuple[bytes, int]]):
        self.number: dict[bytes, int] = {}
        rows = defaultdict(lambda: (array("i"), array("q")))
        for text, item in patterns:
            words = text.split(b" ")
            flat, items = rows[len(words)]
            flat.extend(self.number.setdefault(w, len(self.number)) for w in words)
            items.append(item)
        self.searches = [self._tables(length, np.frombuffer(flat, np.int32).reshape(-1, length), np.frombuffer(items, np.int64))
                         for length, (flat, items) in sorted(rows.items())]

    @staticmethod
    def _tables(length: int, words: np.ndarray, items: np.ndarray):
        block = min(2, length)
        furthest = length - block + 1
        prefix, suffix = _blocks(words, block)[:, 0], _blocks(words, block)[:, -1]
        order = np.lexsort((items, *words.T[::-1], prefix, suffix))
        words, items, prefix, suffix = words[order], items[order], prefix[order], suffix[order]
        new = np.flatnonzero(np.append(True, (words[1:] != words[:-1]).any(axis=1)))  # a pattern of several items
        item_at = np.append(new, len(items))
        words, prefix, suffix = words[new], prefix[new], suffix[new]
        every = _blocks(words, block)
        known = np.unique(every)
        shift = np.full(len(known), furthest, np.int32)
        for at in range(furthest):
            np.minimum.at(shift, np.searchsorted(known, every[:, at]), furthest - 1 - at)
        first = np.append(np.searchsorted(suffix, known), len(suffix))
        return length, block, furthest, known, shift, first, words, prefix, items, item_at

    def jump(self, length: int, *words: bytes) -> int:
        """How far the search for patterns of ``length`` words moves on from a block."""
        _, block, furthest, known, shift, *_ = next(s for s in self.searches if s[0] == length)
        at = np.flatnonzero(known == _blocks(np.array([[self.number.get(w, -1) for w in words]]), block)[0, 0])
        return int(shift[at[0]]) if len(at) else furthest

    def search(self, words: list[bytes]):
        """Yields (start, end, item ids) of every occurrence."""
        n = len(words)
        numbers = np.array([self.number.get(w, -1) for w in words], np.int32)
        for length, block, furthest, known, shift, first, pattern, prefix, items, item_at in self.searches:
            if n < length:
                continue
            blocks = _blocks(numbers[None, :], block)[0]
            place = np.minimum(np.searchsorted(known, blocks), len(known) - 1)
            jumps = np.where(known[place] == blocks, shift[place], furthest).tolist()  # of the block that begins at each word
            i, last = length - block, n - block
            while i <= last:
                jump = jumps[i]
                if jump:
                    i += jump
                    continue
                start = i + block - length
                lo, hi = first[place[i]], first[place[i] + 1]
                lo, hi = lo + np.searchsorted(prefix[lo:hi], blocks[start]), lo + np.searchsorted(prefix[lo:hi], blocks[start], side="right")
                if lo < hi:
                    for k in lo + np.flatnonzero((pattern[lo:hi] == numbers[start:start + length]).all(axis=1)):
                        yield start, start + length, tuple(items[item_at[k]:item_at[k + 1]].tolist())
                i += 1


def _blocks(words: np.ndarray, block: int) -> np.ndarray:
    """Rows of word numbers -> their blocks of ``block`` (1 or 2) words as numbers; negative where a word is unknown."""
    w = words.astype(np.int64)
    if block == 1:
        return w
    return np.where((w[:, :-1] < 0) | (w[:, 1:] < 0), -1, w[:, :-1] << 32 | w[:, 1:])


_READY: dict = {}  # the tables that this Python worker built last, so that its next task need not


def _tables(token: str, patterns) -> Tables:
    if token not in _READY:
        _READY.clear()
        _READY[token] = Tables(patterns.value)
    return _READY[token]


def benchmark_patterns(benchmark: DataFrame, window: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (pattern, item) rows of a benchmark."""

    def run(batches):
        for b in batches:
            rows = [(p, i) for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True) for p in windows(words_of(t), window)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.binary()), pa.array([i for _, i in rows], pa.int64())],
                                             names=["pattern", "item"])

    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return items.mapInArrow(run, "pattern binary, item long").distinct()


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus n_words, n_hit, hits (one byte a word: 1 if inside an occurrence) and item_ids (ascending)."""
    patterns = staged(benchmark_patterns(benchmark, window, item_col, item_text_col), "bench-patterns")
    total = patterns.agg(F.sum(F.length("pattern") + 64)).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    own = [c for c in docs.columns if c.lower() not in RESULT.fieldNames()]
    out = docs.select(*["`" + c.replace("`", "``") + "`" for c in own], F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("long").alias("n_hit"),
                      F.lit(None).cast("binary").alias("hits"), F.lit(None).cast("array<bigint>").alias("item_ids"))
    at = own.index(text_col)
    for k in range(blocks):
        if k:
            out = staged(out, "bench-pass")
        part = patterns.where(F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks)) == k)
        found = [(bytes(r["pattern"]), r["item"]) for r in part.collect()]  # about block_bytes at most
        out = small_batches(out).mapInArrow(_scanner(docs.sparkSession.sparkContext.broadcast(found), at, len(own)), out.schema)
    return out


def _scanner(patterns, text_at: int, n_own: int):
    token = uuid.uuid4().hex

    def run(batches):
        tables = _tables(token, patterns)
        for b in batches:
            counts, hit, marks, found = [], [], [], []
            for text, hits, items in zip(utf8(b.column(text_at)), b.column(n_own + 2).to_pylist(), b.column(n_own + 3).to_pylist(), strict=True):
                words = words_of(text)
                mask = np.frombuffer(hits, np.uint8).copy() if hits else np.zeros(len(words), np.uint8)
                seen = set(items or ())
                for start, end, ids in tables.search(words):
                    mask[start:end] = 1
                    seen.update(ids)
                counts.append(len(words)), hit.append(int(mask.sum())), marks.append(mask.tobytes()), found.append(sorted(seen))
            yield pa.RecordBatch.from_arrays([*b.columns[:n_own], pa.array(counts, pa.int64()), pa.array(hit, pa.int64()), pa.array(marks, pa.binary()),
                                              pa.array(found, pa.list_(pa.int64()))], names=b.schema.names)

    return run


def is_contaminated(items: str = "item_ids"):
    return F.size(items) > 0


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without those in which a benchmark window occurs; the columns stay as they are."""
    rows = plain(docs, "text")
    return scan(rows, benchmark, window).where(~is_contaminated()).select(*rows.columns).toDF(*docs.columns)
