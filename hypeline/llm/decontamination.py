"""Benchmark decontamination by spaced-seed hashing.

A mask such as ``110101011`` selects some of the words in a window and ignores
the others, so a seed still matches when an ignored word was replaced.  Seeds
of all benchmark items are joined with the seeds of every document position;
around each hit the document and the item are aligned word by word (no
insertions or deletions) and the best-scoring stretch of the alignment decides.

The benchmark is cut into blocks of bounded size.  Each block's seed table is
broadcast and joined inside a scan of the documents, so documents are never
shuffled, and a larger benchmark costs more scans, not more memory.

Definitions: words are runs outside ``0x20 0x09-0x0D`` with A-Z lower-cased.
A stretch scores +1 per equal and -3 per different word (at least three
quarters are equal).  A document overlaps an item when the best stretch has
at least ``min(MIN_MATCHED, ceil(3/4 of the item's words))`` equal words.
Items shorter than the masks are looked up as whole word sequences.

Null and empty cases: a null or empty document or item has no words and
overlaps nothing; repeated documents or items each give their own rows; null
ids are carried as null; an empty benchmark leaves every document alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypeline.llm import tokens
from hypeline.llm.common import bounded_batches, field, map_rows

MASKS = ("111111", "110101011", "101100111", "111001101")   # fixed; six words looked at by each
MIN_MATCHED = 12
MISMATCH = 3
BLOCK_BYTES = 4 << 20        # benchmark text per broadcast block
FILTER_BITS = 22

_MULT = tokens.mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)

RESULT = ("doc_id long, item_id long, doc_start long, item_start long, "
          "n_aligned long, n_matched long, n_places long")


def _seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Seed of every window of ``words``; windows are ``len(mask)`` words long."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            total += words[k:k + n] * _MULT[k]
    return total


class Block:
    """Seeds and words of some benchmark items, for use inside tasks."""

    def __init__(self, ids: list, texts: pa.Array) -> None:
        self.ids = ids
        self.words = list(tokens.row_words(texts, lower=True))
        spans = [len(m) for m in MASKS]
        short = sorted({len(w) for w in self.words if 0 < len(w) < max(spans)})
        # A mask longer than an item yields nothing for it; its whole sequence does.
        self.masks = list(dict.fromkeys([*MASKS, *("1" * n for n in short)]))
        self.tables = []
        for mask in self.masks:
            seeds, items, places = [], [], []
            for i, w in enumerate(self.words):
                whole = len(w) < max(spans) and mask == "1" * len(w)
                if (mask in MASKS or whole) and len(w) >= len(mask):
                    s = _seeds(w, mask)
                    seeds.append(s)
                    items.append(np.full(len(s), i, np.int32))
                    places.append(np.arange(len(s), dtype=np.int32))
            if not seeds:
                self.tables.append(None)
                continue
            key = np.concatenate(seeds)
            order = np.argsort(key, kind="stable")
            key = key[order]
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[(key >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.tables.append((seen, key, np.concatenate(items)[order], np.concatenate(places)[order]))

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(position in words, item, position in item) of every equal seed."""
        for mask, tab in zip(self.masks, self.tables):
            if tab is None:
                continue
            seen, key, items, places = tab
            seeds = _seeds(words, mask)
            near = np.flatnonzero(seen[(seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            lo = np.searchsorted(key, seeds[near], side="left")
            hi = np.searchsorted(key, seeds[near], side="right")
            for p, a, b in zip(near[lo < hi], lo[lo < hi], hi[lo < hi]):
                for j in range(a, b):
                    yield int(p), int(items[j]), int(places[j])


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(start, end, equal words) of the stretch with the highest score; the
    earliest, then the shortest, of equals."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.flatnonzero(total[:end + 1] == low[end])[-1]) if end else 0
    return start, end, int(equal[start:end].sum())


def _needed(n: int) -> int:
    return min(MIN_MATCHED, -(-3 * n // 4))


def overlaps(words: np.ndarray, block: Block, found: list[tuple[int, int, int]]) -> dict[int, tuple]:
    """item -> (doc_start, item_start, aligned, matched, places) of verified hits in one document."""
    out: dict[int, tuple] = {}
    for item, diagonal in sorted({(i, p - q) for p, i, q in found}):
        own = block.words[item]
        lo, hi = max(0, -diagonal), min(len(own), len(words) - diagonal)
        start, end, matched = best_stretch(own[lo:hi] == words[lo + diagonal:hi + diagonal])
        if matched >= _needed(len(own)):
            old = out.get(item)
            new = (lo + start + diagonal, lo + start, end - start, matched)
            places = (old[4] if old else 0) + 1
            out[item] = (*(new if old is None or (matched, -new[0]) > (old[3], -old[0]) else old[:4]), places)
    return out


def _scan(batch_text: pa.Array, block: Block) -> Iterator[tuple[int, dict[int, tuple]]]:
    """(row, overlaps) for the rows of one batch that overlap any item."""
    raw, off = tokens.utf8(batch_text)
    raw = tokens.lower_ascii(raw)
    start, end, first = tokens.word_spans(raw, off)
    words = tokens.word_hashes(raw, start, end)
    by_row: dict[int, list] = {}
    for p, item, q in block.hits(words):
        row = int(np.searchsorted(first, p, side="right")) - 1
        by_row.setdefault(row, []).append((p - int(first[row]), item, q))
    for row, found in by_row.items():
        # A window that runs over the row's end fails the alignment.
        if seen := overlaps(words[first[row]:first[row + 1]], block, found):
            yield row, seen


def benchmark_blocks(benchmark: DataFrame, text: str = "text", key: str = "item_id",
                     block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes`` of text; one is on the driver at a time."""
    size = benchmark.agg(F.sum(F.octet_length(field(text)))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64(field(key), field(text)), F.lit(blocks))
    for b in range(blocks):
        rows = (benchmark.where(part == b).select(field(key).cast("long").alias("i"), field(text).alias("t"))
                .where(F.col("t").isNotNull()).orderBy("i", "t").toArrow())
        if rows.num_rows:
            yield Block(rows.column("i").to_pylist(), rows.column("t"))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per (document, item) that overlap: best place, aligned and equal
    words, number of diagonals that pass."""
    spark = docs.sparkSession
    bounded_batches(docs.sparkSession)
    narrow = docs.select(field(key).cast("long").alias("doc_id"), field(text).alias("t"))
    found = []
    for block in benchmark_blocks(benchmark, block_bytes=block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches, shared=shared):
            schema = pa.schema([(n.split()[0], pa.int64()) for n in RESULT.split(", ")])
            for batch in batches:
                ids = batch.column(0)
                rows = [(ids[row].as_py(), shared.value.ids[i], *o)
                        for row, seen in _scan(batch.column(1), shared.value) for i, o in seen.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.int64()) for c in zip(*rows)] if rows
                    else [pa.array([], pa.int64()) for _ in schema], schema=schema)

        found.append(narrow.mapInArrow(scan, RESULT))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], RESULT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that overlap no benchmark item, with all their columns."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text)
    for block in benchmark_blocks(benchmark, block_bytes=block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches, shared=shared):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, _ in _scan(batch.column(at), shared.value):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        docs = map_rows(docs, clean)
    return docs


__all__ = ["MASKS", "MIN_MATCHED", "Block", "best_stretch", "overlaps", "benchmark_blocks",
           "find_overlaps", "decontaminate"]
