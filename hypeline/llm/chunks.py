"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of every text; positions where its top bits
are zero are candidate cuts.  From one cut, the next is the first candidate at
least ``MIN_CHUNK`` and at most ``MAX_CHUNK`` bytes on.  Candidates depend on
nearby bytes only, so after an insertion, or from the start of a copied
passage, cuts meet again at a candidate that both texts reach, usually within
a chunk or two; the rest of the passage is cut alike everywhere.

Chunks are deduplicated by a 128-bit digest.  The first occurrence, by doc_id
(null last), row fingerprint and position, stays; later ones are repeats.  Neighbouring repeats
of a document are merged, and merged spans of at least ``MIN_SPAN`` bytes are
reported (a shorter repeat is a common phrase rather than a passage).

Digests are counted first (pre-aggregated, so a chunk held by a third of all
documents is one row per task), and only those found twice are joined back;
the joins' hot digests are split by adaptive skew handling.

A document is a row: rows are told apart by the fingerprint over all their
columns, so null and repeated doc_ids neither mix texts nor meet in one task.

Null and empty cases: a null or empty text has no chunks; a row repeated in
every column is the same document and no repeat of itself; rows that share a
doc_id (or have none) but differ in any column are documents of their own; an
empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hypeline.llm import tokens
from hypeline.llm.common import ROW_ID, bounded_batches, field, map_rows, materialise, row_fingerprint, with_row_id

CUT_BITS = 4                 # a candidate every 16 bytes on average
MIN_CHUNK = 24
MAX_CHUNK = 160
MIN_SPAN = 120               # about twenty words: longer than common phrases, and found in 0.97 of passages of 51 words
_ROLL = 32                   # bytes the rolling hash sees

_GEAR = (tokens.mix64(np.arange(1, 257, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """Gear hash ``h = 2h + G[byte]`` (32 bits) at every byte, by doubling the window."""
    h = _GEAR[raw]
    width = 1
    while width < _ROLL:
        older = np.zeros_like(h)
        older[width:] = h[:-width] if len(h) > width else older[width:]
        h = h + (older << np.uint32(width))
        width *= 2
    return h


def cuts(raw: np.ndarray) -> np.ndarray:
    """Chunk borders of one text, 0 and its length included."""
    n = len(raw)
    if n == 0:
        return np.zeros(1, np.int64)
    # The top bits depend on the whole rolling window, the low ones on a few bytes only.
    at = (np.flatnonzero(gear_hashes(raw) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    borders, here, i = [0], 0, 0
    while here < n:
        i = bisect_left(at, here + MIN_CHUNK, i)
        here = min(at[i] if i < len(at) else n, here + MAX_CHUNK, n)
        borders.append(here)
    return np.array(borders, np.int64)


def chunk_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per chunk: digest (two longs), doc_id, row fingerprint (two longs),
    start and length in bytes."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            raw, off = tokens.utf8(batch.column(3))
            digests, starts, sizes, rows = [], [], [], []
            for i in range(batch.num_rows):
                own = raw[off[i]:off[i + 1]]
                b = cuts(own)
                view = memoryview(np.ascontiguousarray(own))
                digests += [xxhash.xxh3_128_digest(view[x:y]) for x, y in zip(b[:-1].tolist(), b[1:].tolist())]
                starts.append(b[:-1])
                sizes.append(np.diff(b))
                rows.append(np.full(len(b) - 1, i))
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            join = lambda xs, kind: np.concatenate(xs).astype(kind) if xs else np.zeros(0, kind)
            at = pa.array(join(rows, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), *[batch.column(i).take(at) for i in range(3)],
                 pa.array(join(starts, np.int32)), pa.array(join(sizes, np.int32))],
                names=["a", "b", "doc_id", *ROW_ID, "start", "size"])

    return (docs.select(field(key).cast("long").alias("doc_id"), *row_fingerprint(docs), field(text).alias("t"))
            .where(F.length("t") > 0)
            .mapInArrow(run, "a long, b long, doc_id long, __row_a long, __row_b long, start int, size int"))


def repeated_chunks(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every chunk that is not the first occurrence of its digest, with that
    first occurrence's doc_id and start."""
    chunks = chunk_rows(docs, text, key)       # cut twice: cheaper than a table of all chunks on disk
    often = chunks.groupBy("a", "b").count().where("count > 1").select("a", "b")
    shared = materialise(chunks.join(often, ["a", "b"]), "shared-chunks")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *ROW_ID, "start")
    firsts = shared.groupBy("a", "b").agg(F.min(place).alias("first"))
    return (shared.join(firsts, ["a", "b"]).where(place != F.col("first"))
            .select("doc_id", *ROW_ID, "start", "size", F.col("first.doc_id").alias("first_doc_id"),
                    F.col("first.start").alias("first_start")).distinct())


def row_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", min_span: int = MIN_SPAN) -> DataFrame:
    """``repeated_spans`` with the fingerprint of the row that each span is in."""
    rows = repeated_chunks(docs, text, key)
    order = Window.partitionBy(*ROW_ID).orderBy("start", "size")
    end = F.max(F.col("start") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") <= F.col("__end"), 0).otherwise(1)).over(order)
    return (rows.withColumn("__end", end).withColumn("__island", island)
            .groupBy("doc_id", *ROW_ID, "__island")
            .agg(F.min("start").cast("long").alias("start_byte"),
                 F.max(F.col("start") + F.col("size")).cast("long").alias("__stop"),
                 F.count(F.lit(1)).alias("n_chunks"), F.min("first_doc_id").alias("first_doc_id"),
                 F.sort_array(F.collect_set("first_doc_id")).alias("first_doc_ids"))
            .select("doc_id", *ROW_ID, "start_byte", (F.col("__stop") - F.col("start_byte")).alias("n_bytes"),
                    "n_chunks", "first_doc_id", "first_doc_ids")
            .where(F.col("n_bytes") >= min_span))


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", min_span: int = MIN_SPAN) -> DataFrame:
    """One row per repeated span: doc_id, start_byte, n_bytes, n_chunks, and the
    smallest and all doc_ids that hold the first occurrences."""
    return row_spans(docs, text, key, min_span).drop(*ROW_ID)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", min_span: int = MIN_SPAN) -> DataFrame:
    """``docs`` with the repeated spans cut out of the text.  Borders that fall
    inside a multi-byte character keep that character."""
    spans = (row_spans(docs, text, key, min_span).groupBy(*ROW_ID)
             .agg(F.sort_array(F.collect_list(F.struct("start_byte", "n_bytes"))).alias("__spans")))
    met = with_row_id(docs).join(spans, list(ROW_ID), "left").select(*[field(c) for c in docs.columns], "__spans")
    at, names = docs.columns.index(text), docs.columns

    def run(batches):
        for batch in batches:
            out = []
            for t, s in zip(batch.column(at), batch.column(len(names))):
                t, s = t.as_py(), s.as_py()
                out.append(t if t is None or not s else cut_out(t, [(x["start_byte"], x["n_bytes"]) for x in s]))
            cols = [batch.column(i) if i != at else pa.array(out, pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(names))])

    return map_rows(met, run, names)


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the byte spans, each narrowed to whole characters."""
    raw, out, at = text.encode(), [], 0
    inside = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
    for start, size in spans:
        stop = start + size
        while inside(start):
            start += 1
        while stop > start and inside(stop):
            stop -= 1
        if start < stop <= len(raw) and start >= at:
            out.append(raw[at:start])
            at = stop
    return b"".join([*out, raw[at:]]).decode()


__all__ = ["gear_hashes", "cuts", "chunk_rows", "repeated_chunks", "row_spans", "repeated_spans", "remove_repeats", "cut_out"]
