"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers read a space and the text.  A byte offset where a token of A
and a token of B both end is a *cut*; cuts divide both sequences into groups,
and every A token of a group is linked with every B token of it.

**Lockstep merging.**  One state vector holds, for every document of a batch,
a pointer into its A tokens and one into its B tokens.  At each step the
pointer whose token ends first moves on, both if they end together; then the
step emits the cut and the links of the group it closes.  Finished documents
leave the vector.  A long document rides in several lanes, split at sampled A
ends that are B ends as well, so a batch takes a bounded number of steps
unless a document has no such place.  A group of many links is counted by its
different ids, not link by link.

**Tokens.**  A is a byte-level BPE (:mod:`hypeline.llm.byte_bpe`).  B is a
piece BPE that writes spaces as U+2581 and adds one in front.  If no piece of B
holds a U+2581 behind another character, no merge crosses from a word into the
spaces behind it, and B's tokens are cached per word; otherwise texts are
encoded whole.

**Counts.**  The number of documents that hold an id pair is counted in Spark.
The most frequent pairs, at most ``HOT_PAIRS``, are broadcast back to the
documents; what rarer pairs are left is joined by a shuffle.

Null and empty cases: a text that is null, empty, or whose joined A or B bytes
differ from the space and the text (such as one that holds U+2581) has no
tokens: zeros and an empty digest.  An empty table gives no rows.  Rows that
repeat a doc_id are documents of their own, in counts too.
"""

from __future__ import annotations

import itertools
import json
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypeline.llm.byte_bpe import Codec, SliceCache, Table, spread
from hypeline.llm.common import bounded_batches, field, materialise
from hypeline.llm.tokens import utf8

LANE = 128                   # A tokens after which a document may go on in another lane
PROBES = 16                  # A ends tried for such a split
LARGE = 4096                 # links from which a group is counted by its different ids
BATCH = 1 << 20              # bytes of text aligned at once: the state needs about 100 times as many
HOT_PAIRS = 1_000_000        # id pairs (16 bytes and a row each) that may be broadcast
SPACE_MARK = "▁"


def byte_level(path: str) -> Codec:
    """The byte-level BPE of a tokenizer file in JSON, merging by its list of pairs."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    # Byte-level files write each byte as a printable character (fixed rule): printable Latin-1 as it is,
    # the others from U+0100 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    byte.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    raw = lambda token: bytes(byte[c] for c in token)
    tokens = {raw(t): i for t, i in model["vocab"].items() if all(c in byte for c in t)}
    split = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    special = {raw(t) for t in model["vocab"] if t.startswith("<|") and t.endswith("|>")}
    pairs = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(split)}
    return Codec({t: i for t, i in tokens.items() if t not in special}, pairs)


class Pieces:
    """A piece BPE model, given by its serialised bytes; encodes a space and a text."""

    def __init__(self, model: bytes) -> None:
        self.model = model
        self._ready = False

    @classmethod
    def from_file(cls, path: str) -> Pieces:
        with open(path, "rb") as f:
            return cls(f.read())

    def __getstate__(self):
        return self.model

    def __setstate__(self, model) -> None:
        self.__init__(model)

    def _prepare(self) -> None:
        if self._ready:
            return
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.by_word = not any(SPACE_MARK in name.lstrip(SPACE_MARK) for name in names)
        self.space = self.library.piece_to_id(SPACE_MARK)
        as_byte = lambda i, name: bytes([int(name[3:5], 16)]) if self.library.is_byte(i) else None
        self.vocabulary = Table([as_byte(i, n) or n.replace(SPACE_MARK, " ").encode() for i, n in enumerate(names)])
        self.cache = SliceCache(self._words)
        self._ready = True

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words: each is one or more spaces and what follows up to the next space."""
        lists = self.library.encode([w[1:].decode() for w in words], num_threads=1)
        return _flat([[self.space] if w == b" " else ids for w, ids in zip(words, lists)])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first token of every text) of texts that start with a space, which the
        model is not given.  Texts must not be empty."""
        self._prepare()
        whole = raw.tobytes()
        if not self.by_word:
            texts = [whole[a + 1:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            return _flat([ids or [self.space] for ids in self.library.encode(texts, num_threads=1)])
        space = raw == 0x20
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[offsets[:-1]] = True
        at = np.flatnonzero(start)
        edges = np.append(at, len(raw)).tolist()
        ids, first = self.cache.expand([whole[a:b] for a, b in zip(edges, edges[1:])])
        return ids, first[np.searchsorted(at, offsets)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(first[-1])), first


def _lanes(ea: np.ndarray, fa: np.ndarray, eb: np.ndarray, fb: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first A, end A, first B, end B) of the lanes.  ``ea`` and ``eb`` rise over the batch."""
    inner = np.concatenate([np.arange(a + LANE, b - 1, LANE) for a, b in zip(fa[:-1], fa[1:])] + [np.zeros(0, np.int64)])
    limit = np.repeat(fa[1:], np.maximum(0, -(-(np.diff(fa) - 1 - LANE) // LANE)))
    found = np.full(len(inner), -1)
    for k in range(PROBES):
        at = inner + k
        open_ = (found < 0) & (at < limit - 1)
        if not open_.any():
            break
        place = np.minimum(np.searchsorted(eb, ea[at[open_]]), len(eb) - 1)
        hit = eb[place] == ea[at[open_]]
        found[np.flatnonzero(open_)[hit]] = at[open_][hit]
    last_a = found[found >= 0]                                       # the last A token of a lane that is split off
    last_b = np.searchsorted(eb, ea[last_a])
    a = np.unique(np.concatenate([fa, last_a + 1]))
    b = np.unique(np.concatenate([fb, last_b + 1]))
    return a[:-1], a[1:], b[:-1], b[1:]


def lockstep(ea: np.ndarray, fa: np.ndarray, eb: np.ndarray, fb: np.ndarray):
    """Merge the token ends of all documents of a batch.  ``ea``, ``eb``: byte ends,
    rising over the batch; ``fa``, ``fb``: first token of every document (each
    has at least one).  Returns (cuts, links): the groups as (first A, end A,
    first B, end B), and the links as (A token, B token) of the groups of at
    most ``LARGE`` links."""
    a, stop_a, b, stop_b = (x.copy() for x in _lanes(ea, fa, eb, fb))
    ga, gb = a.copy(), b.copy()
    cuts, links = [], []
    while len(a):
        end_a, end_b = ea[a], eb[b]
        a += end_a <= end_b
        b += end_b <= end_a
        met = np.flatnonzero(end_a == end_b)
        if len(met):
            group = ga[met], a[met], gb[met], b[met]
            cuts.append(np.stack(group))
            ga[met], gb[met] = group[1], group[3]
            links.append(_product(*group))
        alive = (a < stop_a) & (b < stop_b)
        if not alive.all():
            a, stop_a, b, stop_b, ga, gb = (x[alive] for x in (a, stop_a, b, stop_b, ga, gb))
    return (np.concatenate(cuts, axis=1) if cuts else np.zeros((4, 0), np.int64),
            np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64))


def _product(a0, a1, b0, b1) -> np.ndarray:
    wide = b1 - b0
    size = (a1 - a0) * wide
    if size.max() == 1:
        return np.stack([a0, b0])
    size = np.where(size <= LARGE, size, 0)
    own = np.repeat(np.arange(len(a0)), size)
    k = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    return np.stack([a0[own] + k // wide[own], b0[own] + k % wide[own]])


def _factored(ids_a: np.ndarray, ids_b: np.ndarray, cuts: np.ndarray):
    """(A token, A id, B id, links) of the groups with more than ``LARGE`` links, by different ids."""
    large = (cuts[1] - cuts[0]) * (cuts[3] - cuts[2]) > LARGE
    for a0, a1, b0, b1 in cuts[:, large].T.tolist():
        (ua, na), (ub, nb) = (np.unique(x, return_counts=True) for x in (ids_a[a0:a1], ids_b[b0:b1]))
        yield (np.full(len(ua) * len(ub), a0), np.repeat(ua, len(ub)), np.tile(ub, len(ua)),
               np.repeat(na, len(nb)) * np.tile(nb, len(na)))


class Aligner:
    """Both tokenizers and the alignment of a batch of texts."""

    def __init__(self, first: Codec, second: Pieces) -> None:
        self.first, self.second = first, second

    def align(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """Per text that has tokens: ``rows`` (its index), ids and first tokens of both
        sides, ``cuts``, and its different linked pairs with their numbers of links."""
        raw, off = utf8(texts)
        size = np.diff(off)
        rows = np.flatnonzero(size)
        joined, at = _with_space(raw, off, rows)
        ids_a, end_a, fa = self.first.encode(joined, at)
        ids_b, fb = self.second.encode(joined, at) if len(rows) else (np.zeros(0, np.int32), np.zeros(1, np.int64))
        # A's tokens are slices of the text by construction; B may write other bytes.
        size_b = self.second.vocabulary.sizes(ids_b) if len(rows) else np.zeros(0, np.int64)
        same = _same(self.second.vocabulary.join(ids_b) if len(rows) else joined, fb, size_b, joined, at)
        ids_a, size_a, fa = _keep(ids_a, np.diff(end_a, prepend=0), fa, same)
        ids_b, size_b, fb = _keep(ids_b, size_b, fb, same)
        rows = rows[same]
        cuts, links = lockstep(np.cumsum(size_a), fa, np.cumsum(size_b), fb)
        cuts = cuts[:, np.argsort(cuts[0], kind="stable")]
        a, b, m = [ids_a[links[0]]], [ids_b[links[1]]], [np.ones(len(links[0]), np.int64)]
        owner = [np.searchsorted(fa, links[0], side="right") - 1]
        for token, x, y, n in _factored(ids_a, ids_b, cuts):
            a.append(x), b.append(y), m.append(n), owner.append(np.searchsorted(fa, token, side="right") - 1)
        owner, a, b, m = map(np.concatenate, (owner, a, b, m))
        return {"rows": rows, "ids_a": ids_a, "fa": fa, "ids_b": ids_b, "fb": fb, "cuts": cuts,
                **_pairs(owner, a.astype(np.int64), b.astype(np.int64), m, len(rows))}


def _with_space(raw: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of ``rows`` with a space in front of each, and their offsets."""
    at = np.concatenate([[0], np.cumsum(off[rows + 1] - off[rows] + 1)]).astype(np.int64)
    joined = np.full(at[-1], 0x20, np.uint8)
    text = np.ones(at[-1], bool)
    text[at[:-1]] = False
    joined[text] = raw
    return joined, at


def _same(back: np.ndarray, first: np.ndarray, size: np.ndarray, joined: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the joined bytes of each text's tokens are the text."""
    if len(at) == 1:
        return np.zeros(0, bool)
    got = np.concatenate([[0], np.cumsum(size)])[first]
    same = np.diff(got) == np.diff(at)
    if same.all():
        differs = np.flatnonzero(back != joined)
        same[np.searchsorted(at, differs, side="right") - 1] = False
        return same
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(back[got[i]:got[i + 1]], joined[at[i]:at[i + 1]])
    return same


def _keep(ids: np.ndarray, size: np.ndarray, first: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, ...]:
    if same.all():
        return ids, size, first
    kept = np.repeat(same, np.diff(first))
    return ids[kept], size[kept], np.concatenate([[0], np.cumsum(np.diff(first)[same])]).astype(np.int64)


def _pairs(owner: np.ndarray, a: np.ndarray, b: np.ndarray, m: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Different (document, A id, B id) and their numbers of links."""
    wide_a, wide_b = int(a.max(initial=0)) + 1, int(b.max(initial=0)) + 1
    if n * wide_a * wide_b >= 1 << 63:
        raise OverflowError("too many documents in a batch")
    code = (owner * wide_a + a) * wide_b + b
    order = np.argsort(code, kind="stable") if len(code) else np.zeros(0, np.int64)
    code, m = code[order], m[order]
    new = np.flatnonzero(np.diff(code, prepend=-1))
    code, links = code[new], np.add.reduceat(m, new) if len(new) else m
    return {"pair_a": (code // wide_b % wide_a).astype(np.int32), "pair_b": (code % wide_b).astype(np.int32),
            "links": links, "pairs_from": np.searchsorted(code, np.arange(n + 1) * (wide_a * wide_b))}


def _digests(got: dict[str, np.ndarray], first: Codec, decimals: Table) -> list[str]:
    """SHA-256 of every document's groups, ids in decimal."""
    cuts = got["cuts"]
    # Written as one byte table look-up: each token's decimal and comma; the last comma of a side becomes its mark.
    text_a, size_a = first.decimal(got["ids_a"]).copy(), first.decimals.sizes(got["ids_a"])
    text_b, size_b = decimals.join(got["ids_b"]).copy(), decimals.sizes(got["ids_b"])
    at_a, at_b = (np.concatenate([[0], np.cumsum(s)]) for s in (size_a, size_b))
    text_a[at_a[cuts[1]] - 1] = ord("|")
    text_b[at_b[cuts[3]] - 1] = ord(";")
    n_a, n_b = at_a[cuts[1]] - at_a[cuts[0]], at_b[cuts[3]] - at_b[cuts[2]]
    total = np.concatenate([[0], np.cumsum(n_a + n_b)])
    out = np.empty(total[-1], np.uint8)
    is_a = np.zeros(total[-1] + 1, np.int8)
    is_a[total[:-1]], is_a[total[:-1] + n_a] = 1, -1            # no side of a group is empty
    mask = np.cumsum(is_a[:-1]).astype(bool)
    out[mask], out[~mask] = text_a, text_b
    ends = total[np.searchsorted(cuts[0], got["fa"])]
    view = memoryview(out.tobytes())
    return [sha256(view[x:y - 1]).hexdigest() for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


COLUMNS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pair_a array<int>, pair_b array<int>, links array<long>")


def aligned(docs: DataFrame, aligner: Aligner, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row its numbers of tokens, groups and links, the digest of its groups, and
    its different linked id pairs with their numbers of links."""
    bounded_batches(docs.sparkSession, BATCH)
    shared = docs.sparkSession.sparkContext.broadcast(aligner)

    def run(batches):
        decimals = None
        for batch in batches:
            got = shared.value.align(batch.column(1))
            if decimals is None and len(got["rows"]):
                decimals = Table([b"%d," % i for i in range(len(shared.value.second.vocabulary.first) - 1)])
            n, rows = batch.num_rows, got["rows"]

            def per_row(values):
                out = np.zeros(n, np.int64)
                out[rows] = values
                return out

            digest = np.full(n, "", object)
            if len(rows):
                digest[rows] = _digests(got, shared.value.first, decimals)
            groups = np.diff(np.searchsorted(got["cuts"][0], got["fa"]))
            total = np.concatenate([[0], np.cumsum(got["links"])])[got["pairs_from"]]
            count = per_row(np.diff(got["pairs_from"]))
            first = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(first, pa.array(got[c])) for c in ("pair_a", "pair_b", "links")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(per_row(np.diff(got["fa"]))), pa.array(per_row(np.diff(got["fb"]))),
                 pa.array(per_row(groups)), pa.array(per_row(np.diff(total))), pa.array(digest, pa.string()), *lists],
                names=[c.split(" ")[0] for c in COLUMNS.split(", ")])

    return (docs.select(field(key).cast("long").alias("doc_id"), field(text).cast("string").alias("t"))
            .mapInArrow(run, COLUMNS))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n, best): in how many documents an id pair is linked, and whether no pair
    of its A id is in more."""
    counts = materialise(rows.select(F.explode(F.arrays_zip("pair_a", "pair_b")).alias("p"))
                         .groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
                         .agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return materialise(counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _frequent(counts: DataFrame, limit: int) -> int:
    """The smallest power of two such that at most ``limit`` pairs are in as many
    documents; from a histogram of one row per power of two."""
    sizes = {r["k"]: r["c"] for r in counts.groupBy(F.length(F.bin("n")).alias("k")).agg(F.count(F.lit(1)).alias("c")).collect()}
    k, total = max(sizes, default=0) + 1, 0
    while k > 1 and total + sizes.get(k - 1, 0) <= limit:
        k -= 1
        total += sizes.get(k, 0)
    return 1 << (k - 1)


def alignment_report(docs: DataFrame, aligner: Aligner, text: str = "text", key: str = "doc_id",
                     hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is in most
    documents of all pairs of its A id), count_sum (documents of the pair, summed
    over links) and groups_sha256."""
    rows = materialise(aligned(docs, aligner, text, key).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(rows)
    least = _frequent(counts, hot_pairs)
    linked = rows.select("row", F.explode(F.arrays_zip("pair_a", "pair_b", "links")).alias("p")).select(
        "row", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"), F.col("p.links").alias("m"))
    sums = [F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("n")).alias("count_sum")]
    hot = F.broadcast(counts.where(F.col("n") >= least))
    parts = linked.join(hot, ["a", "b"]).groupBy("row").agg(*sums)
    if least > 1:
        rare = counts.where(F.col("n") < least)
        left = linked.join(F.broadcast(counts.where(F.col("n") >= least).select("a", "b")), ["a", "b"], "left_anti")
        parts = parts.unionByName(left.join(rare.hint("merge"), ["a", "b"]).groupBy("row").agg(*sums))
        parts = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (rows.drop("pair_a", "pair_b", "links").join(parts, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"))


__all__ = ["byte_level", "Pieces", "Aligner", "lockstep", "aligned", "pair_counts", "alignment_report"]
