"""Byte-level BPE encoding and decoding of whole texts.

**Pre-tokenisation without regex.**  The pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
is a finite automaton over *symbols*: the class of a code point (letter,
number, white space, other), sharpened by a look at the next two code points
(a white space before a word, an apostrophe before ``s``, ``re``, ...) and by
whether it opens a text.  A symbol is a function from states to states.
These functions compose associatively and generate a small monoid, so the
state in front of every code point of a batch comes from a blocked prefix
scan over numbers of functions: table look-ups on NumPy arrays, all blocks at
once, all texts of a batch in one array.

**Merging.**  The slices between boundaries go to pair merging (lowest rank
first, then leftmost), cached per slice.  The slices of a batch that the cache
lacks are merged in step, one pair of each at a time; a slice of many bytes is
merged with a heap, in n log n.  The cache is bounded and only saves time.

**Decoding.**  Ids are turned back into bytes by their token's bytes; the
token offsets of every text are kept, so texts of a batch decode at once.

Null and empty cases: a null or empty text has no tokens and decodes to no
bytes; an empty table gives no rows; rows repeat as they are; ties between
merges of equal rank go to the left.  Ids outside the vocabulary raise
``IndexError`` on decoding.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import unicodedata
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hypeline.llm.common import bounded_batches, field
from hypeline.llm.tokens import utf8

CACHE = 200_000              # slices a worker keeps between batches, in each of two generations
LONG = 256                   # bytes from which a slice is merged with a heap

# Classes of code points.
LETTER, NUMBER, OTHER, APOSTROPHE, SPACE, WHITE = range(6)
#: Code points with the property White_Space (fixed values).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000]

# Symbols: letter, number, other (and an apostrophe that is no contraction), apostrophe of a contraction with one or
# two letters, space before a word, other white space before a word, white space inside or at the end of a run.
S_LETTER, S_NUMBER, S_OTHER, S_ONE, S_TWO, S_PREFIX, S_SINGLE, S_RUN = range(8)
FIRST = 8                    # added to the symbol of a text's first code point
NONE = 16                    # padding: changes nothing
# States: a new token must start; inside letters, numbers, others; after a prefix space; inside white space; one or two
# letters of a contraction to come.
NEW, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, ONE_LEFT, TWO_LEFT = range(8)


def _transition(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a token starts at this code point)."""
    if symbol == NONE:
        return state, False
    if symbol >= FIRST:
        return _transition(NEW, symbol - FIRST)[0], True
    if state in (ONE_LEFT, TWO_LEFT) and symbol == S_LETTER:      # nothing else can follow there
        return (NEW if state == ONE_LEFT else ONE_LEFT), False
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS}
    if symbol in (S_ONE, S_TWO):
        if state in (IN_OTHERS, AFTER_SPACE):          # the apostrophe belongs to a run of others
            return IN_OTHERS, False
        return (ONE_LEFT if symbol == S_ONE else TWO_LEFT), True
    if symbol in run:
        return run[symbol], state not in (run[symbol], AFTER_SPACE)
    if symbol == S_RUN:
        return IN_WHITE, state != IN_WHITE
    return (AFTER_SPACE if symbol == S_PREFIX else NEW), True


class Scanner:
    """Token boundaries of code point arrays by prefix scans over the monoid of
    the automaton's transition functions."""

    def __init__(self) -> None:
        states, symbols = range(8), range(NONE + 1)
        #: Whether a token starts, by state and symbol.
        self.starts = np.array([[_transition(s, x)[1] for x in symbols] for s in states])
        functions = [tuple(states)]                     # number 0: the identity
        number = {functions[0]: 0}
        single = [tuple(_transition(s, x)[0] for s in states) for x in symbols]
        step = []
        for f in functions:                             # grows while new functions are found
            row = []
            for g in single:
                h = tuple(g[s] for s in f)
                if h not in number:
                    number[h] = len(functions)
                    functions.append(h)
                row.append(number[h])
            step.append(row)
        self.step = np.array(step, np.uint16)
        self.apply = np.array(functions, np.uint8)
        self.compose = np.array([[number[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
        self.classes = np.full(0x110000, OTHER, np.uint8)
        kinds = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
        self.classes[kinds == "L"], self.classes[kinds == "N"] = LETTER, NUMBER
        self.classes[WHITE_SPACE] = WHITE
        self.classes[0x20], self.classes[0x27] = SPACE, APOSTROPHE

    def symbols(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Symbols of the code points of texts that start at the indexes ``first``."""
        n = len(points)
        kind = self.classes[points]
        opens = np.zeros(n + 2, bool)
        opens[first] = True
        opens[n:] = True
        white = kind >= SPACE
        word_next = np.zeros(n, bool)
        word_next[:-1] = ~white[1:] & ~opens[1:n]
        out = np.array([S_LETTER, S_NUMBER, S_OTHER, S_OTHER, S_RUN, S_RUN], np.uint8)[kind]
        out[(kind == SPACE) & word_next] = S_PREFIX
        out[(kind == WHITE) & word_next] = S_SINGLE
        quote = np.flatnonzero(kind == APOSTROPHE)
        quote = quote[~opens[quote + 1]]
        one = points[quote + 1]
        out[quote[np.isin(one, [ord(c) for c in "stmd"])]] = S_ONE
        inside = ~opens[quote + 2]
        quote, one = quote[inside], one[inside]
        two = points[quote + 2]
        pair = ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e"))
                | (one == ord("l")) & (two == ord("l")))
        out[quote[pair]] = S_TWO
        out[first] += FIRST
        return out

    def boundaries(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Indexes of the code points at which tokens start."""
        n = len(points)
        if n == 0:
            return np.zeros(0, np.int64)
        width = 1 << max(4, int(np.sqrt(n)).bit_length() - 1)
        blocks = -(-n // width)
        symbols = np.full(blocks * width, NONE, np.uint8)
        symbols[:n] = self.symbols(points, first)
        columns = np.ascontiguousarray(symbols.reshape(blocks, width).T)
        # Functions of each block's prefixes, every block one step further at a time.
        before = np.empty((width, blocks), np.uint16)
        f = np.zeros(blocks, np.uint16)
        for j in range(width):
            before[j] = f
            f = self.step[f, columns[j]]
        # Prefixes of whole blocks by doubling.
        shift = 1
        while shift < blocks:
            f = np.concatenate([f[:shift], self.compose[f[:-shift], f[shift:]]])
            shift *= 2
        state = np.concatenate([[NEW], self.apply[f[:-1], NEW]]).astype(np.uint8)
        states = self.apply[before, state[None, :]]
        return np.flatnonzero(self.starts[states, columns].T.ravel()[:n])


def _merge_heap(parts: list[bytes], rank) -> list[bytes]:
    """Merge one slice with a heap of (rank, place) and a linked list."""
    n = len(parts)
    after, prior, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i], parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j], after[i] = a + b, False, after[j]
        if after[i] < n:
            prior[after[i]] = i
            if (r := rank(parts[i], parts[after[i]])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))
        if (p := prior[i]) >= 0 and (r := rank(parts[p], parts[i])) is not None:
            heapq.heappush(heap, (r, p, parts[p], parts[i]))
    return [p for p, live in zip(parts, alive) if live]


class PairTable:
    """Rank and merged token of every pair of tokens that merges, for many slices at once."""

    NEVER = 1 << 40

    def __init__(self, pairs: list[tuple[int, int, int, int]], size: int) -> None:
        """``pairs``: (left id, right id, rank, merged id); ids are below ``size``."""
        left, right, rank, merged = np.array(pairs, np.int64).reshape(-1, 4).T
        key = left * size + right
        order = np.argsort(key)
        self.size, self.key, self.rank, self.merged = size, key[order], rank[order], merged[order]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged token) of pairs; rank ``NEVER`` where they do not merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        known = self.key[at] == key if len(self.key) else np.zeros(len(key), bool)
        return np.where(known, self.rank[at] if len(self.key) else 0, self.NEVER), self.merged[at] if len(self.key) else key

    def merge(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all slices in step, one pair of each at a time; slice i is
        tokens[first[i]:first[i + 1]] and not empty.  Returns the same for the
        merged slices."""
        n = len(first) - 1
        owner = np.repeat(np.arange(n), np.diff(first))
        tokens = tokens.astype(np.int64)
        rank, into = np.full(len(tokens), self.NEVER), np.zeros(len(tokens), np.int64)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner], into[inner] = self.find(tokens[inner], tokens[inner + 1])
        done_owner, done_tokens = [], []
        while len(tokens):
            start = np.flatnonzero(np.diff(owner, prepend=-1))
            size = np.diff(start, append=len(owner))
            best = np.repeat(np.minimum.reduceat(rank, start), size)
            live = best < self.NEVER
            if not live.all():                      # finished slices leave
                done_owner.append(owner[~live])
                done_tokens.append(tokens[~live])
                tokens, owner, rank, into, best = (x[live] for x in (tokens, owner, rank, into, best))
                continue
            at = np.flatnonzero(rank == best)
            at = at[np.diff(owner[at], prepend=-1) != 0]            # the leftmost of each slice
            tokens[at] = into[at]
            kept = np.ones(len(tokens), bool)
            kept[at + 1] = False
            tokens, owner = tokens[kept], owner[kept]
            rank[at], rank[at + 1] = self.NEVER, self.NEVER
            rank, into = rank[kept], into[kept]
            at = at - np.arange(len(at))                            # where the merged tokens are now
            for i in (at, at - 1):
                i = i[(i >= 0) & (i < len(tokens) - 1)]
                same = owner[i] == owner[i + 1]
                rank[i[~same]] = self.NEVER
                i = i[same]
                rank[i], into[i] = self.find(tokens[i], tokens[i + 1])
        owner, tokens = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_owner, done_tokens))
        return tokens[np.argsort(owner, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


class SliceCache:
    """Tokens of slices.  ``merge`` turns a list of slices that are met for the first
    time into (tokens, first token of each).  When more than ``CACHE`` slices
    are known, those met again move to a new generation and the rest go."""

    def __init__(self, merge) -> None:
        self.merge = merge
        self.slot: dict[bytes, int] = {}
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.last: SliceCache | None = None

    def _add(self, pieces: list[bytes], ids: np.ndarray, first: np.ndarray) -> None:
        base = len(self.slot)
        self.slot.update(zip(pieces, range(base, base + len(pieces))))
        self.first = np.concatenate([self.first, self.first[-1] + first[1:] - first[0]])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def _ranges(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.first[slots + 1] - self.first[slots]
        return self.ids[spread(self.first[slots], self.first[slots + 1])], np.concatenate([[0], np.cumsum(size)])

    def expand(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of the slices one after the other, first token of each)."""
        if len(self.slot) > CACHE:
            last, self.last = SliceCache(self.merge), None
            last.slot, last.ids, last.first = self.slot, self.ids, self.first
            self.__init__(self.merge)
            self.last = last
        slots = np.fromiter(map(self.slot.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        lost = np.flatnonzero(slots < 0)
        if len(lost):
            new = list(dict.fromkeys([pieces[i] for i in lost.tolist()]))
            if self.last is not None:
                old = np.fromiter(map(self.last.slot.get, new, itertools.repeat(-1)), np.int64, len(new))
                known = np.flatnonzero(old >= 0)
                self._add([new[i] for i in known.tolist()], *self.last._ranges(old[known]))
                new = [new[i] for i in np.flatnonzero(old < 0).tolist()]
            if new:
                self._add(new, *self.merge(new))
            slots[lost] = [self.slot[pieces[i]] for i in lost.tolist()]
        return self._ranges(slots)


def spread(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The indexes of the ranges [start, end), one after the other."""
    size = end - start
    shift = np.cumsum(size) - size
    return np.repeat(start - shift, size) + np.arange(int(size.sum()))


class Table:
    """Byte strings by number, for gathering many at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.first = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.first[ids + 1] - self.first[ids]

    def join(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[spread(self.first[ids], self.first[ids + 1])]


class Codec:
    """A byte-level BPE vocabulary.  ``pairs``: only these pairs of tokens merge,
    by their rank; without it any two neighbours whose bytes are a token do, by
    its id, and a slice that is a token is never taken apart."""

    def __init__(self, tokens: dict[bytes, int], pairs: dict[tuple[bytes, bytes], int] | None = None) -> None:
        self.tokens, self.pairs = tokens, pairs
        self._ready = False

    def __getstate__(self):
        return self.tokens, self.pairs

    def __setstate__(self, state) -> None:
        self.__init__(*state)

    @classmethod
    def from_ranks(cls, path: str) -> Codec:
        """From a file with a base64 token and its rank per line."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def _prepare(self) -> None:
        if self._ready:
            return
        self.scanner = Scanner()
        size = max(self.tokens.values()) + 1
        strings = [b""] * size
        for token, i in self.tokens.items():
            strings[i] = token
        self.known = np.zeros(size, bool)
        self.known[list(self.tokens.values())] = True
        self.vocabulary = Table(strings)
        self.decimals = Table([b"%d," % i for i in range(size)])
        get = self.tokens.get
        if self.pairs is None:
            pairs = [(a, b, i, i) for t, i in self.tokens.items() for k in range(1, len(t))
                     if (a := get(t[:k])) is not None and (b := get(t[k:])) is not None]
        else:
            pairs = [(self.tokens[a], self.tokens[b], rank, self.tokens[a + b]) for (a, b), rank in self.pairs.items()]
        self.table = PairTable(pairs, size)
        self.single = np.array([self.tokens[bytes([i])] for i in range(256)])
        self.cache = SliceCache(self.merge)
        self._ready = True

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of each) of slices."""
        whole = [self.tokens.get(p) if self.pairs is None else None for p in pieces]
        short = [p for p, i in zip(pieces, whole) if i is None and len(p) < LONG]
        first = np.concatenate([[0], np.cumsum([len(p) for p in short])]).astype(np.int64)
        ids, first = self.table.merge(self.single[np.frombuffer(b"".join(short), np.uint8)], first)
        if len(short) == len(pieces):
            return ids, first
        parts, k = [], 0
        for p, i in zip(pieces, whole):
            if i is not None:
                parts.append(np.array([i]))
            elif len(p) < LONG:
                parts.append(ids[first[k]:first[k + 1]])
                k += 1
            else:
                parts.append(self._merge_long(p))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        if self.pairs is None:
            rank = lambda a, b: self.tokens.get(a + b)
        else:
            rank = lambda a, b: self.pairs.get((a, b))
        return np.array([self.tokens[p] for p in _merge_heap([piece[i:i + 1] for i in range(len(piece))], rank)])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, end offsets of the tokens in ``raw``, first token of every text) of the
        texts raw[offsets[i]:offsets[i + 1]] in UTF-8."""
        self._prepare()
        whole = raw.tobytes()
        points = np.frombuffer(whole.decode().encode("utf-32-le"), np.uint32)
        at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))      # byte offset of every code point
        filled = offsets[:-1][np.diff(offsets) > 0]
        edges = np.append(at[self.scanner.boundaries(points, np.searchsorted(at, filled))], len(raw)).tolist()
        ids, _ = self.cache.expand([whole[a:b] for a, b in zip(edges, edges[1:])])
        ends = np.cumsum(self.vocabulary.sizes(ids))
        return ids, ends, np.searchsorted(ends, offsets, side="right")

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after the other."""
        self._prepare()
        if len(ids) and not (ids.min() >= 0 and self.known[ids].all()):
            raise IndexError("an id outside the vocabulary")
        return self.vocabulary.join(ids)

    def vocabulary_sizes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of every token."""
        self._prepare()
        return self.vocabulary.sizes(ids)

    def decimal(self, ids: np.ndarray) -> np.ndarray:
        """The ids in decimal, a comma behind each."""
        self._prepare()
        return self.decimals.join(ids)


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, codec: Codec, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, ids and ends (end offset of every token in the UTF-8 text) of every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        for batch in batches:
            raw, off = utf8(batch.column(1))
            ids, ends, first = shared.value.encode(raw, off)
            own = ends - np.repeat(off[:-1], np.diff(first))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids, first), _lists(own, first)],
                                             names=["doc_id", "ids", "ends"])

    return (docs.select(field(key).cast("long").alias("doc_id"), field(text).cast("string").alias("t"))
            .mapInArrow(run, "doc_id long, ids array<int>, ends array<int>"))


def decode(encoded: DataFrame, codec: Codec, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """doc_id and the decoded bytes of every row; a null list decodes to no bytes."""
    bounded_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            first = np.asarray(lists.offsets, np.int64)
            flat = np.asarray(lists.values)[first[0]:first[-1]]
            sizes = np.concatenate([[0], np.cumsum(shared.value.vocabulary_sizes(flat))])
            raw = shared.value.decode(flat).tobytes()
            cut = sizes[first - first[0]].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([raw[a:b] for a, b in zip(cut, cut[1:])], pa.binary())],
                names=["doc_id", "decoded"])

    return (encoded.select(field(key).cast("long").alias("doc_id"), field(ids).cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id long, decoded binary"))


def round_trip(docs: DataFrame, codec: Codec, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: texts are encoded,
    and the ids alone are decoded again."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        for batch in batches:
            model = shared.value
            raw, off = utf8(batch.column(1))
            ids, _, first = model.encode(raw, off)
            size = np.concatenate([[0], np.cumsum(model.vocabulary_sizes(ids))])[first].tolist()
            back = memoryview(model.decode(ids).tobytes())
            digits = np.concatenate([[0], np.cumsum(model.decimals.sizes(ids))])[first].tolist()
            listed = memoryview(model.decimal(ids).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(first).astype(np.int64)),
                 pa.array([sha256(listed[a:max(a, b - 1)]).hexdigest() for a, b in zip(digits, digits[1:])], pa.string()),
                 pa.array([sha256(back[a:b]).hexdigest() for a, b in zip(size, size[1:])], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(field(key).cast("long").alias("doc_id"), field(text).cast("string").alias("t"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


__all__ = ["CACHE", "Scanner", "PairTable", "SliceCache", "Table", "Codec", "spread", "encode", "decode", "round_trip"]
