"""Hard negatives of anchors within score windows, over Hilbert-ordered blocks with zone maps.

**Blocks.**  Vectors are quantised to integers and ordered by dimension, label
and the index of their cell on a Hilbert curve through all dimensions, so rows
that follow one another are near one another.  The order is cut into blocks of
at most ``BLOCK`` rows with one label each, written as Parquet with a zone map:
the least and the greatest value of every dimension.

**Choosing blocks.**  The score of an anchor is an integer inner product.  By
interval arithmetic over a zone map its score with any row of a block lies
between two bounds.  A search for positives reads the blocks of the anchor's
label whose upper bound reaches the fifth score of the anchor's own block; a
search for negatives reads the blocks of other labels whose bounds meet one of
the anchor's windows.  The same bounds, against the best rows that a task has
found so far, spare the products of a block that is read for other anchors.
Results do not depend on the order or on the size of blocks.

**Rounds.**  Anchors are searched in rounds of at most ``ANCHORS``; a round's
anchors, positives and windows are broadcast, blocks never are, and each task
keeps only the best rows of every window.  Anchors are a stated query set;
every row is a candidate.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part.  Repeated rows are kept as one row with a number of
copies and count as often as they occur, as candidates, as positives and as
anchors.  A null vec_id is a candidate behind all others with its score, never an
anchor (2**63 - 1 stands for it and is reserved).  Vectors of different
length are never compared.  Ties go to the smaller vec_id; rows with the
same score and vec_id are interchangeable.  A window of a negative positive
score is empty.  An empty table gives no rows.  Scores that leave 64 bits
raise ``OverflowError``, components beyond 32 bits an arithmetic error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hypeline.llm.common import bounded_batches, field, materialise, parts_for
from hypeline.operators.joins import broadcast_if_small
from hypeline.session import scratch_path

BLOCK = 512                  # rows of a block
ANCHORS = 4096               # anchors of a round
BITS = 2                     # bits per dimension of a Hilbert cell
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100     # a window: from LOW to HIGH hundredths of the positive's score
EVERY = 100                  # anchors: ids divisible by this
NULL_ID = (1 << 63) - 1


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index of each row's cell on the Hilbert curve, as big-endian bytes; cells
    are (rows, dimensions) of numbers below 2**bits.  Vectorised over rows."""
    x = cells.astype(np.uint16).T.copy()
    d = len(x)
    if d == 0:
        return np.zeros((cells.shape[0], 0), np.uint8)
    q = 1 << (bits - 1)
    while q > 1:                                     # undo the rotations of the finer levels
        for i in range(d):
            invert = (x[i] & q) > 0
            swap = np.where(invert, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(invert, q - 1, swap).astype(np.uint16)
            x[i] ^= swap.astype(np.uint16)
        q >>= 1
    for i in range(1, d):                            # Gray code across dimensions
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint16)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[d - 1] & q, q - 1, 0).astype(np.uint16)
        q >>= 1
    x ^= turn
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])          # bit, dimension, row
    return np.packbits(planes.reshape(bits * d, -1).T.astype(np.uint8), axis=1)


def _matrix(lists: pa.Array, kind=np.int64) -> list[np.ndarray]:
    """The arrays of a list column."""
    first = np.asarray(lists.offsets)
    flat = np.asarray(lists.values).astype(kind)
    return [flat[a:b] for a, b in zip(first.tolist(), first[1:].tolist())]


def quantised(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, label, dim, v (integers) and copies of the rows that take part, each once."""
    v = field(vector)
    # NaN is greater than every number, infinity included.
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    turned = F.when(field(key) % 7 == 0, (field(label) + 1) % 10).otherwise(field(label)).cast("long")
    return (rows.where(v.isNotNull() & field(label).isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(field(key).cast("long").alias("id"), turned.alias("label"),
                    F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("int")).alias("v"))
            .groupBy("id", "label", "v").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("dim", F.size("v")))


def _spread_of(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every dimension, over all rows; partial sums per task."""

    def run(batches):
        total = np.zeros((3, 0))
        for batch in batches:
            first = np.asarray(batch.column(0).offsets)
            flat = np.asarray(batch.column(0).values)[first[0]:first[-1]].astype(float)
            if len(flat):
                place = np.arange(len(flat)) - np.repeat(first[:-1] - first[0], np.diff(first))
                part = np.stack([np.bincount(place), np.bincount(place, flat), np.bincount(place, flat * flat)])
                wide = max(total.shape[1], part.shape[1])
                total = np.pad(total, ((0, 0), (0, wide - total.shape[1]))) + np.pad(part, ((0, 0), (0, wide - part.shape[1])))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[1], dtype=np.int32)), *map(pa.array, total)],
                                         names=["place", "n", "s", "ss"])

    got = (rows.select("v").mapInArrow(run, "place int, n double, s double, ss double")
           .groupBy("place").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]).orderBy("place").toArrow())
    n, s, ss = (np.asarray(got[c].combine_chunks()) for c in ("n", "s", "ss"))
    mean = s / n
    return mean, np.sqrt(np.maximum(ss / n - mean * mean, 0))


BLOCK_SCHEMA = ("label long, dim int, ids array<long>, copies array<long>, v array<int>, lo array<int>, hi array<int>")


def block_table(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Quantised rows cut into Hilbert-ordered blocks with zone maps, written as Parquet; ``block`` numbers them."""
    spark = rows.sparkSession
    rows = materialise(rows, "vectors")
    mean, wide = _spread_of(rows)
    cuts = np.array([k / 2 ** (BITS - 1) for k in range(1 - 2 ** (BITS - 1), 2 ** (BITS - 1))])

    def keyed(batches):
        for batch in batches:
            vectors = _matrix(batch.column("v"))
            keys = np.empty(len(vectors), object)
            dims = np.array([len(v) for v in vectors], np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.stack([vectors[i] for i in at])
                cells = sum(((x - mean[:d]) > c * wide[:d]).astype(np.uint16) for c in cuts)
                keys[at] = [k.tobytes() for k in hilbert_keys(cells, BITS)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, "h"])

    order = ["dim", "label", "h", F.col("id").asc_nulls_last()]
    ordered = (rows.mapInArrow(keyed, "id long, label long, v array<int>, copies long, dim int, h binary")
               .repartitionByRange(parts_for(rows), *order).sortWithinPartitions(*order))

    def cut(batches):
        label, dim, ids, copies, vectors = None, None, [], [], []

        def flush(last: bool):
            out = []
            while len(ids) >= block or (last and ids):
                v = np.stack(vectors[:block])
                out.append((label, dim, ids[:block], copies[:block], v.ravel(),
                            v.min(axis=0), v.max(axis=0)))
                del ids[:block], copies[:block], vectors[:block]
            return out

        for batch in batches:
            got = []
            for i, (a, b, c, n, v) in enumerate(zip(*[batch.column(x).to_pylist() for x in ("label", "dim", "id", "copies")],
                                                    _matrix(batch.column("v"), np.int32))):
                if (a, b) != (label, dim):
                    got += flush(True)
                    label, dim = a, b
                ids.append(NULL_ID if c is None else c), copies.append(n), vectors.append(v)
            got += flush(False)
            yield _block_batch(got)
        yield _block_batch(flush(True))

    blocks = ordered.mapInArrow(cut, BLOCK_SCHEMA).withColumn("block", F.monotonically_increasing_id())
    return materialise(blocks, "blocks")


def _block_batch(blocks: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 3]
    cols = list(zip(*blocks)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                      names=[c.split(" ")[0] for c in BLOCK_SCHEMA.split(", ")])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` with the rows of ``b``."""
    size = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if size < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if size < 1 << 63:
        return a @ b.T
    raise OverflowError("a score may leave 64 bits")


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each row of ``a`` can have with vectors between lo and hi."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


ANCHOR_SCHEMA = "id long, label long, dim int, v array<int>, copies long, reach long"


def anchor_table(blocks: DataFrame, every: int = EVERY, positives: int = POSITIVES) -> DataFrame:
    """The anchors, and a score that each one's last positive reaches for sure (from its
    own block; null if that holds too few others), numbered from 0."""

    def run(batches):
        for batch in batches:
            out = []
            for label, dim, ids, copies, v in _blocks(batch):
                for i in np.flatnonzero((ids % every == 0) & (ids != NULL_ID)):
                    score = products(v[i:i + 1], v)[0]
                    others = copies.copy()
                    others[i] -= 1
                    order = np.argsort(-score, kind="stable")
                    enough = np.flatnonzero(np.cumsum(others[order]) >= positives)
                    out.append((int(ids[i]), label, dim, v[i], int(copies[i]),
                                int(score[order[enough[0]]]) if len(enough) else None))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.int64()]
            cols = list(zip(*out)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                             names=[c.split(" ")[0] for c in ANCHOR_SCHEMA.split(", ")])

    found = materialise(blocks.select("label", "dim", "ids", "copies", "v").mapInArrow(run, ANCHOR_SCHEMA)
                        .withColumn("__at", F.monotonically_increasing_id()), "anchors")
    # The upper bits name the task, the lower 33 the row in it: one count per task gives gapless numbers.
    part = F.shiftright("__at", 33)
    sizes = sorted(found.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    base = F.broadcast(found.sparkSession.createDataFrame(before, "p long, base long"))
    numbered = found.withColumn("p", part).join(base, "p").withColumn("anchor", F.col("base") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    out = numbered.select("anchor", "id", "label", "dim", "v", "copies", "reach")
    out._total = total
    return out


def _blocks(batch: pa.RecordBatch):
    """(label, dim, ids, copies, matrix) of the blocks of a batch."""
    for label, dim, ids, copies, v in zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(),
                                          *[_matrix(batch.column(c)) for c in ("ids", "copies", "v")]):
        yield label, dim, ids, copies, v.reshape(len(ids), dim)


class Round:
    """The anchors of a round by dimension, and the windows of each: rows of
    ``low`` and ``high``, both inclusive; ``top`` rows are kept per window."""

    def __init__(self, anchors: list[dict], low: np.ndarray, high: np.ndarray, top: int, same_label: bool) -> None:
        self.low, self.high, self.top, self.same_label = low, high, top, same_label
        self.id = np.array([r["id"] for r in anchors], np.int64)
        self.label = np.array([r["label"] for r in anchors], np.int64)
        self.vectors = [np.array(r["v"], np.int64) for r in anchors]
        dims = np.array([len(v) for v in self.vectors], np.int64)
        self.of_dim = {int(d): np.flatnonzero(dims == d) for d in np.unique(dims)}
        self.matrix = {d: np.stack([self.vectors[i] for i in at]) for d, at in self.of_dim.items()}

    def reached(self, label: int, dim: int, lo: np.ndarray, hi: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The anchors with a window that a block's scores may meet; ``low`` replaces the windows' lower ends."""
        at = self.of_dim.get(dim, np.zeros(0, np.int64))
        at = at[(self.label[at] == label) == self.same_label]
        if not len(at):
            return at
        least, most = bounds(np.stack([self.vectors[i] for i in at]), lo[None, :], hi[None, :])
        return at[((least <= self.high[at]) & (most >= low[at])).any(axis=1)]


class Best:
    """The best rows of every window that a task has met."""

    def __init__(self, task: Round) -> None:
        self.task = task
        n, k = task.low.shape
        self.score = np.full((n, k, task.top), np.iinfo(np.int64).min)
        self.id = np.full((n, k, task.top), NULL_ID)
        self.copies = np.zeros((n, k, task.top), np.int64)
        self.low = task.low.copy()

    def add(self, label, dim, ids, copies, v) -> None:
        task = self.task
        at = task.reached(label, dim, v.min(axis=0), v.max(axis=0), self.low)
        if not len(at):
            return
        score = products(np.stack([task.vectors[i] for i in at]), v)
        for j in range(task.low.shape[1]):
            fits = (score >= self.low[at, j][:, None]) & (score <= task.high[at, j][:, None])
            row, col = np.nonzero(fits)
            if not len(row):
                continue
            n = copies[col].copy()
            if task.same_label:                       # an anchor is not its own positive
                own = np.flatnonzero(ids[col] == task.id[at[row]])
                for k in own:
                    n[k] -= np.array_equal(v[col[k]], task.vectors[at[row[k]]])
                row, col, n = row[n > 0], col[n > 0], n[n > 0]
            self._merge(at, j, row, score[row, col], ids[col], n)

    def _merge(self, at, j, row, score, ids, copies) -> None:
        touched = np.unique(row)
        old = at[touched]
        top = self.task.top
        row = np.concatenate([np.repeat(touched, top), row])
        score = np.concatenate([self.score[old, j].ravel(), score])
        ids = np.concatenate([self.id[old, j].ravel(), ids])
        copies = np.concatenate([self.copies[old, j].ravel(), copies])
        order = np.lexsort((ids, -score.astype(float), row)) if np.abs(score[copies > 0]).max(initial=0) < 1 << 52 \
            else np.array(sorted(range(len(row)), key=lambda i: (row[i], copies[i] == 0, -int(score[i]), ids[i])))
        row, score, ids, copies = row[order], score[order], ids[order], copies[order]
        start = np.flatnonzero(np.diff(row, prepend=-1))
        place = np.arange(len(row)) - np.repeat(start, np.diff(start, append=len(row)))
        kept = place < top
        shape = (len(touched), top)
        self.score[old, j], self.id[old, j], self.copies[old, j] = (x[kept].reshape(shape) for x in (score, ids, copies))
        full = self.copies[old, j, -1] > 0
        self.low[old[full], j] = np.maximum(self.low[old[full], j], self.score[old[full], j, -1])

    def rows(self, base: int) -> pa.RecordBatch:
        a, j, k = np.nonzero(self.copies)
        ids = self.id[a, j, k]
        return pa.RecordBatch.from_arrays(
            [pa.array(a + base), pa.array(j.astype(np.int32)), pa.array(ids, mask=ids == NULL_ID),
             pa.array(self.score[a, j, k]), pa.array(np.minimum(self.copies[a, j, k], self.task.top))], names=["anchor", "window", "id", "score", "copies"])


def search(blocks: DataFrame, task: Round, base: int) -> DataFrame:
    """(anchor, window, rank, id, score): the first ``top`` rows of each window."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(task)

    def choose(batches):
        for batch in batches:
            own, got = shared.value, []
            for block, label, dim, lo, hi in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                 batch.column(2).to_pylist(), _matrix(batch.column(3)), _matrix(batch.column(4))):
                if len(own.reached(label, dim, lo, hi, own.low)):
                    got.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64())], names=["block"])

    def score(batches):
        best = Best(shared.value)
        for batch in batches:
            for block in _blocks(batch):
                best.add(*block)
        yield best.rows(base)

    chosen = materialise(blocks.select("block", "label", "dim", "lo", "hi").mapInArrow(choose, "block long"), "chosen")
    read = blocks.join(broadcast_if_small(chosen), "block", "left_semi").select("label", "dim", "ids", "copies", "v")
    found = read.mapInArrow(score, "anchor long, window int, id long, score long, copies long")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return each.withColumn("rank", rank).where(F.col("rank") <= task.top).select("anchor", "window", "rank", "id", "score")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                   per_round: int = ANCHORS, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of
    every anchor, each of its positives, and its hard negatives."""
    spark = rows.sparkSession
    bounded_batches(spark)
    blocks = block_table(quantised(rows, key, vector, label), block)
    anchors = materialise(numbered := anchor_table(blocks), "numbered-anchors")
    path = scratch_path(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    least = np.iinfo(np.int64).min
    for base in range(0, numbered._total, per_round):
        part = (anchors.where((F.col("anchor") >= base) & (F.col("anchor") < base + per_round))
                .toArrow().sort_by("anchor").to_pylist())
        low = np.array([[least if r["reach"] is None else r["reach"]] for r in part], np.int64)
        near = search(blocks, Round(part, low, np.full_like(low, np.iinfo(np.int64).max), POSITIVES, True), base)
        near = materialise(near, "positives")
        # At most POSITIVES rows per anchor of the round.
        score = np.full((len(part), POSITIVES), -1, np.int64)
        for a, r, s in zip(*[near.select("anchor", "rank", "score").toArrow()[c].to_pylist() for c in ("anchor", "rank", "score")]):
            score[a - base, r - 1] = s
        wide = int(np.abs(score).max(initial=0)) * HIGH >= 1 << 63
        if wide:
            raise OverflowError("a window may leave 64 bits")
        # 30 p <= 100 s <= 90 p in integers; a missing or negative p has an empty window.
        low, high = -(-LOW * score // WHOLE), HIGH * score // WHOLE
        low, high = np.where(score < 0, 1, low), np.where(score < 0, 0, high)
        far = search(blocks, Round(part, low, high, NEGATIVES, False), base)
        positives = near.select("anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        found = (far.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
                 .join(broadcast_if_small(positives), ["anchor", "window"])
                 .join(F.broadcast(anchors.where((F.col("anchor") >= base) & (F.col("anchor") < base + per_round))
                                   .select("anchor", F.col("id").alias("anchor_id"), "copies")), "anchor")
                 .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
        found.select(*[c.split(" ")[0] for c in RESULT.split(", ")]).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)


__all__ = ["hilbert_keys", "quantised", "block_table", "anchor_table", "bounds", "products", "search", "hard_negatives"]
