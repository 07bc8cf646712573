"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to ``BITS`` bits each, documents are
sorted by their index on the Hilbert curve through that grid, and the order is
cut into runs.  Neighbours on the curve are neighbours in every dimension, so
a shard covers a narrow range of each of them and its files' min/max
statistics prune on any.

Cuts follow the law ``rows``: sizes of shards, counted in documents, differ by
at most one.  Equal texts of one source and language have equal indexes and
lie together in the order.

Null and empty cases: a null text counts 0 bytes and has crc 0 (of no bytes);
null dimensions have grid value 0; ties on the curve go by doc_id (null last)
and text hashes; repeated rows take neighbouring slots; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypeline.llm.common import field, materialise, row_fingerprint, running_total, ROW_ID, with_row_id

SHARDS = 16
BITS = 8


def hilbert_tables(dims: int) -> tuple[list[int], list[int]]:
    """Curve digit and next state for every (state, cell of the 2^dims cube).

    A state is (entry corner, direction) of a sub-cube.  The rule: rotate the
    cell into the frame of the sub-cube, read its position along the Gray code,
    then move the frame to that position's entry corner and direction.
    """
    size, mask = 1 << dims, (1 << dims) - 1

    def gray(i):
        return i ^ (i >> 1)

    def ungray(g):
        i = 0
        while g:
            i ^= g
            g >>= 1
        return i

    def turn_left(x, k):
        k %= dims
        return ((x << k) | (x >> (dims - k))) & mask

    def turn_right(x, k):
        return turn_left(x, dims - k % dims)

    def axis(i):            # the axis along which the Gray code leaves position i
        return (gray(i) ^ gray(i + 1)).bit_length() - 1

    digit, follow = [], []
    for entry in range(size):
        for direction in range(dims):
            for cell in range(size):
                w = ungray(turn_right(cell ^ entry, direction + 1))
                corner = 0 if w == 0 else gray(2 * ((w - 1) // 2))
                step = 0 if w == 0 else (axis(w - 1) if w % 2 == 0 else axis(w)) % dims
                to = (entry ^ turn_left(corner, direction + 1)) & mask
                digit.append(w)
                follow.append(to * dims + (direction + step + 1) % dims)
    return digit, follow


def hilbert_index(dims: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a point whose coordinates lie in [0, 2^bits)."""
    n = len(dims)
    if n * bits > 62:
        raise ValueError("the curve index must fit a long")
    digit, follow = hilbert_tables(n)
    digits, states = F.array(*[F.lit(v) for v in digit]), F.array(*[F.lit(v) for v in follow])
    points = F.array(*[d.cast("long") for d in dims])

    def step(acc: Column, shift: Column) -> Column:
        cell = F.lit(0).cast("long")
        for i in range(n):
            cell = cell + F.shiftleft(
                F.call_function("shiftright", acc["p"][i], shift).bitwiseAND(F.lit(1).cast("long")), i)
        at = (acc["s"] * F.lit(1 << n) + cell.cast("int") + 1).cast("int")
        return F.struct((acc["h"] * F.lit(1 << n).cast("long") + F.element_at(digits, at)).alias("h"),
                        F.element_at(states, at).alias("s"), acc["p"].alias("p"))

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("s"), points.alias("p"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda acc: acc["h"])


def log_grid(value: Column, bits: int = BITS) -> Column:
    """Quantise a count: bit length and the three bits below the leading one
    (eight steps per octave), without floating point."""
    digits = F.bin(value)
    length = F.length(digits)
    below = F.conv(F.rpad(F.substring(digits, 2, 3), 3, "0"), 2, 10).cast("long")
    return F.least(F.when(value > 0, length * 8 + below).otherwise(0), F.lit((1 << bits) - 1))


def hash_grid(value: Column, bits: int = BITS) -> Column:
    """Quantise a label: equal labels share a grid line; null is line 0."""
    return F.when(value.isNull(), F.lit(0)).otherwise(F.pmod(F.crc32(value.cast("string")), F.lit(1 << bits)))


def assign_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id",
                  labels: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per row of ``docs``: doc_id, row hashes, size, text_crc32, law,
    shard, slot (gapless from 0 within the shard), grown_shard and the curve
    index.  ``size`` is the UTF-8 length of the text plus 1."""
    body = F.coalesce(field(text), F.lit(""))
    size = (F.octet_length(body) + 1).cast("long")
    narrow = materialise(docs.select(
        field(key).alias("doc_id"), size.alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        hilbert_index([log_grid(size), *[hash_grid(field(c)) for c in labels]]).alias("curve"),
        F.lit(1).cast("long").alias("__one"), *row_fingerprint(docs)), "shard-keys")
    total = narrow.count()
    placed = running_total(narrow, ["curve", "doc_id", *ROW_ID], "__one", "__rank", name="shard-order")
    small, larger = divmod(total, shards)       # the first ``larger`` shards hold one document more
    place, edge = F.col("__rank") - 1, larger * (small + 1)
    width, rest = F.lit(small + 1), F.lit(max(small, 1))
    first = place < F.lit(edge)
    shard = F.when(first, F.floor(place / width)).otherwise(F.floor((place - edge) / rest) + larger)
    slot = F.when(first, F.pmod(place, width)).otherwise(F.pmod(place - edge, rest))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
                         slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                         "curve", *ROW_ID)


def attach_shards(docs: DataFrame, plan: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``docs`` with its shard and slot; columns of those names are replaced.
    Repeated rows hold several slots of the plan: they are listed per row hash
    and emitted once each."""
    spots = plan.groupBy(*ROW_ID).agg(F.collect_list(F.struct("shard", "slot")).alias("__spots"))
    met = with_row_id(docs).dropDuplicates(list(ROW_ID)).join(spots, list(ROW_ID))
    own = [field(c) for c in docs.columns if c.lower() not in (shard, slot)]
    return (met.select(*own, F.explode("__spots").alias("__spot"))
            .withColumns({shard: F.col("__spot.shard"), slot: F.col("__spot.slot")}).drop("__spot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text", key: str = "doc_id",
                 labels: tuple[str, ...] = ("source", "lang"), rows_per_file: int = 1_000_000) -> None:
    """Write ``docs`` in curve order, one folder per shard.  A shard is dealt over
    as many tasks as it has blocks of ``rows_per_file`` slots, never over one."""
    placed = attach_shards(docs, assign_shards(docs, shards, text, key, labels))
    (placed.withColumn("__block", F.floor(F.col("slot") / rows_per_file))
     .repartition("shard", "__block").sortWithinPartitions("shard", "slot")
     .drop("__block").write.partitionBy("shard").parquet(path))


__all__ = ["SHARDS", "hilbert_tables", "hilbert_index", "log_grid", "hash_grid", "assign_shards",
           "attach_shards", "write_shards"]
