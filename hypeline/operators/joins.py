"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side we are willing to ship to every executor.
DEFAULT_BROADCAST_MAX_ROWS = 500_000
DEFAULT_BROADCAST_MAX_BYTES = 64 * 2**20


def row_bytes(df: DataFrame) -> Column:
    """Payload bytes of a row: encoded length of strings/binaries, the JSON
    length of nested values, 8 per other field (an upper-bound-style estimate
    for the hash table)."""
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            # nested values: 8 bytes for every character of their JSON text, more than any leaf takes
            text = F.to_json(F.struct(F.col(f.name)))
            parts.append(F.coalesce(F.octet_length(text) * 8, F.lit(0)))
        else:
            parts.append(F.lit(8))
    return sum(parts[1:], parts[0]) if parts else F.lit(0)


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    """One bounded job: at most ``max_rows`` rows and ``max_bytes`` payload?"""
    n, size = (df.select(row_bytes(df).cast("bigint").alias("b")).limit(max_rows + 1)     # only sizes go to the one task
                 .agg(F.count(F.lit(1)), F.sum("b"))
                 .first())
    return n <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only after proving the side has at most ``max_rows``
    rows and ``max_bytes`` of payload.

    The proof is one bounded job (``limit(max_rows + 1)`` then count and sum
    of row sizes).  Beyond either bound the plain DataFrame is returned and
    Catalyst/AQE plan a shuffle join (with AQE's skew-join splitting for hot
    keys).
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
