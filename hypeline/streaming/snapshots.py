"""Newest snapshot per key as a stateful stream (W1 over fetches that overlap).

Each fetch reads the last 48 hours again, so a post arrives several times with
newer counts.  The stream's state holds the newest row per (key, creation
time); a watermark on the creation time drops a post from the state once no
fetch can return it, so the state holds one look-back window, not the table.
Update mode emits only the keys a fetch changed, and they are merged into the
target on the key.  The merge replaces rows by key, so a micro-batch that is
run again after a failure leaves the table as it is.

Rows that arrive more than ``delay`` behind the newest creation time seen are
late and dropped by Spark: ``delay`` must be at least the fetches' look-back.
A fetch landed again changes nothing: its rows are in the state, or late and
then at most as new as those in the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypeline.operators.snapshot import _orderable, latest_snapshot
from hypeline.sinks.tables import merge_upsert

_NO_LOAD = 2**63 - 1         # sorts behind every load time


def newest_per_key(stream: DataFrame, keys: Sequence[str], event_time: str = "created_utc",
                   load_time: str = "_loaded_at_utc", delay: str = "48 hours") -> DataFrame:
    """The newest row per (``keys``, ``event_time``), picked as
    :func:`latest_snapshot` picks it: latest ``load_time``, NULL last, ties by the
    other columns in ascending order.  Rows with a NULL ``event_time`` take no
    part (no watermark could ever drop them).  Every column must be orderable."""
    group = [*keys, event_time]
    rest = [f for f in stream.schema.fields if f.name not in group and f.name != load_time]
    odd = [f.name for f in rest if not _orderable(f.dataType)]
    if odd:
        raise ValueError(f"columns without an order cannot break ties: {odd}")
    order = F.coalesce(-F.unix_micros(F.col(load_time).cast("timestamp")), F.lit(_NO_LOAD))
    newest = F.min(F.struct(order.alias("order"), *[F.col(f.name) for f in rest], F.col(load_time)))
    picked = (stream.where(F.col(event_time).isNotNull()).withWatermark(event_time, delay)
                    .groupBy(*group).agg(newest.alias("__newest")))
    return picked.select(*[F.col(c) if c in group else F.col(f"__newest.`{c}`").alias(c) for c in stream.columns])


def keep_latest(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str,
                keys: Sequence[str], event_time: str = "created_utc", load_time: str = "_loaded_at_utc",
                delay: str = "48 hours", partition_col: str | None = None, fmt: str = "parquet") -> None:
    """Bring ``target`` up to date with every file of ``source`` not yet read:
    one row per key, its newest snapshot.  ``partition_col`` is the day of
    ``event_time`` and is added here; a key's creation time is taken as fixed
    (if it moves within a fetch, the newest load wins)."""
    rows = spark.readStream.schema(schema).format(fmt).load(source)
    newest = newest_per_key(rows, keys, event_time, load_time, delay)

    def upsert(batch: DataFrame, _: int) -> None:
        one = latest_snapshot(batch, keys, load_time)
        if partition_col:
            one = one.withColumn(partition_col, F.to_date(event_time))
        merge_upsert(batch.sparkSession, one, target, keys, partition_col, keys, partition_follows_key=True)

    (newest.writeStream.outputMode("update").foreachBatch(upsert)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


__all__ = ["keep_latest", "newest_per_key"]
