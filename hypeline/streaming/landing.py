"""Land newly arrived files into a raw table with Structured Streaming.

The reference lands each daily fetch as an appended batch stamped with one
load time.  The streaming re-expression: a file source over the landing
folder, ``Trigger.AvailableNow`` (process everything new, then stop -- the
daily cadence stays with the scheduler) and Spark's Parquet file sink.

The file sink is exactly-once: files of a micro-batch become visible only
when the batch is recorded in the sink's ``_spark_metadata`` log, and batch
readers of the folder list files through that log.  A batch replayed after
a lost executor or a driver restart therefore never shows up twice.  (A
``foreachBatch`` that appends would only be at-least-once.)  Consequently a
stream-fed raw table must not also receive batch appends: readers would not
see files missing from the log.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder in whatever store holds it (a table of part files)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).isDirectory()


def land_stream(spark: SparkSession, source: str, schema: T.StructType, target: str,
                checkpoint: str, fmt: str = "parquet",
                transform: Callable[[DataFrame], DataFrame] | None = None,
                batch_ts: _dt.datetime | None = None,
                max_files_per_trigger: int | None = None, glob: str | None = None) -> int:
    """Append every not-yet-landed file under ``source`` to ``target``.

    Rows are stamped with ``_loaded_at_utc``: ``batch_ts`` if given, else the
    micro-batch's own timestamp (one value per batch, like a load job).
    ``glob`` restricts the file names picked up in ``source``.  Returns the
    number of micro-batches that landed rows.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source)
    if transform is not None:
        stream = transform(stream)
    stamp = F.lit(batch_ts).cast("timestamp") if batch_ts is not None else F.current_timestamp()
    q = (stream.withColumn("_loaded_at_utc", stamp)
               .writeStream.format("parquet")
               .option("path", target)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p.get("numInputRows", 0) > 0)
