"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hypeline.session import checkpoint_root, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
PART = "__part"
ROW_ID = ("__row_a", "__row_b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def field(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and fixes what
    ``spark_partition_id`` or a sampled range partitioning gave."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the folders of materialised frames that nothing lazy reads any more."""
    for df in frames:
        spark, path = df.sparkSession, df._scratch
        root = checkpoint_root(spark).rstrip("/")
        if not path.startswith(f"{root}/hypeline/"):
            raise ValueError(f"not a scratch folder: {path}")
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Hand rows to Python in batches of a few MB: a batch of long texts then
    needs no more memory than one of short texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def map_rows(df: DataFrame, run, names: list[str] | None = None) -> DataFrame:
    """``df.mapInArrow(run)`` with the schema of ``df`` (or of its columns
    ``names``).  Columns have plain names inside, whatever they are called."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    kept = range(len(df.columns) if names is None else len(names))
    schema = T.StructType([plain.schema.fields[i] for i in kept])
    return plain.mapInArrow(run, schema).toDF(*(names or df.columns))


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hashable(df: DataFrame) -> list[Column]:
    """Columns in a form that hash functions accept (maps have no hash)."""
    out = []
    for f in df.schema.fields:
        c = field(f.name)
        simple = isinstance(f.dataType, T.AtomicType)
        out.append(c if simple else F.to_json(F.struct(c.alias("v"))))
    return out


def row_fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes over every column.  Rows that agree in both are repeated
    rows and interchangeable."""
    cols = []
    for c in _hashable(df):
        cols += [c.isNull(), c]          # hash functions skip nulls: mark them
    return [F.xxhash64(*cols).alias(ROW_ID[0]), F.xxhash64(F.lit("b"), *cols).alias(ROW_ID[1])]


def with_row_id(df: DataFrame) -> DataFrame:
    return df.select(*[field(c) for c in df.columns], *row_fingerprint(df))


def parts_for(df: DataFrame) -> int:
    """Partitions for a range partitioning: the session's shuffle width."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def running_total(df: DataFrame, order: list[str], value: str, out: str,
                  within: str | None = None, name: str = "ordered") -> DataFrame:
    """Exact running total of the integer column ``value`` in the order given
    by ``order`` (inclusive), over the table or within each ``within``.

    No window spans the table or a hot ``within`` value: rows are range
    partitioned by (within, order), each range is totalled, the totals of the
    ranges (one row per range and ``within`` value) are turned into offsets,
    and a window runs inside each range only.  ``order`` must be total up to
    repeated rows; then the result does not depend on where ranges are cut.
    """
    keys = ([within] if within else []) + order
    tagged = materialise(df.repartitionByRange(parts_for(df), *[F.col(k).asc_nulls_last() for k in keys])
                         .withColumn(PART, F.spark_partition_id()), name)
    # A null ``within`` is a group of its own: join and partition on a never-null struct.
    group = F.struct(F.col(within).isNull(), F.col(within)) if within else F.lit(True)
    tagged = tagged.withColumn("__group", group)
    totals = tagged.groupBy("__group", PART).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy("__group").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__group", PART, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = (Window.partitionBy("__group", PART).orderBy(*[F.col(k).asc_nulls_last() for k in order])
              .rowsBetween(Window.unboundedPreceding, 0))
    return (tagged.withColumn("__run", F.sum(value).over(inside))
            .join(offsets, ["__group", PART])
            .withColumn(out, F.col("__run") + F.col("__before"))
            .drop("__group", PART, "__run", "__before"))


__all__ = ["WORD", "GAP", "ROW_ID", "table", "field", "materialise", "discard", "bounded_batches", "map_rows", "word_count",
           "row_fingerprint", "with_row_id", "parts_for", "running_total"]
