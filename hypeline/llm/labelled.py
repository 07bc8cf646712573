"""Bounded samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypeline.llm.common import ROW_ID, field, row_fingerprint


def holdout(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out fold; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))


def unit(key: Column) -> Column:
    """A number in [0, 1) that depends on the id only."""
    return F.pmod(F.xxhash64(key, F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def sample_labels(labels: DataFrame, label: str, rows: int, folds: int, fold: int, key: str = "doc_id") -> DataFrame:
    """About ``rows`` labelled ids outside the held-out fold, chosen by a hash of
    the id (all of them if there are fewer).  Ids labelled twice with different
    values are left out.  The result is small enough to broadcast."""
    usable = (labels.select(field(key).alias("doc_id"), field(label).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~holdout(F.col("doc_id"), folds, fold)))
    total = usable.count()
    if total > rows:
        usable = usable.where(unit(F.col("doc_id")) < rows / total)
    return (usable.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("__max"))
            .where("label = __max").drop("__max"))


def sampled_texts(docs: DataFrame, chosen: DataFrame, text: str, key: str) -> DataFrame:
    """doc_id, text ``t`` and label of the ids in ``chosen`` (see ``sample_labels``):
    one row per id, the one with the smallest fingerprint, however often an id
    is repeated.  Each task forwards at most one row per id."""
    met = docs.join(F.broadcast(chosen.select(F.col("doc_id").alias("__id"), F.col("label").alias("__label"))),
                    field(key) == F.col("__id"))
    rows = met.select(F.col("__id"), F.col("__label"), field(text).alias("__t"), *row_fingerprint(docs))
    return (rows.groupBy("__id", "__label").agg(F.min(F.struct(*ROW_ID, "__t")).alias("__row"))
            .select(F.col("__id").alias("doc_id"), F.col("__row.__t").alias("t"), F.col("__label").alias("label")))


__all__ = ["holdout", "unit", "sample_labels", "sampled_texts"]
