"""A training corpus from ``documents``: toxic documents go, one document of
each near-duplicate group stays, documents with benchmark passages go, sources
are mixed to their target weights, and the rest is dealt to shards.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.

Defined cases, by stage: a null or empty text has no marker, no shingle and no
benchmark passage, so the first three stages keep it; a null id is an id like
any other, and rows are told apart by all their columns.  Rows that repeat as
a whole are one document for the near-copy stage (one stays) unless they have
no words, and as many as they are for the others.  Ties go to the smallest
doc_id (null last), then to the row's fingerprint.  A text without words is
mixed in at the rate of its source and adds no words.  An empty table passes through as an empty table
with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hypeline.llm import decontamination, jaccard_join, mixing, sharding, toxicity
from hypeline.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the limit."""
    return toxicity.keep_civil(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by shingle similarity of 0.75 or more."""
    return jaccard_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot along the Hilbert curve."""
    return sharding.attach_shards(docs, sharding.assign_shards(docs))


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("benchmark", drop_benchmark),
          ("mixing", mix_sources), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs


# Learned severities and the hashes that order the mix have no SQL; tests compare
# each stage with a brute-force version.
ORACLE_SQL = None
