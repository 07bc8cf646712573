"""Driver queries of the operators: each runs over its whole table with
production parameters and returns its full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

import corpus_pipeline
from hypeline.llm import (alignment, byte_bpe, chunks, decontamination, hard_negatives, jaccard_join, langid, mixing,
                          quality, rules, sharding, toxicity, warc)
from hypeline.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to the target weights of their sources."""
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return jaccard_join.component_ids(table(spark, sf_dir, "documents"))


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the cascade's verdict of every document."""
    return rules.rule_report(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt to 16 shards along the Hilbert curve."""
    return sharding.assign_shards(table(spark, sf_dir, "documents")).drop("__row_a", "__row_b")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated spans of all documents, with the documents that hold the first occurrences."""
    return chunks.repeated_spans(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as a deduplicated archive and read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap benchmark items."""
    return decontamination.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_alignment(spark: SparkSession, sf_dir: str, first: str = public_tokenizers.path("byte_bpe_50k.json"),
                   second: str = public_tokenizers.path("piece_bpe_32k.model")) -> DataFrame:
    """Tokens of two tokenizers aligned over every document."""
    aligner = alignment.Aligner(alignment.byte_level(first), alignment.Pieces.from_file(second))
    return alignment.alignment_report(table(spark, sf_dir, "documents"), aligner)


def op12_byte_bpe(spark: SparkSession, sf_dir: str,
                  ranks: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")) -> DataFrame:
    """Every document encoded and decoded again."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe.Codec.from_ranks(ranks))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, per positive."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_mixing, op2_language, op3_toxicity, op4_quality, op5_jaccard, op6_rules,
                                   op7_sharding, op8_substrings, op9_warc, op10_decontamination, op11_alignment, op12_byte_bpe,
                                   op13_hard_negatives, pipeline)}
