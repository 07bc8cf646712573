"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``rate = target / source size`` copies.
The expected copies are prefix-summed within the source, one random offset is
added, and a document is emitted once per integer boundary that its interval
crosses: ``floor(E_end + u) - floor(E_start + u)`` times.  Rates stay at or
below ``MAX_REPEAT``, so no document is taken more often than that.

Documents of a source are ordered by size.  Each stretch of the order then
holds documents of like size, and the words taken differ from the target by
about one large document.  The offset is the best of ``OFFSETS`` evenly spaced
ones behind a random start.

Null and empty cases:
- a null or empty text has size 0: it counts as a document and takes 0 words;
- a null source is one source, ordered after all others;
- a source without words has target 0 and nothing of it is taken;
- repeated rows are grouped, and their joint copies are dealt out evenly;
- an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypeline.llm.common import (ROW_ID, field, materialise, row_fingerprint, running_total, with_row_id,
                                 word_count)

WEIGHTS = (1, 2, 3)      # by rank of the source, repeating
MAX_REPEAT = 3
OFFSETS = 32
SEED = "mix"


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, size) -> (source, size, target).

    Weights go by code-point rank.  A target above ``max_repeat * size`` stops
    there and the excess is reshared by weight until none is above: the level
    ``(total - capped) / weight of the others`` only rises, so the loop ends.
    Only sums come to the driver.
    """
    ranked = materialise(
        running_total(sizes.withColumn("__one", F.lit(1)), ["source"], "__one", "__rank", name="sources")
        .withColumn("__w", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                        (F.pmod(F.col("__rank") - 1, F.lit(len(weights))) + 1).cast("int")))
        .select("source", "size", "__w"), "source-weights")
    cap = F.col("size") * max_repeat
    level, seen = None, -1
    while True:
        open_ = F.lit(True) if level is None else F.col("__w") * F.lit(level) < cap
        row = ranked.agg(F.sum("size").alias("total"), F.sum(F.when(open_, F.col("__w"))).alias("w"),
                         F.sum(F.when(~open_, cap)).alias("capped"), F.count(F.when(~open_, 1)).alias("n")).first()
        if row["n"] == seen or not row["w"]:
            break
        seen, left, weight = row["n"], row["total"] - (row["capped"] or 0), row["w"]
        level = left / weight
    if level is None:
        return ranked.select("source", "size", F.lit(0.0).alias("target"))
    share = F.lit(float(left)) * F.col("__w") / F.lit(float(weight))
    return ranked.select("source", "size", F.when(F.col("__w") * F.lit(level) < cap, share)
                         .otherwise(cap.cast("double")).alias("target"))


def _start(source: Column, seed: str) -> Column:
    """A random number in [0, 1) that depends on the source and the seed only."""
    digest = F.md5(F.concat(F.coalesce(source, F.lit("")), F.lit("|" + seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def _crossed(rate: Column, end: Column, n: Column, offset: Column) -> Column:
    return (F.floor(rate * end + offset) - F.floor(rate * (end - n) + offset)).cast("long")


def plan_mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
             weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """One row per distinct document row: key, row hashes, ``n`` (how often the
    row occurs), size, source_size, target and ``copies`` for all n together."""
    units = materialise(
        docs.select(field(key).alias("doc_id"), field(source).cast("string").alias("source"),
                    word_count(field(text)).alias("size"), *row_fingerprint(docs))
        .groupBy("doc_id", "source", "size", *ROW_ID).agg(F.count(F.lit(1)).alias("n")), "mix-units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"))
    targets = materialise(
        source_targets(sizes, weights, max_repeat)
        .select(F.col("source").alias("t_source"), F.col("size").alias("source_size"), "target",
                F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0).alias("rate"),
                _start(F.col("source"), seed).alias("start")), "mix-targets")
    same = F.col("source").eqNullSafe(F.col("t_source"))
    ordered = materialise(running_total(units, ["size", "doc_id", *ROW_ID], "n", "end", within="source",
                                        name="mix-order").join(targets, same).drop("t_source"), "mix-ordered")
    offset = [(F.col("start") + j) / F.lit(float(OFFSETS)) for j in range(OFFSETS)]
    taken = ordered.groupBy("source", "target").agg(*[
        F.sum(F.col("size") * _crossed(F.col("rate"), F.col("end"), F.col("n"), offset[j])).alias(f"__t{j}")
        for j in range(OFFSETS)])
    # Nearest to the target first, then the smaller offset.
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"__t{j}") - F.col("target")).alias("d"), F.lit(j).alias("j"))
                                 for j in range(OFFSETS)]))["j"]
    chosen = taken.select(F.col("source").alias("c_source"), best.alias("__j"))
    return (ordered.join(chosen, F.col("source").eqNullSafe(F.col("c_source")))
            .withColumn("copies", _crossed(F.col("rate"), F.col("end"), F.col("n"),
                                           (F.col("start") + F.col("__j")) / F.lit(float(OFFSETS))))
            .select("doc_id", *ROW_ID, "n", "source", "size", "source_size", "target", "copies"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken, with the
    columns of ``docs``.  Rows are found again by their row hashes."""
    plan = plan_mix(docs, text, source, key, **options).where("copies > 0").select(*ROW_ID, F.col("copies").alias("__copies"))
    # ``copies`` covers all repeats of a row, so one of them is kept before emitting.
    met = with_row_id(docs).dropDuplicates(list(ROW_ID)).join(plan, list(ROW_ID))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__copy")
    return met.select(*[field(c) for c in docs.columns], times).drop("__copy")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, copies."""
    plan = plan_mix(docs, **options)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("__i")
    dealt = F.floor(F.col("copies") / F.col("n")).cast("long") + F.when(
        F.col("__i") < F.pmod(F.col("copies"), F.col("n")), 1).otherwise(0)
    return (plan.select("*", each).withColumn("copies", dealt)
            .select("doc_id", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"))


__all__ = ["WEIGHTS", "MAX_REPEAT", "source_targets", "plan_mix", "mix", "mix_report"]
