"""Exact n-gram Jaccard join in the metric space of shingle sets.

A document is its set of 5-word shingles; the distance of two sets is
``1 - |x & y| / |x | y|``, a metric.  Documents link within distance 1/4.

**First level.**  The pivots are the one-shingle sets, in one global order
(frequent shingles last, then by hash).  A set's region is its first shingle;
a partner y within the radius can be at home in any region among the first
``|x| // 4 + 1`` shingles of x and in none behind them, because lacking the
shingles in front of it would already cost more than 1/4.  So a document is
replicated to exactly those regions, and any two documents that link meet in
one.  Regions that hold one set only, the great majority, end here.

**Inside regions.**  Every region has a pivot document; a document is compared
with it if they share enough regions, and verified links give labels.  Two
documents with one label are connected already and are never compared again:
components are asked for, not pairs.  What is left are pairs of documents with
different labels; those that share too few regions to reach the threshold are
dropped by an exact count, the others are verified on their whole sets.

**Frequent shingles.**  A region of a frequent shingle can be large.  It holds
documents made of frequent shingles mainly (large groups of near copies).
All rarer shingles of such a document are in its prefix, so a pair that shares
one of them has met in its region already; what is left are pairs that share
frequent shingles only, and a document with too few of those drops out of the
region before any pair is made.  The region is
split recursively by ``PIVOTS`` document pivots: each member goes to the
Voronoi region of its nearest pivot, and also to that of every pivot whose
distance is within twice the radius of the nearest one (triangle inequality:
no partner can be at home further away).  Regions whose members all carry one
label end; regions with few pairs of different labels, and regions that no
longer shrink, are finished by verifying those pairs.  A member of the main
label of a region is never paired with another one.

The order of shingles decides cost only: any order gives the same links.  The
list of frequent shingles is counted over a fixed share of the distinct sets
and holds at most ``FREQUENT_MAX`` entries.

Null and empty cases: a null text or a text without words has the empty set
(0 shingles), links with nothing and is its own component; fewer than five
words are one shingle; exact copies share one set and link; rows that repeat
a doc_id are separate documents with that id; a null doc_id never is a
component id unless all ids of a component are null; an empty table gives no
rows.  Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hypeline.llm import tokens
from hypeline.llm.common import (ROW_ID, WORD, bounded_batches, field, materialise, row_fingerprint,
                                 with_row_id)
from hypeline.llm.components import components

NUM, DEN = 75, 100           # link: DEN * intersection >= NUM * union
RADIUS = 1 - NUM / DEN
SAMPLE = 16                  # one in so many distinct sets is counted for the order
FREQUENT = 4                 # frequent: in so many sampled sets
FREQUENT_MAX = 1 << 17
REGION = 256                 # regions with at most the square of it to compare are finished by their pairs
PIVOTS = 8
COMPARED = 1 << 20           # the same once members have met the region's pivots
DEPTH = 4
BATCH = 1 << 20              # bytes of text that a task hashes at once
BROADCAST_IDS = 1_000_000    # ids (24 bytes each) that may be broadcast


def _signed(s: np.ndarray) -> np.ndarray:
    """Hashes as signed longs in the same order."""
    return (s ^ np.uint64(1 << 63)).view(np.int64)


def _digest(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def prefix_length(n):
    """How many shingles, from the front of the order, a partner must share one of."""
    return n - -(-NUM * n // DEN) + 1


def _needed(n: Column, m: Column) -> Column:
    """Smallest intersection with which sets of n and m elements link."""
    return F.ceil((n + m) * NUM / F.lit(float(NUM + DEN)) - 1e-9)


def _beyond(n: Column) -> Column:
    """Elements of a set behind its prefix."""
    return F.ceil(n * NUM / F.lit(float(DEN)) - 1e-9) - 1


def set_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, row hashes, node (hash of the set; null if empty) and n (size of the set)."""
    names = ["doc_id", *ROW_ID, "node", "n"]

    def run(batches):
        for batch in batches:
            sets = list(tokens.row_shingle_sets(batch.column(3)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([_digest(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64())], names=names)

    return (docs.select(field(key).cast("long").alias("doc_id"), *row_fingerprint(docs), field(text).alias("t"))
            .mapInArrow(run, ", ".join(f"{n} long" for n in names)))


def _sampled() -> Column:
    return F.pmod(F.col(ROW_ID[0]), F.lit(SAMPLE)) == 0


def frequent_shingles(docs: DataFrame, classes: DataFrame, text: str) -> np.ndarray:
    """Hashes of frequent shingles, counted over one in ``SAMPLE`` distinct sets.
    If there are too many, the count asked for is raised until they fit."""
    reps = classes.where(_sampled()).select(*ROW_ID, F.col("node").alias("want"))
    rows = docs.select(*row_fingerprint(docs), field(text).alias("t")).where(_sampled()).join(reps, list(ROW_ID)).select("t", "want")

    def run(batches):
        seen = set()                 # a repeated row counts once in a task
        for batch in batches:
            want = batch.column(1).to_pylist()
            sets = []
            for s, w in zip(tokens.row_shingle_sets(batch.column(0)), want):
                if w not in seen:
                    seen.add(w)
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))], names=["h"])

    # A row repeated in several tasks counts once for each of them; the order of shingles may be any.
    counts = materialise(rows.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= FREQUENT), "frequent")
    least = FREQUENT
    # One row per power of two: a bounded histogram decides.
    sizes = {r["b"]: r["n"] for r in counts.groupBy(F.length(F.bin("count")).alias("b")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    while sum(n for b, n in sizes.items() if b >= least.bit_length()) > FREQUENT_MAX:
        least = 1 << least.bit_length()
    got = counts.where(F.col("count") >= least).select("h").toArrow()["h"]
    return np.sort(np.asarray(got.combine_chunks()).view(np.uint64))


def prefix_rows(docs: DataFrame, frequent: np.ndarray, text: str) -> DataFrame:
    """(h, hot, node, n) for the shingles in each set's prefix.  A task emits a
    set that it meets again only once."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        often, seen = shared.value, set()
        for batch in batches:
            hs, hots, nodes, sizes = [], [], [], []
            for s in tokens.row_shingle_sets(batch.column(0)):
                if not len(s) or (node := _digest(s)) in seen:
                    continue
                seen.add(node)
                k = prefix_length(len(s))
                hot = np.zeros(len(s), bool)
                if len(often):
                    hot = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s
                order = np.concatenate([np.flatnonzero(~hot), np.flatnonzero(hot)])[:k]
                hs.append(s[order])
                hots.append(hot[order])
                nodes.append(np.full(k, node, np.int64))
                sizes.append(np.full(k, len(s), np.int32))
            cat = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(cat(hs, np.uint64))), pa.array(cat(hots, bool)),
                 pa.array(cat(nodes, np.int64)), pa.array(cat(sizes, np.int32))], names=["h", "hot", "node", "n"])

    return docs.select(field(text).alias("t")).mapInArrow(run, "h long, hot boolean, node long, n int")


class Sets:
    """Fetches whole sets of nodes, from the text of one document per node, and compares them."""

    def __init__(self, docs: DataFrame, classes: DataFrame, text: str) -> None:
        self.docs = docs.select(*row_fingerprint(docs), field(text).alias("t"))
        self.classes = classes

    def of(self, nodes: DataFrame) -> DataFrame:
        wanted = materialise(self.classes.join(nodes, "node").select(*ROW_ID, F.col("node").alias("want")), "wanted")
        side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
        # One long as the key keeps a broadcast table small; the second hash is compared behind it.
        a, b = ROW_ID
        rows = (self.docs.join(side, (self.docs[a] == wanted[a]) & (self.docs[b].bitwiseXOR(wanted[b]) == 0))
                .select("t", "want"))

        def run(batches):
            seen = set()                 # a repeated row gives its set once in a task
            for batch in batches:
                want, sets, found = batch.column(1).to_pylist(), [], []
                for s, w in zip(tokens.row_shingle_sets(batch.column(0)), want):
                    if w not in seen:
                        seen.add(w)
                        sets.append(s)
                        found.append(w)
                off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(flat))],
                    names=["node", "s"])

        return materialise(rows.mapInArrow(run, "node long, s array<long>").dropDuplicates(["node"]), "sets")

    def compare(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, b, i, u): sizes of intersection and union of the pairs' sets.  A set
        is moved once per pair that has it as b; the pairs themselves are broadcast
        to the sets of a if they are few enough, and joined by a shuffle if not."""
        pairs = materialise(pairs.select("a", "b").distinct(), name)
        side = F.broadcast(pairs) if pairs.count() <= BROADCAST_IDS else pairs
        sets = self.of(pairs.select(F.col("a").alias("node")).distinct()
                       .unionByName(pairs.select(F.col("b").alias("node")).distinct()).distinct())
        both = (sets.select(F.col("node").alias("a"), F.col("s").alias("sa")).join(side, "a")
                .join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b"))
        common = F.size(F.array_intersect("sa", "sb")).cast("long")
        # A repeated row gives its set, and so its comparisons, more than once.
        return materialise(both.select("a", "b", common.alias("i"), F.size("sa").alias("na"), F.size("sb").alias("nb"))
                           .select("a", "b", "i", (F.col("na") + F.col("nb") - F.col("i")).alias("u")).distinct(),
                           name + "-compared")


def _links(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("i") * DEN >= F.col("u") * NUM).select("a", "b")


def _labels(links: DataFrame) -> DataFrame:
    """(node, label): nodes that share a label are connected."""
    return materialise(components(links).select("node", F.col("root").alias("label")).distinct(), "labels")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _mixed(rows: DataFrame, by: str) -> DataFrame:
    """Rows of the regions that hold more than one label."""
    regions = (rows.groupBy(by).agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("cnt"))
               .where("lo != hi").select(by, "cnt"))
    return rows.drop("cnt").join(regions, by)


def _pairs(rows: DataFrame, by: str, keep: list[str], more: Column | None = None) -> DataFrame:
    """Pairs of one region with different labels and sizes that can link."""
    left = rows.select(by, *[F.col(c).alias(c + "_a") for c in ["node", "n", "label", *keep]])
    right = rows.select(F.col(by).alias("__by"), *[F.col(c).alias(c + "_b") for c in ["node", "n", "label", *keep]])
    fits = ((F.col(by) == F.col("__by")) & (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b"))
            & (F.least("n_a", "n_b") * DEN >= F.greatest("n_a", "n_b") * NUM))
    return left.join(right, fits if more is None else fits & more)


def _small_region_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of first-level regions that share enough regions to reach the
    threshold.  ``extra`` bounds what a pair may share in frequent regions,
    which are not joined here."""
    shared = (_pairs(rows, "h", ["extra"]).groupBy("node_a", "node_b")
              .agg(F.count(F.lit(1)).alias("c"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"),
                   F.least(F.first("extra_a"), F.first("extra_b")).alias("extra")))
    most = F.col("c") + F.col("extra") + F.greatest(_beyond(F.col("n_a")), _beyond(F.col("n_b")))
    return (shared.where(most >= _needed(F.col("n_a"), F.col("n_b")))
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))


def _large_region_pairs(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Pairs of frequent regions that share no rarer shingle: pairs that do meet in
    the region of that shingle, and are made there.

    All rarer shingles of a node with a frequent one in its prefix are in the
    prefix (``rare`` of them), and a pair of this kind shares none of them.
    Nor does it share the frequent ones that only one of them has: all of a
    node's are known (``hot``) up to its last in the prefix.  Both bound the
    intersection, and a pair is made only in the first region it shares."""
    need, common = _needed(F.col("n_a"), F.col("n_b")), F.array_intersect("hot_a", "hot_b")
    most = F.size(common) + F.greatest(_beyond(F.col("n_a")), _beyond(F.col("n_b")))
    last = F.least(F.array_max("hot_a"), F.array_max("hot_b"))
    upto = lambda c: F.size(F.filter(c, lambda x: x <= last))
    lost = F.col("rare_a") + F.col("rare_b")
    apart = lost + upto(F.col("hot_a")) + upto(F.col("hot_b")) - 2 * F.size(common)
    enough = lambda lost: F.col("n_a") + F.col("n_b") - lost >= 2 * need
    # What is not rare of either bounds the intersection, too; numbers cost least and drop most pairs of near copies.
    frequent = F.least(F.col("n_a") - F.col("rare_a"), F.col("n_b") - F.col("rare_b"))
    more = (frequent >= need) & enough(lost) & (F.col("h_a") == F.array_min(common)) & (most >= need) & enough(apart)
    rows = rows.drop("rare").join(prefixes, "node")
    names = ["node", "n", "label", "own", "minor", "h", "hot", "rare"]
    # Different labels: one of the two is not of the region's main label, and comes from the left.
    left = rows.where("minor").select("region", *[F.col(c).alias(c + "_a") for c in names])
    right = rows.select(F.col("region").alias("__by"), *[F.col(c).alias(c + "_b") for c in names])
    first = F.col("node_a") < F.col("node_b")
    once = (first | ~F.col("minor_b")) & F.when(first, F.col("own_a")).otherwise(F.col("own_b"))
    fits = ((F.col("region") == F.col("__by")) & (F.col("label_a") != F.col("label_b")) & once
            & (F.least("n_a", "n_b") * DEN >= F.greatest("n_a", "n_b") * NUM))
    return left.join(right, fits & more).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _minorities(rows: DataFrame) -> DataFrame:
    """Rows of the regions that hold more than one label, with the sizes of the region
    (``cnt``) and of what is not of its most frequent label (``others``, ``minor``)."""
    counts = rows.groupBy("region", "label").agg(F.count(F.lit(1)).alias("c"))
    regions = (counts.groupBy("region").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("cnt"),
                                            F.max("c").alias("most"))
               .where("cnt > most").select("region", "main", "cnt", (F.col("cnt") - F.col("most")).alias("others")))
    return (rows.drop("cnt", "others", "minor").join(regions, "region")
            .withColumn("minor", F.col("label") != F.col("main")).drop("main"))


def _able(rows: DataFrame) -> DataFrame:
    """Members with enough frequent shingles to link in their region with any
    member of the smallest size there that fits: the others are the fringe of
    a group of near copies, and can link through rarer shingles only."""
    low = rows.groupBy("region").agg(F.min("n").alias("low"))
    least = F.greatest(F.col("low"), F.ceil(F.col("n") * NUM / F.lit(float(DEN)) - 1e-9))
    return (rows.join(low, "region").where(F.col("n") - F.col("rare") >= _needed(F.col("n"), least)).drop("low"))


def _meet_pivots(rows: DataFrame, sets: Sets, depth: int) -> tuple[DataFrame, DataFrame]:
    """(pivots of every region, comparisons of every node with the pivots of its
    regions).  Pivots are the members with the fewest rarer shingles, the middle of
    a group of copies; most regions of a group choose the same ones, and a node
    is compared with each of them once."""
    pick = Window.partitionBy("region").orderBy("rare", F.xxhash64("node", F.lit(depth)), "node")
    pivots = materialise(rows.withColumn("r", F.row_number().over(pick)).where(F.col("r") <= PIVOTS)
                         .groupBy("region").agg(F.sort_array(F.collect_list("node")).alias("pivots")), "region-pivots")
    near = rows.join(pivots, "region").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("pivots"))
    pairs = near.select(F.col("node").alias("a"), F.explode("pivots").alias("b")).where("a != b")
    return pivots, sets.compare(pairs, f"pivots-{depth}")


def _split(rows: DataFrame, pivots: DataFrame, compared: DataFrame) -> DataFrame:
    """The members of the pivots' Voronoi regions with their windows.  Voronoi
    regions that keep nine tenths of their parent do not separate it: their
    members stay in the parent, marked ``stuck``.  A node is at home (``own``)
    with its nearest pivot; by the triangle inequality any partner is there
    as well, so a pair is made there and in no other region."""
    far = compared.select(F.col("a").alias("node"), F.col("b").alias("pivot"),
                          (1 - F.col("i") / F.col("u")).alias("d"))
    near = (rows.join(pivots, "region").withColumn("pivot", F.explode("pivots")).join(far, ["node", "pivot"], "left")
            .withColumn("d", F.coalesce("d", F.lit(0.0))))
    home = F.min(F.struct("d", "pivot")).over(Window.partitionBy("region", "node"))
    window = materialise(near.withColumn("home", home).where(F.col("d") <= F.col("home.d") + 2 * RADIUS + 1e-9)
                         .withColumn("own", F.col("own") & (F.col("pivot") == F.col("home.pivot")))
                         .select("region", "pivot", "h", "node", "n", "rare", "cnt", "own"), "windows")
    size = (window.groupBy("region", "pivot").agg((F.count(F.lit(1)) > 0.9 * F.max("cnt")).alias("stuck")))
    region = F.when(F.col("stuck"), F.col("region")).otherwise(F.xxhash64("region", "pivot"))
    return (window.join(size, ["region", "pivot"]).withColumn("region", region)
            .groupBy("region", "h", "node", "n", "rare", "stuck").agg(F.max("own").alias("own")))


def join_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, row hashes, n (size of its set), root
    (the component; null if the set is empty) and component_id."""
    bounded_batches(docs.sparkSession, BATCH)
    members = materialise(set_rows(docs, text, key), "sets-of-docs")
    # Each different set is fetched again from one row that has it, found by the row's fingerprint.
    classes = materialise(members.where("n > 0").groupBy("node").agg(
        F.min(F.struct(*ROW_ID)).alias("r"), F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
        .select("node", *[F.col("r")[c].alias(c) for c in ROW_ID], "doc_id", "n"), "classes")
    frequent = frequent_shingles(docs, classes, text)
    sets = Sets(docs, classes, text)

    # First level.  Rows of frequent shingles are spread; the others' regions are small.
    spread = F.when(F.col("hot"), F.pmod("node", F.lit(64))).otherwise(0)
    own = Window.partitionBy("h", "salt")
    regions = materialise(
        prefix_rows(docs, frequent, text).withColumn("salt", spread)
        .withColumn("lo", F.min("node").over(own)).withColumn("hi", F.max("node").over(own))
        .where("hot or lo != hi").dropDuplicates(["h", "salt", "node"])
        .select("h", "hot", "node", "n", "lo"), "regions")
    small, large = regions.where("not hot"), regions.where("hot")

    # A pivot per region: the smallest node, so that it is the same in all regions of a group.
    tops = large.groupBy("h").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("h", "lo")
    stars = (small.select("node", "n", "lo").unionByName(large.drop("lo").join(tops, "h").select("node", "n", "lo"))
             .where("node != lo").groupBy("node", F.col("lo").alias("pivot"))
             .agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n")))
    stars = stars.join(classes.select(F.col("node").alias("pivot"), F.col("n").alias("m")), "pivot")
    likely = ((F.col("c") + F.greatest(_beyond(F.col("n")), _beyond(F.col("m"))) >= _needed(F.col("n"), F.col("m")))
              & (F.least("n", "m") * DEN >= F.greatest("n", "m") * NUM))
    # One pivot per document, the one with which it shares most regions: enough
    # for labels, and every link that is not found here is among the pairs below.
    stars = (stars.where(likely).groupBy("node").agg(F.max_by("pivot", F.struct("c", "pivot")).alias("b"))
             .select(F.col("node").alias("a"), "b"))
    found = [_links(sets.compare(stars, "stars"))]
    labels = _labels(found[0])

    # What the stars left open in the regions of rarer shingles.
    extra = large.groupBy("node").agg(F.count(F.lit(1)).alias("extra"))
    open_ = _mixed(_labelled(small.select("h", "node", "n"), labels), "h")
    open_ = open_.join(extra, "node", "left").withColumn("extra", F.coalesce("extra", F.lit(0)))
    candidates = [_small_region_pairs(materialise(open_, "open-regions"))]

    # And in those of frequent shingles, recursively.
    # A prefix has n - _beyond(n) shingles; those not frequent are rarer.
    hot = large.groupBy("node").agg(F.collect_list("h").alias("hot"), F.first("n").alias("n"))
    prefixes = materialise(hot.select("node", "hot", (F.col("n") - _beyond(F.col("n")) - F.size("hot")).alias("rare")), "prefixes")
    rows = materialise(large.drop("hot").join(prefixes, "node").select(F.col("h").alias("region"), "h", "node", "n", "rare",
                                                                       F.lit(False).alias("stuck"), F.lit(True).alias("own")),
                       "frequent-rows")
    for depth in range(DEPTH):
        rows = materialise(_minorities(_able(_labelled(rows, labels))), "large-regions")
        # A pair has a member outside the main label: that many times the region's size are compared.
        small = F.col("others") * F.col("cnt") <= REGION * REGION
        done = F.lit(True) if depth == DEPTH - 1 else F.col("stuck") | small
        candidates.append(_large_region_pairs(rows.where(done), prefixes))
        rows = rows.where(~done)
        if rows.isEmpty():
            break
        pivots, compared = _meet_pivots(rows, sets, depth)
        found.append(_links(compared))
        labels = _labels(found[-1].unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
        # What the pivots have not connected: few enough to compare, or split further.
        rows = materialise(_minorities(_labelled(rows, labels)), "large-regions")
        small = F.col("others") * F.col("cnt") <= COMPARED
        candidates.append(_large_region_pairs(rows.where(small), prefixes))
        rows = rows.where(~small)
        if rows.isEmpty():
            break
        rows = _split(rows, pivots, compared)

    found.append(_links(sets.compare(reduce(DataFrame.unionByName, candidates), "candidates")))
    known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    roots = components(reduce(DataFrame.unionByName, [known, *found[-1:]]))
    met = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = met.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = materialise(met.join(lowest, "root").select(F.col("node").alias("__node"), "root", "component_id"),
                          "components")
    return (members.join(by_node, members["node"] == by_node["__node"], "left")
            .select("doc_id", *ROW_ID, "n", "root",
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def component_ids(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by
    links) of every row."""
    return join_rows(docs, text, key).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of every component, the one with the smallest doc_id (null
    last, then by row hash), with all its columns; documents without words all stay."""
    rows = materialise(join_rows(docs, text, key), "joined")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *ROW_ID)).alias("f")
    kept = rows.where("n > 0").groupBy("root").agg(first).select(*[F.col("f")[c].alias(c) for c in ROW_ID])
    tagged, own = with_row_id(docs), [field(c) for c in docs.columns]
    wordless = ~F.coalesce(field(text), F.lit("")).rlike(WORD)
    return (tagged.where(~wordless).join(kept, list(ROW_ID), "left_semi").dropDuplicates(list(ROW_ID)).select(*own)
            .unionByName(tagged.where(wordless).select(*own)))


__all__ = ["set_rows", "prefix_length", "join_rows", "component_ids", "keep_one"]
