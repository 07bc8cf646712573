from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hypeline.llm import mixing

from .cases import SF, awkward, nothing, words


def targets(sizes, weights=(1, 2, 3), most=3):
    """Plain resharing: cap, share the excess by weight, repeat."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= most * sizes[s]}
        if not over:
            return {**{s: float(most * sizes[s]) for s in capped}, **share}
        capped |= over
        if len(capped) == len(order):
            return {s: float(most * sizes[s]) for s in order}


def check(docs):
    rows = mixing.mix_report(docs).collect()
    have = docs.select("doc_id", "text", "source").collect()
    assert Counter((r.doc_id, r.size, r.source) for r in rows) == Counter((d.doc_id, len(words(d.text)), d.source) for d in have)
    sizes, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    want = targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s] + 1
    return rows


def test_mix_against_plain_resharing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = check(docs)
    again = mixing.mix_report(docs.repartition(5)).collect()
    assert Counter(first) == Counter(again)


def test_mix_with_a_capped_source(spark):
    docs = spark.createDataFrame([(i, "w " * n, "en", s, 0) for i, (n, s) in enumerate(
        [(5, "a"), (500, "b"), (7, "c"), (900, "b"), (3, None)])], "doc_id long, text string, lang string, source string, n_chars long")
    rows = check(docs)
    assert {r.source: r.target for r in rows}["c"] == 21.0


def test_mix_awkward_rows(spark):
    docs = awkward(spark)
    rows = check(docs)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    emitted = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    planned = Counter()
    text = {(d.doc_id, len(words(d.text)), d.source): d.text for d in docs.collect()}
    for r in rows:
        if r.copies:
            planned[(r.doc_id, text[(r.doc_id, r.size, r.source)], r.source)] += r.copies
    assert sum(emitted.values()) == sum(planned.values())
    assert {k: v for k, v in emitted.items() if k[0] not in (None, 1, 2, 3)} == {
        k: v for k, v in planned.items() if k[0] not in (None, 1, 2, 3)}


def test_mix_empty(spark):
    assert mixing.mix_report(nothing(spark)).count() == 0
    assert mixing.mix(nothing(spark)).count() == 0


def test_mix_all_empty_texts(spark):
    docs = nothing(spark).select("doc_id", "text", "source").unionByName(
        spark.range(3).select(F.col("id").alias("doc_id"), F.lit("").alias("text"), F.lit("s").alias("source")))
    assert [(r.taken, r.target) for r in mixing.mix_report(docs).collect()] == [(0, 0.0)] * 3
