import re
from collections import Counter

from pyspark.sql import functions as F

from hypeline.llm import rules

from .cases import SF, awkward, nothing, words


def expected(text):
    ws = words(text)
    windows = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    seen = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    n, chars, symbols = len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or ""))
    dup, upper = len(lines) - len(set(lines)), len(re.findall("[A-Z]", text or ""))
    base = n < 20 or 100 * len(covered) > 30 * n
    bad = (base or 100 * symbols > 50 * n or 100 * dup > 30 * len(lines) or not 2.5 * n <= chars <= 12 * n
           or 100 * upper > 50 * chars)
    return n, chars, symbols, dup, len(covered), base, not bad


def check(docs):
    rows = rules.rule_report(docs).collect()
    got = Counter(tuple(r) for r in rows)
    assert got == Counter((d["doc_id"], *expected(d["text"])) for d in docs.collect())


def test_report_against_brute_force(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(docs)
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(expected(r["text"])[-1] for r in docs.collect())


def test_repeats(spark):
    texts = ["a b c d e f g h", "a b c d e f g h " * 2, "x " * 9, "a b c d e f g h i a b c d e f g h i z z",
             "1 2 3 4 5 6 7 8 q r 1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_empty(spark):
    assert rules.rule_report(nothing(spark)).count() == 0


def test_order_by_rejection_per_cost():
    assert rules.order_rules([("a", 1.0, 0.1), ("b", 0.1, 0.1), ("c", 1.0, 0.5), ("d", 1.0, 0.0), ("e", 2.0, 0.0)]) == list("bcade")


def test_cascade_stops_at_the_first_rejection(spark):
    order = ["too_short", "explodes"]
    bad = {"too_short": rules.RULES["too_short"], "explodes": lambda m: F.raise_error(F.lit("reached")).cast("boolean")}
    df = spark.createDataFrame([("a b",)], "t string")
    values = rules.measures(F.col("t"))
    assert df.select(rules.first_failed(order, values, bad).alias("f")).first().f == "too_short"
