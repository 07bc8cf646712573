"""Quality rules as a short-circuit cascade.

Every rule is a DataFrame expression that is true for a document that fails
it.  A sample gives each rule's cost (measured time) and selectivity (share of
documents it rejects); rules run in the order of rejection per cost, inside
one ``CASE`` expression, so a document pays only for the rules up to the first
that rejects it.  The verdict does not depend on the order.

Null and empty cases: a null text has no words, lines or symbols (all counts
0) and fails ``too_short`` like an empty one; a rule that yields null does not
reject; an empty table gives no rows and keeps the declared order.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypeline.llm.common import WORD, discard, field, materialise

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30       # words in repeated windows
MAX_SYMBOLS_PERCENT = 50      # symbols per word
MAX_DUP_LINE_PERCENT = 30     # repeated lines among lines with a word
WORD_LENGTH = (2.5, 12.0)     # mean code points per word
MAX_UPPER_PERCENT = 50        # A-Z among the characters of words
WINDOW = 8
SYMBOLS = "[^#*$%&|<>]+"      # what is removed to leave the symbols
SAMPLE_ROWS = 2000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def repeated_window_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` consecutive words found at least
    twice in the text, the first find included.

    Windows are hashed; hashes are sorted with their positions, equal
    neighbours mark repeated windows, and the positions' union is summed.
    Everything is n log n in the number of words of one text.
    """
    def covered(wins: Column) -> Column:
        ordered = F.sort_array(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            twin = lambda x, i: F.when((x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"])
            return F.sort_array(F.filter(F.transform(s, twin), lambda p: p.isNotNull()))

        zero = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        return F.aggregate(let(ordered, marked), zero,
                           lambda a, p: F.struct((a["n"] + F.least(F.lit(width), p - a["last"])).alias("n"),
                                                 p.alias("last")), lambda a: a["n"])

    def windows(h: Column) -> Column:
        wins = F.transform(F.sequence(F.lit(1), F.size(h) - (width - 1)),
                           lambda i: F.xxhash64(F.slice(h, i, width)))
        return F.when(F.size(h) <= width, F.lit(0)).otherwise(
            let(wins, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), windows).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(WORD))


def measures(text: Column) -> dict[str, Column]:
    """The counts that rules are made of, as expressions over the text."""
    body = F.coalesce(text, F.lit(""))
    return {
        "n_words": F.size(words_of(body)).cast("long"),
        "word_chars": F.length(F.array_join(words_of(body), "")).cast("long"),
        "n_symbols": F.octet_length(F.regexp_replace(body, SYMBOLS, "")).cast("long"),
        "n_dup_lines": let(_lines(body), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_window_words(words_of(body)),
        "n_lines": F.size(_lines(body)).cast("long"),
        "n_upper": F.octet_length(F.regexp_replace(body, "[^A-Z]+", "")).cast("long"),
    }


Rule = Callable[[dict[str, Column]], Column]

BASE: dict[str, Rule] = {
    "too_short": lambda m: m["n_words"] < MIN_WORDS,
    "repetitive": lambda m: m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT,
}
RULES: dict[str, Rule] = {
    **BASE,
    "symbols": lambda m: m["n_symbols"] * 100 > m["n_words"] * MAX_SYMBOLS_PERCENT,
    "dup_lines": lambda m: m["n_dup_lines"] * 100 > m["n_lines"] * MAX_DUP_LINE_PERCENT,
    "word_length": lambda m: ~m["word_chars"].between(m["n_words"] * WORD_LENGTH[0], m["n_words"] * WORD_LENGTH[1]),
    "shouting": lambda m: m["n_upper"] * 100 > m["word_chars"] * MAX_UPPER_PERCENT,
}


def estimate(docs: DataFrame, text: str = "text", rules: dict[str, Rule] = RULES,
             sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds per sampled document, share rejected) for each rule,
    measured one by one on a sample of about ``sample_rows`` documents."""
    total = docs.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    # Dealt by a shuffle of the sample: a coalesce would make eight tasks of the scan of the whole table.
    sample = materialise(docs.sample(share, seed=1).select(field(text).alias("__text")).repartition(8), "rule-sample")
    out = []
    for name, rule in rules.items():
        failed = F.coalesce(rule(measures(F.col("__text"))), F.lit(False))
        job = sample.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(failed, 1)).alias("bad"))
        job.first()                            # generates and compiles the rule's code, which is not its cost
        started = time.perf_counter()
        row = job.first()
        out.append((name, (time.perf_counter() - started) / max(row["n"], 1), row["bad"] / max(row["n"], 1)))
    discard(sample)
    return out


def order_rules(estimates: list[tuple[str, float, float]]) -> list[str]:
    """Rules by rejected share per cost, highest first; ties by name."""
    return [name for name, cost, bad in sorted(estimates, key=lambda e: (-e[2] / max(e[1], 1e-12), e[0]))]


def first_failed(order: list[str], values: dict[str, Column], rules: dict[str, Rule] = RULES) -> Column:
    """Name of the first rule in ``order`` that rejects, or null.  CASE stops at
    the first true branch."""
    out = None
    for name in order:
        test = rules[name](values)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out if out is not None else F.lit(None).cast("string")


def keep_good(docs: DataFrame, text: str = "text", rules: dict[str, Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    order = order_rules(estimate(docs, text, rules))
    return docs.where(first_failed(order, measures(field(text)), rules).isNull())


def rule_report(docs: DataFrame, text: str = "text", key: str = "doc_id",
                rules: dict[str, Rule] = RULES) -> DataFrame:
    """One row per document: the counts, whether a base rule fails, and the
    cascade's verdict.  Reported counts are computed once per document; the
    others only where the cascade reaches a rule that needs them."""
    order = order_rules(estimate(docs, text, rules))
    body = field(text)
    every = measures(F.col("__text"))
    words = docs.select(field(key).alias("doc_id"), body.alias("__text"), words_of(body).alias("__words"))
    counted = words.select(
        "doc_id", "__text",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        every["n_symbols"].alias("n_symbols"), every["n_dup_lines"].alias("n_dup_lines"),
        repeated_window_words(F.col("__words")).alias("n_repeat_words"))
    reported = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    values = {**every, **{c: F.col(c) for c in reported}}
    base = F.lit(False)
    for rule in BASE.values():
        base = base | rule(values)
    return counted.select("doc_id", *reported, base.alias("base_failed"),
                          first_failed(order, values, rules).isNull().alias("kept"))


__all__ = ["RULES", "BASE", "estimate", "order_rules", "first_failed", "keep_good", "rule_report",
           "measures", "repeated_window_words"]
