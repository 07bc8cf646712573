"""N-grams by shifted tokens equal the sliced ones, in generated code; the cleaning pattern equals the constant."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from hypeline.constants import TITLE_KEEP_CLASS
from hypeline.functions.text import clean_title, ngrams_of, tokenize
from hypeline.operators import match_entities, roster
from hypeline.operators.entities import WIDEST, text_ngrams

TEXTS = ["", " ", "a", "a b", "a  b", " a b c ", "a a a a a", "x" * 300, " ".join(f"w{i % 7}" for i in range(40)), None]


def counted(df):
    return Counter((r.id, r.match_name) for r in df.collect())


@pytest.mark.parametrize("sizes", [[1], [2, 3], [3, 1], [1, WIDEST, WIDEST + 1, 30], [WIDEST + 2], []])
def test_shifted_ngrams_equal_sliced_ones(spark, sizes):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    want = docs.select("id", F.explode(ngrams_of(tokenize("text"), sorted(sizes))).alias("match_name"))
    assert counted(text_ngrams(docs, "id", tokenize("text"), sizes)) == counted(want)


def test_first_word_bitmap_loses_no_match(spark):
    docs = spark.createDataFrame([(i, f"n{i} n{i + 1} n{i + 2}  n{i + 3} n{i}") for i in range(300)], "id int, text string")
    names = [f"N{i} n{i + 1}" for i in range(0, 300, 3)] + ["n5", "", " n9", "n7 n8 n9  n10 n7", " ".join(f"q{i}" for i in range(12))]
    rost = roster(spark.createDataFrame([(n,) for n in names], "player_name string"), "player_name")
    pairs = [sorted(map(tuple, match_entities(docs, rost, "id", "text", broadcast_max_rows=bound, any_length=True).collect()))
             for bound in (0, 500_000)]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 100 and (7, "n7 n8 n9  n10 n7") in pairs[0]


def test_every_kept_character_is_kept_and_no_other(spark):
    points = spark.range(1, 0x11000, 1, 4).where("id < 55296 or id > 57343").select(
        F.decode(F.encode(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')"), "UTF-8"), "UTF-8").alias("c"))
    text = F.concat(F.lit("a"), "c", "c", F.lit("b"))
    assert points.where(clean_title(text) != F.regexp_replace(text, TITLE_KEEP_CLASS, "")).count() == 0
    assert points.where(F.length(clean_title("c")) == 1).count() == 10 + 52 + 1 + 4 + 1 + 1


def test_ngrams_run_in_generated_code(spark):
    docs = spark.createDataFrame([(1, "Ann Lee")], "id int, text string")
    names = roster(spark.createDataFrame([("Ann Lee",)], "player_name string"), "player_name")
    for bound in (0, 500_000):
        plan = match_entities(docs, names, "id", "text", broadcast_max_rows=bound, any_length=True)._jdf.queryExecution().optimizedPlan().toString()
        assert "array_join" not in plan and "a-z" not in plan.lower().replace(TITLE_KEEP_CLASS.lower(), "a-z")
