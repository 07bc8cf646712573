import datetime as dt

import pytest
from pyspark.sql import functions as F

from hypeline.functions import (
    clean_title, local_to_utc, mmss_to_seconds, ngrams, opponent, parse_date_any,
    post_type, season_label, tokenize, travel_status,
)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_mmss_to_seconds(spark):  # F-1
    assert one(spark, [("35:08",), (None,)], "m string", mmss_to_seconds("m")) == [2108, 0]


@pytest.mark.parametrize("bad", ["35", ""])
def test_mmss_to_seconds_rejects_malformed(spark, bad):  # F-2
    with pytest.raises(Exception):
        one(spark, [(bad,)], "m string", mmss_to_seconds("m"))


def test_clean_title(spark):  # F-3
    t = "[Highlight] Luka Dončić & Karl-Anthony Towns' De'Aaron Fox P.J."
    assert one(spark, [(t,)], "t string", clean_title("t")) == [
        "Highlight Luka Doni  Karl-Anthony Towns DeAaron Fox PJ"]


def test_clean_title_keeps_re2_whitespace_only(spark):
    assert one(spark, [("a\tb\x0bc",)], "t string", clean_title("t")) == ["a\tbc"]


def test_tokenize_double_space(spark):
    assert one(spark, [("a  b",)], "t string", tokenize("t")) == [["a", "", "b"]]


def test_ngrams(spark):  # F-4
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), (None,)], "w array<string>")
    got = [r[0] for r in df.select(ngrams("w")).collect()]
    assert sorted(got[0]) == ["a b", "a b c", "b c"]
    assert got[1] == []
    assert got[2] is None
    assert df.select(F.explode(ngrams("w"))).count() == 3


def test_parse_date_any(spark):  # F-5
    got = one(spark, [("NOV 09, 2025",), ("11/09/2025",), ("2025-11-09",), ("2025-11-09T19:30:00",),
                      ("zz",)], "d string", parse_date_any("d"))
    assert got == [dt.date(2025, 11, 9)] * 4 + [None]


def test_season_label(spark):  # F-6
    rows = [(dt.date(1999, 12, 1),), (dt.date(2025, 10, 22),), (dt.date(2026, 9, 30),)]
    assert one(spark, rows, "d date", season_label("d")) == ["1999-00", "2025-26", "2025-26"]


def test_local_to_utc(spark):  # F-7
    rows = [("2026-01-20T19:30:00Z",), ("2025-11-02T01:30:00",), ("2025-03-09T02:30:00",), ("nope",),
            ("2026-01-20T19:30:00+05:00",), ("2026-01-20 19:30",), ("2026-01-20",)]
    got = one(spark, rows, "s string", local_to_utc("s").cast("timestamp_ntz"))
    assert got == [dt.datetime(2026, 1, 21, 0, 30), dt.datetime(2025, 11, 2, 6, 30),
                   dt.datetime(2025, 3, 9, 7, 30), None, None, dt.datetime(2026, 1, 21, 0, 30),
                   dt.datetime(2026, 1, 20, 5, 0)]
    daylight = one(spark, [("2025-11-02T01:30:00",)], "s string",
                   local_to_utc("s", ambiguous="daylight").cast("timestamp_ntz"))
    assert daylight == [dt.datetime(2025, 11, 2, 5, 30)]


def test_opponent_and_travel(spark):  # F-8
    df = spark.createDataFrame([("LAL vs. BOS", "LAL"), ("LAL @ BOS", "LAL"), (None, "LAL"),
                                ("N1 vs. N12", "N1")], "m string, t string")
    got = df.select(opponent("m", "t"), travel_status("m")).collect()
    assert [tuple(r) for r in got] == [("BOS", "home"), ("BOS", "away"), (None, "home"), ("2", "home")]


def test_post_type(spark):  # F-9
    rows = [("[Highlight] x",), ("[Post Game Thread] x",), ("[Post Game Thread] [Highlight]",),
            ("[highlight] x",), (None,)]
    assert one(spark, rows, "t string", post_type("t")) == [
        "Highlight", "Post Game Thread", "Highlight", "Other", "Other"]
