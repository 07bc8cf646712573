"""Writes and landings lose nothing: merges, crashed builds, malformed input, new fields."""

import datetime as dt
import json

import pytest

from hypeline.operators.joins import fits_broadcast
from hypeline.plans import ingest, models
from hypeline.plans.pipeline import run
from hypeline.sinks import tables
from hypeline.sources import flatten_schedule, read_source

TS = dt.datetime(2026, 1, 10, 10)


def rows(spark, path, *cols):
    return sorted(tuple(r[c] for c in cols) for r in tables.read_table(spark, path).collect())


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def test_stale_staging_is_dropped_by_a_later_write(spark, scratch, monkeypatch):
    path = scratch("t")
    ddl = "k string, v int, d string"
    tables.materialize_table(frame(spark, [("a", 1, "x"), ("c", 7, "x")], ddl), path, ["d"])
    with monkeypatch.context() as m:
        m.setattr(tables, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            tables.merge_upsert(spark, frame(spark, [("a", 5, "x")], ddl), path, ["k"], "d")
    tables.materialize_table(frame(spark, [("a", 1, "x"), ("b", 2, "x"), ("z", 3, "y")], ddl), path, ["d"])
    tables.merge_upsert(spark, frame(spark, [("b", 9, "x")], ddl), path, ["k"], "d")
    assert rows(spark, path, "k", "v") == [("a", 1), ("b", 9), ("z", 3)]


@pytest.mark.parametrize("stop", ["publish", "delete"])
def test_interrupted_merge_is_finished(spark, scratch, monkeypatch, stop):
    path, ddl = scratch("t"), "k string, v int, d string"
    tables.materialize_table(frame(spark, [("a", 1, "x"), ("b", 2, "y")], ddl), path, ["d"])
    moved = frame(spark, [("a", 5, "y")], ddl)
    with monkeypatch.context() as m:
        if stop == "publish":
            m.setattr(tables, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        else:
            real = tables.delete
            m.setattr(tables, "delete", lambda s, p: real(s, p) if "/d=" not in p else (_ for _ in ()).throw(RuntimeError()))
        with pytest.raises(RuntimeError):
            tables.merge_upsert(spark, moved, path, ["k"], "d")
    tables.merge_upsert(spark, frame(spark, [("c", 3, "y")], ddl), path, ["k"], "d")
    assert rows(spark, path, "k", "v") == [("a", 5), ("b", 2), ("c", 3)]


@pytest.mark.parametrize("part", [None, "d"])
def test_merge_keeps_columns_the_batch_lacks(spark, scratch, part):
    path = scratch("t")
    tables.materialize_table(frame(spark, [("a", 1, "x", "old"), ("b", 2, "x", "kept")], "k string, v int, d string, extra string"),
                             path, [part] if part else [])
    tables.merge_upsert(spark, frame(spark, [("a", 5, "x", 1.5), ("n", 6, "x", 2.5)], "k string, v int, d string, more double"),
                        path, ["k"], part)
    got = {r["k"]: r for r in tables.read_table(spark, path, merge_schema=True).collect()}
    assert (got["a"]["v"], got["a"]["extra"], got["a"]["more"]) == (5, "old", 1.5)
    assert (got["b"]["extra"], got["b"]["more"], got["n"]["extra"]) == ("kept", None, None)


def test_moved_keys_leave_null_and_escaped_partitions(spark, scratch):
    path, ddl = scratch("t"), "k string, v int, d string"
    tables.materialize_table(frame(spark, [("a", 1, None), ("b", 2, "10:30/x"), ("c", 3, "z")], ddl), path, ["d"])
    tables.merge_upsert(spark, frame(spark, [("a", 5, "z"), ("b", 6, "z")], ddl), path, ["k"], "d")
    assert rows(spark, path, "k", "v", "d") == [("a", 5, "z"), ("b", 6, "z"), ("c", 3, "z")]


def test_a_crashed_first_build_is_not_a_table(spark, scratch):
    path = scratch("t")
    tables.touch(spark, f"{path}/_temporary/0/task")
    assert tables.table_exists(spark, path) and not tables.table_built(spark, path)
    tables.insert_overwrite(frame(spark, [("a", "x")], "k string, d string"), path, "d")
    assert tables.table_built(spark, path)


def test_run_needs_utc(spark, scratch):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            run(spark, scratch("root"), "2026-01-10")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_malformed_lines_are_rejects_and_new_fields_stay(spark, scratch, tmp_path):
    root = scratch("root")
    post = {"post_id": "p", "title": "t", "score": 1, "num_comments": 2, "created_utc": TS.timestamp(), "url": "u"}
    first, second = tmp_path / "a.json", tmp_path / "b.json"
    first.write_text("\n".join([json.dumps(post), "{broken", json.dumps(post | {"created_utc": "noon"}), '"text"', "", "null"]))
    second.write_text(json.dumps(post | {"post_id": "q", "flair": "GOAT"}))
    ingest.ingest_posts(spark, root, str(first), TS)
    ingest.ingest_posts(spark, root, str(second), TS)
    assert [r.post_id for r in read_source(spark, root, "reddit_nba_posts").orderBy("post_id").collect()] == ["p", "q"]
    both = {r.post_id: r.flair for r in read_source(spark, root, "reddit_nba_posts", extra=True).collect()}
    assert both == {"p": None, "q": "GOAT"}
    assert spark.read.parquet(f"{root}/rejects/reddit_nba_posts").count() == 4

    players = tmp_path / "p.json"
    players.write_text('{"PERSON_ID": 1, "DISPLAY_FIRST_LAST": "A B"}\n{broken')
    ingest.ingest_player_list(spark, root, str(players), TS)
    assert [r.PERSON_ID for r in read_source(spark, root, "nba_player_list").collect()] == [1]
    assert spark.read.parquet(f"{root}/rejects/nba_player_list").count() == 1


def test_broken_schedule_documents_are_rejects(spark):
    docs = spark.createDataFrame([("{broken",), ('{"x":1}',), (None,)], "doc string")
    games, rejects = flatten_schedule(docs)
    assert games.count() == 0
    assert [r.level for r in rejects.collect()] == ["document"] * 3


def test_mentions_match_each_row_by_its_own_title(spark):
    posts = spark.createDataFrame(
        [("p1", "s", "Ann Lee wins", "u", "b", TS, TS.date(), 1, 2), ("p1", "s", "edited: nothing", "u", "b", TS, TS.date(), 3, 4)],
        "post_id string, subreddit string, title string, url string, body string, created_utc timestamp, created_date date, "
        "num_comments long, score long")
    logs = spark.createDataFrame([("Ann Lee", TS.date())], "player_name string, game_date date")
    assert [r.title for r in models.player_mentions(posts, logs).collect()] == ["Ann Lee wins"]


def test_nested_values_count_for_the_broadcast_bound(spark):
    assert not fits_broadcast(spark.sql("SELECT array_repeat('x', 10000) AS a"), max_bytes=1000)


def test_one_digit_day_of_month(spark):
    from hypeline.functions import parse_date_any
    got = spark.createDataFrame([("NOV 9, 2025",), ("NOV 09, 2025",)], "c string").select(parse_date_any("c").alias("d"))
    assert {r.d for r in got.collect()} == {dt.date(2025, 11, 9)}
