import datetime as dt

from hypeline.operators import latest_snapshot

T1, T2 = dt.datetime(2026, 1, 1, 10), dt.datetime(2026, 1, 2, 10)


def test_newest_load_wins(spark):  # W-1
    df = spark.createDataFrame([("k", 1, T1), ("k", 2, T2)], "k string, v int, _loaded_at_utc timestamp")
    assert [r.v for r in latest_snapshot(df, ["k"]).collect()] == [2]


def test_ties_broken_deterministically(spark):  # W-2
    df = spark.createDataFrame([("k", 2, T1), ("k", 1, T1)], "k string, v int, _loaded_at_utc timestamp")
    for _ in range(3):
        assert [r.v for r in latest_snapshot(df, ["k"]).collect()] == [1]
    assert [r.v for r in latest_snapshot(df, ["k"], tie_break=[df.v.desc()]).collect()] == [2]


def test_null_load_time_sorts_last(spark):  # W-3
    df = spark.createDataFrame([("k", 1, None), ("k", 2, T1)], "k string, v int, _loaded_at_utc timestamp")
    assert [r.v for r in latest_snapshot(df, ["k"]).collect()] == [2]


def test_plan_trims_before_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v", "current_timestamp() AS _loaded_at_utc")
    plan = latest_snapshot(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_key_snapshot_equals_max_by(spark):
    from pyspark.sql import functions as F
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select(
        "event_id", "ts", "value",
        F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("k"))
    ours = latest_snapshot(ev, ["k"], "ts", tie_break=["event_id"]).select("k", "event_id")
    want = ev.groupBy("k").agg(F.max_by("event_id", F.struct(F.col("ts"), -F.col("event_id"))).alias("event_id"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, want.collect()))
