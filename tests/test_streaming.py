import datetime as dt

from hypeline.sinks import read_table
from hypeline.streaming import land_stream

LOAD = dt.datetime(2026, 1, 1, 10)


def test_stream_landing_is_exactly_once_across_restarts(spark, scratch):
    src, target, ckpt = scratch("src"), scratch("tgt"), scratch("ckpt")
    schema = "post_id string, score long"
    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.mode("append").parquet(src)
    n = land_stream(spark, src, spark.createDataFrame([], schema).schema, target, ckpt,
                    batch_ts=LOAD)
    assert n >= 1
    # restart with nothing new: no batch, no duplicates
    land_stream(spark, src, spark.createDataFrame([], schema).schema, target, ckpt, batch_ts=LOAD)
    spark.createDataFrame([("c", 3)], schema).write.mode("append").parquet(src)
    land_stream(spark, src, spark.createDataFrame([], schema).schema, target, ckpt, batch_ts=LOAD)
    got = sorted((r.post_id, r.score) for r in read_table(spark, target).collect())
    assert got == [("a", 1), ("b", 2), ("c", 3)]
    assert {r._loaded_at_utc.replace(tzinfo=None) for r in read_table(spark, target).collect()} == {LOAD}


def test_stream_landing_stamps_one_time_per_batch(spark, scratch):
    src, target, ckpt = scratch("src"), scratch("tgt"), scratch("ckpt")
    schema = "post_id string, score long"
    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.mode("append").parquet(src)
    land_stream(spark, src, spark.createDataFrame([], schema).schema, target, ckpt)
    stamps = {r._loaded_at_utc for r in read_table(spark, target).collect()}
    assert len(stamps) == 1


def test_stream_query_lands_a_file_and_a_folder_of_parts(spark, scratch):
    from hypeline.plans.queries import q_stream_landing
    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet")
    want = sorted(r.event_id for r in events.select("event_id").collect())
    folder = scratch("sf")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    for d in (sf, folder, folder + "/"):
        assert sorted(r.event_id for r in q_stream_landing(spark, d).select("event_id").collect()) == want


POST = "post_id string, created_utc timestamp, score long, _loaded_at_utc timestamp"
T0 = dt.datetime(2026, 1, 1, 10)


def _fetch(n, posts, shift=0):
    """Rows of the 48 h fetch on day ``n``: post i is created six hours after post i - 1."""
    at = T0 + dt.timedelta(days=n)
    created = lambda i: T0 - dt.timedelta(days=2) + dt.timedelta(hours=6 * i)
    return [(f"p{i}", created(i), 100 * n + i + shift, at) for i in range(posts)
            if at - dt.timedelta(hours=48) <= created(i) <= at]


def _stream(spark, src, tgt, ckpt):
    from hypeline.streaming import keep_latest
    keep_latest(spark, src, spark.createDataFrame([], POST).schema, tgt, ckpt, ["post_id"], partition_col="created_date")


def test_stream_of_overlapping_fetches_equals_the_snapshot_of_their_union(spark, scratch):
    from hypeline.operators import latest_snapshot
    src, tgt, ckpt = scratch("src"), scratch("tgt"), scratch("ckpt")
    fetches = [_fetch(0, 40), _fetch(1, 40), _fetch(2, 40), _fetch(0, 40), _fetch(5, 40), _fetch(1, 40)]  # two landed again
    seen = []
    for rows in fetches:
        seen += rows
        spark.createDataFrame(rows, POST).coalesce(1).write.mode("append").parquet(src)
        _stream(spark, src, tgt, ckpt)
        want = latest_snapshot(spark.createDataFrame(seen, POST), ["post_id"]).collect()
        got = read_table(spark, tgt).select("post_id", "created_utc", "score", "_loaded_at_utc").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    _stream(spark, src, tgt, ckpt)                        # nothing new
    assert read_table(spark, tgt).count() == len(want)


def test_stream_state_breaks_ties_as_the_snapshot_does(spark, scratch):
    from hypeline.operators import latest_snapshot
    src, tgt, ckpt = scratch("src"), scratch("tgt"), scratch("ckpt")
    data = [("a", T0, 5, T0), ("a", T0, 3, T0), ("a", T0, None, T0), ("b", T0, 1, None), ("b", T0, 2, T0),
            ("b", T0, 2, T0), (None, T0, 7, T0), ("c", None, 1, T0)]
    spark.createDataFrame(data, POST).write.parquet(src)
    _stream(spark, src, tgt, ckpt)
    want = latest_snapshot(spark.createDataFrame(data, POST).where("created_utc IS NOT NULL"), ["post_id"])
    got = read_table(spark, tgt).select("post_id", "created_utc", "score", "_loaded_at_utc")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_state_drops_posts_behind_the_watermark(spark, scratch):
    import json
    src, tgt, ckpt = scratch("src"), scratch("tgt"), scratch("ckpt")
    from hypeline.streaming import newest_per_key
    schema = spark.createDataFrame([], POST).schema
    kept = []
    for n in (0, 10, 20):
        spark.createDataFrame(_fetch(n, 100), POST).coalesce(1).write.mode("append").parquet(src)
        q = (newest_per_key(spark.readStream.schema(schema).parquet(src), ["post_id"]).writeStream
             .outputMode("update").format("noop").option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        kept.append(json.loads(q.lastProgress.json)["stateOperators"][0]["numRowsTotal"])
    # A fetch has nine posts; the one exactly 48 h older than the newest is at the watermark, and goes.
    assert kept == [8, 8, 8]                              # no more, however many fetches came before
