"""The daily cycle lands and stages every post and matches those it lands last."""

from pyspark.sql import functions as F

from hypeline.plans import adapters, queries

SF = "/root/testdata/sf0.01"


def test_cycle_days_end_after_the_newest_post(spark):
    days = queries.cycle_days(spark, SF)
    newest = adapters.raw_posts(spark, SF).agg(F.max("created_utc")).first()[0]
    load = queries._dt.datetime.combine(days[-1] + queries._dt.timedelta(days=1), queries._dt.time(10))
    assert newest <= load and len(days) == 4


def test_cycle_stages_every_post(spark):
    out = queries.q_incremental_cycle(spark, SF).select("table_name", "post_id", "score", "created_utc")
    rows = out.collect()
    staged = [r.post_id for r in rows if r.table_name == "stg_reddit_nba_posts"]
    assert len(staged) == len(set(staged)) == adapters.raw_posts(spark, SF).count()
    assert {r.table_name for r in rows} == {"stg_reddit_nba_posts", "int_reddit_player_mentions",
                                            "fct_player_daily_summary"}
