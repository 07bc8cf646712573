"""Shape the driver's test tables into the pipeline's raw sources.

* game logs and schedule: ``events`` of type ``purchase`` (one game per
  purchase; the player is the user, named after a ``benchmark`` passage);
* posts: ``documents`` (title = whole text with a type tag by ``doc_id``).

Every column is derived with built-in expressions so the same rows can be
produced by the DuckDB oracle SQL in :mod:`hypeline.plans.oracles`.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypeline.functions.parse import season_label
from hypeline.functions.text import clean_title, tokenize
from hypeline.operators.joins import broadcast_if_small

# Fixed values of the adapter (mirrored in the oracle SQL).
LOAD_TS = _dt.datetime(2024, 2, 1, 10, 0, 0)
TEAMS = 30               # team number = user % 30
POSTS_EPOCH = _dt.datetime(2024, 1, 1)
POST_SPACING_MIN = 43    # created_utc = epoch + (doc_id % 1000) * 43 minutes
SCHEDULE_GAP = 10        # purchases with event_id % 10 = 0 lack a schedule row
GAMES_FROM = "2024-01-03"
POSTS_FROM = "2024-01-04"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def player_names(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """``events`` with the name of their user: with n passages, user u is named
    after 2 or 3 cleaned words of passage ``u % n``, starting at a word that
    moves on with ``u / n``.  Every passage gives names."""
    bm = table(spark, sf_dir, "benchmark")
    n = bm.count()
    words = bm.select("item_id", tokenize(clean_title(F.col("text"))).alias("__words"))
    length = F.lit(2) + F.pmod(F.col("item_id"), F.lit(2))
    start = F.pmod(F.floor(F.col("user_id") / n), F.size("__words") - length + 1) + 1
    return (events.withColumn("item_id", F.pmod(F.col("user_id"), F.lit(n)))
            .join(broadcast_if_small(words), "item_id")
            .withColumn("player_name", F.array_join(F.slice("__words", start.cast("int"), length.cast("int")), " "))
            .drop("__words"))


def _mod(c: str, m: int) -> Column:
    return F.pmod(F.col(c), F.lit(m))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")


def raw_game_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = player_names(spark, sf_dir, purchases(spark, sf_dir))
    team_no = _mod("user_id", TEAMS)
    opp_no = F.pmod(F.col("user_id") + 1 + _mod("event_id", TEAMS - 1), F.lit(TEAMS))
    team = F.concat(F.lit("T"), team_no.cast("string"))
    fgm, fg3m, ftm = _mod("event_id", 13), _mod("event_id", 4), _mod("event_id", 7)
    fga = fgm + 1 + _mod("user_id", 7)
    fg3a = fg3m + _mod("user_id", 3)
    fta = ftm + 1 + _mod("user_id", 3)
    oreb, dreb = _mod("event_id", 5), _mod("user_id", 9)
    pts = fgm * 2 + fg3m + ftm
    min_sec = F.concat(F.minute("ts").cast("string"), F.lit(":"),
                       F.lpad(F.second("ts").cast("string"), 2, "0"))
    return ev.select(
        season_label(F.to_date("ts")).alias("SEASON_YEAR"),
        F.col("user_id").alias("PLAYER_ID"),
        F.col("player_name").alias("PLAYER_NAME"),
        team_no.alias("TEAM_ID"),
        team.alias("TEAM_ABBREVIATION"),
        F.concat(F.lit("Team "), team_no.cast("string")).alias("TEAM_NAME"),
        F.col("event_id").cast("string").alias("GAME_ID"),
        F.date_format("ts", "yyyy-MM-dd").alias("GAME_DATE"),
        F.concat(team, F.when(_mod("event_id", 2) == 0, F.lit(" vs. ")).otherwise(F.lit(" @ ")),
                 F.lit("T"), opp_no.cast("string")).alias("MATCHUP"),
        F.when(_mod("event_id", 5) < 2, F.lit("W")).otherwise(F.lit("L")).alias("WL"),
        F.col("value").alias("MIN"),
        fgm.alias("FGM"), fga.alias("FGA"), (fgm / fga).alias("FG_PCT"),
        fg3m.alias("FG3M"), fg3a.alias("FG3A"),
        F.when(fg3a > 0, fg3m / fg3a).alias("FG3_PCT"),
        ftm.alias("FTM"), fta.alias("FTA"), (ftm / fta).alias("FT_PCT"),
        oreb.alias("OREB"), dreb.alias("DREB"), (oreb + dreb).alias("REB"),
        _mod("event_id", 11).alias("AST"), _mod("user_id", 4).alias("TOV"),
        _mod("event_id", 3).alias("STL"), _mod("user_id", 3).alias("BLK"),
        _mod("event_id", 2).alias("BLKA"), _mod("event_id", 6).alias("PF"),
        _mod("user_id", 5).alias("PFD"), pts.alias("PTS"),
        (_mod("event_id", 41) - 20).cast("double").alias("PLUS_MINUS"),
        F.col("value").alias("NBA_FANTASY_PTS"),
        F.when((pts >= 10) & (oreb + dreb >= 10), 1).otherwise(0).cast("bigint").alias("DD2"),
        F.lit(0).cast("bigint").alias("TD3"),
        F.col("value").alias("WNBA_FANTASY_PTS"),
        F.when(_mod("event_id", 11) == 0, F.lit(None).cast("string")).otherwise(min_sec).alias("MIN_SEC"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("_loaded_at_utc"),
    )


def raw_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = purchases(spark, sf_dir).where(_mod("event_id", SCHEDULE_GAP) != 0)
    return ev.select(
        F.col("event_id").cast("string").alias("game_id"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("game_date"),
        F.col("ts").alias("utc_start_time"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("_loaded_at_utc"),
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tag = (F.when(_mod("doc_id", 3) == 0, F.lit("[Highlight] "))
            .when(_mod("doc_id", 3) == 1, F.lit("[Post Game Thread] ")).otherwise(F.lit("")))
    created = (F.lit(POSTS_EPOCH).cast("timestamp_ntz")
               + F.make_dt_interval(F.lit(0), F.lit(0), _mod("doc_id", 1000) * POST_SPACING_MIN))
    return docs.select(
        F.col("doc_id").cast("string").alias("post_id"),
        F.col("source").alias("subreddit"),
        F.concat(tag, F.col("text")).alias("title"),
        F.col("n_chars").alias("score"),
        _mod("doc_id", 97).alias("num_comments"),
        created.alias("created_utc"),
        F.concat(F.lit("post/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("lang").alias("selftext"),
        F.lit(LOAD_TS).cast("timestamp_ntz").alias("_loaded_at_utc"),
    )
