"""Driver queries: one per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or data Spark derives from them) in
full, except where a date filter is its subject and in ``incremental_runs``,
whose four dates are fixed (``incremental_cycle`` covers every post).  Computed columns carry the same aliases as the oracle SQL in
:mod:`hypeline.plans.oracles`.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypeline.functions import labels, parse, text
from hypeline.operators import (
    attribute_as_of,
    broadcast_if_small,
    conform,
    latest_snapshot,
    match_entities,
    roster,
    rolling_lookback,
    since,
    with_next_start,
)
from hypeline.plans import adapters, models
from hypeline.plans.adapters import table
from hypeline.plans.ingest import load_raw
from hypeline.plans.pipeline import run
from hypeline.session import scratch_path
from hypeline.sinks import append, insert_overwrite, materialize_table, merge_upsert, overwrite, read_table
from hypeline.sources.landing import land_game_logs, land_posts, union_batches
from hypeline.sources.schedule import flatten_schedule, has_key
from hypeline.streaming import is_folder, keep_latest, land_stream

RUN_DT = _dt.date(2024, 1, 15)


# -- W1 ----------------------------------------------------------------------
def q_latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Newest ship date per (order, line) of lineitem; every other column breaks ties."""
    li = table(spark, d, "lineitem")
    others = [c for c in li.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    return latest_snapshot(li, ["l_orderkey", "l_linenumber"], "l_shipdate", tie_break=others)


# -- S4 ----------------------------------------------------------------------
def q_rolling_lookback_48h(spark: SparkSession, d: str) -> DataFrame:
    """Events in the 48 hours before the newest event (a scalar subquery, no driver round trip)."""
    ev = table(spark, d, "events")
    as_of = ev.select(F.max("ts")).scalar()
    return rolling_lookback(ev, "ts", as_of, 48).select("event_id", "ts", "user_id", "event_type")


# -- J3 A2 (M5) ----------------------------------------------------------------
def _staged(spark: SparkSession, d: str):
    gl = models.stage_game_logs(adapters.raw_game_logs(spark, d))
    sc = models.stage_schedule(adapters.raw_schedule(spark, d))
    po = models.stage_posts(adapters.raw_posts(spark, d))
    return gl, sc, po


def q_entity_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Mentions model over documents as posts and benchmark passages as player names."""
    gl, _, po = _staged(spark, d)
    m = models.player_mentions(po, gl, unique_posts=True)
    return m.select("post_id", "matched_player", "subreddit", "created_utc", "created_date",
                    "num_comments", "score", "post_type")


# -- J3 beyond the broadcast bound -----------------------------------------------
def passage_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of one to five cleaned words: item i of ``benchmark`` gives
    ``1 + i % 5`` words from word ``i % 7`` on."""
    i = F.col("item_id")
    words = text.tokenize(text.clean_title("text"))
    cut = F.slice(words, (F.pmod(i, F.lit(7)) + 1).cast("int"), (F.pmod(i, F.lit(5)) + 1).cast("int"))
    return table(spark, d, "benchmark").select(F.array_join(cut, " ").alias("player_name"))


def q_entity_mentions_any_length(spark: SparkSession, d: str) -> DataFrame:
    """Names of any number of words in whole posts, by the path of a roster that is too
    large to broadcast: a bitmap of the roster, then a join shuffled on the n-gram."""
    posts = adapters.raw_posts(spark, d).select("post_id", "title")
    return match_entities(posts, roster(passage_names(spark, d), "player_name"), "post_id", "title",
                          broadcast_max_rows=0, any_length=True)


# -- W2 F8 -------------------------------------------------------------------
def q_next_start(spark: SparkSession, d: str) -> DataFrame:
    """Each purchase's next purchase time per user, or +7 days for the last one."""
    p = adapters.purchases(spark, d).select("event_id", "user_id", "ts")
    return with_next_start(p, "user_id", "ts", out="next_ts", tie_break=["event_id"])


# -- J4 ----------------------------------------------------------------------
def q_interval_attribution(spark: SparkSession, d: str) -> DataFrame:
    """Every non-purchase event attributed to its user's purchase interval [start, next)."""
    ev = table(spark, d, "events")
    iv = with_next_start(
        ev.where(F.col("event_type") == "purchase")
          .select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("p_user_id"),
                  F.col("ts").alias("start_ts")),
        "p_user_id", "start_ts", out="end_ts", tie_break=["purchase_id"])
    other = ev.where(F.col("event_type") != "purchase").select("event_id", "user_id", "ts", "event_type")
    hit = attribute_as_of(other, iv, [("user_id", "p_user_id")], "ts", "start_ts", "end_ts")
    return hit.select("event_id", "user_id", "ts", "event_type", "purchase_id", "start_ts", "end_ts")


# -- M5 M6 (flagship) ----------------------------------------------------------
def q_daily_summary(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: staging -> mentions -> engagement per player, game and post type."""
    gl, sc, po = _staged(spark, d)
    mentions = models.player_mentions(po, gl, unique_posts=True, title_ids=True)
    return models.player_daily_summary(gl, sc, mentions, adapters.GAMES_FROM, adapters.POSTS_FROM)


QUERIES = {
    "latest_snapshot": q_latest_snapshot,
    "rolling_lookback_48h": q_rolling_lookback_48h,
    "entity_mentions": q_entity_mentions,
    "entity_mentions_any_length": q_entity_mentions_any_length,
    "next_start": q_next_start,
    "interval_attribution": q_interval_attribution,
    "daily_summary": q_daily_summary,
}


# -- P1 P2 P3 ----------------------------------------------------------------
def q_conform_projection(spark: SparkSession, d: str) -> DataFrame:
    """Orders renamed to a contract with ids cast to string and the date to DATE."""
    return conform(table(spark, d, "orders"), [
        ("o_orderkey", "order_id", "string"), ("o_custkey", "customer_id", "string"),
        ("o_orderstatus", "status", None), ("o_totalprice", "total_price", None),
        ("o_orderdate", "order_date", "date"), ("o_orderpriority", "priority", None)])


# -- P4 / P5 F6 F7 ---------------------------------------------------------------
def q_since_run_date(spark: SparkSession, d: str) -> DataFrame:
    """Incremental gate: events on or after the run date."""
    return since(table(spark, d, "events"), "ts", RUN_DT).select("event_id", "ts", "user_id", "event_type")


def q_since_lookback(spark: SparkSession, d: str) -> DataFrame:
    """Incremental gate with one day of look-back, plus DATE(ts)."""
    ev = since(table(spark, d, "events"), "ts", RUN_DT, lookback_days=1)
    return ev.select("event_id", "ts", F.to_date("ts").alias("created_date"))


# -- F1 F15 P11 --------------------------------------------------------------------
def _clock_text(ev: DataFrame) -> DataFrame:
    mins = F.minute("ts") + F.pmod(F.col("event_id"), F.lit(3)) * 60
    txt = F.concat(mins.cast("string"), F.lit(":"), F.lpad(F.second("ts").cast("string"), 2, "0"))
    return ev.select("event_id", F.when(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit(None))
                     .otherwise(txt).alias("min_sec"))


def q_mmss_seconds(spark: SparkSession, d: str) -> DataFrame:
    """'MM:SS' clock text (NULL for some rows) to seconds, NULL -> 0."""
    ev = _clock_text(table(spark, d, "events"))
    return ev.select("event_id", "min_sec", parse.mmss_to_seconds("min_sec").alias("seconds_played"))


# -- F9 P10 ------------------------------------------------------------------------
def q_opponent_and_venue(spark: SparkSession, d: str) -> DataFrame:
    """Opponent and home/away from 'A vs. B' / 'A @ B' matchups built from customer nations."""
    nation = broadcast_if_small(table(spark, d, "nation").select("n_nationkey", "n_name"))
    c = table(spark, d, "customer").select(
        "c_custkey", "c_nationkey",
        F.pmod(F.col("c_nationkey") + 1 + F.pmod(F.col("c_custkey"), F.lit(24)), F.lit(25)).alias("opp_key"))
    home = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("team"))
    opp = nation.select(F.col("n_nationkey").alias("opp_key"), F.col("n_name").alias("opp_name"))
    j = c.join(home, "c_nationkey").join(opp, "opp_key")
    sep = F.when(F.pmod(F.col("c_custkey"), F.lit(2)) == 0, F.lit(" vs. ")).otherwise(F.lit(" @ "))
    matchup = F.when(F.pmod(F.col("c_custkey"), F.lit(50)) == 0, F.lit(None).cast("string")) \
               .otherwise(F.concat("team", sep, "opp_name"))
    j = j.select("c_custkey", "team", matchup.alias("matchup"))
    return j.select("c_custkey", "team", "matchup",
                    parse.opponent("matchup", "team").alias("opponent_team"),
                    labels.travel_status("matchup").alias("travel_status"))


# -- P8 P9 -------------------------------------------------------------------------
def q_post_type_label(spark: SparkSession, d: str) -> DataFrame:
    """First-match-wins post type from bracket tags, case-sensitive."""
    docs = table(spark, d, "documents")
    k = F.pmod(F.col("doc_id"), F.lit(5))
    tag = (F.when(k == 0, F.lit("[Highlight] ")).when(k == 1, F.lit("[Post Game Thread] "))
            .when(k == 2, F.lit("[Post Game Thread] [Highlight] ")).when(k == 3, F.lit("[highlight] "))
            .otherwise(F.lit("")))
    return docs.select("doc_id", labels.post_type(F.concat(tag, F.col("text"))).alias("post_type"))


# -- F10 ---------------------------------------------------------------------------
def q_multi_format_date(spark: SparkSession, d: str) -> DataFrame:
    """Order dates rendered in three spellings (and junk) parsed back."""
    o = table(spark, d, "orders")
    k = F.pmod(F.col("o_orderkey"), F.lit(4))
    raw = (F.when(k == 0, F.upper(F.date_format("o_orderdate", "MMM dd, yyyy")))
            .when(k == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
            .when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(F.pmod(F.col("o_orderkey"), F.lit(7)) == 0, F.lit("not a date"))
            .otherwise(F.date_format("o_orderdate", "M/d/yyyy")))
    o = o.select("o_orderkey", raw.alias("raw_date"))
    return o.select("o_orderkey", "raw_date", parse.parse_date_any("raw_date").alias("game_date"))


# -- F11 F12 -----------------------------------------------------------------------
def q_local_to_utc(spark: SparkSession, d: str) -> DataFrame:
    """Eastern wall-clock text (trailing Z, November DST fall-back) to UTC."""
    ev = table(spark, d, "events")
    wall = F.col("ts") + F.expr("INTERVAL 306 DAYS")   # lands in November: DST fall-back
    est = F.when(F.pmod(F.col("event_id"), F.lit(53)) == 0, F.lit("not a time")) \
           .otherwise(F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    ev = ev.select("event_id", est.alias("est_text"))
    return ev.select("event_id", "est_text",
                     parse.local_to_utc("est_text").cast("timestamp_ntz").alias("utc_start_time"))


# -- F13 ---------------------------------------------------------------------------
def q_season_label(spark: SparkSession, d: str) -> DataFrame:
    """Season label flipping in October for every order date."""
    return table(spark, d, "orders").select(
        "o_orderkey", parse.season_label(F.to_date("o_orderdate")).alias("season_year"))


# -- S3 F14 ------------------------------------------------------------------------
def q_epoch_to_ts(spark: SparkSession, d: str) -> DataFrame:
    """Timestamps to epoch seconds and back."""
    ev = table(spark, d, "events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch_s"))
    return ev.select("event_id", "epoch_s",
                     parse.epoch_to_ts("epoch_s").cast("timestamp_ntz").alias("created_utc"))


def q_land_posts(spark: SparkSession, d: str) -> DataFrame:
    """Fetched post records (epoch seconds) landed: 48 h window and load stamp."""
    docs = table(spark, d, "documents")
    fetched = docs.select(
        F.col("doc_id").cast("string").alias("post_id"), F.col("source").alias("subreddit"),
        F.col("text").alias("title"), F.col("n_chars").alias("score"),
        F.pmod(F.col("doc_id"), F.lit(97)).alias("num_comments"),
        (F.lit(1704067200) + F.pmod(F.col("doc_id"), F.lit(1000)) * 2580).alias("created_utc"),
        F.concat(F.lit("post/"), F.col("doc_id").cast("string")).alias("url"),
        F.concat("lang", F.lit(": "), "text").alias("selftext"))
    landed = land_posts(fetched, adapters.LOAD_TS, as_of=_dt.datetime(2024, 1, 20), lookback_hours=48)
    return landed.select("post_id", "subreddit", "title", "score", "num_comments", "url", "selftext",
                         F.col("created_utc").cast("timestamp_ntz").alias("created_utc"),
                         F.col("_loaded_at_utc").cast("timestamp_ntz").alias("_loaded_at_utc"))


# -- S9 ----------------------------------------------------------------------------
def q_json_key_presence(spark: SparkSession, d: str) -> DataFrame:
    """Key present / present-but-null / absent in a JSON object."""
    ev = table(spark, d, "events")
    k = F.pmod(F.col("event_id"), F.lit(3))
    doc = (F.when(k == 0, F.col("props")).when(k == 1, F.lit('{"k": null}'))
            .otherwise(F.lit('{"j": 1}')))
    ev = ev.select("event_id", doc.alias("doc"))
    return ev.select("event_id", has_key("doc", "k").alias("has_k"),
                     F.get_json_object("doc", "$.k").alias("k_value"))


# -- S6 S7 S8 ------------------------------------------------------------------------
def schedule_docs(spark: SparkSession, d: str) -> DataFrame:
    """One schedule document per event, with absent / null / malformed
    parts chosen by ``event_id``."""
    ev = table(spark, d, "events")
    m = lambda n: F.pmod(F.col("event_id"), F.lit(n))
    team = lambda off: F.struct(
        F.concat(F.lit("T"), F.pmod(F.col("user_id") + off, F.lit(30)).cast("string")).alias("teamName"),
        F.pmod(F.col("user_id") + off, F.lit(30)).alias("teamId"))
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    game = F.struct(
        F.col("event_id").cast("string").alias("gameId"),
        F.when(m(5) != 0, F.concat(F.lit("2"), F.year("ts").cast("string"))).alias("seasonId"),
        F.col("event_type").alias("gameStatusText"),
        F.when(m(4) != 0, F.concat(F.lit("Arena "), F.col("user_id").cast("string"))).alias("arenaName"),
        F.concat(F.lit("City "), F.pmod(F.col("user_id"), F.lit(10)).cast("string")).alias("arenaCity"),
        team(0).alias("homeTeam"),
        F.when(m(89) != 0, team(7)).alias("awayTeam"),
        F.when((m(3) == 0) & (m(31) != 0),
               F.concat(F.date_format("ts", iso), F.lit("Z"))).alias("gameDateTimeUTC"),
        F.when(m(3) == 1, F.concat(F.date_format(F.col("ts") - F.expr("INTERVAL 5 HOURS"), iso),
                                   F.lit("Z"))).alias("gameDateTimeEst"))
    day = (F.when(m(97) == 0, F.lit("garbage"))
            .when(m(2) == 0, F.concat(F.date_format("ts", "MM/dd/yyyy"), F.lit(" 00:00:00")))
            .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" 00:00:00"))))
    doc = F.to_json(F.struct(F.struct(F.array(F.struct(
        day.alias("gameDate"), F.array(game).alias("games"))).alias("gameDates")).alias("leagueSchedule")))
    # a key present with a null value (to_json drops null fields)
    doc = F.when((m(3) == 0) & (m(31) == 0),
                 F.replace(doc, F.lit('{"gameId":'), F.lit('{"gameDateTimeUTC":null,"gameId":'))) \
           .otherwise(doc)
    return ev.select(doc.alias("doc"))


def _games_out(games: DataFrame) -> DataFrame:
    return games.select(
        "game_id", "season_id", F.col("game_date").cast("date").alias("game_date"),
        "home_team", "home_team_id", "visitor_team", "visitor_team_id", "game_status",
        F.col("utc_start_time").cast("timestamp_ntz").alias("utc_start_time"), "arena_name", "city")


def q_json_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Nested schedule documents flattened to one row per game."""
    games, _ = flatten_schedule(schedule_docs(spark, d))
    return _games_out(games)


def q_json_flatten_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Days and games the schedule flattener rejects, with reasons."""
    _, rejects = flatten_schedule(schedule_docs(spark, d))
    return rejects.select("level", "raw_date", "reason",
                          F.get_json_object("game", "$.gameId").alias("game_id"))


def q_schedule_for_date(spark: SparkSession, d: str) -> DataFrame:
    """Flattened schedule restricted to one normalised day."""
    games, _ = flatten_schedule(schedule_docs(spark, d), target_date=RUN_DT)
    return _games_out(games)


# -- F2 F3 -------------------------------------------------------------------------
def q_clean_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned-title token statistics per document (whole texts)."""
    docs = (table(spark, d, "documents").select("doc_id", text.clean_title("text").alias("clean"))
            .select("doc_id", "clean", text.tokenize("clean").alias("toks")))   # split once
    return docs.select("doc_id", F.size("toks").alias("n_tokens"),
                       F.size(F.filter("toks", lambda t: t == "")).alias("n_empty"),
                       F.length("clean").alias("clean_chars"))


# -- F4 F5 J2 ------------------------------------------------------------------------
def q_ngrams_2_3(spark: SparkSession, d: str) -> DataFrame:
    """Counts of lower-cased 2- and 3-word n-grams per benchmark passage."""
    bm = table(spark, d, "benchmark")
    g = bm.select("item_id", F.explode(text.ngrams(text.tokenize(text.clean_title("text")))).alias("g"))
    g = g.select("item_id", F.lower("g").alias("ngram"), F.size(F.split("g", " ")).alias("n"))
    return g.groupBy("item_id", "ngram", "n").agg(F.count(F.lit(1)).alias("cnt"))


# -- A1 ----------------------------------------------------------------------------
def q_roster_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (name, match key) roster from the staged game logs."""
    gl = models.stage_game_logs(adapters.raw_game_logs(spark, d))
    return roster(gl, "player_name")


# -- J1 ----------------------------------------------------------------------------
def q_left_join_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Orders left-joined to one customer segment."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return o.join(c, "o_custkey", "left")


# -- A3 A4 A5 A6 ---------------------------------------------------------------------
def q_engagement_rollup(spark: SparkSession, d: str) -> DataFrame:
    """COUNT(DISTINCT) + SUM per (user, type, day), then summed per type."""
    ev = table(spark, d, "events")
    per = (ev.groupBy("user_id", "event_type", F.to_date("ts").alias("event_date"))
             .agg(F.count_distinct("props").alias("posts_count"),
                  F.sum(F.pmod(F.col("event_id"), F.lit(97))).alias("total_comments"),
                  F.count(F.lit(1)).alias("n_events")))
    return per.groupBy("event_type").agg(F.sum("posts_count").alias("post_count"),
                                         F.sum("total_comments").alias("total_comments"),
                                         F.sum("n_events").alias("n_events"))


QUERIES.update({
    "conform_projection": q_conform_projection,
    "since_run_date": q_since_run_date,
    "since_lookback": q_since_lookback,
    "mmss_seconds": q_mmss_seconds,
    "opponent_and_venue": q_opponent_and_venue,
    "post_type_label": q_post_type_label,
    "multi_format_date": q_multi_format_date,
    "local_to_utc": q_local_to_utc,
    "season_label": q_season_label,
    "epoch_to_ts": q_epoch_to_ts,
    "land_posts": q_land_posts,
    "json_key_presence": q_json_key_presence,
    "json_flatten": q_json_flatten,
    "json_flatten_rejects": q_json_flatten_rejects,
    "schedule_for_date": q_schedule_for_date,
    "clean_tokens": q_clean_tokens,
    "ngrams_2_3": q_ngrams_2_3,
    "roster_distinct": q_roster_distinct,
    "left_join_schedule": q_left_join_schedule,
    "engagement_rollup": q_engagement_rollup,
})


# -- sinks: K1-K10 ------------------------------------------------------------------
def _event_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("event_date"))


def _event_schema():
    return T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                         T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                         T.StructField("event_date", T.DateType())])


def _batch2(spark: SparkSession, d: str) -> DataFrame:
    """Second load: every third event from RUN_DT on, with a new value."""
    ev = since(_event_rows(spark, d), "event_date", RUN_DT)
    return ev.where(F.pmod(F.col("event_id"), F.lit(3)) == 0) \
             .withColumn("value", F.col("value") + F.lit(1000.0))


def q_union_additive(spark: SparkSession, d: str) -> DataFrame:
    """Union by name of two batches, one lacking a column."""
    ev = table(spark, d, "events")
    odd = F.pmod(F.col("event_id"), F.lit(2)) == 1
    return union_batches([ev.where(~odd).select("event_id", "event_type", "value"),
                          ev.where(odd).select("event_id", "event_type")])


def q_append_evolve(spark: SparkSession, d: str) -> DataFrame:
    """Two appends, the second adding a column; read back with schema merging."""
    ev = table(spark, d, "events")
    odd = F.pmod(F.col("event_id"), F.lit(2)) == 1
    path = scratch_path(spark, "append_evolve")
    append(ev.where(~odd).select("event_id", "event_type", "value"), path)
    append(ev.where(odd).select("event_id", "event_type", "value", "props"), path)
    return read_table(spark, path, merge_schema=True)


def q_empty_overwrite_noop(spark: SparkSession, d: str) -> DataFrame:
    """Overwrite, then an empty overwrite that must leave the table as it was."""
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "overwrite")
    overwrite(orders, path)
    if overwrite(orders.where(F.lit(False)), path):
        raise AssertionError("an empty batch must not truncate")
    return read_table(spark, path, orders.schema)


def q_full_refresh_clustered(spark: SparkSession, d: str) -> DataFrame:
    """Full-refresh write partitioned by priority and clustered, read back."""
    orders = table(spark, d, "orders")
    path = scratch_path(spark, "full_refresh")
    materialize_table(orders, path, ["o_orderpriority"], ["o_custkey", "o_orderkey"])
    return read_table(spark, path, orders.schema)


def q_insert_overwrite_days(spark: SparkSession, d: str) -> DataFrame:
    """Day partitions of a second batch replace the first load's days; others stay."""
    path = scratch_path(spark, "insert_overwrite")
    insert_overwrite(_event_rows(spark, d), path, "event_date")
    insert_overwrite(_batch2(spark, d), path, "event_date")
    return read_table(spark, path, _event_schema())


def q_merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Merge of a second batch into day-partitioned events: update, insert, keep."""
    path = scratch_path(spark, "merge")
    first = _event_rows(spark, d).where(F.pmod(F.col("event_id"), F.lit(2)) == 0)
    merge_upsert(spark, first, path, ["event_id"], partition_col="event_date")
    merge_upsert(spark, _batch2(spark, d), path, ["event_id"], partition_col="event_date")
    return read_table(spark, path, _event_schema())


def q_merge_vs_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Same initial table and batch under both strategies: insert_overwrite
    drops a day's rows absent from the batch, merge keeps them."""
    p_io, p_m = scratch_path(spark, "vs_io"), scratch_path(spark, "vs_merge")
    insert_overwrite(_event_rows(spark, d), p_io, "event_date")
    insert_overwrite(_batch2(spark, d), p_io, "event_date")
    merge_upsert(spark, _event_rows(spark, d), p_m, ["event_id"], partition_col="event_date")
    merge_upsert(spark, _batch2(spark, d), p_m, ["event_id"], partition_col="event_date")
    io = read_table(spark, p_io, _event_schema()).withColumn("strategy", F.lit("insert_overwrite"))
    m = read_table(spark, p_m, _event_schema()).withColumn("strategy", F.lit("merge"))
    return io.unionByName(m).select("strategy", "event_id", "event_date", "value")


QUERIES.update({
    "union_additive": q_union_additive,
    "append_evolve": q_append_evolve,
    "empty_overwrite_noop": q_empty_overwrite_noop,
    "full_refresh_clustered": q_full_refresh_clustered,
    "insert_overwrite_days": q_insert_overwrite_days,
    "merge_upsert": q_merge_upsert,
    "merge_vs_overwrite": q_merge_vs_overwrite,
})


# -- staging models M1-M4 -----------------------------------------------------------
LOAD2_TS = adapters.LOAD_TS + _dt.timedelta(days=1)


def _second_load(df: DataFrame, cond, **changes) -> DataFrame:
    out = df.where(cond)
    for name, col in changes.items():
        out = out.withColumn(name, col)
    return out.withColumn("_loaded_at_utc", F.lit(LOAD2_TS).cast("timestamp_ntz"))


def q_staged_game_logs(spark: SparkSession, d: str) -> DataFrame:
    """Staged game logs (incremental) over two loads: the later load wins."""
    raw = adapters.raw_game_logs(spark, d)
    raw = raw.unionByName(_second_load(raw, F.pmod(F.col("GAME_ID").cast("bigint"), F.lit(4)) == 0,
                                       MIN=F.col("MIN") + F.lit(1.0)))
    st = models.stage_game_logs(raw, RUN_DT, incremental=True)
    return st.select("game_id", "player_id", "game_date", "minutes_played", "seconds_played",
                     "_loaded_at_utc")


def raw_player_list(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("PERSON_ID"),
        F.concat(F.col("c_name"), F.lit(", X")).alias("DISPLAY_LAST_COMMA_FIRST"),
        F.col("c_name").alias("DISPLAY_FIRST_LAST"),
        (F.lit(1990) + F.pmod(F.col("c_custkey"), F.lit(30))).cast("string").alias("FROM_YEAR"),
        (F.lit(2000) + F.pmod(F.col("c_custkey"), F.lit(25))).cast("string").alias("TO_YEAR"),
        F.lower("c_name").alias("PLAYERCODE"),
        F.lit(adapters.LOAD_TS).cast("timestamp_ntz").alias("_loaded_at_utc"))


def q_staged_player_list(spark: SparkSession, d: str) -> DataFrame:
    """Staged roster over two loads: the later load wins."""
    raw = raw_player_list(spark, d)
    raw = raw.unionByName(_second_load(raw, F.pmod(F.col("PERSON_ID"), F.lit(3)) == 0,
                                       TO_YEAR=F.lit("2026")))
    return models.stage_player_list(raw)


def q_staged_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Staged schedule (incremental) over two loads: the later load wins."""
    raw = adapters.raw_schedule(spark, d)
    raw = raw.unionByName(_second_load(raw, F.pmod(F.col("game_id").cast("bigint"), F.lit(5)) == 0,
                                       utc_start_time=F.col("utc_start_time") + F.expr("INTERVAL 1 HOUR")))
    return models.stage_schedule(raw, RUN_DT, incremental=True)


def q_staged_posts(spark: SparkSession, d: str) -> DataFrame:
    """Staged posts (incremental, one day look-back) over two loads."""
    raw = adapters.raw_posts(spark, d)
    raw = raw.unionByName(_second_load(raw, F.pmod(F.col("post_id").cast("bigint"), F.lit(2)) == 0,
                                       score=F.col("score") + F.lit(100)))
    st = models.stage_posts(raw, RUN_DT, incremental=True)
    return st.select("post_id", "subreddit", "score", "num_comments", "url", "body",
                     "created_utc", "created_date", "_loaded_at_utc")


# -- M7: incremental runs over landed raw tables ------------------------------------
RUN_DAYS = [_dt.date(2024, 1, 12), _dt.date(2024, 1, 13), _dt.date(2024, 1, 14), _dt.date(2024, 1, 15)]


def land_static_fixture(spark: SparkSession, d: str, root: str) -> None:
    """Raw game logs, schedule and roster under ``root`` (loaded once)."""
    load_raw(adapters.raw_game_logs(spark, d), root, "nba_game_logs")
    load_raw(adapters.raw_schedule(spark, d), root, "nba_schedule")
    load_raw(raw_player_list(spark, d), root, "nba_player_list", "overwrite")


def land_post_load(spark: SparkSession, d: str, root: str, k: int, load_ts: _dt.datetime | None = None) -> None:
    """Post load ``k`` (by default at 10:00 of ``RUN_DAYS[k]``): the first holds
    all history up to its load time, later ones re-fetch the last 48 h with
    grown engagement."""
    posts = adapters.raw_posts(spark, d)
    load_ts = load_ts or _dt.datetime.combine(RUN_DAYS[k], _dt.time(10))
    at = F.lit(load_ts).cast("timestamp_ntz")
    batch = rolling_lookback(posts, "created_utc", at, 48, until=at) if k else \
        posts.where(F.col("created_utc") <= at)
    batch = (batch.withColumn("score", F.col("score") + F.lit(10 * k))
                  .withColumn("num_comments", F.col("num_comments") + F.lit(k))
                  .withColumn("_loaded_at_utc", F.lit(load_ts)))
    load_raw(batch, root, "reddit_nba_posts")


def q_incremental_runs(spark: SparkSession, d: str) -> DataFrame:
    """Daily cycle: land the day's posts, then run the whole pipeline --
    full refresh on the first day, incrementally on the next three.
    Returns the staged posts."""
    root = scratch_path(spark, "warehouse")
    land_static_fixture(spark, d, root)
    paths = {}
    for k, day in enumerate(RUN_DAYS):
        land_post_load(spark, d, root, k)
        paths = run(spark, root, day, full_refresh=(k == 0),
                    games_from=adapters.GAMES_FROM, posts_from=adapters.POSTS_FROM)
    st = read_table(spark, paths["stg_reddit_nba_posts"])
    return st.select("post_id", "score", "num_comments", "created_date",
                     F.col("_loaded_at_utc").cast("timestamp_ntz").alias("_loaded_at_utc"))


QUERIES.update({
    "staged_game_logs": q_staged_game_logs,
    "staged_player_list": q_staged_player_list,
    "staged_schedule": q_staged_schedule,
    "staged_posts": q_staged_posts,
    "incremental_runs": q_incremental_runs,
})


def cycle_days(spark: SparkSession, d: str) -> list[_dt.date]:
    """Logical dates of four daily runs, each loaded at 10:00 of the following
    day (as the reference schedules them), the last load after the newest post."""
    newest = adapters.raw_posts(spark, d).agg(F.max("created_utc")).first()[0]
    if newest is None:
        return RUN_DAYS
    last = (newest - _dt.timedelta(hours=10)).date()
    return [last - _dt.timedelta(days=n) for n in (3, 2, 1, 0)]


def q_incremental_cycle(spark: SparkSession, d: str) -> DataFrame:
    """Daily cycle over every post: a full refresh, then three incremental
    runs.  Returns the staged posts, the mentions and the daily summary that
    the cycle leaves, told apart by ``table_name``."""
    root = scratch_path(spark, "cycle")
    land_static_fixture(spark, d, root)
    paths = {}
    for k, day in enumerate(cycle_days(spark, d)):
        land_post_load(spark, d, root, k, _dt.datetime.combine(day + _dt.timedelta(days=1), _dt.time(10)))
        paths = run(spark, root, day, full_refresh=(k == 0),
                    games_from=adapters.GAMES_FROM, posts_from=adapters.POSTS_FROM)
    out = None
    for name in ("stg_reddit_nba_posts", "int_reddit_player_mentions", "fct_player_daily_summary"):
        part = read_table(spark, paths[name]).withColumn("table_name", F.lit(name))
        for c in ("created_utc", "game_start_utc", "_loaded_at_utc"):
            if c in part.columns:
                part = part.withColumn(c, F.col(c).cast("timestamp_ntz"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


QUERIES["incremental_cycle"] = q_incremental_cycle


# -- streaming landing ---------------------------------------------------------------
def q_stream_landing(spark: SparkSession, d: str) -> DataFrame:
    """Land ``events`` (one file or a folder of part files) with the streaming
    file source and the exactly-once Parquet file sink (AvailableNow), stamped
    with a fixed load time, and read the table back."""
    schema = table(spark, d, "events").schema
    target, ckpt = scratch_path(spark, "stream_target"), scratch_path(spark, "stream_ckpt")
    source = f"{d.rstrip('/')}/events.parquet"
    if is_folder(spark, source):
        land_stream(spark, source, schema, target, ckpt, batch_ts=adapters.LOAD_TS)
    else:
        land_stream(spark, d, schema, target, ckpt, glob="events.parquet", batch_ts=adapters.LOAD_TS)
    out = read_table(spark, target)
    return out.select("event_id", "user_id", "event_type", "ts",
                      F.col("_loaded_at_utc").cast("timestamp_ntz").alias("_loaded_at_utc"))


QUERIES["stream_landing"] = q_stream_landing


# -- W1 as a stream -----------------------------------------------------------------
FETCHES = 3              # fetches of twelve days, ten days apart; the last is open-ended


def land_fetch(spark: SparkSession, d: str, landing: str, k: int) -> None:
    """Land fetch ``k`` of every post: a fetch repeats two days of the one before, with other counts."""
    at = F.lit(adapters.POSTS_EPOCH).cast("timestamp_ntz")
    day = lambda n: at + F.make_dt_interval(F.lit(n))
    posts = adapters.raw_posts(spark, d).where(F.col("created_utc") >= day(10 * k))
    if k < FETCHES - 1:
        posts = posts.where(F.col("created_utc") < day(10 * k + 12))
    load = F.lit(adapters.LOAD_TS + _dt.timedelta(days=k)).cast("timestamp_ntz")
    (posts.withColumn("score", F.col("score") + k).withColumn("_loaded_at_utc", load)
          .withColumn("created_utc", F.col("created_utc").cast("timestamp"))
          .write.mode("append").parquet(landing))


def q_stream_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Newest snapshot per post, kept by a stateful stream over overlapping fetches, the second of them landed twice."""
    landing, target, ckpt = (scratch_path(spark, n) for n in ("fetches", "snapshots", "snapshots_ckpt"))
    for k in (0, 1, 1, 2):
        land_fetch(spark, d, landing, k)
        keep_latest(spark, landing, spark.read.parquet(landing).schema, target, ckpt, ["post_id"],
                    delay="72 hours", partition_col="created_date")
    out = read_table(spark, target)
    return out.select("post_id", "subreddit", "score", "num_comments", "url", F.md5("title").alias("title_md5"),
                      F.col("created_utc").cast("timestamp_ntz").alias("created_utc"), "created_date",
                      F.col("_loaded_at_utc").cast("timestamp_ntz").alias("_loaded_at_utc"))


QUERIES["stream_snapshots"] = q_stream_snapshots


# -- S5 S12 F10: game-log landing -------------------------------------------------------
def q_game_log_load(spark: SparkSession, d: str) -> DataFrame:
    """Three season-type batches (one lacking PLUS_MINUS, dates in three
    spellings, some unparseable) -> union -> season load selection."""
    raw = adapters.raw_game_logs(spark, d).drop("_loaded_at_utc")
    k = F.pmod(F.col("GAME_ID").cast("bigint"), F.lit(3))
    d0 = F.to_date("GAME_DATE")
    regular = raw.where(k == 0)
    playoffs = raw.where(k == 1).withColumn("GAME_DATE", F.upper(F.date_format(d0, "MMM dd, yyyy")))
    preseason = (raw.where(k == 2).drop("PLUS_MINUS")
                    .withColumn("GAME_DATE", F.when(F.pmod(F.col("GAME_ID").cast("bigint"), F.lit(7)) == 0,
                                                    F.lit("TBD")).otherwise(F.date_format(d0, "MM/dd/yyyy"))))
    rows, rejects, mode = land_game_logs(union_batches([regular, playoffs, preseason]),
                                         adapters.LOAD_TS, season="2023-24")
    assert mode == "overwrite"
    return rows.select("GAME_ID", "GAME_DATE", "PLUS_MINUS", "SEASON_YEAR",
                       F.col("_loaded_at_utc").cast("timestamp_ntz").alias("_loaded_at_utc"))


QUERIES["game_log_load"] = q_game_log_load
