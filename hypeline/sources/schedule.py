"""Flatten the nested schedule document: days -> games -> one row per game.

Per game the reference distinguishes a key that is *absent* from a key
present with ``null``; ``from_json`` cannot, so each game is kept as raw JSON
text and key presence is read with ``json_object_keys``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypeline.constants import OPTIONAL_DEFAULT, SCHEDULE_DAY_FORMATS
from hypeline.functions.parse import local_to_utc, try_ts
from hypeline.sources.schemas import SCHEDULE_DOC, SCHEDULE_GAME


def has_key(json_text: "Column | str", key: str) -> Column:
    """True when the JSON object has ``key`` (even with a null value)."""
    c = F.col(json_text) if isinstance(json_text, str) else json_text
    return F.coalesce(F.array_contains(F.json_object_keys(c), F.lit(key)), F.lit(False))


def _in(keys: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(keys, F.lit(key)), F.lit(False))


def flatten_schedule(docs: DataFrame, doc_col: str = "doc", target_date=None):
    """Return ``(games, rejects)``.

    ``games`` has the raw schedule columns (``game_date`` as midnight
    timestamp).  A document without a list of days, a day whose ``gameDate`` does not parse and a game missing a
    required key (``gameId``, ``homeTeam``/``awayTeam`` with ``teamName`` and
    ``teamId``) or with an unusable Eastern time go to ``rejects`` with a
    reason.  ``target_date`` keeps one normalised day.
    """
    read = docs.select(F.col(doc_col).alias("__doc"), F.from_json(F.col(doc_col), SCHEDULE_DOC).alias("__d"))
    bad_docs = read.where(F.col("__d.leagueSchedule.gameDates").isNull()).select(
        F.lit("document").alias("level"), F.lit(None).cast("string").alias("raw_date"), F.col("__doc").alias("game"),
        F.lit("no leagueSchedule.gameDates").alias("reason"))
    days = (read.select(F.explode("__d.leagueSchedule.gameDates").alias("__day"))
                .select(F.col("__day.gameDate").alias("raw_date"), F.col("__day.games").alias("games")))
    date_part = F.split(F.col("raw_date"), " ")[0]
    slash_fmt, iso_fmt = SCHEDULE_DAY_FORMATS
    day = F.when(date_part.contains("/"), F.try_to_date(date_part, slash_fmt)) \
           .otherwise(F.try_to_date(date_part, iso_fmt))
    days = days.withColumn("__date", day)

    bad_days = days.where(F.col("__date").isNull()).select(
        F.lit("day").alias("level"), F.col("raw_date"), F.lit(None).cast("string").alias("game"),
        F.lit("unparseable gameDate").alias("reason"))

    good_days = days.where(F.col("__date").isNotNull())
    if target_date is not None:
        good_days = good_days.where(F.col("__date") == F.lit(target_date).cast("date"))
    g = F.col("game")
    # Parse each game once: its fields, and the key lists of the game and of
    # both team objects (presence tests are then array lookups).  Parsing inside
    # the generator fixes the result: as a projection it would be repeated in
    # every filter and column that names it.
    parsed = F.transform("games", lambda t: F.struct(
        t.alias("game"), F.from_json(t, SCHEDULE_GAME).alias("__g"), F.json_object_keys(t).alias("__k"),
        F.json_object_keys(F.get_json_object(t, "$.homeTeam")).alias("__hk"),
        F.json_object_keys(F.get_json_object(t, "$.awayTeam")).alias("__ak")))
    games = good_days.select("raw_date", "__date", F.explode(parsed).alias("__x")).select("raw_date", "__date", "__x.*")
    k, hk, ak = F.col("__k"), F.col("__hk"), F.col("__ak")
    required = (_in(k, "gameId") & _in(hk, "teamName") & _in(hk, "teamId")
                & _in(ak, "teamName") & _in(ak, "teamId"))
    has_utc, has_est = _in(k, "gameDateTimeUTC"), _in(k, "gameDateTimeEst")
    est = local_to_utc(F.col("__g.gameDateTimeEst"))
    games = games.withColumn("__reason", F.when(~required, F.lit("missing required key"))
                             .when(~has_utc & has_est & est.isNull(), F.lit("bad gameDateTimeEst")))

    bad_games = games.where(F.col("__reason").isNotNull()).select(
        F.lit("game").alias("level"), F.col("raw_date"), g, F.col("__reason").alias("reason"))

    p = F.col("__g")

    def optional(key: str) -> Column:
        # Default '' only when the key is absent; a present null stays NULL.
        return F.when(_in(k, key), p[key]).otherwise(F.lit(OPTIONAL_DEFAULT))

    out = games.where(F.col("__reason").isNull()).select(
        p["gameId"].alias("game_id"),
        optional("seasonId").alias("season_id"),
        F.col("__date").cast("timestamp").alias("game_date"),
        p["homeTeam"]["teamName"].alias("home_team"),
        p["homeTeam"]["teamId"].alias("home_team_id"),
        p["awayTeam"]["teamName"].alias("visitor_team"),
        p["awayTeam"]["teamId"].alias("visitor_team_id"),
        optional("gameStatusText").alias("game_status"),
        F.when(has_utc, try_ts(p["gameDateTimeUTC"])).when(has_est, est)
         .otherwise(F.lit(None).cast("timestamp")).alias("utc_start_time"),
        optional("arenaName").alias("arena_name"),
        optional("arenaCity").alias("city"),
    )
    return out, bad_docs.unionByName(bad_days).unionByName(bad_games)


def read_schedule_docs(spark, path: str) -> DataFrame:
    """One row per schedule document file (``doc`` column, whole file text)."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "doc")


def land_schedule(docs: DataFrame, batch_ts, date=None, season: str | None = None):
    """Select a schedule load: ``date`` keeps that day and appends; ``season``
    loads the whole document and overwrites (the season label only names the
    run -- it does not filter).  Exactly one of them is required.
    Returns ``(rows, rejects, mode)`` with rows stamped with ``batch_ts``."""
    from hypeline.sources.landing import stamp_loaded_at
    if (date is None) == (season is None):
        raise ValueError("land_schedule needs exactly one of date= or season=")
    games, rejects = flatten_schedule(docs, target_date=date)
    return stamp_loaded_at(games, batch_ts), rejects, ("append" if date is not None else "overwrite")
