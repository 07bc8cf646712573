import datetime as dt
import json

from hypeline.sources import flatten_schedule


def _doc(games, game_date="01/20/2026 00:00:00"):
    return json.dumps({"leagueSchedule": {"gameDates": [{"gameDate": game_date, "games": games}]}})


TEAM = {"teamName": "Lakers", "teamId": 1610612747}
AWAY = {"teamName": "Celtics", "teamId": 1610612738}


def _flatten(spark, docs, **kw):
    games, rejects = flatten_schedule(spark.createDataFrame([(d,) for d in docs], "doc string"), **kw)
    return {r.game_id: r for r in games.collect()}, rejects.collect()


def test_utc_key_present_but_null_wins(spark):  # N-1
    g = {"gameId": "1", "homeTeam": TEAM, "awayTeam": AWAY, "gameDateTimeUTC": None,
         "gameDateTimeEst": "2026-01-20T19:30:00Z"}
    games, _ = _flatten(spark, [_doc([g])])
    assert games["1"].utc_start_time is None


def test_eastern_fallback_and_utc(spark):
    est = {"gameId": "1", "homeTeam": TEAM, "awayTeam": AWAY, "gameDateTimeEst": "2026-01-20T19:30:00Z"}
    utc = {"gameId": "2", "homeTeam": TEAM, "awayTeam": AWAY, "gameDateTimeUTC": "2026-01-21T03:00:00Z"}
    games, _ = _flatten(spark, [_doc([est, utc])])
    assert games["1"].utc_start_time.replace(tzinfo=None) == dt.datetime(2026, 1, 21, 0, 30)
    assert games["2"].utc_start_time.replace(tzinfo=None) == dt.datetime(2026, 1, 21, 3, 0)


def test_rejects_missing_team_and_bad_day(spark):  # N-2
    ok = {"gameId": "1", "homeTeam": TEAM, "awayTeam": AWAY}
    no_away = {"gameId": "2", "homeTeam": TEAM}
    games, rejects = _flatten(spark, [_doc([ok, no_away]), _doc([ok], game_date="someday")])
    assert set(games) == {"1"}
    assert sorted((r.level, r.reason) for r in rejects) == [
        ("day", "unparseable gameDate"), ("game", "missing required key")]


def test_optional_defaults_only_when_absent(spark):  # N-3
    g = {"gameId": "1", "homeTeam": TEAM, "awayTeam": AWAY, "seasonId": None, "arenaCity": "LA"}
    games, _ = _flatten(spark, [_doc([g], game_date="2026-01-20 00:00:00")])
    r = games["1"]
    assert (r.arena_name, r.season_id, r.city, r.game_status) == ("", None, "LA", "")
    assert r.game_date.date() == dt.date(2026, 1, 20)


def test_target_date_filter(spark):
    g = {"gameId": "1", "homeTeam": TEAM, "awayTeam": AWAY}
    docs = [_doc([g]), _doc([dict(g, gameId="2")], game_date="2026-01-21 00:00:00")]
    games, _ = _flatten(spark, docs, target_date="2026-01-21")
    assert set(games) == {"2"}


def test_land_schedule_modes(spark, scratch):
    from hypeline.sources import land_schedule, read_schedule_docs
    p = scratch("docs")
    g = {"gameId": "1", "homeTeam": TEAM, "awayTeam": AWAY}
    for doc in (_doc([g]), json.dumps(json.loads(_doc([dict(g, gameId="2")], "2026-01-21 00:00:00")), indent=2)):
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("append").text(p)
    docs = read_schedule_docs(spark, p)
    load = dt.datetime(2026, 1, 22, 10)
    rows, _, mode = land_schedule(docs, load, date=dt.date(2026, 1, 21))
    assert mode == "append" and [r.game_id for r in rows.collect()] == ["2"]
    rows, _, mode = land_schedule(docs, load, season="2025-26")
    assert mode == "overwrite" and sorted(r.game_id for r in rows.collect()) == ["1", "2"]
    assert {r._loaded_at_utc.replace(tzinfo=None) for r in rows.collect()} == {load}


def test_each_game_is_parsed_once(spark):
    from hypeline.sources import flatten_schedule
    games, rejects = flatten_schedule(spark.createDataFrame([("{}",)], "doc string"))
    for df in (games, rejects.where("level = 'game'")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField(gameId") <= 1
