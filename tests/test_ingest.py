"""Daily cycle from landed files: ingest every source, then run the models."""

import datetime as dt
import json

from hypeline.plans import ingest
from hypeline.plans.pipeline import run
from hypeline.sinks import read_table

LOAD = dt.datetime(2026, 1, 11, 10)


def _write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_files_to_summary(spark, scratch):
    root, lp, lg, lr, ls = scratch("wh"), scratch("lp"), scratch("lg"), scratch("lr"), scratch("ls")
    post = lambda pid, title, t: json.dumps({"post_id": pid, "subreddit": "nba", "title": title,
                                             "score": 5, "num_comments": 2, "url": "u", "selftext": "",
                                             "created_utc": t.replace(tzinfo=dt.timezone.utc).timestamp()})
    _write_lines(spark, lp, [post("p1", "[Highlight] Ann Lee scores", dt.datetime(2026, 1, 11, 3)),
                             post("p0", "old Ann Lee post", dt.datetime(2026, 1, 8, 9))])
    log = {"GAME_ID": "g1", "PLAYER_ID": 7, "PLAYER_NAME": "Ann Lee", "TEAM_ID": 1, "TEAM_ABBREVIATION": "LAL",
           "MATCHUP": "LAL @ BOS", "WL": "W", "SEASON_YEAR": "2025-26", "MIN": 30.5, "PTS": 20, "MIN_SEC": "30:30"}
    _write_lines(spark, lg, [json.dumps(dict(log, GAME_DATE="JAN 10, 2026")),
                             json.dumps(dict(log, GAME_ID="g2", GAME_DATE="someday"))])
    _write_lines(spark, lr, [json.dumps({"PERSON_ID": 7, "DISPLAY_FIRST_LAST": "Ann Lee", "FROM_YEAR": "2020",
                                         "TO_YEAR": "2026"})])
    doc = {"leagueSchedule": {"gameDates": [{"gameDate": "01/10/2026 00:00:00", "games": [
        {"gameId": "g1", "homeTeam": {"teamName": "Celtics", "teamId": 2},
         "awayTeam": {"teamName": "Lakers", "teamId": 1}, "gameDateTimeEst": "2026-01-10T19:30:00Z"}]}]}}
    _write_lines(spark, ls, [json.dumps(doc)])

    assert ingest.ingest_posts(spark, root, lp, LOAD)
    assert ingest.ingest_game_logs(spark, root, lg, LOAD, date="2026-01-10")
    assert ingest.ingest_player_list(spark, root, lr, LOAD)
    assert ingest.ingest_schedule(spark, root, ls, LOAD, date=dt.date(2026, 1, 10))
    assert [r.GAME_ID for r in read_table(spark, f"{root}/rejects/nba_game_logs").collect()] == ["g2"]
    assert [r.post_id for r in read_table(spark, f"{root}/raw/reddit_nba_posts").collect()] == ["p1"]

    paths = run(spark, root, "2026-01-10", full_refresh=True, games_from="2026-01-01", posts_from="2026-01-01")
    fct = read_table(spark, paths["fct_player_daily_summary"]).collect()
    assert [(r.player_name, r.opponent_team, r.travel_status, r.post_type, r.post_count, r.seconds_played)
            for r in fct] == [("Ann Lee", "BOS", "away", "Highlight", 1, 1830)]
    assert fct[0].game_start_utc.replace(tzinfo=None) == dt.datetime(2026, 1, 11, 0, 30)


def test_command_line_ingest(spark, scratch, capsys):
    from hypeline.__main__ import main
    root, lp = scratch("wh"), scratch("lp")
    _write_lines(spark, lp, [json.dumps({"post_id": "p1", "title": "Ann Lee", "score": 1, "num_comments": 1,
                                         "created_utc": dt.datetime(2026, 1, 11, 3, tzinfo=dt.timezone.utc).timestamp()})])
    main(["ingest", "--root", root, "--source", "posts", "--landing", lp, "--batch-ts", "2026-01-11T10:00:00"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"source": "posts", "loaded": True}
    posts = read_table(spark, f"{root}/raw/reddit_nba_posts").collect()
    assert [(r.post_id, r._loaded_at_utc.replace(tzinfo=None)) for r in posts] == [("p1", LOAD)]
