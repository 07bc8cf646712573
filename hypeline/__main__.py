"""Command line.

``python -m hypeline ingest --root DIR --source posts|game_logs|player_list|schedule --landing PATH``
lands one fetched batch into ``DIR/raw``; ``python -m hypeline run --root DIR
--run-dt YYYY-MM-DD [--full-refresh]`` runs every model for one logical date.
"""

from __future__ import annotations

import argparse
import json

import datetime as dt

from hypeline.plans import ingest
from hypeline.constants import DEFAULT_RUN_DT, GAMES_FROM, POSTS_FROM
from hypeline.plans.pipeline import run
from hypeline.session import get_spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="hypeline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="run all models for one run date")
    r.add_argument("--root", required=True)
    r.add_argument("--run-dt", default=DEFAULT_RUN_DT)
    r.add_argument("--full-refresh", action="store_true")
    r.add_argument("--games-from", default=GAMES_FROM)
    r.add_argument("--posts-from", default=POSTS_FROM)
    i = sub.add_parser("ingest", help="land one fetched batch into <root>/raw")
    i.add_argument("--root", required=True)
    i.add_argument("--source", required=True, choices=["posts", "game_logs", "player_list", "schedule"])
    i.add_argument("--landing", required=True)
    i.add_argument("--batch-ts", help="load time (default: now, UTC)")
    when = i.add_mutually_exclusive_group()
    when.add_argument("--date")
    when.add_argument("--season")
    args = ap.parse_args(argv)
    spark = get_spark()
    if args.cmd == "run":
        paths = run(spark, args.root, args.run_dt, args.full_refresh, args.games_from, args.posts_from)
        print(json.dumps(paths))
        return
    ts = (dt.datetime.fromisoformat(args.batch_ts) if args.batch_ts
          else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    if args.source == "posts":
        done = ingest.ingest_posts(spark, args.root, args.landing, ts)
    elif args.source == "game_logs":
        done = ingest.ingest_game_logs(spark, args.root, args.landing, ts, args.date, args.season)
    elif args.source == "player_list":
        done = ingest.ingest_player_list(spark, args.root, args.landing, ts)
    else:
        done = ingest.ingest_schedule(spark, args.root, args.landing, ts,
                                      dt.date.fromisoformat(args.date) if args.date else None, args.season)
    print(json.dumps({"source": args.source, "loaded": bool(done)}))


if __name__ == "__main__":
    main()
