"""Command line: land raw tables, build the models, write the summaries.

  python -m courtline land    --sf-dir DIR --raw-root RAW [--table T ...] [--batch-days 10] [--run-id ID]
  python -m courtline responses --responses DIR --raw-root RAW --table T [--day D ...]
  python -m courtline stage   --raw-root RAW --staging-root STG [--table T ...] [--day D ...]
  python -m courtline build   --staging-root STG --out OUT [--model M ...]
  python -m courtline summary --staging-root STG --out OUT [--day D]

``land`` derives raw tables from the input tables and lands them in runs of at
most ``--batch-days`` days; ``responses`` lands the newest fetch of each (given)
day from a folder of API responses; ``stage`` parses the pending (or given) days into
typed staging; ``build`` writes the models (full history) as Parquet tables;
``summary`` writes the league summary and the watchlist document for a day
(default: the latest day with games).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import functions as F

from courtline.plans import analytics, chain
from courtline.plans.backfill import backfill
from courtline.plans.materialize import STAGING_MODELS, build_staging, pending_days, read_staging
from courtline.session import build_session, free_scratch
from courtline.sinks.tables import replace_table, write_document, write_partitions
from courtline.sources.raw import RAW_TABLES, days_of_responses, land_response


def _staged_models(spark, staging_root):
    return chain.models_over(*(read_staging(spark, staging_root, t) for t in RAW_TABLES))


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="courtline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("land")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--raw-root", required=True)
    p.add_argument("--table", action="append", choices=RAW_TABLES)
    p.add_argument("--batch-days", type=int, default=10)
    p.add_argument("--run-id", help="a stopped backfill goes on when it is started again under its id")
    p = sub.add_parser("responses")
    p.add_argument("--responses", required=True)
    p.add_argument("--raw-root", required=True)
    p.add_argument("--table", required=True, choices=RAW_TABLES)
    p.add_argument("--day", action="append")
    p = sub.add_parser("stage")
    p.add_argument("--raw-root", required=True)
    p.add_argument("--staging-root", required=True)
    p.add_argument("--table", action="append", choices=list(STAGING_MODELS))
    p.add_argument("--day", action="append")
    p = sub.add_parser("build")
    p.add_argument("--staging-root", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--model", action="append", choices=chain.MODELS)
    p = sub.add_parser("summary")
    p.add_argument("--staging-root", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--day")
    ap.add_argument("--master", default=None)
    return ap


def run(spark, args) -> None:
    """Run one parsed command on an existing session."""
    if args.cmd == "land":
        for t in args.table or RAW_TABLES:
            runs = backfill(spark, chain.raw(spark, args.sf_dir, t), os.path.join(args.raw_root, t),
                            batch_days=args.batch_days, log_path=os.path.join(args.raw_root, "_load_log"),
                            table_name=t, run_id=args.run_id)
            print(f"{t}: {runs} runs")
    elif args.cmd == "responses":
        rows = land_response(spark, args.responses)
        if args.day:
            rows = rows.where(F.col("partition_date").cast("string").isin(args.day))
        days = args.day or [r[0] for r in days_of_responses(spark, args.responses).collect()]  # one per day
        write_partitions(rows, os.path.join(args.raw_root, args.table), days=days)
        print(f"{args.table}: {len(days)} days landed")
    elif args.cmd == "stage":
        for t in args.table or list(STAGING_MODELS):
            days = args.day or pending_days(spark, args.raw_root, args.staging_root, t)
            build_staging(spark, args.raw_root, args.staging_root, t, days)
            print(f"{t}: {len(days)} days staged")
    elif args.cmd == "build":
        models = _staged_models(spark, args.staging_root)
        for name in args.model or chain.MODELS:
            replace_table(chain.report(name, models), os.path.join(args.out, name))
            print(f"{name}: written")
    elif args.cmd == "summary":
        m = _staged_models(spark, args.staging_root)
        games, perf, teams = m["fct_game_results"], m["fct_player_performance"], m["dim_teams"]
        day = F.lit(args.day).cast("date") if args.day else analytics.latest_day(games, "game_date")
        summary = analytics.league_summary(games, perf, m["stg_team_stats"], teams, day)
        write_document(summary, os.path.join(args.out, "league_daily_summary"))
        alerts = analytics.watchlist_alerts(perf, day)
        write_document(lambda items: analytics.watchlist_summary(items, day),
                       os.path.join(args.out, "player_watchlist_alerts"), items=alerts)
        print("summaries written")


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("courtline-" + args.cmd, master=args.master)
    try:
        run(spark, args)
    finally:
        free_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()
