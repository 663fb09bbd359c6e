"""Query registry: one callable ``(spark, root) -> DataFrame`` per key of the
operator inventory. Every query reads the input tables under ``root`` (or
tables Spark derives from them), over their whole extent."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.functions.json import GAME_DDL, json_int, json_text, parse_json
from courtline.functions.scalar import count_true
from courtline.operators.aggregates import conditional_count, group_count
from courtline.operators.partitions import (
    backfill_batches,
    batch_summary,
    for_day,
    partition_calendar,
)
from courtline.operators.windows import global_rank, latest_per_key
from courtline.plans import analytics, chain, landing, marts
from courtline.plans.backfill import backfill_job
from courtline.plans.materialize import incremental_staging_job, read_staging
from courtline.plans.states import incremental_rankings_job
from courtline.session import scratch_path
from courtline.sinks.tables import write_document, write_partitions
from courtline.sources.adapters import team_payroll
from courtline.sources.raw import read_sheet, write_sheet
from courtline.sources.tables import read_table
from courtline.streaming.landing import stream_landing_job

Query = Callable[[SparkSession, str], DataFrame]


# --- JSON ------------------------------------------------------------------

def q_json_scalar(spark: SparkSession, root: str) -> DataFrame:
    """Validate + parse event properties, extract ``k`` as text and as INT."""
    ev = read_table(spark, root, "events", "event_id", "props")
    doc = parse_json(F.col("props"), "k STRING")
    return ev.select("event_id", doc.alias("p")).select(
        "event_id", json_text(F.col("p"), "k").alias("k_text"), json_int(F.col("p"), "k").alias("k")
    )


def q_json_nested(spark: SparkSession, root: str) -> DataFrame:
    """Nested extraction ``doc->'home_team'->>'abbreviation'`` from raw games."""
    doc = F.col("g")
    return chain.raw(spark, root, "games").select(parse_json(F.col("data"), GAME_DDL).alias("g")).select(
        json_text(doc, "id").alias("game_id"),
        json_text(doc, "home_team", "abbreviation").alias("home_team"),
        json_text(doc, "home_team", "full_name").alias("home_team_name"),
        json_text(doc, "visitor_team", "abbreviation").alias("away_team"),
        json_text(doc, "visitor_team", "full_name").alias("away_team_name"),
    )


def q_json_build(spark: SparkSession, root: str) -> DataFrame:
    """Record -> JSON text: the raw games documents."""
    return chain.raw(spark, root, "games")


# --- scalar expressions ------------------------------------------------------

_STAT_KEYS = ["stat_id", "game_id", "player_id"]


def q_guarded_ratio(spark: SparkSession, root: str) -> DataFrame:
    return chain.stg_player_stats(spark, root).select(*_STAT_KEYS, "fg_pct", "fg3_pct", "ft_pct")


def q_efficiency_rating(spark: SparkSession, root: str) -> DataFrame:
    return chain.stg_player_stats(spark, root).select(
        *_STAT_KEYS, marts.efficiency_rating().alias("efficiency_rating")
    )


def q_weighted_score(spark: SparkSession, root: str) -> DataFrame:
    return chain.stg_player_stats(spark, root).select(
        *_STAT_KEYS, marts.fantasy_points().alias("fantasy_points")
    )


def q_threshold_count(spark: SparkSession, root: str) -> DataFrame:
    stats = [F.col(n) >= marts.DOUBLE_AT for n in marts.DOUBLE_STATS]
    return chain.fct_player_performance(spark, root).select(
        *_STAT_KEYS,
        count_true(stats).alias("double_digit_stats"),
        "is_double_double",
        "is_triple_double",
    )


def q_game_type_bucket(spark: SparkSession, root: str) -> DataFrame:
    return chain.fct_game_results(spark, root).select("game_id", "margin_of_victory", "game_type")


def q_team_tier_bucket(spark: SparkSession, root: str) -> DataFrame:
    return chain.stg_team_stats(spark, root).select(
        "team_abbreviation", "stat_date", "net_rating", marts.team_tier(F.col("net_rating")).alias("team_tier")
    )


# --- aggregates, windows ---------------------------------------------------

def q_group_count(spark: SparkSession, root: str) -> DataFrame:
    return group_count(chain.fct_game_results(spark, root), ["home_team"], "games")


def q_conditional_count(spark: SparkSession, root: str) -> DataFrame:
    g = chain.fct_game_results(spark, root)
    return conditional_count(
        g,
        ["home_team"],
        {
            "home_wins": F.col("winner") == F.col("home_team"),
            "nail_biters": F.col("game_type") == "Nail Biter",
        },
        total="games",
    )


def q_latest_per_key(spark: SparkSession, root: str) -> DataFrame:
    return latest_per_key(
        chain.stg_team_stats(spark, root), ["team_abbreviation"], [F.col("stat_date").desc()]
    )


def q_global_rank(spark: SparkSession, root: str) -> DataFrame:
    """Rank every game by total points (ties by game id)."""
    g = chain.fct_game_results(spark, root).select("game_id", "game_date", "total_points")
    order = [F.col("total_points").desc_nulls_last(), F.col("game_id").asc_nulls_last()]
    return global_rank(g, order, "points_rank", keys=["game_id"])


# --- partitions ---------------------------------------------------------------

def q_partition_calendar(spark: SparkSession, root: str) -> DataFrame:
    return partition_calendar(chain.raw(spark, root, "games"), "partition_date")


def q_backfill_batches(spark: SparkSession, root: str) -> DataFrame:
    cal = partition_calendar(chain.raw(spark, root, "games"), "partition_date")
    return batch_summary(backfill_batches(cal))


def q_for_day(spark: SparkSession, root: str) -> DataFrame:
    """The last day's games from typed staging kept by day: the day is a literal,
    so the scan lists that day's folder alone."""
    base = scratch_path(spark, "for-day")
    write_partitions(chain.stg_games(spark, root), os.path.join(base, "games"), col="game_date")
    staged = read_staging(spark, base, "games")
    day = staged.agg(F.max("game_date")).first()[0]
    return marts.fct_game_results(for_day(staged, "game_date", day))


# --- summaries ------------------------------------------------------------------

MID_DAY = "1998-06-30"  # a day within the tables' range, for the summaries of a chosen day


def _league_summary(spark: SparkSession, root: str, until: str | None) -> DataFrame:
    games = chain.fct_game_results(spark, root)
    seen = games.where(F.col("game_date") <= F.lit(until).cast("date")) if until else games
    day = F.lit(seen.agg(F.max("game_date")).first()[0]).cast("date")
    return analytics.league_summary(
        games,
        chain.fct_player_performance(spark, root),
        chain.stg_team_stats(spark, root),
        chain.dim_teams(spark, root),
        day,
    )


def q_league_summary(spark: SparkSession, root: str) -> DataFrame:
    return _league_summary(spark, root, None)


def q_league_summary_for_day(spark: SparkSession, root: str) -> DataFrame:
    """The league on the last day with games up to MID_DAY."""
    return _league_summary(spark, root, MID_DAY)


def q_league_document(spark: SparkSession, root: str) -> DataFrame:
    """The league summary written as a document and read back."""
    summary = _league_summary(spark, root, None)
    out = scratch_path(spark, "league-document")
    write_document(summary, out)
    return spark.read.schema(summary.schema).json(os.path.join(out, "summary"))


def q_watchlist_alerts_for_day(spark: SparkSession, root: str) -> DataFrame:
    """The alerts as they stood on MID_DAY."""
    return analytics.watchlist_alerts(chain.fct_player_performance(spark, root), F.lit(MID_DAY).cast("date"))


def q_salary_sheet(spark: SparkSession, root: str) -> DataFrame:
    """The known 8-column salary sheet: written as a CSV drop and read by its name."""
    sheet = scratch_path(spark, "salary-sheet")
    write_sheet(analytics.salary_cap(team_payroll(spark, root)), sheet)
    return read_sheet(spark, sheet, "salary_cap")


def q_watchlist_alerts(spark: SparkSession, root: str) -> DataFrame:
    states = analytics.kept_states(chain.fct_player_performance(spark, root))
    return analytics.alerts_of(states, analytics.latest_day(states, "game_date"))


def q_watchlist_summary(spark: SparkSession, root: str) -> DataFrame:
    states = analytics.kept_states(chain.fct_player_performance(spark, root))
    day = analytics.latest_day(states, "game_date")
    return analytics.watchlist_summary(analytics.alerts_of(states, day), day)


def q_salary_cap(spark: SparkSession, root: str) -> DataFrame:
    return analytics.salary_cap(team_payroll(spark, root))


QUERIES: dict[str, Query] = {
    # sources / sinks (file-based: write to a scratch folder, return the read-back)
    "raw_scan": landing.raw_scan_job,
    "partition_replace": landing.partition_replace_job,
    "land_response": landing.land_response_job,
    "sheet_ingest": landing.sheet_ingest_job,
    "changed_files": landing.changed_files_job,
    "load_log": landing.load_log_job,
    "day_log": landing.day_log_job,
    "stream_landing": stream_landing_job,
    "incremental_staging": incremental_staging_job,
    "backfill_runs": backfill_job,
    "watchlist_document": landing.watchlist_document_job,
    # partitions
    "partition_calendar": q_partition_calendar,
    "backfill_batches": q_backfill_batches,
    "for_day": q_for_day,
    # JSON
    "json_scalar": q_json_scalar,
    "json_nested": q_json_nested,
    "json_build": q_json_build,
    # scalar expressions
    "guarded_ratio": q_guarded_ratio,
    "efficiency_rating": q_efficiency_rating,
    "weighted_score": q_weighted_score,
    "threshold_count": q_threshold_count,
    "game_type_bucket": q_game_type_bucket,
    "team_tier_bucket": q_team_tier_bucket,
    # aggregates and windows
    "group_count": q_group_count,
    "conditional_count": q_conditional_count,
    "latest_per_key": q_latest_per_key,
    "global_rank": q_global_rank,
    # models
    "stg_games": chain.stg_games,
    "stg_player_stats": chain.stg_player_stats,
    "stg_team_stats": chain.stg_team_stats,
    "fct_game_results": chain.fct_game_results,
    "fct_player_performance": chain.fct_player_performance,
    "dim_teams": chain.dim_teams,
    "rpt_team_standings": chain.rpt_team_standings,
    "rpt_player_rankings": chain.rpt_player_rankings,
    "incremental_rankings": incremental_rankings_job,
    # summaries
    "league_summary": q_league_summary,
    "league_summary_for_day": q_league_summary_for_day,
    "league_document": q_league_document,
    "watchlist_alerts_for_day": q_watchlist_alerts_for_day,
    "salary_sheet": q_salary_sheet,
    "watchlist_alerts": q_watchlist_alerts,
    "watchlist_summary": q_watchlist_summary,
    "salary_cap": q_salary_cap,
}
