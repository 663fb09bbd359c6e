"""Per-day player states: what a day's box scores add to the reports over the whole history.

A state row holds the counts, sums and maxima of one player, team and day, all
of which merge by addition or maximum.  Reports over the history read states
instead of facts; a day that is landed again replaces its own states only.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.functions.scalar import round_half_away
from courtline.plans import chain, marts, materialize, staging
from courtline.plans.reports import rank_players
from courtline.session import scratch_path
from courtline.sinks import manifest
from courtline.sinks.tables import read_partitions, write_partitions

# Measures that are averaged: name of the average -> column of the facts.
AVERAGED = {
    "avg_points": "points", "avg_rebounds": "rebounds", "avg_assists": "assists", "avg_steals": "steals",
    "avg_blocks": "blocks", "avg_turnovers": "turnovers", "avg_efficiency": "efficiency_rating",
}
RATES = {"avg_fg_pct": "fg_pct", "avg_fg3_pct": "fg3_pct", "avg_ft_pct": "ft_pct"}
MAXIMA = {"max_points": "points", "max_rebounds": "rebounds", "max_assists": "assists"}
KEYS = ["game_date", "player_id", "team"]
# The columns of a state that ``player_form`` reads.
FORM_COLUMNS = ["player_id", "game_date", "n_fantasy_points", "sum_fantasy_points", "last_game"]

_SHIFT = 10**18  # fantasy points in tenths lie within +-10**17
_WHOLE = "decimal(38,0)"


def _whole(n: int) -> Column:
    return F.lit(Decimal(n)).cast(_WHOLE)


def game_key() -> Column:
    """A day's games of a player in order, as one DECIMAL(38): by stat id as a number
    (none lowest), then by fantasy points (none lowest). Fixed-width, so that its
    maximum is kept in a hash aggregate."""
    number = F.col("stat_id").try_cast("long").cast(_WHOLE) + _whole(2**63 + 1)
    tenths = (F.col("fantasy_points") * 10).cast(_WHOLE) + _whole(_SHIFT // 2)
    return (F.coalesce(number, _whole(0)) * _whole(_SHIFT) + F.coalesce(tenths, _whole(0))).cast(_WHOLE)


def points_of(key: Column) -> Column:
    """The fantasy points within a ``game_key``."""
    tenths = F.pmod(key, _whole(_SHIFT))
    return F.when(tenths > 0, ((tenths - _whole(_SHIFT // 2)) / 10).cast(marts.FANTASY_TYPE))


def player_days(perf: DataFrame) -> DataFrame:
    """The states of the facts' days: one hash aggregate, combined before the shuffle."""
    averaged = [*AVERAGED.values(), *RATES.values(), "fantasy_points"]
    return perf.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("games"),
        *[F.sum(c).alias(f"sum_{c}") for c in averaged],
        *[F.count(c).alias(f"n_{c}") for c in averaged],
        *[F.max(c).alias(f"max_{c}") for c in MAXIMA.values()],
        F.count_if("is_double_double").alias("double_doubles"),
        F.count_if("is_triple_double").alias("triple_doubles"),
        F.max(game_key()).alias("last_game"),
    )


def merged_aggregates(states: DataFrame) -> DataFrame:
    """The rankings' aggregates per player and team, from states alone."""
    def mean(c: str) -> Column:
        return F.sum(f"sum_{c}").cast("double") / F.nullif(F.sum(f"n_{c}"), F.lit(0))

    fantasy = (F.sum("sum_fantasy_points") / F.nullif(F.sum("n_fantasy_points"), F.lit(0))).cast("decimal(21,5)")
    means = {name: round_half_away(mean(c), 1) for name, c in AVERAGED.items()}
    means["avg_fantasy_points"] = F.round(fantasy, 1).cast("double")
    means |= {name: round_half_away(mean(c), 3) for name, c in RATES.items()}
    return states.groupBy("player_id", "team").agg(
        F.sum("games").cast("long").alias("games_played"),
        *[m.alias(name) for name, m in means.items()],
        F.sum("double_doubles").cast("long").alias("double_doubles"),
        F.sum("triple_doubles").cast("long").alias("triple_doubles"),
        *[F.max(f"max_{c}").alias(name) for name, c in MAXIMA.items()],
    )


def player_form(states: DataFrame) -> DataFrame:
    """Per player: the last game (latest date; ties by stat id as a number, then
    fantasy points) and the count and sum of the known fantasy points of the
    earlier games. Hash aggregates by day, then by player; no join and no sort."""
    days = states.groupBy("player_id", "game_date").agg(
        F.sum("n_fantasy_points").alias("games"), F.sum("sum_fantasy_points").alias("total_fp"), F.max("last_game").alias("last_game")
    )
    players = days.groupBy("player_id").agg(
        F.max("game_date").alias("last_game_date"), F.sum("games").alias("games"), F.sum("total_fp").alias("total_fp"),
        F.max_by("last_game", "game_date").alias("last_game"),
    )
    last_points = points_of(F.col("last_game"))
    has_last = F.when(last_points.isNull(), 0).otherwise(1)
    return players.select(
        "player_id",
        "last_game_date",
        last_points.alias("last_fantasy_points"),
        (F.col("games") - has_last).cast("long").alias("earlier_games"),
        (F.col("total_fp") - F.coalesce(last_points, F.lit(0))).alias("earlier_fp"),
    )


def pending_state_days(spark: SparkSession, staging_root: str, states_root: str) -> list:
    """Days whose newest staging write is not the one their states were made from."""
    return materialize.pending(spark, os.path.join(staging_root, "player_stats"), os.path.join(states_root, "player_days"))


def build_states(spark: SparkSession, staging_root: str, states_root: str, days: Iterable | None = None) -> dict:
    """Make the states of ``days`` (by default the pending ones) from the typed box
    scores of these days alone, and replace those days' states."""
    staged = os.path.join(staging_root, "player_stats")
    version = manifest.newest(spark, staged)
    held = {r["day"]: r["write"] for r in manifest.entries(spark, staged, version).collect()}  # a row per day
    days = manifest.day_list(pending_state_days(spark, staging_root, states_root) if days is None else days)
    if not days:
        return {}
    facts = marts.fct_player_performance(materialize.read_staging(spark, staging_root, "player_stats", version, days))
    return write_partitions(player_days(facts), os.path.join(states_root, "player_days"), col="game_date", days=days, sources=held)


def read_states(spark: SparkSession, states_root: str) -> DataFrame:
    facts = marts.fct_player_performance(materialize.empty_staging(spark, "player_stats"))
    return read_partitions(spark, os.path.join(states_root, "player_days"), player_days(facts).schema, "game_date")


def incremental_rankings_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Player rankings from states kept per day: all days are staged, the first twenty
    without assists; their states are made; these days are staged again, complete, and only their
    states are made anew. The rankings merge the states."""
    base = scratch_path(spark, "states")
    staging_root, states_root = os.path.join(base, "staging"), os.path.join(base, "states")
    path = os.path.join(staging_root, "player_stats")
    # read anew for the twenty days: their documents alone are parsed twice, and no copy of all days is kept
    documents = chain.raw(spark, sf_root, "player_stats")
    first = [r[0] for r in documents.select("partition_date").distinct().orderBy("partition_date").take(20)]
    open_day = F.col("game_date").isin(first)
    early = staging.stg_player_stats(documents).withColumn("assists", F.when(open_day, 0).otherwise(F.col("assists")).cast("int"))
    again = staging.stg_player_stats(documents.where(F.col("partition_date").isin(first)))
    for rows in (early, again):
        write_partitions(rows, path, col="game_date")
        build_states(spark, staging_root, states_root)
    return rank_players(merged_aggregates(read_states(spark, states_root)))
