"""Report models: team standings and player rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.functions.scalar import round_half_away
from courtline.operators.windows import ranks_by_measure

# Tie-breaks appended to every ranking so that ranks are reproducible.
TEAM_TIEBREAK = ["team_abbreviation"]
PLAYER_TIEBREAK = ["player_id", "team"]


def team_game_counts(game_results: DataFrame) -> DataFrame:
    """Per team: home games, home wins and wins, in ONE pass over the games.

    The games are counted by (home team, winner) first; each of these at most
    teams x teams groups then adds to its home team and to its winner."""
    c = F.col
    games = game_results.groupBy("home_team", "winner").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    home_win = F.when(c("winner") == c("home_team"), c("n")).otherwise(zero)
    rows = games.select(
        F.explode(
            F.array(
                F.struct(c("home_team").alias("team"), c("n").alias("h"), home_win.alias("hw"), zero.alias("w")),
                F.struct(c("winner").alias("team"), zero.alias("h"), zero.alias("hw"), c("n").alias("w")),
            )
        ).alias("r")
    ).select("r.*")
    return rows.groupBy("team").agg(
        F.sum("h").cast("long").alias("home_games"),
        F.sum("hw").cast("long").alias("home_wins"),
        F.sum("w").cast("long").alias("wins_in_data"),
    )


def standings_base(teams: DataFrame, game_results: DataFrame) -> DataFrame:
    """Standings rows before ranking: one row per team of the dimension."""
    c = F.col
    counts = team_game_counts(game_results)
    # Both sides are one row per team; AQE broadcasts the smaller at run time
    # from its measured size.
    joined = teams.join(counts, teams.team_abbreviation == counts.team, "left")
    base = joined.select(
        "team_abbreviation", "team_name", "wins", "losses", "games_played", "win_pct",
        "pts_per_game", "opp_pts_per_game", "net_rating", "team_tier",
        "fg_pct", "fg3_pct", "ft_pct",
        F.coalesce(c("home_games"), F.lit(0).cast("long")).alias("home_games_played"),
        F.coalesce(c("home_wins"), F.lit(0).cast("long")).alias("home_wins"),
        F.coalesce(c("wins_in_data"), F.lit(0).cast("long")).alias("total_wins_in_data"),
    )
    return base


def rpt_team_standings(teams: DataFrame, game_results: DataFrame) -> DataFrame:
    base = standings_base(teams, game_results)
    ranked = ranks_by_measure(base, {"overall_rank": "win_pct"}, keys=TEAM_TIEBREAK)
    return ranked.orderBy("overall_rank")


def player_aggregates(perf: DataFrame) -> DataFrame:
    c = F.col
    return perf.groupBy("player_id", "team").agg(
        F.count(F.lit(1)).alias("games_played"),
        round_half_away(F.avg("points"), 1).alias("avg_points"),
        round_half_away(F.avg("rebounds"), 1).alias("avg_rebounds"),
        round_half_away(F.avg("assists"), 1).alias("avg_assists"),
        round_half_away(F.avg("steals"), 1).alias("avg_steals"),
        round_half_away(F.avg("blocks"), 1).alias("avg_blocks"),
        round_half_away(F.avg("turnovers"), 1).alias("avg_turnovers"),
        round_half_away(F.avg("efficiency_rating"), 1).alias("avg_efficiency"),
        # average in DECIMAL (exact sum), round, then DOUBLE
        F.round(F.avg("fantasy_points"), 1).cast("double").alias("avg_fantasy_points"),
        round_half_away(F.avg("fg_pct"), 3).alias("avg_fg_pct"),
        round_half_away(F.avg("fg3_pct"), 3).alias("avg_fg3_pct"),
        round_half_away(F.avg("ft_pct"), 3).alias("avg_ft_pct"),
        F.sum(F.when(c("is_double_double"), 1).otherwise(0)).cast("long").alias("double_doubles"),
        F.sum(F.when(c("is_triple_double"), 1).otherwise(0)).cast("long").alias("triple_doubles"),
        F.max("points").alias("max_points"),
        F.max("rebounds").alias("max_rebounds"),
        F.max("assists").alias("max_assists"),
    )


def rpt_player_rankings(perf: DataFrame) -> DataFrame:
    return rank_players(player_aggregates(perf))


def rank_players(aggregates: DataFrame) -> DataFrame:
    measures = {"efficiency_rank": "avg_efficiency", "scoring_rank": "avg_points", "fantasy_rank": "avg_fantasy_points"}
    return ranks_by_measure(aggregates, measures, keys=PLAYER_TIEBREAK).orderBy("efficiency_rank")
