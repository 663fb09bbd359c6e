"""Mart models: game facts, player performance facts, team dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.functions.scalar import guarded_ratio, ordered_bucket, threshold_count, weighted_sum
from courtline.operators.windows import latest_per_key

# Fixed values of the models (thresholds, weights and labels).
GAME_TYPE_LIMITS = [("<=", 3, "Nail Biter"), ("<=", 10, "Close Game"), ("<=", 20, "Comfortable Win")]
GAME_TYPE_ELSE = "Blowout"
TEAM_TIER_LIMITS = [
    (">", 5, "Elite"),
    (">", 2, "Above Average"),
    (">", -2, "Average"),
    (">", -5, "Below Average"),
]
TEAM_TIER_ELSE = "Rebuilding"
FANTASY_WEIGHTS = [
    ("points", "1.0"),
    ("rebounds", "1.2"),
    ("assists", "1.5"),
    ("steals", "3.0"),
    ("blocks", "3.0"),
    ("turnovers", "-1.0"),
]
FANTASY_TYPE = "decimal(17,1)"
DOUBLE_STATS = ["points", "rebounds", "assists", "steals", "blocks"]
DOUBLE_AT = 10


def game_type(margin) -> "F.Column":
    return ordered_bucket(margin, GAME_TYPE_LIMITS, GAME_TYPE_ELSE)


def team_tier(net_rating) -> "F.Column":
    return ordered_bucket(net_rating, TEAM_TIER_LIMITS, TEAM_TIER_ELSE)


def efficiency_rating() -> "F.Column":
    c = F.col
    return (
        c("points") + c("rebounds") + c("assists") + c("steals") + c("blocks")
        - (c("field_goals_attempted") - c("field_goals_made"))
        - (c("free_throws_attempted") - c("free_throws_made"))
        - c("turnovers")
    )


def fantasy_points() -> "F.Column":
    return weighted_sum([(F.col(n), w) for n, w in FANTASY_WEIGHTS], FANTASY_TYPE)


def fct_game_results(games: DataFrame) -> DataFrame:
    c = F.col
    margin = F.abs(c("score_differential"))
    return games.select(
        "game_id", "game_date", "season", "game_status",
        "home_team", "home_team_name", "away_team", "away_team_name",
        "home_score", "away_score", "score_differential",
        margin.alias("margin_of_victory"),
        "winner", "loser",
        game_type(margin).alias("game_type"),
        (c("home_score") + c("away_score")).alias("total_points"),
        F.when(c("home_score") > c("away_score"), F.lit("Home")).otherwise(F.lit("Away"))
        .alias("winner_location"),
    )


def fct_player_performance(stats: DataFrame) -> DataFrame:
    stat_cols = [F.col(n) for n in DOUBLE_STATS]
    return stats.select(
        "*",
        efficiency_rating().alias("efficiency_rating"),
        fantasy_points().alias("fantasy_points"),
        threshold_count(stat_cols, DOUBLE_AT, 2).alias("is_double_double"),
        threshold_count(stat_cols, DOUBLE_AT, 3).alias("is_triple_double"),
    )


def dim_teams(team_stats: DataFrame) -> DataFrame:
    """Latest stats row per team, with games played, win pct and tier.

    Of several rows of one team and day, the one with the most games, then the
    most wins, then the highest net rating counts."""
    c = F.col
    newest = [c("stat_date").desc(), (c("wins") + c("losses")).desc_nulls_last(), c("wins").desc_nulls_last(), c("net_rating").desc_nulls_last()]
    latest = latest_per_key(team_stats, ["team_abbreviation"], newest)
    played = c("wins") + c("losses")
    return latest.select(
        "team_abbreviation", "team_name",
        c("stat_date").alias("last_updated"),
        "wins", "losses",
        played.alias("games_played"),
        guarded_ratio(c("wins"), played).alias("win_pct"),
        "pts_per_game", "reb_per_game", "ast_per_game", "opp_pts_per_game",
        "fg_pct", "fg3_pct", "ft_pct", "net_rating",
        team_tier(c("net_rating")).alias("team_tier"),
    )
