"""The model chain over one input folder, as lazy DataFrames.

    raw games        -> stg_games        -> fct_game_results       -+
    raw team_stats   -> stg_team_stats   -> dim_teams              -+-> rpt_team_standings
    raw player_stats -> stg_player_stats -> fct_player_performance --> rpt_player_rankings

The staging and mart models run nothing until they are read. The two reports
rank on checkpointed inputs, which run when the report is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtline.plans import marts, reports, staging
from courtline.sources.adapters import RAW_BUILDERS


def raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    return RAW_BUILDERS[table](spark, root)


def stg_games(spark: SparkSession, root: str) -> DataFrame:
    return staging.stg_games(raw(spark, root, "games"))


def stg_player_stats(spark: SparkSession, root: str) -> DataFrame:
    return staging.stg_player_stats(raw(spark, root, "player_stats"))


def stg_team_stats(spark: SparkSession, root: str) -> DataFrame:
    return staging.stg_team_stats(raw(spark, root, "team_stats"))


def fct_game_results(spark: SparkSession, root: str) -> DataFrame:
    return marts.fct_game_results(stg_games(spark, root))


def fct_player_performance(spark: SparkSession, root: str) -> DataFrame:
    return marts.fct_player_performance(stg_player_stats(spark, root))


def dim_teams(spark: SparkSession, root: str) -> DataFrame:
    return marts.dim_teams(stg_team_stats(spark, root))


def rpt_team_standings(spark: SparkSession, root: str) -> DataFrame:
    return reports.rpt_team_standings(dim_teams(spark, root), fct_game_results(spark, root))


def rpt_player_rankings(spark: SparkSession, root: str) -> DataFrame:
    return reports.rpt_player_rankings(fct_player_performance(spark, root))


MODELS = [
    "stg_games", "stg_player_stats", "stg_team_stats",
    "fct_game_results", "fct_player_performance", "dim_teams",
    "rpt_team_standings", "rpt_player_rankings",
]


def publish_views(models: dict[str, DataFrame]) -> list[str]:
    """Publish models as temp views under their names (replacing older ones)."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return list(models)


def models_over(games: DataFrame, player_stats: DataFrame, team_stats: DataFrame) -> dict[str, DataFrame]:
    """The staging and mart models over typed staging inputs (lazy; nothing
    runs). The two reports rank on checkpointed inputs, so ``report`` builds
    them on demand."""
    return {
        "stg_games": games,
        "stg_player_stats": player_stats,
        "stg_team_stats": team_stats,
        "fct_game_results": marts.fct_game_results(games),
        "fct_player_performance": marts.fct_player_performance(player_stats),
        "dim_teams": marts.dim_teams(team_stats),
    }


def report(name: str, models: dict[str, DataFrame]) -> DataFrame:
    """Any of the eight models by name (reports are built here, on demand)."""
    if name == "rpt_team_standings":
        return reports.rpt_team_standings(models["dim_teams"], models["fct_game_results"])
    if name == "rpt_player_rankings":
        return reports.rpt_player_rankings(models["fct_player_performance"])
    return models[name]

