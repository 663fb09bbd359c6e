"""Staging models: parse the raw JSON documents and cast them to typed columns.

Each model takes a raw DataFrame ``(partition_date, data)`` and returns a
typed one. The document is parsed once (one ``from_json`` per row) and the
fields are read from the resulting struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions.json import (
    GAME_DDL,
    PLAYER_STATS_DDL,
    TEAM_STATS_DDL,
    json_float,
    json_int,
    json_text,
    parse_documents,
    parse_json,
)
from courtline.functions.scalar import guarded_ratio

_DOC = "doc"


def _parsed(raw: DataFrame, ddl: str) -> DataFrame:
    return raw.select(F.col("partition_date"), parse_json(F.col("data"), ddl).alias(_DOC))


def stg_games(raw: DataFrame) -> DataFrame:
    """Games: ids as text, scores as INT, differential and winner/loser.

    A tie, or a NULL score, makes the away team the winner."""
    doc = F.col(_DOC)
    typed = _parsed(raw, GAME_DDL).select(
        json_text(doc, "id").alias("game_id"),
        F.col("partition_date").cast("date").alias("game_date"),
        json_int(doc, "season").alias("season"),
        json_text(doc, "status").alias("game_status"),
        json_text(doc, "home_team", "abbreviation").alias("home_team"),
        json_text(doc, "home_team", "full_name").alias("home_team_name"),
        json_text(doc, "visitor_team", "abbreviation").alias("away_team"),
        json_text(doc, "visitor_team", "full_name").alias("away_team_name"),
        json_int(doc, "home_team_score").alias("home_score"),
        json_int(doc, "visitor_team_score").alias("away_score"),
    )
    home_wins = F.col("home_score") > F.col("away_score")
    return typed.select(
        "*",
        (F.col("home_score") - F.col("away_score")).alias("score_differential"),
        F.when(home_wins, F.col("home_team")).otherwise(F.col("away_team")).alias("winner"),
        F.when(home_wins, F.col("away_team")).otherwise(F.col("home_team")).alias("loser"),
    )


_PLAYER_INTS = [
    ("pts", "points"),
    ("reb", "rebounds"),
    ("ast", "assists"),
    ("stl", "steals"),
    ("blk", "blocks"),
    ("turnover", "turnovers"),
    ("fgm", "field_goals_made"),
    ("fga", "field_goals_attempted"),
    ("fg3m", "three_pointers_made"),
    ("fg3a", "three_pointers_attempted"),
    ("ftm", "free_throws_made"),
    ("fta", "free_throws_attempted"),
    ("pf", "personal_fouls"),
]


def stg_player_stats(raw: DataFrame) -> DataFrame:
    """Player box scores with guarded shooting rates (0.0 on zero attempts)."""
    parsed = parse_documents(raw, PLAYER_STATS_DDL, [src for src, _ in _PLAYER_INTS])
    usual, doc = F.col("typed"), F.col("doc")

    def text(*path: str) -> Column:
        return F.coalesce(json_text(usual, *path), json_text(doc, *path))

    typed = parsed.select(
        text("id").alias("stat_id"),
        text("game_id").alias("game_id"),
        text("player_id").alias("player_id"),
        text("team", "abbreviation").alias("team"),
        F.col("partition_date").cast("date").alias("game_date"),
        text("min").alias("minutes_played"),
        *[F.coalesce(usual.getField(src), json_int(doc, src)).alias(dst) for src, dst in _PLAYER_INTS],
    )
    c = F.col
    return typed.select(
        "stat_id", "game_id", "player_id", "team", "game_date", "minutes_played",
        "points", "rebounds", "assists", "steals", "blocks", "turnovers",
        "field_goals_made", "field_goals_attempted",
        guarded_ratio(c("field_goals_made"), c("field_goals_attempted")).alias("fg_pct"),
        "three_pointers_made", "three_pointers_attempted",
        guarded_ratio(c("three_pointers_made"), c("three_pointers_attempted")).alias("fg3_pct"),
        "free_throws_made", "free_throws_attempted",
        guarded_ratio(c("free_throws_made"), c("free_throws_attempted")).alias("ft_pct"),
        "personal_fouls",
    )


_TEAM_FLOATS = [
    "pts_per_game", "reb_per_game", "ast_per_game", "opp_pts_per_game",
    "fg_pct", "fg3_pct", "ft_pct",
]


def stg_team_stats(raw: DataFrame) -> DataFrame:
    """Team season averages as FLOAT, plus net rating rounded to 1 digit."""
    doc = F.col(_DOC)
    return _parsed(raw, TEAM_STATS_DDL).select(
        json_text(doc, "team", "abbreviation").alias("team_abbreviation"),
        json_text(doc, "team", "full_name").alias("team_name"),
        F.col("partition_date").cast("date").alias("stat_date"),
        json_int(doc, "wins").alias("wins"),
        json_int(doc, "losses").alias("losses"),
        *[json_float(doc, name).alias(name) for name in _TEAM_FLOATS],
        F.round(json_float(doc, "pts_per_game") - json_float(doc, "opp_pts_per_game"), 1)
        .alias("net_rating"),
    )
