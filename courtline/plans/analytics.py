"""Summaries built on the models: league day summary, player watchlist
alerts, salary cap sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions.scalar import guarded_ratio, round_half_away
from courtline.session import checkpoint_root
from courtline.plans.states import FORM_COLUMNS, player_days, player_form

# Fixed values of the salary cap rules.
SALARY_CAP = 136_000_000.0
LUXURY_TAX_LINE = 165_000_000.0
LUXURY_TAX_RATE = 1.5

# Watchlist rules (parameters with these defaults).
MIN_EARLIER_GAMES = 5
BREAKOUT_AT = 1.5
BREAKOUT_HIGH_AT = 2.0
SLUMP_AT = 0.5
SLUMP_HIGH_AT = 0.25
ALERT_DETAIL = "Performance threshold exceeded"


def kept_states(perf: DataFrame) -> DataFrame:
    """What the watchlist reads of the facts' states, checkpointed, so that a
    report and its day come from one pass over the facts."""
    checkpoint_root(perf.sparkSession)
    return player_days(perf).select(*FORM_COLUMNS).checkpoint(eager=True)


def latest_day(df: DataFrame, date_col: str) -> Column:
    """``(SELECT max(date_col) FROM df)`` as a scalar subquery column."""
    return df.agg(F.max(date_col)).scalar()


def league_summary(
    games: DataFrame,
    players: DataFrame,
    team_days: DataFrame,
    teams: DataFrame,
    day: Column,
) -> DataFrame:
    """One row describing ``day``: games, mean score, top scorer, upsets,
    three-pointers, closest margin, overtime games, and the number of teams.

    ``team_days`` are the daily team statistics: an upset is a win of the team
    with the lower win share on ``day``. ``teams`` has the standings' teams.
    The mean is over the scores that are known.

    Each input is reduced once to a one-row aggregate (the day filter reaches
    the scans); the rows are stacked by ``unionByName`` and folded into one
    row, so no join and no per-field pass over the data is needed."""
    c = F.col
    g = games.where(c("game_date") == day)
    p = players.where(c("game_date") == day)
    played = c("wins") + c("losses")
    standing = team_days.where(c("stat_date") == day).select("team_abbreviation", guarded_ratio(c("wins"), played).alias("pct"))
    standing = standing.groupBy("team_abbreviation").agg(F.max("pct").alias("pct"))
    tw = standing.select(c("team_abbreviation").alias("w_team"), c("pct").alias("w_pct"))
    tl = standing.select(c("team_abbreviation").alias("l_team"), c("pct").alias("l_pct"))
    upsets = g.join(tw, g.winner == tw.w_team).join(tl, g.loser == tl.l_team).where(c("w_pct") < c("l_pct"))
    n_games = F.count(F.lit(1))
    known_sum = F.sum(F.coalesce(c("home_score"), F.lit(0)) + F.coalesce(c("away_score"), F.lit(0)))
    parts = [
        g.agg(
            n_games.alias("games_played_yesterday"),
            round_half_away(known_sum / F.nullif(F.count("home_score") + F.count("away_score"), F.lit(0)), 1).alias("avg_score"),
            F.min("margin_of_victory").alias("closest_game_margin"),
            F.count_if(c("game_status").contains("OT")).alias("overtime_games"),
        ),
        p.agg(
            F.max(F.struct("points", "player_id")).getField("player_id").alias("highest_scorer"),
            F.max("points").alias("highest_score"),
            F.sum("three_pointers_made").cast("long").alias("total_three_pointers"),
        ),
        upsets.agg(F.count(F.lit(1)).alias("upsets")),
        teams.agg(F.count(F.lit(1)).alias("total_teams")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    fields = [
        "games_played_yesterday", "avg_score", "highest_scorer", "highest_score", "upsets",
        "total_three_pointers", "closest_game_margin", "overtime_games", "total_teams",
    ]
    # each field is non-NULL in at most one stacked row
    return stacked.agg(*[F.max(f).alias(f) for f in fields]).select(day.alias("report_date"), *fields)


def watchlist_alerts(perf: DataFrame, report_date: Column, **rules) -> DataFrame:
    """``alerts_of`` the facts' states."""
    return alerts_of(player_days(perf), report_date, **rules)


def alerts_of(
    states: DataFrame,
    report_date: Column,
    min_earlier: int = MIN_EARLIER_GAMES,
    breakout_at: float = BREAKOUT_AT,
    breakout_high_at: float = BREAKOUT_HIGH_AT,
    slump_at: float = SLUMP_AT,
    slump_high_at: float = SLUMP_HIGH_AT,
) -> DataFrame:
    """One row per alert: the last game up to ``report_date`` against the mean
    of the earlier ones; later games are not seen.

    ``last >= breakout_at * mean`` is a breakout, ``last <= slump_at * mean``
    a slump; severity is high beyond the ``*_high_at`` factors, else medium.
    Compared as ``last * n >= f * sum`` in exact DECIMAL arithmetic, so no
    division rounds. Players need ``min_earlier`` earlier games and a
    positive mean. ``states`` are per player and day (``plans.states``)."""
    form = player_form(states.where(F.col("game_date") <= report_date))
    last_n = F.col("last_fantasy_points") * F.col("earlier_games")

    def times(f: float) -> Column:
        return F.lit(str(f)).cast("decimal(6,2)") * F.col("earlier_fp")

    eligible = (F.col("earlier_games") >= min_earlier) & (F.col("earlier_fp") > 0)
    alert_type = (
        F.when(last_n >= times(breakout_at), F.lit("breakout_game"))
        .when(last_n <= times(slump_at), F.lit("slump_alert"))
    )
    severity = (
        F.when((last_n >= times(breakout_high_at)) | (last_n <= times(slump_high_at)), F.lit("high"))
        .otherwise(F.lit("medium"))
    )
    return (
        form.where(eligible)
        .withColumn("alert_type", alert_type)
        .where(F.col("alert_type").isNotNull())
        .select(
            report_date.alias("report_date"),
            "player_id",
            "alert_type",
            severity.alias("severity"),
            "last_game_date",
            "last_fantasy_points",
            "earlier_games",
            F.lit(ALERT_DETAIL).alias("detail"),
        )
    )


def watchlist_summary(alerts: DataFrame, report_date: Column) -> DataFrame:
    """The document head: report date, number of alerts, high-severity count."""
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("severity") == "high").alias("high_severity_count"),
    ).select(report_date.alias("report_date"), "total_alerts", "high_severity_count")


def salary_cap(payroll: DataFrame) -> DataFrame:
    """Cap space, luxury tax bill, mean salary and cap status per team."""
    total = F.col("total_salary")
    space = F.lit(SALARY_CAP) - total
    tax = F.greatest(F.lit(0.0), total - F.lit(LUXURY_TAX_LINE)) * LUXURY_TAX_RATE
    return payroll.select(
        "team_abbr",
        "team_name",
        "total_salary",
        space.alias("cap_space"),
        round_half_away(tax, 2).alias("luxury_tax_bill"),
        "num_players",
        round_half_away(total / F.col("num_players"), 2).alias("avg_salary"),
        F.when(space < 0, F.lit("Over Cap")).otherwise(F.lit("Under Cap")).alias("cap_status"),
    )
