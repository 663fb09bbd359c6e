"""Hand-made edge cases: ties, NULLs, bucket limits, zero attempts, JSON
errors, missing keys, latest-per-key, empty joins."""

import datetime as dt
import json

import pytest

from courtline.plans import marts, reports, staging
from courtline.sources.raw import RAW_SCHEMA

D1, D2 = dt.date(2024, 10, 22), dt.date(2024, 10, 23)


def raw_df(spark, docs):
    rows = [(d if isinstance(d, str) or d is None else json.dumps(d), day) for d, day in docs]
    return spark.createDataFrame(rows, RAW_SCHEMA).select("partition_date", "data")


def game(i, home, away, hs, as_, status="Final"):
    return {
        "id": i, "date": "x", "season": 2024, "status": status,
        "home_team": {"abbreviation": home, "full_name": home + " name"},
        "visitor_team": {"abbreviation": away, "full_name": away + " name"},
        "home_team_score": hs, "visitor_team_score": as_,
    }


def by(rows, key):
    return {r[key]: r for r in rows}


def test_tie_and_null_score_make_away_the_winner(spark):
    raw = raw_df(spark, [(game(1, "A", "B", 100, 100), D1), (game(2, "C", "D", None, 90), D1)])
    rows = by(marts.fct_game_results(staging.stg_games(raw)).collect(), "game_id")
    tie, nul = rows["1"], rows["2"]
    assert (tie.winner, tie.loser, tie.score_differential) == ("B", "A", 0)
    assert (tie.game_type, tie.winner_location) == ("Nail Biter", "Away")
    assert (nul.winner, nul.margin_of_victory, nul.game_type) == ("D", None, "Blowout")


@pytest.mark.parametrize(
    "margin,label",
    [(3, "Nail Biter"), (4, "Close Game"), (10, "Close Game"), (11, "Comfortable Win"),
     (20, "Comfortable Win"), (21, "Blowout"), (-3, "Nail Biter"), (-21, "Blowout")],
)
def test_game_type_limits(spark, margin, label):
    raw = raw_df(spark, [(game(1, "A", "B", 100 + margin, 100), D1)])
    assert marts.fct_game_results(staging.stg_games(raw)).first().game_type == label


def team_doc(abbr, wins, losses, pts, opp):
    return {
        "team": {"abbreviation": abbr, "full_name": abbr + " name"}, "date": "x",
        "wins": wins, "losses": losses, "pts_per_game": pts, "reb_per_game": 40.0,
        "ast_per_game": 25.0, "opp_pts_per_game": opp, "fg_pct": 0.45, "fg3_pct": 0.35,
        "ft_pct": 0.8,
    }


@pytest.mark.parametrize(
    "net,tier",
    [(5.0, "Above Average"), (5.1, "Elite"), (2.0, "Average"), (-2.0, "Below Average"),
     (-5.0, "Rebuilding"), (0.0, "Average")],
)
def test_team_tier_limits(spark, net, tier):
    raw = raw_df(spark, [(team_doc("A", 1, 1, 110.0 + net, 110.0), D1)])
    assert marts.dim_teams(staging.stg_team_stats(raw)).first().team_tier == tier


def test_null_net_rating_is_rebuilding(spark):
    doc = team_doc("A", 1, 1, 110.0, 110.0)
    del doc["opp_pts_per_game"]
    raw = raw_df(spark, [(doc, D1)])
    row = marts.dim_teams(staging.stg_team_stats(raw)).first()
    assert row.net_rating is None and row.team_tier == "Rebuilding"


def test_zero_games_gives_zero_win_pct_and_latest_row_wins(spark):
    raw = raw_df(spark, [(team_doc("A", 9, 1, 110.0, 100.0), D1), (team_doc("A", 0, 0, 110.0, 100.0), D2)])
    rows = marts.dim_teams(staging.stg_team_stats(raw)).collect()
    assert len(rows) == 1
    assert (rows[0].last_updated, rows[0].games_played, rows[0].win_pct) == (D2, 0, 0.0)


def stat_doc(i, **kw):
    base = {"id": i, "game_id": 1000, "player_id": 7, "team": {"abbreviation": "A"}, "date": "x",
            "min": "30:00", "pts": 0, "reb": 0, "ast": 0, "stl": 0, "blk": 0, "turnover": 0,
            "fgm": 0, "fga": 0, "fg3m": 0, "fg3a": 0, "ftm": 0, "fta": 0, "pf": 0}
    base.update(kw)
    return base


def test_zero_and_null_attempts_give_zero_rates(spark):
    doc = stat_doc(1, fgm=3, fga=0, fg3m=1)
    del doc["fg3a"]
    row = staging.stg_player_stats(raw_df(spark, [(doc, D1)])).first()
    assert (row.fg_pct, row.fg3_pct, row.three_pointers_attempted) == (0.0, 0.0, None)
    row = staging.stg_player_stats(raw_df(spark, [(stat_doc(2, ftm=2, fta=3), D1)])).first()
    assert row.ft_pct == pytest.approx(0.667, abs=1e-6)


def test_double_and_triple_double(spark):
    docs = [
        (stat_doc(1, pts=10, reb=10, ast=9), D1),
        (stat_doc(2, pts=10, reb=10, ast=10), D1),
        (stat_doc(3, pts=30, stl=9, blk=9), D1),
    ]
    rows = by(marts.fct_player_performance(staging.stg_player_stats(raw_df(spark, docs))).collect(), "stat_id")
    assert (rows["1"].is_double_double, rows["1"].is_triple_double) == (True, False)
    assert (rows["2"].is_double_double, rows["2"].is_triple_double) == (True, True)
    assert (rows["3"].is_double_double, rows["3"].is_triple_double) == (False, False)


def test_efficiency_and_fantasy_points(spark):
    doc = stat_doc(1, pts=20, reb=5, ast=4, stl=1, blk=2, turnover=3, fgm=8, fga=15, ftm=2, fta=4)
    row = marts.fct_player_performance(staging.stg_player_stats(raw_df(spark, [(doc, D1)]))).first()
    assert row.efficiency_rating == 20 + 5 + 4 + 1 + 2 - 7 - 2 - 3
    assert str(row.fantasy_points) == "38.0"  # 20 + 6 + 6 + 3 + 6 - 3


def test_missing_key_and_json_null_are_null(spark):
    doc = game(1, "A", "B", 100, 90)
    del doc["season"]
    doc["status"] = None
    row = staging.stg_games(raw_df(spark, [(doc, D1)])).first()
    assert row.season is None and row.game_status is None and row.home_score == 100


@pytest.mark.parametrize("bad", ["{not json", "", "   ", "\n", "\t", "[1, 2]", '{"id": 1'])
def test_malformed_or_empty_json_raises(spark, bad):
    with pytest.raises(Exception):
        staging.stg_games(raw_df(spark, [(bad, D1)])).collect()


def test_null_document_gives_null_fields(spark):
    row = staging.stg_games(raw_df(spark, [(None, D1)])).first()
    assert row.game_id is None and row.winner is None


def test_non_integer_text_raises(spark):
    doc = game(1, "A", "B", "12.7", 90)
    with pytest.raises(Exception):
        staging.stg_games(raw_df(spark, [(doc, D1)])).collect()


def test_standings_team_without_home_games(spark):
    teams = raw_df(spark, [(team_doc("A", 5, 5, 110.0, 100.0), D1), (team_doc("B", 6, 4, 110.0, 100.0), D1),
                           (team_doc("C", 1, 9, 100.0, 110.0), D1)])
    games = raw_df(spark, [(game(1, "A", "B", 100, 90), D1), (game(2, "A", "B", 80, 90), D1)])
    dim = marts.dim_teams(staging.stg_team_stats(teams))
    fct = marts.fct_game_results(staging.stg_games(games))
    rows = by(reports.rpt_team_standings(dim, fct).collect(), "team_abbreviation")
    assert (rows["A"].home_games_played, rows["A"].home_wins, rows["A"].total_wins_in_data) == (2, 1, 1)
    assert (rows["B"].home_games_played, rows["B"].home_wins, rows["B"].total_wins_in_data) == (0, 0, 1)
    assert (rows["C"].home_games_played, rows["C"].home_wins, rows["C"].total_wins_in_data) == (0, 0, 0)
    assert [rows[t].overall_rank for t in "BAC"] == [1, 2, 3]


def test_rankings_break_ties_by_player_then_team(spark):
    docs = [(stat_doc(i, player_id=p, team={"abbreviation": t}, pts=10), D1)
            for i, (p, t) in enumerate([(2, "A"), (1, "B"), (1, "A")])]
    perf = marts.fct_player_performance(staging.stg_player_stats(raw_df(spark, docs)))
    rows = reports.rpt_player_rankings(perf).collect()
    assert [(r.player_id, r.team, r.efficiency_rank, r.scoring_rank) for r in rows] == [
        ("1", "A", 1, 1), ("1", "B", 2, 2), ("2", "A", 3, 3)
    ]
    assert all(isinstance(r.efficiency_rank, int) for r in rows)
    assert dict(perf.dtypes)["fantasy_points"] == "decimal(17,1)"


def test_mean_score_is_over_known_scores(spark):
    from pyspark.sql import functions as F

    from courtline.plans import analytics

    games = marts.fct_game_results(staging.stg_games(raw_df(spark, [(game(1, "A", "B", 100, 90), D1), (game(2, "A", "B", None, 80), D1)])))
    perf = marts.fct_player_performance(staging.stg_player_stats(raw_df(spark, [(stat_doc(1, pts=9), D1)])))
    # B wins game 2; its share is lower on the day itself and higher later
    days = [(team_doc("A", 8, 2, 110.0, 100.0), D1), (team_doc("B", 1, 9, 110.0, 100.0), D1), (team_doc("B", 99, 0, 110.0, 100.0), D2)]
    team_days = staging.stg_team_stats(raw_df(spark, days))
    day = F.lit(D1)
    row = analytics.league_summary(games, perf, team_days, marts.dim_teams(team_days), day).first()
    assert (row.avg_score, row.upsets, row.total_teams, row.games_played_yesterday) == (90.0, 1, 2, 2)


def test_watchlist_stops_at_its_day(spark):
    from pyspark.sql import functions as F

    from courtline.plans import analytics

    docs = [(stat_doc(i, pts=10), D1) for i in range(1, 7)] + [(stat_doc(99, pts=40), D1), (stat_doc(100, pts=2), D2)]
    perf = marts.fct_player_performance(staging.stg_player_stats(raw_df(spark, docs)))
    early = analytics.watchlist_alerts(perf, F.lit(D1)).collect()
    late = analytics.watchlist_alerts(perf, F.lit(D2)).collect()
    assert [(r.alert_type, r.last_game_date, r.earlier_games) for r in early] == [("breakout_game", D1, 6)]
    assert [(r.alert_type, r.last_game_date, r.earlier_games) for r in late] == [("slump_alert", D2, 7)]
