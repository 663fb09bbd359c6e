"""Model invariants on the sf0.001 tables."""

from pyspark.sql import functions as F

from courtline.plans import chain
from tests.conftest import SF_SMALL


def test_dim_teams_one_row_per_team(spark):
    dim = chain.dim_teams(spark, SF_SMALL)
    assert dim.count() == dim.select("team_abbreviation").distinct().count() > 0


def test_standings_counts_are_consistent(spark):
    st = chain.rpt_team_standings(spark, SF_SMALL).collect()
    assert sorted(r.overall_rank for r in st) == list(range(1, len(st) + 1))
    assert all(r.home_wins <= r.home_games_played for r in st)
    ranked = sorted(st, key=lambda r: r.overall_rank)
    assert all(a.win_pct >= b.win_pct for a, b in zip(ranked, ranked[1:]))
    games = chain.fct_game_results(spark, SF_SMALL)
    # every game has one winner; teams missing from the dimension drop out
    wins = {r.winner: r["count"] for r in games.groupBy("winner").count().collect()}
    assert all(r.total_wins_in_data == wins.get(r.team_abbreviation, 0) for r in st)
    assert sum(r.total_wins_in_data for r in st) <= games.count()


def test_game_types_partition_the_games(spark):
    games = chain.fct_game_results(spark, SF_SMALL)
    by_type = games.groupBy("game_type").count().collect()
    assert sum(r["count"] for r in by_type) == games.count()
    assert {r.game_type for r in by_type} <= {"Nail Biter", "Close Game", "Comfortable Win", "Blowout"}


def test_player_rankings_ranks_are_permutations(spark):
    rk = chain.rpt_player_rankings(spark, SF_SMALL)
    n = rk.count()
    for c in ("efficiency_rank", "scoring_rank", "fantasy_rank"):
        agg = rk.agg(F.min(c), F.max(c), F.countDistinct(c)).first()
        assert tuple(agg) == (1, n, n)
    perf = chain.fct_player_performance(spark, SF_SMALL)
    assert rk.agg(F.sum("games_played")).first()[0] == perf.count()
    first = rk.orderBy("efficiency_rank").first()
    assert first.avg_efficiency == rk.agg(F.max("avg_efficiency")).first()[0]
