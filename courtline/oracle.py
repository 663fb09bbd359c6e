"""Independent DuckDB SQL for every checked query key.

These compute the same columns directly from the input tables (no JSON), so a
match checks the adapters, the JSON round trip and every model at once. The
views ``orders customer nation lineitem supplier events`` are the input tables.
"""

from __future__ import annotations

# --- building blocks (CTEs) --------------------------------------------------

STG_GAMES = """
og AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate,
         c.c_nationkey AS hk, (c.c_nationkey + 1 + o.o_orderkey % 24) % 25 AS vk
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
games_typed AS (
  SELECT CAST(og.o_orderkey AS VARCHAR) AS game_id,
         CAST(og.o_orderdate AS DATE) AS game_date,
         CAST(year(og.o_orderdate) AS INTEGER) AS season,
         og.o_orderstatus AS game_status,
         'N' || CAST(og.hk AS VARCHAR) AS home_team,
         hn.n_name AS home_team_name,
         'N' || CAST(og.vk AS VARCHAR) AS away_team,
         vn.n_name AS away_team_name,
         CAST(85 + (og.o_orderkey * 7) % 46 AS INTEGER) AS home_score,
         CAST(85 + (og.o_custkey * 13 + og.o_orderkey) % 46 AS INTEGER) AS away_score
  FROM og
  JOIN nation hn ON hn.n_nationkey = og.hk
  JOIN nation vn ON vn.n_nationkey = og.vk
),
stg_games AS (
  SELECT *,
         home_score - away_score AS score_differential,
         CASE WHEN home_score > away_score THEN home_team ELSE away_team END AS winner,
         CASE WHEN home_score > away_score THEN away_team ELSE home_team END AS loser
  FROM games_typed
)"""

FCT_GAME_RESULTS = STG_GAMES + """,
fct_game_results AS (
  SELECT game_id, game_date, season, game_status, home_team, home_team_name,
         away_team, away_team_name, home_score, away_score, score_differential,
         abs(score_differential) AS margin_of_victory,
         winner, loser,
         CASE WHEN abs(score_differential) <= 3 THEN 'Nail Biter'
              WHEN abs(score_differential) <= 10 THEN 'Close Game'
              WHEN abs(score_differential) <= 20 THEN 'Comfortable Win'
              ELSE 'Blowout' END AS game_type,
         home_score + away_score AS total_points,
         CASE WHEN home_score > away_score THEN 'Home' ELSE 'Away' END AS winner_location
  FROM stg_games
)"""

STG_PLAYER_STATS = """
li AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln,
         CAST(l.l_quantity AS BIGINT) AS q, l.l_shipdate, s.s_nationkey
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
ps_typed AS (
  SELECT CAST(ok * 10 + ln AS VARCHAR) AS stat_id,
         CAST(ok AS VARCHAR) AS game_id,
         CAST(pk % 500 + 1 AS VARCHAR) AS player_id,
         'N' || CAST(s_nationkey AS VARCHAR) AS team,
         CAST(l_shipdate AS DATE) AS game_date,
         CAST(5 + q % 36 AS VARCHAR) || ':00' AS minutes_played,
         CAST(q % 46 AS INTEGER) AS points,
         CAST((pk * 3 + ln) % 19 AS INTEGER) AS rebounds,
         CAST((sk * 5 + ln) % 16 AS INTEGER) AS assists,
         CAST((ok + ln) % 6 AS INTEGER) AS steals,
         CAST((pk + sk) % 6 AS INTEGER) AS blocks,
         CAST(ok % 8 AS INTEGER) AS turnovers,
         CAST((pk * 7) % 19 AS INTEGER) AS field_goals_made,
         CAST((ok * 3 + pk) % 26 AS INTEGER) AS field_goals_attempted,
         CAST(sk % 9 AS INTEGER) AS three_pointers_made,
         CAST((ok + sk) % 13 AS INTEGER) AS three_pointers_attempted,
         CAST(pk % 13 AS INTEGER) AS free_throws_made,
         CAST((pk + ln) % 15 AS INTEGER) AS free_throws_attempted,
         CAST(ok % 7 AS INTEGER) AS personal_fouls
  FROM li
),
stg_player_stats AS (
  SELECT stat_id, game_id, player_id, team, game_date, minutes_played,
         points, rebounds, assists, steals, blocks, turnovers,
         field_goals_made, field_goals_attempted,
         CASE WHEN field_goals_attempted > 0
              THEN round(CAST(field_goals_made AS FLOAT) / field_goals_attempted, 3)
              ELSE 0.0 END AS fg_pct,
         three_pointers_made, three_pointers_attempted,
         CASE WHEN three_pointers_attempted > 0
              THEN round(CAST(three_pointers_made AS FLOAT) / three_pointers_attempted, 3)
              ELSE 0.0 END AS fg3_pct,
         free_throws_made, free_throws_attempted,
         CASE WHEN free_throws_attempted > 0
              THEN round(CAST(free_throws_made AS FLOAT) / free_throws_attempted, 3)
              ELSE 0.0 END AS ft_pct,
         personal_fouls
  FROM ps_typed
)"""

FCT_PLAYER_PERFORMANCE = STG_PLAYER_STATS + """,
fct_player_performance AS (
  SELECT *,
         points + rebounds + assists + steals + blocks
           - (field_goals_attempted - field_goals_made)
           - (free_throws_attempted - free_throws_made)
           - turnovers AS efficiency_rating,
         points * 1.0 + rebounds * 1.2 + assists * 1.5 + steals * 3.0 + blocks * 3.0
           - turnovers * 1.0 AS fantasy_points,
         len(list_filter([points, rebounds, assists, steals, blocks], lambda x: x >= 10)) >= 2 AS is_double_double,
         len(list_filter([points, rebounds, assists, steals, blocks], lambda x: x >= 10)) >= 3 AS is_triple_double
  FROM stg_player_stats
)"""

STG_TEAM_STATS = """
team_days AS (
  SELECT DISTINCT CAST(ts AS DATE) AS day, user_id % 25 AS k FROM events
),
td AS (
  SELECT t.day, t.k, n.n_name, (t.day - DATE '1970-01-01') AS d
  FROM team_days t JOIN nation n ON n.n_nationkey = t.k
),
stg_team_stats AS (
  SELECT 'N' || CAST(k AS VARCHAR) AS team_abbreviation,
         n_name AS team_name,
         day AS stat_date,
         CAST((k * 7 + d * 3) % 61 AS INTEGER) AS wins,
         CAST((k * 11 + d * 5) % 61 AS INTEGER) AS losses,
         CAST(CAST(1000 + (k * 31 + d * 17) % 201 AS DOUBLE) / 10.0 AS FLOAT) AS pts_per_game,
         CAST(CAST(380 + (k * 5 + d) % 121 AS DOUBLE) / 10.0 AS FLOAT) AS reb_per_game,
         CAST(CAST(200 + (k * 3 + d) % 101 AS DOUBLE) / 10.0 AS FLOAT) AS ast_per_game,
         CAST(CAST(1000 + (k * 13 + d * 29) % 201 AS DOUBLE) / 10.0 AS FLOAT) AS opp_pts_per_game,
         CAST(CAST(420 + (k + d) % 101 AS DOUBLE) / 1000.0 AS FLOAT) AS fg_pct,
         CAST(CAST(320 + (k * 2 + d) % 81 AS DOUBLE) / 1000.0 AS FLOAT) AS fg3_pct,
         CAST(CAST(720 + (k * 3 + d) % 131 AS DOUBLE) / 1000.0 AS FLOAT) AS ft_pct,
         round(CAST(CAST(1000 + (k * 31 + d * 17) % 201 AS DOUBLE) / 10.0 AS FLOAT)
               - CAST(CAST(1000 + (k * 13 + d * 29) % 201 AS DOUBLE) / 10.0 AS FLOAT), 1) AS net_rating
  FROM td
)"""

DIM_TEAMS = STG_TEAM_STATS + """,
latest_team AS (
  SELECT *, row_number() OVER (PARTITION BY team_abbreviation
           ORDER BY stat_date DESC, wins + losses DESC, wins DESC, net_rating DESC) AS rn
  FROM stg_team_stats
),
dim_teams AS (
  SELECT team_abbreviation, team_name, stat_date AS last_updated, wins, losses,
         wins + losses AS games_played,
         CASE WHEN wins + losses > 0 THEN round(CAST(wins AS FLOAT) / (wins + losses), 3)
              ELSE 0.0 END AS win_pct,
         pts_per_game, reb_per_game, ast_per_game, opp_pts_per_game,
         fg_pct, fg3_pct, ft_pct, net_rating,
         CASE WHEN net_rating > 5 THEN 'Elite'
              WHEN net_rating > 2 THEN 'Above Average'
              WHEN net_rating > -2 THEN 'Average'
              WHEN net_rating > -5 THEN 'Below Average'
              ELSE 'Rebuilding' END AS team_tier
  FROM latest_team WHERE rn = 1
)"""

RPT_TEAM_STANDINGS = FCT_GAME_RESULTS + "," + DIM_TEAMS + """,
rpt_team_standings AS (
  SELECT t.team_abbreviation, t.team_name, t.wins, t.losses, t.games_played, t.win_pct,
         t.pts_per_game, t.opp_pts_per_game, t.net_rating, t.team_tier,
         t.fg_pct, t.fg3_pct, t.ft_pct,
         (SELECT count(*) FROM fct_game_results g WHERE g.home_team = t.team_abbreviation) AS home_games_played,
         (SELECT count(*) FROM fct_game_results g
          WHERE g.home_team = t.team_abbreviation AND g.winner = t.team_abbreviation) AS home_wins,
         (SELECT count(*) FROM fct_game_results g WHERE g.winner = t.team_abbreviation) AS total_wins_in_data,
         row_number() OVER (ORDER BY t.win_pct DESC, t.team_abbreviation) AS overall_rank
  FROM dim_teams t
)"""

RPT_PLAYER_RANKINGS = FCT_PLAYER_PERFORMANCE + """,
player_agg AS (
  SELECT player_id, team, count(*) AS games_played,
         round(avg(points), 1) AS avg_points,
         round(avg(rebounds), 1) AS avg_rebounds,
         round(avg(assists), 1) AS avg_assists,
         round(avg(steals), 1) AS avg_steals,
         round(avg(blocks), 1) AS avg_blocks,
         round(avg(turnovers), 1) AS avg_turnovers,
         round(avg(efficiency_rating), 1) AS avg_efficiency,
         round(avg(fantasy_points), 1) AS avg_fantasy_points,
         round(avg(fg_pct), 3) AS avg_fg_pct,
         round(avg(fg3_pct), 3) AS avg_fg3_pct,
         round(avg(ft_pct), 3) AS avg_ft_pct,
         CAST(sum(CASE WHEN is_double_double THEN 1 ELSE 0 END) AS BIGINT) AS double_doubles,
         CAST(sum(CASE WHEN is_triple_double THEN 1 ELSE 0 END) AS BIGINT) AS triple_doubles,
         max(points) AS max_points, max(rebounds) AS max_rebounds, max(assists) AS max_assists
  FROM fct_player_performance GROUP BY player_id, team
),
rpt_player_rankings AS (
  SELECT *,
         row_number() OVER (ORDER BY avg_efficiency DESC, player_id, team) AS efficiency_rank,
         row_number() OVER (ORDER BY avg_points DESC, player_id, team) AS scoring_rank,
         row_number() OVER (ORDER BY avg_fantasy_points DESC, player_id, team) AS fantasy_rank
  FROM player_agg
)"""


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


ORACLE: dict[str, str] = {
    "stg_games": _with(STG_GAMES, "SELECT * FROM stg_games"),
    "fct_game_results": _with(FCT_GAME_RESULTS, "SELECT * FROM fct_game_results"),
    "stg_player_stats": _with(STG_PLAYER_STATS, "SELECT * FROM stg_player_stats"),
    "fct_player_performance": _with(
        FCT_PLAYER_PERFORMANCE,
        "SELECT * REPLACE (CAST(fantasy_points AS DECIMAL(17,1)) AS fantasy_points) "
        "FROM fct_player_performance",
    ),
    "stg_team_stats": _with(STG_TEAM_STATS, "SELECT * FROM stg_team_stats"),
    "dim_teams": _with(DIM_TEAMS, "SELECT * FROM dim_teams"),
    "rpt_team_standings": _with(RPT_TEAM_STANDINGS, "SELECT * FROM rpt_team_standings"),
    "rpt_player_rankings": _with(RPT_PLAYER_RANKINGS, "SELECT * FROM rpt_player_rankings"),
}


# --- operator keys -------------------------------------------------------------

GAMES_JSON = """
games_json AS (
  SELECT CAST(og.o_orderdate AS DATE) AS partition_date,
         CAST(to_json({
           'id': og.o_orderkey,
           'date': strftime(og.o_orderdate, '%Y-%m-%d'),
           'season': year(og.o_orderdate),
           'status': og.o_orderstatus,
           'home_team': {'abbreviation': 'N' || CAST(og.hk AS VARCHAR), 'full_name': hn.n_name},
           'visitor_team': {'abbreviation': 'N' || CAST(og.vk AS VARCHAR), 'full_name': vn.n_name},
           'home_team_score': 85 + (og.o_orderkey * 7) % 46,
           'visitor_team_score': 85 + (og.o_custkey * 13 + og.o_orderkey) % 46
         }) AS VARCHAR) AS data
  FROM og
  JOIN nation hn ON hn.n_nationkey = og.hk
  JOIN nation vn ON vn.n_nationkey = og.vk
)"""

CALENDAR = STG_GAMES + """,
bounds AS (SELECT min(game_date) AS lo, max(game_date) AS hi FROM stg_games),
days AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds
),
per_day AS (SELECT game_date AS day, count(*) AS n FROM stg_games GROUP BY game_date),
calendar AS (
  SELECT d.day, coalesce(p.n, 0) AS rows FROM days d LEFT JOIN per_day p ON d.day = p.day
)"""

PAYROLL = """
payroll AS (
  SELECT 'N' || CAST(c.c_nationkey AS VARCHAR) AS team_abbr,
         n.n_name AS team_name,
         CAST((10000000000 + (((sum(CAST(round(c.c_acctbal * 100) AS BIGINT)) % 9000000000)
                + 9000000000) % 9000000000)) / 100.0 AS DOUBLE) AS total_salary,
         CAST(count(*) AS INTEGER) AS num_players
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  GROUP BY c.c_nationkey, n.n_name
)"""

WATCHLIST = FCT_PLAYER_PERFORMANCE + """,
last_game AS (
  SELECT player_id, game_date AS last_game_date, fantasy_points AS last_fp,
         count(*) OVER (PARTITION BY player_id) AS games,
         sum(fantasy_points) OVER (PARTITION BY player_id) AS total_fp,
         row_number() OVER (PARTITION BY player_id
                            ORDER BY game_date DESC, CAST(stat_id AS BIGINT) DESC, fantasy_points DESC) AS rn
  FROM fct_player_performance
),
form AS (
  SELECT player_id, last_game_date, last_fp, games - 1 AS n, total_fp - last_fp AS earlier
  FROM last_game WHERE rn = 1
),
alerts AS (
  SELECT (SELECT max(game_date) FROM fct_player_performance) AS report_date,
         player_id,
         CASE WHEN last_fp * n >= 1.5 * earlier THEN 'breakout_game'
              WHEN last_fp * n <= 0.5 * earlier THEN 'slump_alert' END AS alert_type,
         CASE WHEN last_fp * n >= 2.0 * earlier OR last_fp * n <= 0.25 * earlier
              THEN 'high' ELSE 'medium' END AS severity,
         last_game_date,
         CAST(last_fp AS DECIMAL(17,1)) AS last_fantasy_points,
         n AS earlier_games,
         'Performance threshold exceeded' AS detail
  FROM form
  WHERE n >= 5 AND earlier > 0
    AND (last_fp * n >= 1.5 * earlier OR last_fp * n <= 0.5 * earlier)
)"""

def _league(day: str) -> str:
    """The league on one day; ``day`` picks it from the games."""
    return _with(
        FCT_GAME_RESULTS + "," + DIM_TEAMS + "," + FCT_PLAYER_PERFORMANCE,
        f""", chosen AS (SELECT {day} AS d FROM fct_game_results),
g AS (SELECT * FROM fct_game_results WHERE game_date = (SELECT d FROM chosen)),
scores AS (SELECT unnest([home_score, away_score]) AS score FROM g),
p AS (SELECT * FROM fct_player_performance WHERE game_date = (SELECT d FROM chosen)),
share AS (SELECT team_abbreviation AS team, CASE WHEN wins + losses > 0 THEN wins / (wins + losses) ELSE 0 END AS pct
          FROM stg_team_stats WHERE stat_date = (SELECT d FROM chosen))
SELECT (SELECT d FROM chosen) AS report_date,
       (SELECT count(*) FROM g) AS games_played_yesterday,
       (SELECT round(avg(score), 1) FROM scores) AS avg_score,
       (SELECT player_id FROM p ORDER BY points DESC, player_id DESC LIMIT 1) AS highest_scorer,
       (SELECT max(points) FROM p) AS highest_score,
       (SELECT count(*) FROM g WHERE (SELECT round(pct, 3) FROM share WHERE team = winner)
                                   < (SELECT round(pct, 3) FROM share WHERE team = loser)) AS upsets,
       (SELECT CAST(sum(three_pointers_made) AS BIGINT) FROM p) AS total_three_pointers,
       (SELECT min(margin_of_victory) FROM g) AS closest_game_margin,
       (SELECT count(*) FROM g WHERE contains(game_status, 'OT')) AS overtime_games,
       (SELECT count(DISTINCT team_abbreviation) FROM stg_team_stats) AS total_teams""",
    )


ORACLE.update({
    "raw_scan": ORACLE["stg_games"],
    "land_response": ORACLE["stg_games"],
    "stream_landing": ORACLE["stg_games"],
    "incremental_staging": ORACLE["stg_games"],
    "partition_replace": _with(
        STG_GAMES,
        "SELECT * FROM stg_games WHERE game_date <> (SELECT min(game_date) FROM stg_games)",
    ),
    "json_build": _with(STG_GAMES.split("games_typed AS")[0].rstrip().rstrip(",") + "," + GAMES_JSON,
                        "SELECT partition_date, data FROM games_json"),
    "json_scalar": """
SELECT event_id, props->>'k' AS k_text, CAST(props->>'k' AS INTEGER) AS k FROM events""",
    "json_nested": _with(
        STG_GAMES,
        "SELECT game_id, home_team, home_team_name, away_team, away_team_name FROM stg_games",
    ),
    "guarded_ratio": _with(
        STG_PLAYER_STATS,
        "SELECT stat_id, game_id, player_id, fg_pct, fg3_pct, ft_pct FROM stg_player_stats",
    ),
    "efficiency_rating": _with(
        FCT_PLAYER_PERFORMANCE,
        "SELECT stat_id, game_id, player_id, efficiency_rating FROM fct_player_performance",
    ),
    "weighted_score": _with(
        FCT_PLAYER_PERFORMANCE,
        "SELECT stat_id, game_id, player_id, CAST(fantasy_points AS DECIMAL(17,1)) AS fantasy_points "
        "FROM fct_player_performance",
    ),
    "threshold_count": _with(
        FCT_PLAYER_PERFORMANCE,
        """SELECT stat_id, game_id, player_id,
       CAST(len(list_filter([points, rebounds, assists, steals, blocks], lambda x: x >= 10)) AS INTEGER) AS double_digit_stats,
       is_double_double, is_triple_double
FROM fct_player_performance""",
    ),
    "game_type_bucket": _with(
        FCT_GAME_RESULTS, "SELECT game_id, margin_of_victory, game_type FROM fct_game_results"
    ),
    "team_tier_bucket": _with(
        STG_TEAM_STATS,
        """SELECT team_abbreviation, stat_date, net_rating,
       CASE WHEN net_rating > 5 THEN 'Elite'
            WHEN net_rating > 2 THEN 'Above Average'
            WHEN net_rating > -2 THEN 'Average'
            WHEN net_rating > -5 THEN 'Below Average'
            ELSE 'Rebuilding' END AS team_tier
FROM stg_team_stats""",
    ),
    "group_count": _with(
        FCT_GAME_RESULTS, "SELECT home_team, count(*) AS games FROM fct_game_results GROUP BY home_team"
    ),
    "conditional_count": _with(
        FCT_GAME_RESULTS,
        """SELECT home_team, count(*) AS games,
       CAST(sum(CASE WHEN winner = home_team THEN 1 ELSE 0 END) AS BIGINT) AS home_wins,
       CAST(sum(CASE WHEN game_type = 'Nail Biter' THEN 1 ELSE 0 END) AS BIGINT) AS nail_biters
FROM fct_game_results GROUP BY home_team""",
    ),
    "latest_per_key": _with(
        STG_TEAM_STATS,
        """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY team_abbreviation ORDER BY stat_date DESC) AS rn
  FROM stg_team_stats) WHERE rn = 1""",
    ),
    "global_rank": _with(
        FCT_GAME_RESULTS,
        """SELECT game_id, game_date, total_points,
       row_number() OVER (ORDER BY total_points DESC, game_id) AS points_rank
FROM fct_game_results""",
    ),
    "partition_calendar": _with(CALENDAR, "SELECT day, rows FROM calendar"),
    "backfill_batches": _with(
        CALENDAR,
        """SELECT batch_id, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days,
       CAST(sum(rows) AS BIGINT) AS rows
FROM (SELECT *, CAST((day - (SELECT min(day) FROM calendar)) // 10 AS INTEGER) AS batch_id
      FROM calendar) GROUP BY batch_id""",
    ),
    "for_day": _with(
        FCT_GAME_RESULTS,
        "SELECT * FROM fct_game_results WHERE game_date = (SELECT max(game_date) FROM fct_game_results)",
    ),
    "sheet_ingest": _with(PAYROLL, "SELECT * FROM payroll"),
    "salary_cap": _with(
        PAYROLL,
        """SELECT team_abbr, team_name, total_salary,
       136000000.0::DOUBLE - total_salary AS cap_space,
       round(greatest(0.0::DOUBLE, total_salary - 165000000.0::DOUBLE) * 1.5, 2) AS luxury_tax_bill,
       num_players,
       round(total_salary / num_players, 2) AS avg_salary,
       CASE WHEN 136000000.0::DOUBLE - total_salary < 0 THEN 'Over Cap' ELSE 'Under Cap' END AS cap_status
FROM payroll""",
    ),
    "watchlist_alerts": _with(WATCHLIST, "SELECT * FROM alerts"),
    "watchlist_summary": _with(
        WATCHLIST,
        """SELECT (SELECT max(game_date) FROM fct_player_performance) AS report_date,
       count(*) AS total_alerts,
       count(*) FILTER (WHERE severity = 'high') AS high_severity_count
FROM alerts""",
    ),
    "league_summary": _league("max(game_date)"),
    "league_summary_for_day": _league("max(game_date) FILTER (WHERE game_date <= DATE '1998-06-30')"),
    "watchlist_alerts_for_day": _with(
        FCT_PLAYER_PERFORMANCE.replace(
            "FROM stg_player_stats\n)", "FROM stg_player_stats WHERE game_date <= DATE '1998-06-30'\n)"
        ) + WATCHLIST[len(FCT_PLAYER_PERFORMANCE):],
        "SELECT * REPLACE (DATE '1998-06-30' AS report_date) FROM alerts",
    ),
    "changed_files": "SELECT 1 AS tick, o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus",
    "load_log": _with(
        STG_GAMES + "," + STG_PLAYER_STATS + "," + STG_TEAM_STATS,
        """SELECT 'games' AS table_name, count(*) AS record_count, min(game_date) AS first_partition,
       max(game_date) AS last_partition FROM stg_games
UNION ALL SELECT 'player_stats', count(*), min(game_date), max(game_date) FROM stg_player_stats
UNION ALL SELECT 'team_stats', count(*), min(stat_date), max(stat_date) FROM stg_team_stats""",
    ),
    "day_log": _with(
        STG_GAMES + "," + STG_PLAYER_STATS + "," + STG_TEAM_STATS,
        """SELECT 'games' AS table_name, game_date AS partition_date, count(*) AS record_count FROM stg_games GROUP BY game_date
UNION ALL SELECT 'player_stats', game_date, count(*) FROM stg_player_stats GROUP BY game_date
UNION ALL SELECT 'team_stats', stat_date, count(*) FROM stg_team_stats GROUP BY stat_date""",
    ),
})

ORACLE["watchlist_document"] = ORACLE["watchlist_alerts"]
ORACLE["league_document"] = ORACLE["league_summary"]
ORACLE["salary_sheet"] = ORACLE["salary_cap"]
ORACLE["incremental_rankings"] = ORACLE["rpt_player_rankings"]
ORACLE["backfill_runs"] = ORACLE["dim_teams"]
