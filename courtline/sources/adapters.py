"""Sports-shaped raw tables derived from the driver's TPC-H-style tables.

The input tables hold no sports data, so each raw table is a Spark query over
them that ends in the raw layout ``(partition_date DATE, data STRING)``, where
``data`` is one JSON document per row, exactly as the ingestion layer lands it.
Numbers below are the fixed mapping rules (our own definitions); the DuckDB
oracle computes the same columns from the same tables without JSON.

* games        orders x customer x nation (home, visitor); date o_orderdate
* player_stats lineitem x supplier; date l_shipdate
* team_stats   distinct (event day, user_id % 25) x nation; date of the event
* team_payroll customer grouped by nation (the salary sheet's rows)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.functions.json import build_json
from courtline.operators.joins import lookup_join
from courtline.sources.tables import read_table

N_TEAMS = 25          # one team per nation
N_PLAYERS = 500       # player_id = partkey % 500 + 1


def team_ref(key: Column, name: Column | None = None) -> Column:
    """Team object ``{abbreviation: 'N<k>', full_name: <nation name>}``."""
    fields = [F.concat(F.lit("N"), key.cast("string")).alias("abbreviation")]
    if name is not None:
        fields.append(name.alias("full_name"))
    return F.struct(*fields)


def _nation(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    return read_table(spark, root, "nation", "n_nationkey", "n_name").select(
        F.col("n_nationkey").alias(f"{prefix}_key"), F.col("n_name").alias(f"{prefix}_name")
    )


def _day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def games_raw(spark: SparkSession, root: str) -> DataFrame:
    """Raw games: one document per order."""
    o = read_table(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = read_table(spark, root, "customer", "c_custkey", "c_nationkey")
    # orders x customer is a fact-to-fact join at scale: let Spark/AQE choose.
    g = o.join(c, o.o_custkey == c.c_custkey).withColumn(
        "visitor_key", (F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % N_TEAMS
    )
    g = lookup_join(g, _nation(spark, root, "h"), F.col("c_nationkey") == F.col("h_key"))
    g = lookup_join(g, _nation(spark, root, "v"), F.col("visitor_key") == F.col("v_key"))
    doc = F.struct(
        F.col("o_orderkey").alias("id"),
        _day_text(F.col("o_orderdate")).alias("date"),
        F.year("o_orderdate").alias("season"),
        F.col("o_orderstatus").alias("status"),
        team_ref(F.col("c_nationkey"), F.col("h_name")).alias("home_team"),
        team_ref(F.col("visitor_key"), F.col("v_name")).alias("visitor_team"),
        (85 + (F.col("o_orderkey") * 7) % 46).alias("home_team_score"),
        (85 + (F.col("o_custkey") * 13 + F.col("o_orderkey")) % 46).alias("visitor_team_score"),
    )
    return g.select(F.to_date("o_orderdate").alias("partition_date"), build_json(doc).alias("data"))


def player_stats_raw(spark: SparkSession, root: str) -> DataFrame:
    """Raw player box scores: one document per line item."""
    li = read_table(
        spark, root, "lineitem",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate",
    )
    s = read_table(spark, root, "supplier", "s_suppkey", "s_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    q = F.col("l_quantity").cast("int")
    doc = F.struct(
        (ok * 10 + ln).alias("id"),
        ok.alias("game_id"),
        (pk % N_PLAYERS + 1).alias("player_id"),
        team_ref(F.col("s_nationkey")).alias("team"),
        _day_text(F.col("l_shipdate")).alias("date"),
        F.concat((5 + q % 36).cast("string"), F.lit(":00")).alias("min"),
        (q % 46).alias("pts"),
        ((pk * 3 + ln) % 19).alias("reb"),
        ((sk * 5 + ln) % 16).alias("ast"),
        ((ok + ln) % 6).alias("stl"),
        ((pk + sk) % 6).alias("blk"),
        (ok % 8).alias("turnover"),
        ((pk * 7) % 19).alias("fgm"),
        ((ok * 3 + pk) % 26).alias("fga"),
        (sk % 9).alias("fg3m"),
        ((ok + sk) % 13).alias("fg3a"),
        (pk % 13).alias("ftm"),
        ((pk + ln) % 15).alias("fta"),
        (ok % 7).alias("pf"),
    )
    return j.select(F.to_date("l_shipdate").alias("partition_date"), build_json(doc).alias("data"))


def team_stats_raw(spark: SparkSession, root: str) -> DataFrame:
    """Raw team season averages: one document per (event day, team) seen in events."""
    e = read_table(spark, root, "events", "ts", "user_id")
    # distinct on two small columns: the partial aggregate in each scan task
    # already collapses the rows, so the scan is not spread first
    days = e.select(F.to_date("ts").alias("day"), (F.col("user_id") % N_TEAMS).alias("k")).distinct()
    j = lookup_join(days, _nation(spark, root, "t"), F.col("k") == F.col("t_key"))
    k = F.col("k")
    d = F.unix_date("day")  # day number since 1970-01-01

    def tenths(base: int, expr: Column, scale: float) -> Column:
        return (F.lit(base) + expr).cast("double") / scale

    doc = F.struct(
        team_ref(k, F.col("t_name")).alias("team"),
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        ((k * 7 + d * 3) % 61).alias("wins"),
        ((k * 11 + d * 5) % 61).alias("losses"),
        tenths(1000, (k * 31 + d * 17) % 201, 10.0).alias("pts_per_game"),
        tenths(380, (k * 5 + d) % 121, 10.0).alias("reb_per_game"),
        tenths(200, (k * 3 + d) % 101, 10.0).alias("ast_per_game"),
        tenths(1000, (k * 13 + d * 29) % 201, 10.0).alias("opp_pts_per_game"),
        tenths(420, (k + d) % 101, 1000.0).alias("fg_pct"),
        tenths(320, (k * 2 + d) % 81, 1000.0).alias("fg3_pct"),
        tenths(720, (k * 3 + d) % 131, 1000.0).alias("ft_pct"),
    )
    return j.select(F.col("day").alias("partition_date"), build_json(doc).alias("data"))


def team_payroll(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the salary sheet: one per team (nation) with its payroll.

    total_salary = 100,000,000 + (sum of account balances in cents mod 9e9) / 100,
    num_players = number of customers of the nation. Integer cents keep the
    sum exact in any engine.
    """
    c = read_table(spark, root, "customer", "c_nationkey", "c_acctbal")
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    per_team = c.groupBy("c_nationkey").agg(
        F.sum(cents).alias("cents"), F.count(F.lit(1)).cast("int").alias("num_players")
    )
    j = lookup_join(per_team, _nation(spark, root, "t"), F.col("c_nationkey") == F.col("t_key"))
    return j.select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("team_abbr"),
        F.col("t_name").alias("team_name"),
        ((F.lit(10_000_000_000) + F.pmod(F.col("cents"), F.lit(9_000_000_000))) / 100.0)
        .cast("double").alias("total_salary"),
        F.col("num_players"),
    )


RAW_BUILDERS = {
    "games": games_raw,
    "player_stats": player_stats_raw,
    "team_stats": team_stats_raw,
}
