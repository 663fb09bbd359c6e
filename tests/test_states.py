"""Per-day player states: merged states equal the aggregates over the facts, and only re-landed days are read."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from courtline.plans import analytics, marts, materialize, reports, staging, states
from courtline.sinks import manifest
from courtline.sinks.tables import write_partitions
from tests.conftest import SF_SMALL
from tests.test_fixtures import raw_df, stat_doc

D = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(30)]


def facts(spark, docs):
    return marts.fct_player_performance(staging.stg_player_stats(raw_df(spark, docs)))


def mixed(spark):
    docs = []
    for k in range(160):
        doc = stat_doc(k * 37 % 1000, player_id=k % 7, team={"abbreviation": "AB"[k % 2]}, pts=k * 13 % 45, reb=k % 12, ast=k * 5 % 11, fga=k % 5, fgm=k % 3)
        if k % 11 == 0:
            doc["pts"] = None
        docs.append((doc, D[k % 20]))
    return facts(spark, docs)


def test_merged_states_equal_the_aggregates(spark):
    perf = mixed(spark)
    got = states.merged_aggregates(states.player_days(perf))
    want = reports.player_aggregates(perf)
    assert got.schema.simpleString() == want.select(*got.columns).schema.simpleString()
    assert sorted(got.select(*want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_form_against_row_by_row(spark):
    perf = mixed(spark)
    rows = perf.select("player_id", "game_date", "stat_id", "fantasy_points").collect()
    for r in states.player_form(states.player_days(perf)).collect():
        mine = sorted((x for x in rows if x.player_id == r.player_id), key=lambda x: (x.game_date, int(x.stat_id), x.fantasy_points is not None, x.fantasy_points or 0))
        known = [x.fantasy_points for x in mine if x.fantasy_points is not None]
        last = mine[-1]
        assert (r.last_game_date, r.last_fantasy_points) == (last.game_date, last.fantasy_points)
        assert r.earlier_games == len(known) - (last.fantasy_points is not None)
        assert r.earlier_fp == sum(known) - (last.fantasy_points or 0)


def test_order_of_a_days_games(spark):
    """Stat ids compare as numbers, none lowest; negative ids and points keep their order."""
    ids = ["9", "10", "-5", "9223372036854775807", "-9223372036854775808", "x", None]
    values = [(i, p) for i in ids for p in ("-99999.9", "-0.1", "0.0", "3.5", None)]
    rows = spark.createDataFrame(values, "stat_id string, p string").withColumn("fantasy_points", F.col("p").cast(marts.FANTASY_TYPE))
    keyed = rows.select("stat_id", "fantasy_points", states.game_key().alias("k")).select("*", states.points_of(F.col("k")).alias("back")).collect()
    assert all(r.back == r.fantasy_points for r in keyed)

    def order(r):
        number = int(r.stat_id) if r.stat_id not in (None, "x") else None
        return (number is not None, number or 0, r.fantasy_points is not None, r.fantasy_points or 0)

    assert [order(r) for r in sorted(keyed, key=lambda r: r.k)] == sorted(order(r) for r in keyed)


def test_one_scan_of_the_facts_and_no_self_join(spark):
    from courtline.plans import chain

    perf = chain.fct_player_performance(spark, SF_SMALL)
    plan = analytics.alerts_of(states.player_days(perf), F.lit(D[0]))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet .*l_orderkey", plan)) == 1
    joins = re.findall(r"(\w*Join)", plan)
    assert len(joins) == len(re.findall(r"(\w*Join)", perf._jdf.queryExecution().executedPlan().toString()))  # those of the adapter
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "Window" not in plan


def test_a_day_landed_again_reads_that_day_alone(spark, tmp_dir, monkeypatch):
    stg, root = os.path.join(tmp_dir, "stg"), os.path.join(tmp_dir, "states")
    path = os.path.join(stg, "player_stats")
    stats = staging.stg_player_stats(raw_df(spark, [(stat_doc(k, pts=k % 30, player_id=k % 5), D[k % 30]) for k in range(120)]))
    write_partitions(stats, path, col="game_date")
    assert set(states.build_states(spark, stg, root)) == set(D)
    assert states.build_states(spark, stg, root) == {}
    again = staging.stg_player_stats(raw_df(spark, [(stat_doc(900, pts=44, player_id=1), D[3])]))
    write_partitions(again, path, col="game_date", days=[D[3], D[4]])
    assert states.pending_state_days(spark, stg, root) == [D[3], D[4]]
    read = []
    real = states.player_days

    def watched(perf):
        read.append(perf)
        return real(perf)

    monkeypatch.setattr(states, "player_days", watched)
    assert states.build_states(spark, stg, root) == {D[3]: 1, D[4]: 0}
    monkeypatch.undo()
    assert [r.game_date for r in read[0].select("game_date").distinct().collect()] == [D[3]]
    assert "dynamicpruning" in read[0]._jdf.queryExecution().executedPlan().toString()
    perf = marts.fct_player_performance(materialize.read_staging(spark, stg, "player_stats"))
    got = states.merged_aggregates(states.read_states(spark, root)).collect()
    assert sorted(got, key=str) == sorted(reports.player_aggregates(perf).select(*got[0].__fields__).collect(), key=str)
    assert {r.day: r.source for r in manifest.entries(spark, os.path.join(root, "player_days")).collect()} == {
        r.day: r["write"] for r in manifest.entries(spark, path).collect()
    }
