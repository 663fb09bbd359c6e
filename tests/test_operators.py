"""Operators: ranged global rank vs the plain window, partition replacement,
landing, sheets, changed-file detection, calendar and batches, plan shapes."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from courtline.operators.partitions import backfill_batches, batch_summary, for_day, partition_calendar
from courtline.operators.windows import global_rank, global_ranks, latest_per_key
from courtline.sinks.tables import write_partitions
from courtline.sources import files, raw
from courtline.plans import landing


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranged_rank_equals_single_window(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 97).alias("m"), F.col("id").alias("k"), (F.col("id") * 7 % 13).alias("x")
    )
    order = [F.col("m").desc(), F.col("k")]
    ranged = global_rank(df, order, "r", keys=["k"], rows_per_range=700)
    plain = df.withColumn("r", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert sorted(ranged.select(*plain.columns).collect()) == sorted(plain.collect())
    assert "SinglePartition" not in _plan(ranged)


def test_ranks_are_one_to_n(spark):
    df = spark.range(0, 3000).select((F.col("id") % 11).alias("a"), (F.col("id") % 7).alias("b"), "id")
    out = global_ranks(
        df,
        {"ra": [F.col("a").desc(), F.col("id")], "rb": [F.col("b"), F.col("id")]},
        keys=["id"],
        rows_per_range=500,
    )
    for c in ("ra", "rb"):
        assert sorted(r[0] for r in out.select(c).collect()) == list(range(1, 3001))


def test_latest_per_key_plans_partial_group_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("d"))
    out = latest_per_key(df, ["k"], [F.col("d").desc()])
    assert sorted(r.d for r in out.collect()) == list(range(990, 1000))
    out.collect()
    assert "WindowGroupLimit" in out._jdf.queryExecution().optimizedPlan().toString()


def _raw_rows(spark, days):
    rows = [(f'{{"id":{i}}}', d) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, raw.RAW_SCHEMA)


def test_partition_replace_is_idempotent_and_clears_empty_days(spark, tmp_dir):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    path = os.path.join(tmp_dir, "games")
    df = _raw_rows(spark, [d1, d1, d2])
    write_partitions(df, path)
    write_partitions(df, path)  # re-run: same content, no duplicates
    assert raw.raw_scan(spark, path).count() == 3
    # a new load for d1 replaces d1 only
    write_partitions(_raw_rows(spark, [d1]), path)
    assert sorted(r.partition_date for r in raw.raw_scan(spark, path).collect()) == [d1, d2]
    # an empty load for d2 clears d2
    empty = spark.createDataFrame([], raw.RAW_SCHEMA)
    write_partitions(empty, path, days=[d2])
    assert [r.partition_date for r in raw.raw_scan(spark, path).collect()] == [d1]


def test_day_filter_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "games")
    write_partitions(_raw_rows(spark, [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]), path)
    one = for_day(raw.raw_scan(spark, path), "partition_date", "2024-01-02")
    assert one.count() == 1
    plan = _plan(one)
    assert "PartitionFilters: [isnotnull(partition_date" in plan and "2024-01-02" in plan


def test_land_response_missing_data_gives_no_rows(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "responses", "partition_date=2024-01-01")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.txt"), "w") as f:
        f.write('{"data": [{"id": 1}, {"id": 2}]}\n{"meta": 1}\n{"data": []}\n')
    rows = raw.land_response(spark, os.path.join(tmp_dir, "responses")).collect()
    assert [(r.partition_date, r.data) for r in rows] == [
        (dt.date(2024, 1, 1), '{"id":1}'), (dt.date(2024, 1, 1), '{"id":2}')
    ]


def test_write_responses_round_trip(spark, tmp_dir):
    days = [dt.date(2024, 1, 1 + i % 3) for i in range(250)]
    df = _raw_rows(spark, days)
    out = os.path.join(tmp_dir, "resp")
    raw.write_responses(df, out, "0000", page_rows=40)
    back = raw.land_response(spark, out)
    assert sorted(back.collect()) == sorted(df.select("partition_date", "data").collect())
    longest = spark.read.text(out).select(F.max(F.size(F.split("value", '\\{"id"')))).first()[0]
    assert longest - 1 <= 40  # no page exceeds page_rows


def test_read_sheet_missing_raises(spark, tmp_dir):
    with pytest.raises(Exception):
        raw.read_sheet(spark, os.path.join(tmp_dir, "nope.csv"), landing.PAYROLL_SCHEMA).collect()


def test_changed_files_sensor(spark, tmp_dir):
    watched = os.path.join(tmp_dir, "sheets")
    os.makedirs(watched)
    p = os.path.join(watched, "salary_cap.csv")
    with open(p, "w") as f:
        f.write("a\n1\n")
    cursor_path = os.path.join(tmp_dir, "cursor")

    def tick():
        return [r.run_key for r in files.tick(spark, watched, cursor_path, "*.csv").collect()]

    first = tick()
    assert len(first) == 1 and first[0].startswith("salary_cap_")
    assert tick() == []  # unchanged
    t = time.time() + 5
    os.utime(p, (t, t))
    second = tick()
    assert len(second) == 1 and second != first  # changed: a new run key
    # two files of one name and time are two runs
    twin = os.path.join(watched, "other", "salary_cap.csv")
    os.makedirs(os.path.dirname(twin))
    with open(twin, "w") as f:
        f.write("a\n1\n")
    for q in (p, twin):
        os.utime(q, (t + 9, t + 9))
    assert len(set(tick())) == 2
    os.remove(p)
    assert tick() == []  # missing file: no change


def test_calendar_and_batches(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 4), dt.date(2024, 1, 25)]
    cal = partition_calendar(_raw_rows(spark, days), "partition_date")
    rows = {r.day: r.rows for r in cal.collect()}
    assert len(rows) == 25 and rows[dt.date(2024, 1, 1)] == 2 and rows[dt.date(2024, 1, 2)] == 0
    batches = sorted(batch_summary(backfill_batches(cal)).collect())
    assert [(b.batch_id, b.n_days, b.rows) for b in batches] == [(0, 10, 3), (1, 10, 0), (2, 5, 1)]


def test_identical_documents_do_not_share_one_page(spark, tmp_dir):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([('{"id":1}', day)] * 400, raw.RAW_SCHEMA)
    out = os.path.join(tmp_dir, "resp")
    raw.write_responses(df, out, "0000", page_rows=40)
    sizes = [r[0] for r in spark.read.text(out).select(F.size(F.split("value", '\\{"id"')) - 1).collect()]
    assert sum(sizes) == 400 and max(sizes) <= 40 and len(sizes) >= 10


def test_backfill_runs_of_ten_days(spark, tmp_dir):
    from courtline.plans.backfill import backfill, plan_runs

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(23) if i != 5]
    df = _raw_rows(spark, days)
    runs = plan_runs(df, batch_days=10)
    assert [len(r) for r in runs] == [10, 10, 3]
    path, log = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "log")
    assert backfill(spark, df, path, batch_days=10, log_path=log, table_name="t") == 3
    assert raw.raw_scan(spark, path).count() == 22
    assert sorted(r.record_count for r in spark.read.parquet(log).collect()) == [3, 9, 10]


def test_stream_landing_with_split_batches(spark, tmp_dir):
    """Batches of one file each still land every day completely."""
    from courtline.streaming.landing import start_landing

    days = [dt.date(2024, 1, 1 + i % 3) for i in range(300)]
    df = _raw_rows(spark, days)
    responses, table, ckpt = (os.path.join(tmp_dir, n) for n in ("resp", "table", "ckpt"))
    raw.write_responses(df, responses, "0000", page_rows=40)
    start_landing(spark, responses, table, ckpt, max_files_per_trigger=1).awaitTermination()
    got = raw.raw_scan(spark, table)
    assert sorted(got.collect()) == sorted(df.select("partition_date", "data").collect())
    # a re-fetch of one day replaces only that day
    raw.write_responses(_raw_rows(spark, [dt.date(2024, 1, 2)] * 5), responses, "0001")
    start_landing(spark, responses, table, ckpt, max_files_per_trigger=1).awaitTermination()
    counts = {r.partition_date: r["count"] for r in raw.raw_scan(spark, table).groupBy("partition_date").count().collect()}
    assert counts == {dt.date(2024, 1, 1): 100, dt.date(2024, 1, 2): 5, dt.date(2024, 1, 3): 100}
    # a re-fetch without rows empties its day
    raw.write_responses(_raw_rows(spark, []), responses, "0002", days=[dt.date(2024, 1, 3)])
    start_landing(spark, responses, table, ckpt).awaitTermination()
    counts = {r.partition_date: r["count"] for r in raw.raw_scan(spark, table).groupBy("partition_date").count().collect()}
    assert counts == {dt.date(2024, 1, 1): 100, dt.date(2024, 1, 2): 5}


def test_cli_land_and_stage_team_stats(spark, tmp_dir):
    from courtline.__main__ import parser, run
    from courtline.plans import marts
    from courtline.plans.materialize import read_staging
    from tests.conftest import SF_SMALL

    raw_root, stg = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "stg")
    run(spark, parser().parse_args(["land", "--sf-dir", SF_SMALL, "--raw-root", raw_root, "--table", "team_stats"]))
    run(spark, parser().parse_args(["stage", "--raw-root", raw_root, "--staging-root", stg, "--table", "team_stats"]))
    from courtline.plans import chain
    expected = chain.dim_teams(spark, SF_SMALL).collect()
    assert sorted(marts.dim_teams(read_staging(spark, stg, "team_stats")).collect()) == sorted(expected)
    # staging again finds nothing pending
    run(spark, parser().parse_args(["stage", "--raw-root", raw_root, "--staging-root", stg, "--table", "team_stats"]))


def test_land_response_keeps_latest_fetch_per_day(spark, tmp_dir):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    out = os.path.join(tmp_dir, "resp")
    first = spark.createDataFrame([('{"v":1}', d1), ('{"v":1}', d2), ('{"v":1}', d3)] + [(f'{{"p":{i}}}', d1) for i in range(90)],
                                  raw.RAW_SCHEMA)
    raw.write_responses(first, out, "0000", page_rows=30)
    # a second fetch of day 1, of several foreign files; one without rows of day 3
    for name, v in (("page1.json", 2), ("page2.json", 3)):
        folder = os.path.join(out, "partition_date=2024-01-01", "fetch_id=0001")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w") as f:
            f.write(f'{{"data": [{{"v": {v}}}]}}\n')
    raw.write_responses(spark.createDataFrame([], raw.RAW_SCHEMA), out, "0001", days=[d3])
    rows = sorted((r.partition_date, r.data) for r in raw.land_response(spark, out).collect())
    assert rows == [(d1, '{"v":2}'), (d1, '{"v":3}'), (d2, '{"v":1}')]
    plan = _plan(raw.land_response(spark, out))
    assert plan.count("FileScan text") == 1  # the newest fetch is found without reading the texts


def test_staging_follows_days_landed_again(spark, tmp_dir):
    from courtline.plans.materialize import build_staging, pending_days, read_staging
    from tests.test_fixtures import game

    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    raw_root, stg = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "stg")
    path = os.path.join(raw_root, "games")

    def land(score, day):
        write_partitions(spark.createDataFrame([(json.dumps(game(1, "A", "B", score, 90)), day)], raw.RAW_SCHEMA), path)

    def stage():
        days = pending_days(spark, raw_root, stg, "games")
        build_staging(spark, raw_root, stg, "games", days)
        return days, sorted((r.game_date, r.home_score) for r in read_staging(spark, stg, "games").collect())

    land(100, d1)
    land(80, d2)
    assert stage() == ([d1, d2], [(d1, 100), (d2, 80)])
    assert stage()[0] == []
    land(50, d1)
    assert stage() == ([d1], [(d1, 50), (d2, 80)])
    write_partitions(spark.createDataFrame([], raw.RAW_SCHEMA), path, days=[d2])
    assert stage() == ([d2], [(d1, 50)])


def test_cli_lands_responses(spark, tmp_dir):
    from courtline.__main__ import parser, run

    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    responses, raw_root = os.path.join(tmp_dir, "resp"), os.path.join(tmp_dir, "raw")
    args = ["responses", "--responses", responses, "--raw-root", raw_root, "--table", "games"]
    raw.write_responses(_raw_rows(spark, [d1, d1, d2]), responses, "0000")
    run(spark, parser().parse_args(args))
    raw.write_responses(_raw_rows(spark, [d1]), responses, "0001", days=[d1, d2])
    run(spark, parser().parse_args(args))
    assert [r.partition_date for r in raw.raw_scan(spark, os.path.join(raw_root, "games")).collect()] == [d1]


def test_plans_of_reports_and_day(spark):
    from courtline.plans import chain
    from courtline.registry import QUERIES
    from tests.conftest import SF_SMALL

    for name in ("rpt_team_standings", "rpt_player_rankings", "global_rank"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "SinglePartition" not in plan and "RoundRobin" not in plan, name
    assert "PartitionFilters: [isnotnull(game_date" in _plan(QUERIES["for_day"](spark, SF_SMALL))
    assert "RoundRobin" not in _plan(chain.fct_player_performance(spark, SF_SMALL))


def test_read_sheet_named_layouts(spark, tmp_dir):
    p = os.path.join(tmp_dir, "trade_targets.csv")
    with open(p, "w") as f:
        f.write("player_name,team_abbr,position,age,contract_value,years_remaining,trade_value_rating,scouting_notes\n")
        f.write("A B,N1,SG,26,18500000,2,8.5,notes\n")
    row = raw.read_sheet(spark, p, "trade_targets").first()
    assert (row.age, row.contract_value, row.trade_value_rating) == (26, 18500000, 8.5)
    bad = os.path.join(tmp_dir, "bad.csv")
    with open(bad, "w") as f:
        f.write("id,name,value\nx,item,3\n")
    with pytest.raises(Exception):
        raw.read_sheet(spark, bad, "default").collect()


def test_scale_conf_sizes_partitions():
    from courtline.session import scale_conf

    big = scale_conf(100 * 1024**4, cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600  # 100 TiB / 256 MiB
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)
    small = scale_conf(10 * 1024**2, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
