"""Day tables behind a manifest: atomic commits, conflicts, lost writers, pruning, per-day counts."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from courtline.sinks import manifest, tables
from courtline.sinks.tables import read_partitions, write_partitions
from courtline.sources import raw
from courtline.streaming.landing import start_landing

D = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(2400)]


def rows(spark, *days, text="x"):
    return spark.createDataFrame([(f'{{"v":"{text}{k}"}}', d) for k, d in enumerate(days)], raw.RAW_SCHEMA)


def held(spark, path, **how):
    return sorted(((r.partition_date, r.data) for r in raw.raw_scan(spark, path, **how).collect()), key=lambda r: (r[0] or dt.date.max, r[1]))


@pytest.fixture()
def path(tmp_dir):
    return os.path.join(tmp_dir, "games")


def test_a_run_killed_before_its_commit_changes_nothing(spark, path, monkeypatch):
    write_partitions(rows(spark, D[0], D[1]), path)
    before = held(spark, path)

    def killed(*args, **kw):
        raise InterruptedError

    monkeypatch.setattr(manifest, "commit", killed)
    with pytest.raises(InterruptedError):
        write_partitions(rows(spark, D[0], text="y"), path, days=[D[0], D[1]])
    monkeypatch.undo()
    assert held(spark, path) == before
    # the whole run, with the day it empties, becomes visible at once
    write_partitions(rows(spark, D[0], text="y"), path, days=[D[0], D[1]])
    assert held(spark, path) == [(D[0], '{"v":"y0"}')]


def test_a_writer_lost_while_committing_does_not_block(spark, path):
    write_partitions(rows(spark, D[0]), path)
    assert manifest.create_new(spark, f"{path}/log/{2:012d}", "")  # an entry without content
    assert manifest.newest(spark, path).number == 1 and len(held(spark, path)) == 1
    write_partitions(rows(spark, D[1]), path)
    assert manifest.newest(spark, path).number == 3 and [d for d, _ in held(spark, path)] == [D[0], D[1]]


def test_two_writers_from_one_version_both_land(spark, path, monkeypatch):
    write_partitions(rows(spark, D[0]), path)
    stale, calls = manifest.newest(spark, path), []
    real = manifest.newest

    def newest(s, table):
        calls.append(table)
        return stale if len(calls) == 1 else real(s, table)

    write_partitions(rows(spark, D[1]), path)
    monkeypatch.setattr(manifest, "newest", newest)
    write_partitions(rows(spark, D[2]), path)
    monkeypatch.undo()
    assert len(calls) == 2  # the first attempt found its number taken
    assert [d for d, _ in held(spark, path)] == D[:3]


def test_readers_keep_their_version(spark, path):
    write_partitions(rows(spark, D[0]), path)
    old = manifest.newest(spark, path)
    early = raw.raw_scan(spark, path)
    write_partitions(rows(spark, D[0], D[0], text="y"), path)
    assert early.count() == 1 and len(held(spark, path, version=old)) == 1 and len(held(spark, path)) == 2
    assert manifest.vacuum(spark, path, keep=2) == []
    assert len(manifest.vacuum(spark, path, keep=1)) == 1
    assert len(held(spark, path)) == 2
    write_partitions(rows(spark), path, days=[D[0]])
    assert held(spark, path) == []


def test_counts_come_from_the_write(spark, path, monkeypatch):
    def listed(*args, **kw):
        raise AssertionError("a folder was listed")

    monkeypatch.setattr(tables, "listing", listed)
    counts = write_partitions(rows(spark, *[D[k % 700] for k in range(2000)], None, None), path, days=[D[0], D[900]])
    monkeypatch.undo()
    assert counts == {D[k]: 3 if k < 600 else 2 for k in range(700)} | {D[900]: 0, None: 2}
    log = os.path.join(path, "..", "_load_log")
    tables.append_load_log(spark, log, "games", path, counts)
    whole = spark.read.parquet(log).first()
    assert (whole.record_count, whole.first_partition, whole.last_partition) == (2002, D[0], D[699])
    by_day = {r.partition_date: r.record_count for r in spark.read.parquet(log + "_days").collect()}
    assert by_day == counts


def test_rows_without_a_day_are_a_day(spark, path):
    write_partitions(rows(spark, D[0], None, None), path)
    write_partitions(rows(spark, D[0], text="y"), path)
    assert held(spark, path) == [(D[0], '{"v":"y0"}'), (None, '{"v":"x1"}'), (None, '{"v":"x2"}')]
    write_partitions(rows(spark, None, text="z"), path)
    assert held(spark, path) == [(D[0], '{"v":"y0"}'), (None, '{"v":"z0"}')]


@pytest.mark.parametrize("n", [1, 2000])
def test_asked_days_prune_folders_at_run_time(spark, path, n):
    write_partitions(rows(spark, *D[:40]), path)
    some = raw.raw_scan(spark, path, days=D[5 : 5 + n])
    plan = some._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan parquet" in x and "partition_date" in x and "data=" not in x)
    assert "dynamicpruning" in scan and str(D[7]) not in scan
    assert [r.partition_date for r in some.orderBy("partition_date").collect()] == D[5 : min(40, 5 + n)]


def test_tables_landed_as_plain_folders_are_read(spark, path):
    rows(spark, D[0], D[1], D[1]).write.partitionBy("partition_date").parquet(path)
    assert [d for d, _ in held(spark, path)] == [D[0], D[1], D[1]]
    assert [d for d, _ in held(spark, path, days=[D[0]])] == [D[0]]


def test_read_of_an_empty_table_has_its_schema(spark, path):
    write_partitions(rows(spark), path, days=[D[0]])
    assert read_partitions(spark, path, raw.RAW_SCHEMA).schema == raw.RAW_SCHEMA and held(spark, path) == []


def test_stream_ignores_a_late_older_fetch(spark, tmp_dir):
    responses, table, ckpt = (os.path.join(tmp_dir, n) for n in ("resp", "table", "ckpt"))

    def land():
        start_landing(spark, responses, table, ckpt, max_files_per_trigger=1).awaitTermination()
        return held(spark, table)

    raw.write_responses(rows(spark, D[0], D[1], text="new"), responses, "0005")
    new = land()
    raw.write_responses(rows(spark, D[0], D[2], text="old"), responses, "0003")
    assert land() == [*new, (D[2], '{"v":"old1"}')]  # day 0 keeps its newer fetch; day 2 had none
    # a further page of the newest fetch joins the others
    page = os.path.join(responses, f"partition_date={D[1]}", "fetch_id=0005", "page9.txt")
    with open(page, "w") as f:
        f.write('{"data":[{"v":"more"}]}\n')
    assert (D[1], '{"v":"more"}') in land() and len(land()) == 4
    assert {r.day: r.source for r in manifest.entries(spark, table).collect()} == {D[0]: "0005", D[1]: "0005", D[2]: "0003"}


def test_staging_notes_the_raw_write_with_its_rows(spark, tmp_dir, monkeypatch):
    from courtline.plans.materialize import build_staging, pending_days
    from tests.test_fixtures import game

    raw_root, stg = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "stg")
    docs = [(json.dumps(game(k, "A", "B", 90, 80)), D[k]) for k in range(3)]
    write_partitions(spark.createDataFrame(docs, raw.RAW_SCHEMA), os.path.join(raw_root, "games"))
    assert build_staging(spark, raw_root, stg, "games", D[:2]) == {D[0]: 1, D[1]: 1}
    assert pending_days(spark, raw_root, stg, "games") == [D[2]]
    real = manifest.commit
    monkeypatch.setattr(manifest, "commit", lambda *a, **k: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        build_staging(spark, raw_root, stg, "games", [D[2]])
    monkeypatch.setattr(manifest, "commit", real)
    assert pending_days(spark, raw_root, stg, "games") == [D[2]]
    build_staging(spark, raw_root, stg, "games")
    assert pending_days(spark, raw_root, stg, "games") == []
    assert manifest.entries(spark, os.path.join(stg, "games")).where(F.col("source").isNull()).count() == 0


def test_a_stopped_backfill_goes_on(spark, path, monkeypatch):
    from courtline.plans import backfill as plan

    source = rows(spark, *D[:25])
    real, calls = plan.write_partitions, []

    def stopped(df, table, **kw):
        if table == path:
            calls.append(kw["days"])
            if len(calls) == 3:
                raise InterruptedError
        return real(df, table, **kw)

    monkeypatch.setattr(plan, "write_partitions", stopped)
    with pytest.raises(InterruptedError):
        plan.backfill(spark, source, path, run_id="a")
    assert [d for d, _ in held(spark, path)] == D[:20]
    calls.clear()
    monkeypatch.setattr(plan, "write_partitions", lambda df, table, **kw: (calls.append(kw.get("days")), real(df, table, **kw))[1])
    assert plan.backfill(spark, source, path, run_id="a") == 1
    assert calls == [None, D[20:25]] and [d for d, _ in held(spark, path)] == D[:25]
    assert plan.backfill(spark, source, path, run_id="a") == 0 and plan.backfill(spark, source, path, run_id="b") == 3


def test_scratch_tables_are_freed(spark):
    from courtline.session import free_scratch, scratch_path, scratch_root

    name = scratch_path(spark, "some")
    spark.range(3).write.parquet(name)
    assert os.path.basename(name) in manifest.names_in(spark, scratch_root(spark))
    free_scratch(spark)
    assert manifest.names_in(spark, scratch_root(spark)) == []
    spark.range(3).write.parquet(scratch_path(spark, "more"))  # later jobs make it anew
