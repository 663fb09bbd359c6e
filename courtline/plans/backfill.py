"""Partitioned backfill: land a range of days in runs of at most N days.

Each run is one Spark job that replaces its days (days in parallel inside
the job); the driver only walks the list of runs, which is bounded by the
calendar, not by the data. The source is read once, into a scratch table
kept by day; a run then reads the folders of its days (a partition filter).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.operators.partitions import DEFAULT_BATCH_DAYS, backfill_batches, partition_calendar
from courtline.plans import chain, marts
from courtline.plans.materialize import build_staging, read_staging
from courtline.session import scratch_path
from courtline.sinks import manifest
from courtline.sinks.tables import append_load_log, write_partitions
from courtline.sources import raw


def plan_runs(source: DataFrame, batch_days: int = DEFAULT_BATCH_DAYS) -> list[list]:
    """The days of ``source`` split into runs of at most ``batch_days``
    calendar days (one list entry per day of the calendar)."""
    cal = backfill_batches(partition_calendar(source, "partition_date"), batch_days=batch_days)
    runs = cal.groupBy("batch_id").agg(F.sort_array(F.collect_list("day")).alias("days"))
    return [r.days for r in runs.orderBy("batch_id").collect()]


def split_runs(days: list, batch_days: int = DEFAULT_BATCH_DAYS) -> list[list]:
    """``plan_runs`` of the calendar from the first to the last of ``days``."""
    if not days:
        return []
    first, last = min(days), max(days)
    calendar = [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]
    return [calendar[at : at + batch_days] for at in range(0, len(calendar), batch_days)]


def backfill(
    spark: SparkSession,
    source: DataFrame,
    table_path: str,
    batch_days: int = DEFAULT_BATCH_DAYS,
    log_path: str | None = None,
    table_name: str = "raw",
    run_id: str | None = None,
) -> int:
    """Land ``source`` into ``table_path`` run by run; returns the number of
    runs that were landed. Every calendar day of a run is replaced, so a day without rows in
    the source is emptied if the table holds it.

    With a ``run_id``, each run's commit notes it for its days, which makes the
    table's manifest the ledger of the backfill: started again under the same id, it
    goes on behind the runs that were committed."""
    path = scratch_path(spark, "backfill-source")
    counted = write_partitions(source, path)
    ledger = f"backfill {run_id}"
    landed = manifest.entries(spark, table_path).where(F.col("source") == ledger).select("day").collect() if run_id else []
    done = {r["day"] for r in landed}  # one per day of the calendar
    runs = [run for run in split_runs([d for d in counted if d], batch_days) if not done.issuperset(run)]
    for run in runs:
        # a day that the table holds and the source does not is emptied in the same commit
        notes = dict.fromkeys(run, ledger) if run_id else None
        counts = write_partitions(raw.raw_scan(spark, path, days=run), table_path, days=run, sources=notes)
        if log_path:
            append_load_log(spark, log_path, table_name, table_path, counts)
    return len(runs)


def backfill_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Backfill raw team stats in 10-day runs, stage the landed days into the
    typed table, and build the team dimension from the typed table."""
    base = scratch_path(spark, "backfill")
    raw_root, staging_root = os.path.join(base, "raw"), os.path.join(base, "staging")
    backfill(spark, chain.raw(spark, sf_root, "team_stats"), os.path.join(raw_root, "team_stats"),
             log_path=os.path.join(base, "_load_log"), table_name="team_stats")
    build_staging(spark, raw_root, staging_root, "team_stats")
    return marts.dim_teams(read_staging(spark, staging_root, "team_stats"))
