"""Landing jobs: raw rows -> stored raw tables, plus the sheet and file-sensor jobs.

Each function does its writes (actions) and returns the DataFrame that reads
the result back, so the caller sees exactly what was stored.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.plans import chain, staging
from courtline.session import scratch_path
from courtline.sinks.tables import DAY_LOG_DDL, LOAD_LOG_SCHEMA, append_load_log, replace_table, write_document, write_partitions
from courtline.sources import files, raw
from courtline.sources.adapters import team_payroll

PAYROLL_SCHEMA = T.StructType(
    [
        T.StructField("team_abbr", T.StringType()),
        T.StructField("team_name", T.StringType()),
        T.StructField("total_salary", T.DoubleType()),
        T.StructField("num_players", T.IntegerType()),
    ]
)


def land_raw(spark: SparkSession, sf_root: str, out_root: str, table: str) -> tuple[str, dict]:
    """Land one raw table; returns its path and the rows of each day."""
    path = os.path.join(out_root, table)
    return path, write_partitions(chain.raw(spark, sf_root, table), path)


def raw_scan_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Land raw games, register the raw views, build stg_games on the view,
    publish it as a view and read the view."""
    out = scratch_path(spark, "raw")
    land_raw(spark, sf_root, out, "games")
    raw.register_raw(spark, out, tables=("games",))
    chain.publish_views({"stg_games": staging.stg_games(spark.table("raw_games"))})
    return spark.table("stg_games")


def watchlist_document_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Write the watchlist document (head + alert items as JSON lines) and
    read the items back with the alerts' schema."""
    from courtline.plans import analytics

    states = analytics.kept_states(chain.fct_player_performance(spark, sf_root))
    day = analytics.latest_day(states, "game_date")
    alerts = analytics.alerts_of(states, day)
    out = scratch_path(spark, "document")
    return write_document(lambda items: analytics.watchlist_summary(items, day), out, items=alerts)


def partition_replace_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Land games twice (the re-run must change nothing), then replace the
    first day by an empty load; stg_games over what is stored."""
    out = scratch_path(spark, "replace")
    path, _ = land_raw(spark, sf_root, out, "games")
    land_raw(spark, sf_root, out, "games")
    first = raw.raw_scan(spark, path).agg(F.min("partition_date")).first()[0]
    empty = spark.createDataFrame([], raw.RAW_SCHEMA)
    write_partitions(empty, path, days=[first])
    return staging.stg_games(raw.raw_scan(spark, path))


def land_response_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Write raw games as paged API responses, fetch the first twenty days twice
    more (with no rows, then whole), land the newest fetches, stage them."""
    out, source = scratch_path(spark, "responses"), scratch_path(spark, "source")
    games = chain.raw(spark, sf_root, "games")
    games.write.parquet(source)
    games = spark.read.schema(games.schema).parquet(source)
    days = [r[0] for r in games.select("partition_date").distinct().orderBy("partition_date").take(20)]
    raw.write_responses(games, out, "0000")
    raw.write_responses(games.where(F.lit(False)), out, "0001", days=days)
    raw.write_responses(games.where(F.col("partition_date").isin(days)), out, "0002")
    return staging.stg_games(raw.land_response(spark, out))


def sheet_ingest_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Drop the payroll sheet as CSV, read it with its declared schema,
    replace the table with it, read the table back."""
    sheet = scratch_path(spark, "sheet")
    table = scratch_path(spark, "sheet-table")
    raw.write_sheet(team_payroll(spark, sf_root), sheet)
    replace_table(raw.read_sheet(spark, sheet, PAYROLL_SCHEMA), table)
    return spark.read.parquet(table)


def changed_files_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Two sensor ticks over the files of ``orders``: the rows of the files that
    each tick requests, by order status. The first (empty cursor) requests all
    files, the second (advanced cursor) none."""
    watched, cursor = os.path.join(sf_root, "orders.parquet"), scratch_path(spark, "cursor")
    loads = []
    for number in (1, 2):
        paths = [r["path"] for r in files.tick(spark, watched, cursor, "*.parquet").select("path").collect()]
        if paths:
            loads.append(spark.read.parquet(*paths).select(F.lit(number).alias("tick"), "o_orderstatus"))
    rows = loads[0]
    for load in loads[1:]:
        rows = rows.unionByName(load)
    return rows.groupBy("tick", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


def _logged_loads(spark: SparkSession, sf_root: str) -> str:
    """Land the three raw tables; returns the load log's path."""
    out = scratch_path(spark, "logged")
    log = os.path.join(out, "_load_log")
    for table in raw.RAW_TABLES:
        path, counts = land_raw(spark, sf_root, out, table)
        append_load_log(spark, log, table, path, counts)
    return log


def load_log_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Land the three raw tables, logging record count and day range of each."""
    logged = spark.read.schema(LOAD_LOG_SCHEMA).parquet(_logged_loads(spark, sf_root))
    return logged.select("table_name", "record_count", "first_partition", "last_partition")


def day_log_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Land the three raw tables, logging the records of each day."""
    logged = spark.read.schema(DAY_LOG_DDL).parquet(_logged_loads(spark, sf_root) + "_days")
    return logged.select("table_name", "partition_date", "record_count")
