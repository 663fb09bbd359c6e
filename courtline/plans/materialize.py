"""Typed staging tables, built incrementally from the stored raw tables.

Marts and reports over typed Parquet read only the columns they use (the
scan's ReadSchema) and only the days they filter on (PartitionFilters),
while a model over raw JSON must parse every whole document. Staging is
rebuilt per day: only days whose raw data was (re)landed are parsed again;
marts stay full-history over the staging tables.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.plans import chain, staging
from courtline.session import scratch_path
from courtline.sinks import manifest
from courtline.sinks.tables import read_partitions, write_partitions
from courtline.sources import raw

STAGING_MODELS = {
    "games": (staging.stg_games, "game_date"),
    "player_stats": (staging.stg_player_stats, "game_date"),
    "team_stats": (staging.stg_team_stats, "stat_date"),
}


def pending(spark: SparkSession, source: str, target: str) -> list:
    """Days of the day table ``target`` that are not made from the newest write of
    that day in ``source``: landed, landed again, or emptied. From the two
    manifests alone, which have a row per day."""
    landed = manifest.entries(spark, source).select("day", "write")
    made = manifest.entries(spark, target).select("day", "source")
    both = landed.join(made, "day", "left").where(~F.col("write").eqNullSafe(F.col("source")))
    return sorted(r.day for r in both.where("day is not null").select("day").collect())


def pending_days(spark: SparkSession, raw_root: str, staging_root: str, table: str) -> list:
    """Days of a raw table that have to be staged (again)."""
    return pending(spark, os.path.join(raw_root, table), os.path.join(staging_root, table))


def build_staging(
    spark: SparkSession, raw_root: str, staging_root: str, table: str, days: Iterable | None = None
) -> dict:
    """Parse ``days`` (all days when None) of a raw table into its typed
    staging table, and return the rows of each staged day; the raw scan is pruned
    to those day folders, and only those staging days are replaced. A requested day
    without raw rows is emptied.

    All is read from one version of the raw table, and the raw write behind each
    staged day is committed with its rows: a day landed meanwhile is pending
    again, and a run that is killed has staged all of its days or none. A raw table
    without a manifest has no such notes; its days are staged as asked."""
    model, date_col = STAGING_MODELS[table]
    raw_path = os.path.join(raw_root, table)
    version = manifest.newest(spark, raw_path)
    held = {r["day"]: r["write"] for r in manifest.entries(spark, raw_path, version).collect()}  # a row per day
    if days is not None:
        days = manifest.day_list(days)
        if not days:
            return {}
    source = raw.raw_scan(spark, raw_path, version, days)
    days = sorted(d for d in held if d) if days is None else days
    return write_partitions(model(source), os.path.join(staging_root, table), col=date_col, days=days, sources=held)


def empty_staging(spark: SparkSession, table: str) -> DataFrame:
    """No rows, with the columns of a typed staging table."""
    return STAGING_MODELS[table][0](spark.createDataFrame([], raw.RAW_SCHEMA))


def read_staging(
    spark: SparkSession, staging_root: str, table: str, version: manifest.Version | None = None, days: Iterable | None = None
) -> DataFrame:
    schema, date_col = empty_staging(spark, table).schema, STAGING_MODELS[table][1]
    return read_partitions(spark, os.path.join(staging_root, table), schema, date_col, version, days)


def incremental_staging_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Land and stage raw games in four steps, staging only what is pending:
    all days, of which the first twenty have no home scores yet; these again,
    complete; these emptied; and these landed once more. The result is the
    staging table, which must hold the last landing of every day."""
    base = scratch_path(spark, "staging")
    raw_root, staging_root, source = (os.path.join(base, n) for n in ("raw", "staging", "source"))
    games = chain.raw(spark, sf_root, "games")
    games.write.parquet(source)
    games = spark.read.schema(games.schema).parquet(source)
    days = games.select("partition_date").distinct().orderBy("partition_date")
    first = [r[0] for r in days.take(20)]
    open_day = F.col("partition_date").isin(first)
    unknown = F.regexp_replace("data", '("home_team_score":)[0-9]+', "$10")
    early = games.withColumn("data", F.when(open_day, unknown).otherwise(F.col("data")))
    path = os.path.join(raw_root, "games")
    again = games.where(open_day)
    for rows, replaced in ((early, None), (again, None), (games.where(F.lit(False)), first), (again, None)):
        write_partitions(rows, path, days=replaced)
        build_staging(spark, raw_root, staging_root, "games", pending_days(spark, raw_root, staging_root, "games"))
    return read_staging(spark, staging_root, "games")
