"""Incremental landing of new API response files with Structured Streaming.

A file stream over the response folder sees each new file once (the stream's
checkpoint remembers the files it has processed). ``foreachBatch`` lands the
days that the batch touches; their commit to the raw table's manifest
also notes each day's fetch, and this is the stream's state: an older fetch
that arrives late is ignored, a newer one replaces its day, all in one commit.

A micro-batch may hold only some of a fetch's response files (e.g. under
``maxFilesPerTrigger``), so a batch does not land its own rows: it reads the
folders of the newest fetches of the days it touched, and no others. A
restart after a failure re-runs the uncommitted batch with the same result.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.plans import chain, staging
from courtline.session import scratch_path
from courtline.sinks import manifest
from courtline.sinks.tables import listing, write_partitions
from courtline.sources import raw


def start_landing(
    spark: SparkSession,
    responses_dir: str,
    table_path: str,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the landing stream; returns the StreamingQuery."""
    # partition_date and fetch_id are discovered from the folder names
    reader = spark.readStream.format("text").schema(raw.FETCH_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    with listing(spark):
        stream = reader.load(responses_dir)

    def land(batch: DataFrame, batch_id: int) -> None:
        arrived = batch.groupBy("partition_date").agg(F.max("fetch_id").alias("fetch_id"))
        known = manifest.entries(spark, table_path).select(F.col("day").alias("partition_date"), "source")
        current = arrived.join(F.broadcast(known), "partition_date", "left").where("source is null or fetch_id >= source")
        # one entry per touched day (bounded by the calendar)
        fetches = {r["partition_date"]: r["fetch_id"] for r in current.collect()}
        if fetches:
            # a day whose newest fetch is empty is emptied
            write_partitions(raw.land_fetches(spark, responses_dir, fetches), table_path, days=fetches, sources=fetches)

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    with listing(spark):
        return writer.start()


def stream_landing_job(spark: SparkSession, sf_root: str) -> DataFrame:
    """Four arrivals of response files, each landed by one availableNow run of
    the same stream: even days and odd days; then the first twenty even days
    again with no rows; then these with theirs. stg_games over the landed table."""
    base = scratch_path(spark, "stream")
    responses = os.path.join(base, "responses")
    table = os.path.join(base, "raw_games")
    ckpt = os.path.join(base, "_checkpoint")
    games = chain.raw(spark, sf_root, "games")
    parity = F.pmod(F.unix_date("partition_date"), F.lit(2))
    games.write.parquet(os.path.join(base, "source"))
    games = spark.read.schema(games.schema).parquet(os.path.join(base, "source"))
    days = games.where(parity == 0).select("partition_date").distinct().orderBy("partition_date")
    early = [r[0] for r in days.take(20)]
    arrivals = [(parity == 0, None), (parity == 1, None), (F.lit(False), early), (F.col("partition_date").isin(early), None)]
    for number, (rows, days) in enumerate(arrivals):
        raw.write_responses(games.where(rows), responses, f"{number:04d}", days=days)
        start_landing(spark, responses, table, ckpt).awaitTermination()
    return staging.stg_games(raw.raw_scan(spark, table))
