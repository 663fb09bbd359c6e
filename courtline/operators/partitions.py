"""Daily partitions: calendar, backfill batches, single-day restriction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days per backfill run (the reference's backfill policy).
DEFAULT_BATCH_DAYS = 10


def day_calendar(start: Column, end: Column) -> Column:
    """``explode(sequence(start, end, 1 day))``: one row per day, inclusive."""
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def partition_calendar(df: DataFrame, date_col: str, day_col: str = "day") -> DataFrame:
    """Every day from the first to the last ``date_col`` of ``df``, with the
    number of rows landed for it (0 for a day without rows).

    The per-day counts are one grouped count with map-side combine; the bounds
    come from these counts (Spark reuses their shuffle), so the rows are read
    once. Counts and calendar have a row per day, bounded by the time span."""
    counts = df.groupBy(F.col(date_col).alias(day_col)).agg(F.count(F.lit(1)).alias("rows"))
    bounds = counts.agg(F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi"))
    days = bounds.select(day_calendar(F.col("_lo"), F.col("_hi")).alias(day_col))
    return days.join(counts, day_col, "left").select(
        day_col, F.coalesce(F.col("rows"), F.lit(0).cast("long")).alias("rows")
    )


def backfill_batches(
    calendar: DataFrame, day_col: str = "day", batch_days: int = DEFAULT_BATCH_DAYS
) -> DataFrame:
    """Split a contiguous calendar into runs of at most ``batch_days`` days.

    For a contiguous range, ``row_number() - 1`` equals the day offset from the
    first day, so the batch id is arithmetic and needs no global window."""
    first = calendar.agg(F.min(day_col).alias("_first"))
    batch = F.floor(F.datediff(F.col(day_col), first.scalar()) / batch_days).cast("int")
    return calendar.withColumn("batch_id", batch)


def batch_summary(batched: DataFrame, day_col: str = "day") -> DataFrame:
    """One row per batch: first and last day, number of days, rows landed."""
    return batched.groupBy("batch_id").agg(
        F.min(day_col).alias("first_day"),
        F.max(day_col).alias("last_day"),
        F.count(F.lit(1)).alias("n_days"),
        F.sum("rows").alias("rows"),
    )


def for_day(df: DataFrame, date_col: str, day) -> DataFrame:
    """Restrict a model to one day. On a table stored in ``partition_date=``
    folders this is a partition filter: Catalyst lists only that folder."""
    value = day if isinstance(day, Column) else F.lit(day).cast("date")
    return df.where(F.col(date_col) == value)
