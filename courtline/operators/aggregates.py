"""Grouped counts. Each is one hash aggregate with a partial (map-side) step,
so the shuffle carries at most one row per group per task, however skewed
the groups are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """``count(*)`` per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_where(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)``: a NULL condition counts 0,
    and an empty group gives NULL as in SQL (``count_if`` would give 0)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def conditional_count(
    df: DataFrame, keys: list[str], conditions: dict[str, Column], total: str | None = "n"
) -> DataFrame:
    """Per group: optional ``count(*)`` plus one conditional count per entry."""
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    aggs += [count_where(c).alias(name) for name, c in conditions.items()]
    return df.groupBy(*keys).agg(*aggs)
