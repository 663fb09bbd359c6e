"""Joins against dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def lookup_join(fact: DataFrame, dim: DataFrame, on: Column | str | list, how: str = "inner") -> DataFrame:
    """Join a large ``fact`` to a ``dim`` table.

    No side is forced to be broadcast: Spark broadcasts ``dim`` when its size
    in bytes, from the files' statistics or measured at run time by AQE, is
    within ``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise."""
    return fact.join(dim, on, how)
