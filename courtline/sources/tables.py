"""Reading the input tables (one Parquet dataset per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """Scan ``<root>/<name>.parquet``; selecting ``columns`` right away lets the
    scan's ReadSchema carry only what the caller uses."""
    df = spark.read.parquet(os.path.join(root, f"{name}.parquet"))
    return df.select(*columns) if columns else df
