"""Reading the given tables and cutting lineage through the shared folder."""

from __future__ import annotations

import os
import threading
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import courtline
from courtline.session import scoped_conf, scratch_path
from courtline.sinks.manifest import remove

BATCH_ROWS = 1000
#: For steps whose results are all stored: a job's shuffles go as soon as it ends, and tables are small.
LITTLE_DISK = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}

_made = threading.local()  # tables: (path, frame) of what the thread's innermost ``settled`` has stored so far


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    The rows then survive the loss of executors and their order within a file
    is fixed, so ids derived from a position are the same in every rerun."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    frame = spark.read.schema(df.schema).parquet(path)
    if (tables := getattr(_made, "tables", None)) is not None:
        tables.append((path, frame))
    return frame


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, stored; all other tables that were stored on the way to it are deleted."""
    outer, _made.tables = getattr(_made, "tables", None), []
    try:
        df = make()
        if not any(frame is df for _, frame in _made.tables):
            df = stored(df, name)
        tables = _made.tables
    finally:
        _made.tables = outer
    for path, frame in tables:
        if frame is not df:
            remove(df.sparkSession, path)
        elif outer is not None:
            outer.append((path, frame))
    return df


def freed(*frames: DataFrame) -> None:
    """Delete those of ``frames`` that the innermost ``settled`` stored and nothing reads any more."""
    for path, frame in list(getattr(_made, "tables", None) or ()):
        if any(frame is x for x in frames):
            remove(frame.sparkSession, path)
            _made.tables.remove((path, frame))


def small_batches(spark: SparkSession):
    """For jobs run inside the block: Arrow batches of BATCH_ROWS rows, as texts
    and sets are large and a worker holds a batch several times over."""
    return scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)})


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where it lies.

    On a cluster the package is shipped with ``--py-files`` or installed."""
    root = str(Path(courtline.__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    return spark
