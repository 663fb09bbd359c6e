"""Changed-file detection against a cursor table (the file sensor, as a batch job).

Spark lists the files (``binaryFile`` with the content column pruned, so no
file body is read), compares each modification time with the cursor table by
a left join, and emits one run request per changed file. A file whose
modification time equals its cursor entry is unchanged; a missing file is
simply absent from the listing, hence no change.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.session import checkpoint_root
from courtline.sinks.tables import path_exists

CURSOR_SCHEMA = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("cursor_mtime", T.LongType())]
)


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``(path, name, mtime, length)`` of the files under ``folder``; mtime in
    microseconds since the epoch."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "modificationTime", "length")
    )
    return files.select(
        "path",
        F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("name"),
        F.unix_micros("modificationTime").alias("mtime"),
        "length",
    )


def changed_files(files: DataFrame, cursor: DataFrame) -> DataFrame:
    """Files whose mtime differs from the cursor (or that have no cursor
    entry), each with its run key ``<name>_<mtime>_<digest of the path>``."""
    joined = files.join(cursor, "path", "left")
    changed = joined.where(~F.col("mtime").eqNullSafe(F.col("cursor_mtime")))
    digest = F.substring(F.sha2("path", 256), 1, 12)
    keyed = changed.withColumn("run_key", F.concat_ws("_", "name", F.col("mtime").cast("string"), digest))
    return keyed.select("run_key", "path", "name", "mtime", "length")


def advance_cursor(cursor: DataFrame, changed: DataFrame) -> DataFrame:
    """The new cursor: changed files take their new mtime, others keep theirs."""
    updates = changed.select("path", F.col("mtime").alias("cursor_mtime"))
    kept = cursor.join(updates.select("path"), "path", "left_anti")
    return kept.unionByName(updates)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The stored cursor's complete versions."""
    if not path_exists(spark, path):
        return []
    done = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    found = done.select(F.regexp_extract("path", r"/version=(\d+)/", 1).alias("v")).distinct().collect()
    return sorted(int(r["v"]) for r in found if r["v"])


def read_cursor(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the stored cursor, or an empty one on the first run."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], CURSOR_SCHEMA)
    return spark.read.schema(CURSOR_SCHEMA).parquet(os.path.join(path, f"version={versions[-1]}"))


def write_cursor(cursor: DataFrame, path: str) -> None:
    """Store ``cursor`` as a new version; the version it was made from stays
    readable until the new one is complete."""
    version = max(_versions(cursor.sparkSession, path), default=0) + 1
    cursor.coalesce(1).write.parquet(os.path.join(path, f"version={version}"))


def tick(spark: SparkSession, folder: str, cursor_path: str, glob: str = "*") -> DataFrame:
    """One run of the sensor: the changed files' run requests, after the cursor
    has been advanced past them."""
    checkpoint_root(spark)
    cursor = read_cursor(spark, cursor_path)
    changed = changed_files(list_files(spark, folder, glob), cursor).checkpoint(eager=True)
    write_cursor(advance_cursor(cursor, changed), cursor_path)
    return changed
