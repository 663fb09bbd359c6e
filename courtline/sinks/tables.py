"""Writers: replace days of a partitioned table, replace a whole table,
write a summary document, append to the load log."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.session import scoped_conf
from courtline.sinks import manifest

PARTITION_COL = "partition_date"
# Bound on rows per output file, so a hot day is written as several files
# by the tasks that hold its rows instead of being funnelled into one task.
MAX_RECORDS_PER_FILE = 5_000_000
# Days that one write may hold (some 270 years): the bins of its per-day metric.
MAX_DAYS = 100_000

# AQE sizes rebalanced write partitions as min(advisory size, max(this floor,
# total / parallelism)). Lowering the floor keeps a small load spread over all
# cores (each day folder costs a file open); large loads are sized by the
# advisory size as before.
SMALL_WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}

LOAD_LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("first_partition", T.DateType()),
        T.StructField("last_partition", T.DateType()),
        T.StructField("output_path", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

DAY_LOG_DDL = "table_name string, partition_date date, record_count long, output_path string, loaded_at timestamp"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` has anything to read (files are listed, none is opened)."""
    try:
        with listing(spark):
            spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def listing(spark: SparkSession):
    """For reads made inside the block: folders are listed by a few tasks per core.

    Spark starts a task per folder otherwise, up to 10,000, which costs more
    than the listing itself when a table has a folder per day."""
    tasks = max(16, 2 * spark.sparkContext.defaultParallelism)
    return scoped_conf(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)})


def _per_day(col: str) -> Column:
    """Rows by day as a metric of the write: a histogram whose bins hold one day each."""
    return F.histogram_numeric(F.unix_date(col), F.lit(MAX_DAYS)).alias("days")


def _counted(metric: list | None) -> dict[dt.date, int]:
    counts: dict[dt.date, int] = {}
    for x in metric or []:
        if x["x"] != int(x["x"]):
            raise ValueError(f"more than {MAX_DAYS} days in one write")
        day = dt.date(1970, 1, 1) + dt.timedelta(days=int(x["x"]))
        counts[day] = counts.get(day, 0) + int(x["y"])
    return counts


def write_partitions(
    df: DataFrame,
    table_path: str,
    col: str = PARTITION_COL,
    days: Iterable | None = None,
    sources: dict[dt.date, str] | None = None,
) -> dict[dt.date, int]:
    """Replace the days present in ``df`` and leave every other day untouched;
    a re-run with the same rows changes nothing that is read.

    ``days`` names the days this run is responsible for: those without rows are
    emptied. Rows go to a folder of their own, and one commit to the table's
    manifest makes all days of the run visible at once (``sinks.manifest``): a run
    that is killed before it leaves the table as it was, one killed after it is done.
    ``sources`` notes what each day was made from. Returns the rows of
    each replaced day, which the write itself counts; nothing is listed. Rows
    without a day are a day of their own (None), replaced when a run has such rows."""
    spark = df.sparkSession
    wanted = manifest.day_list(days) if days is not None else []
    name = uuid.uuid4().hex
    metrics = Observation(f"write-{name}")
    # observed behind the exchange, in the tasks that write: a map task that is run again adds nothing
    rows = clustered_by_day(df, col).observe(metrics, _per_day(col), F.count_if(F.col(col).isNull()).alias("dayless"))
    with scoped_conf(spark, SMALL_WRITE_CONF):
        rows.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(col).parquet(f"{table_path}/data/write={name}")
    found = metrics.get
    counts = dict.fromkeys(wanted, 0) | _counted(found.get("days"))
    if found.get("dayless"):
        counts[None] = found["dayless"]
    manifest.commit(spark, table_path, name, counts, sources)
    return counts


def read_partitions(spark: SparkSession, table_path: str, schema: T.StructType, col: str = PARTITION_COL,
                    version: manifest.Version | None = None, days: Iterable | None = None) -> DataFrame:
    """A day table's rows (those of ``days``, if given) in one version, by default the
    newest: the rows whose day the manifest gives to the write they lie in.

    The manifest's days are a broadcast semi join (a row per day and write, bounded
    by the calendar), from which Spark prunes the folders at run time (dynamic partition
    pruning); a filter on the day is a partition filter of the scan. The columns
    come in the order of ``schema``."""
    live = manifest.entries(spark, table_path, version).where("rows > 0").select(F.col("day").alias(col), "write")
    if days is not None:
        live = live.join(F.broadcast(spark.createDataFrame([(d,) for d in manifest.day_list(days)], f"{col} date")), col, "left_semi")
    writes = {r["write"]: r["dayless"] for r in live.groupBy("write").agg(F.max(F.col(col).isNull()).alias("dayless")).collect()}  # at most one per day
    if not writes:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*(f for f in schema.fields if f.name != col), T.StructField("write", T.StringType()), T.StructField(col, T.DateType())])
    with listing(spark):
        folders = [f"{table_path}/data/write={w}" for w in sorted(writes)]
        rows = spark.read.schema(stored).option("basePath", f"{table_path}/data").parquet(*folders)
    found = rows.join(F.broadcast(live), ["write", col], "left_semi")
    for write in (w for w, dayless in writes.items() if dayless):  # one at most
        found = found.unionByName(rows.where((F.col("write") == write) & F.col(col).isNull()))
    return found.select(*schema.fieldNames())


def clustered_by_day(df: DataFrame, col: str = PARTITION_COL) -> DataFrame:
    """Cluster rows by day before a partitioned write (REBALANCE hint).

    Without it every task writes a file into every day it holds rows of
    (tasks x days small files). REBALANCE shuffles by the day, and AQE then
    coalesces small days into one task and splits a hot day over several,
    so files stay few and near the advisory size."""
    return df.hint("rebalance", col)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a whole (unpartitioned) table."""
    df.write.mode("overwrite").parquet(path)


def write_document(summary: DataFrame | Callable[[DataFrame], DataFrame], path: str, items: DataFrame | None = None) -> DataFrame | None:
    """A summary document as JSON: ``path/summary`` holds the one-row summary;
    a list that grows with the data (e.g. alerts) goes to ``path/items`` as
    JSON lines, written by the tasks that hold it rather than nested into one
    row. ``summary`` may be a function of the written items, which are then
    computed once. Returns the items as written."""
    if items is not None:
        items.write.mode("overwrite").json(f"{path}/items")
        items = items.sparkSession.read.schema(items.schema).json(f"{path}/items")
    head = summary(items) if callable(summary) else summary
    head.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    return items


def append_load_log(spark: SparkSession, log_path: str, table_name: str, output_path: str, counts: dict[dt.date, int]) -> None:
    """Append what a write returned to the load log: one row of the whole load
    (``log_path``) and one per replaced day (``log_path`` + "_days")."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    held = [d for d, n in counts.items() if n and d]
    row = (table_name, sum(counts.values()), min(held, default=None), max(held, default=None), output_path, now)
    spark.createDataFrame([row], LOAD_LOG_SCHEMA).write.mode("append").parquet(log_path)
    days = [(table_name, d, n, output_path, now) for d, n in counts.items()]
    spark.createDataFrame(days, DAY_LOG_DDL).coalesce(1).write.mode("append").parquet(f"{log_path}_days")
