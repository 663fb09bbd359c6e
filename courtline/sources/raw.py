"""Raw layer: stored raw tables, landed API responses, sheets.

Raw tables are stored as Parquet under ``<root>/<table>/partition_date=<day>/``
with the fixed layout ``(data STRING)`` + the ``partition_date`` folder column.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.json import RESPONSE_DDL, parse_json
from courtline.session import scoped_conf
from courtline.sinks import manifest
from courtline.sinks.tables import SMALL_WRITE_CONF, listing, read_partitions, replace_table

RAW_SCHEMA = T.StructType(
    [T.StructField("data", T.StringType()), T.StructField("partition_date", T.DateType())]
)
RESPONSE_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("partition_date", T.DateType())]
)
FETCH_SCHEMA = T.StructType([*RESPONSE_SCHEMA.fields, T.StructField("fetch_id", T.StringType())])
RAW_TABLES = ("games", "player_stats", "team_stats")
# Records per landed response page (the API's page size).
RESPONSE_PAGE_ROWS = 100


def raw_scan(spark: SparkSession, table_path: str, version: manifest.Version | None = None, days: Iterable | None = None) -> DataFrame:
    """All days (or ``days``) of one raw table as ``(partition_date, data)``.

    The schema is fixed, so no file is opened to infer it, and a filter on
    ``partition_date`` prunes folders (PartitionFilters) before any read. A
    table without a manifest, landed by other means, is read as its
    ``partition_date=`` folders hold it."""
    version = version or manifest.newest(spark, table_path)
    if version.manifest is not None:
        return read_partitions(spark, table_path, RAW_SCHEMA, version=version, days=days).select("partition_date", "data")
    with listing(spark):
        rows = spark.read.schema(RAW_SCHEMA).option("basePath", table_path).parquet(table_path)
    rows = rows if days is None else rows.where(F.col("partition_date").isin(manifest.day_list(days)))
    return rows.select("partition_date", "data")


def register_raw(spark: SparkSession, root: str, tables=RAW_TABLES, prefix: str = "raw_") -> list[str]:
    """(Re)create one temp view per raw table found under ``root``."""
    names = []
    for t in tables:
        raw_scan(spark, os.path.join(root, t)).createOrReplaceTempView(prefix + t)
        names.append(prefix + t)
    return names


def write_responses(
    raw: DataFrame, path: str, fetch_id: str, page_rows: int = RESPONSE_PAGE_ROWS, days: Iterable | None = None
) -> None:
    """Write raw rows as the landed API responses of one fetch: JSON lines
    ``{"data": [...]}``, at most ``page_rows`` documents per line, in
    ``partition_date=<day>/fetch_id=<id>/`` folders. A re-run of a fetch
    replaces that fetch; other fetches stay.

    ``fetch_id`` orders the fetches of a day as text (e.g. a UTC time stamp).
    ``days`` are the days asked for: one without rows gets an empty response,
    so that the newest fetch of such a day is known to have no rows.

    Pages are consecutive runs of ``page_rows`` rows inside a task after a
    REBALANCE by day (AQE splits a hot day over several tasks) and a sort by
    (day, document): a page never exceeds ``page_rows`` documents, even when
    many documents are identical, and the page of every row is fixed by the
    content of its task, so a retried task rebuilds the same pages."""
    ordered = raw.hint("rebalance", "partition_date").sortWithinPartitions("partition_date", "data")
    paged = ordered.withColumn("_page", F.floor(F.monotonically_increasing_id() / page_rows))
    body = F.concat(F.lit('{"data":['), F.array_join(F.collect_list("data"), ","), F.lit("]}"))
    pages = paged.groupBy("partition_date", "_page").agg(body.alias("value")).select("partition_date", "value")
    if days is not None:
        spark = raw.sparkSession
        asked = spark.createDataFrame([(d,) for d in days], "partition_date date")
        empty = asked.join(raw.select("partition_date").distinct(), "partition_date", "left_anti")
        pages = pages.unionByName(empty.withColumn("value", F.lit('{"data":[]}')))
    with scoped_conf(raw.sparkSession, SMALL_WRITE_CONF):
        (
            pages.withColumn("fetch_id", F.lit(fetch_id))
            .hint("rebalance", "partition_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("partition_date", "fetch_id")
            .text(path)
        )


def responses_to_raw(lines: DataFrame) -> DataFrame:
    """Response lines ``(value, partition_date)`` -> raw rows: one row per
    element of ``data``; a response without ``data`` gives no rows; a
    malformed response raises."""
    doc = parse_json(F.col("value"), RESPONSE_DDL)
    return lines.select(
        F.col("partition_date").cast("date").alias("partition_date"),
        F.explode(F.coalesce(doc.getField("data"), F.array().cast("array<string>"))).alias("data"),
    )


def listed_responses(spark: SparkSession, path: str) -> DataFrame:
    """``(path, partition_date[, fetch_id])`` of the response files, from one listing;
    the folder columns are text, as fetch ids may look like numbers."""
    with listing(spark), scoped_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        return spark.read.format("binaryFile").load(path).drop("content")


def land_response(spark: SparkSession, path: str) -> DataFrame:
    """Landed response files -> raw rows ``(partition_date, data)``; the day
    comes from the ``partition_date=`` folder names.

    Where the days hold ``fetch_id=`` folders, the newest fetch of a day
    replaces its earlier ones; its files, whatever their names, all count.
    Files that lie in a day's folder itself are one fetch. All days of a
    folder must have the same layout."""
    files = listed_responses(spark, path)
    if "fetch_id" not in files.columns:
        with listing(spark):
            return responses_to_raw(spark.read.schema(RESPONSE_SCHEMA).text(path))
    newest = files.groupBy(F.col("partition_date").cast("date").alias("partition_date")).agg(F.max("fetch_id").alias("fetch_id"))
    with listing(spark):
        lines = spark.read.schema(FETCH_SCHEMA).text(path)
    lines = lines.join(newest, ["partition_date", "fetch_id"], "left_semi")
    return responses_to_raw(lines.select("value", "partition_date"))


def land_fetches(spark: SparkSession, path: str, fetches: dict) -> DataFrame:
    """The raw rows of one fetch per day (``fetches``: day -> fetch id); only the
    folders of these fetches are listed and read."""
    folders = [f"{path}/partition_date={day}/fetch_id={fetch}" for day, fetch in sorted(fetches.items())]
    with listing(spark):
        lines = spark.read.schema(FETCH_SCHEMA).option("basePath", path).text(folders)
    return responses_to_raw(lines.select("value", "partition_date"))


def days_of_responses(spark: SparkSession, path: str) -> DataFrame:
    """``(partition_date)``: the days that have response files, from the listing."""
    return listed_responses(spark, path).select(F.col("partition_date").cast("date").alias("partition_date")).distinct()


# Fixed sheet layouts (header names and types of the known sheets).
SHEET_SCHEMAS = {
    "salary_cap": (
        "team_abbr STRING, team_name STRING, total_salary DOUBLE, cap_space DOUBLE, "
        "luxury_tax_bill DOUBLE, num_players INT, avg_salary DOUBLE, cap_status STRING"
    ),
    "trade_targets": (
        "player_name STRING, team_abbr STRING, position STRING, age INT, contract_value BIGINT, "
        "years_remaining INT, trade_value_rating DOUBLE, scouting_notes STRING"
    ),
    "default": "id INT, name STRING, value INT",
}


class SheetHeaderError(ValueError):
    """A sheet whose columns are not those declared."""


def _sheet_layout(spark: SparkSession, path: str, schema: T.StructType | str) -> T.StructType:
    """The declared fields in the order of the sheet's header."""
    schema = SHEET_SCHEMAS.get(schema, schema) if isinstance(schema, str) else schema
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = {f.name: f for f in declared.fields}
    header = [name.strip() for name in spark.read.option("header", True).option("multiLine", True).csv(path).columns]
    unknown, missing = [n for n in header if n not in fields], [n for n in fields if n not in header]
    if unknown or missing or len(set(header)) < len(header):
        raise SheetHeaderError(f"{path}: unknown columns {unknown}, missing columns {missing}, header {header}")
    return T.StructType([fields[n] for n in header])


def _sheet(spark: SparkSession, path: str, layout: T.StructType, mode: str):
    """Files of one drop must agree in their header (``enforceSchema`` off checks each);
    a quoted cell may hold line breaks."""
    reader = spark.read.option("header", True).option("enforceSchema", False).option("multiLine", True).option("escape", '"')
    return reader.option("mode", mode).schema(layout)


def read_sheet(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A header-first table drop (CSV export of a sheet) with a declared
    schema (a ``SHEET_SCHEMAS`` name or a schema), in the schema's column order.

    Columns are found by their header, in whatever order the sheet has them; an
    unknown, missing or repeated header raises. A missing file raises (AnalysisException:
    PATH_NOT_FOUND); a malformed row raises (FAILFAST)."""
    layout = _sheet_layout(spark, path, schema)
    declared = SHEET_SCHEMAS.get(schema, schema) if isinstance(schema, str) else schema
    names = (T.StructType.fromDDL(declared) if isinstance(declared, str) else declared).fieldNames()
    return _sheet(spark, path, layout, "FAILFAST").csv(path).select(*names)


BAD_ROW = "_bad_row"


def sift_sheet(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """``read_sheet`` that sets malformed rows aside: the good rows, and the bad ones with
    their file, their whole text (``record``) and the fields that could be read."""
    layout = _sheet_layout(spark, path, schema)
    names = read_sheet(spark, path, schema).columns
    rows = _sheet(spark, path, layout.add(BAD_ROW, "string"), "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW).csv(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"))
    good = rows.where(F.col(BAD_ROW).isNull()).select(*names)
    return good, rows.where(F.col(BAD_ROW).isNotNull()).select("file", F.col(BAD_ROW).alias("record"), *names)


def land_sheet(spark: SparkSession, path: str, schema: T.StructType | str, table_path: str) -> None:
    """Replace a table by a sheet's good rows, and ``<table_path>_bad`` by its bad rows."""
    good, bad = sift_sheet(spark, path, schema)
    replace_table(good, table_path)
    replace_table(bad, f"{table_path}_bad")


def write_sheet(df: DataFrame, path: str) -> None:
    """Write a table as a header-first CSV drop (one file per task)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
