"""The commit log of a day table: which written folders hold each day.

    <table>/data/write=<id>/<day column>=<day>/   rows, as one write left them
    <table>/manifests/<id>/                       (day, write, rows, source), the whole table's
    <table>/log/<number>                          the id of that version's manifest

A write's rows are invisible until its version is in the log.  A log entry is
created only if its number is free, so of two writers that started from one
version the second one fails to commit, takes the newest version and merges
its days into that.  Readers take the newest entry and see one version
throughout.  A manifest has a row per day and write of that day, so it is
bounded by the calendar; nothing of the table is listed to find a day.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_DDL = "day date, write string, rows long, source string"
KEPT_VERSIONS = 100  # log entries that a commit leaves


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in one folder (not below it); none if there is no such folder."""
    files, place = _at(spark, folder)
    try:
        return sorted(s.getPath().getName() for s in files.listStatus(place))
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return []
        raise


def create_new(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file; False if there is one of this name."""
    files, place = _at(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError as e:
        if _is(e, "FileAlreadyExistsException"):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def read_small(spark: SparkSession, path: str) -> str:
    files, place = _at(spark, path)
    source = files.open(place)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(source)).decode()
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


@dataclass(frozen=True)
class Version:
    """One version of a table: its number, and its manifest's id (None: no version yet)."""

    number: int
    manifest: str | None


def newest(spark: SparkSession, table: str) -> Version:
    """The newest committed version. An entry without content belongs to a
    writer that was lost while it committed, and counts as taken, not as a version."""
    numbers = sorted((int(n) for n in names_in(spark, f"{table}/log") if n.isdigit()), reverse=True)
    for number in numbers:
        if manifest := read_small(spark, f"{table}/log/{number:012d}"):
            return Version(number, manifest)
    return Version(0, None)


def entries(spark: SparkSession, table: str, version: Version | None = None) -> DataFrame:
    """(day, write, rows, source) of a version, by default the newest; empty without one."""
    version = version or newest(spark, table)
    if version.manifest is None:
        return spark.createDataFrame([], MANIFEST_DDL)
    return spark.read.schema(MANIFEST_DDL).parquet(f"{table}/manifests/{version.manifest}")


def commit(spark: SparkSession, table: str, write: str, counts: dict[dt.date | None, int], sources: dict[dt.date, str] | None = None,
           attempts: int = 20) -> Version:
    """Make ``write`` the one that holds the days in ``counts`` (rows; 0 empties a day),
    all at once; other days stay with their writes."""
    sources = sources or {}
    fresh = spark.createDataFrame([(d, write, n, sources.get(d)) for d, n in counts.items()], MANIFEST_DDL)
    for _ in range(attempts):
        now = newest(spark, table)
        kept = entries(spark, table, now).join(F.broadcast(fresh.select("day")), "day", "left_anti")
        kept = kept.where("day is not null") if None in counts else kept
        manifest = uuid.uuid4().hex
        kept.unionByName(fresh).coalesce(1).sortWithinPartitions("day").write.parquet(f"{table}/manifests/{manifest}")
        taken = [int(n) for n in names_in(spark, f"{table}/log") if n.isdigit()]
        number = now.number + 1
        while number in taken and not read_small(spark, f"{table}/log/{number:012d}"):
            number += 1  # a lost writer's entry
        if create_new(spark, f"{table}/log/{number:012d}", manifest):
            for old in taken:
                if old <= number - KEPT_VERSIONS:
                    remove(spark, f"{table}/log/{old:012d}")
            return Version(number, manifest)
        remove(spark, f"{table}/manifests/{manifest}")
    raise RuntimeError(f"{table}: no free version in {attempts} attempts")


def vacuum(spark: SparkSession, table: str, keep: int = 10) -> list[str]:
    """Delete the writes and manifests that none of the newest ``keep`` versions uses;
    returns the deleted writes. Not to be run while a write is under way, whose
    folder no version uses yet."""
    numbers = [int(n) for n in names_in(spark, f"{table}/log") if n.isdigit()][-keep:]
    used = [m for n in numbers if (m := read_small(spark, f"{table}/log/{n:012d}"))]
    if not used:
        return []
    found = spark.read.schema(MANIFEST_DDL).parquet(*(f"{table}/manifests/{m}" for m in used))
    live = {r["write"] for r in found.select("write").distinct().collect()}  # at most one per day and version
    for name in names_in(spark, f"{table}/manifests"):
        if name not in used:
            remove(spark, f"{table}/manifests/{name}")
    dead = [n for n in names_in(spark, f"{table}/data") if n.startswith("write=") and n.removeprefix("write=") not in live]
    for name in dead:
        remove(spark, f"{table}/data/{name}")
    return [n.removeprefix("write=") for n in dead]


def day_list(days: Iterable) -> list[dt.date]:
    """``days`` (dates or ISO texts) as sorted distinct dates."""
    return sorted({d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in days})
