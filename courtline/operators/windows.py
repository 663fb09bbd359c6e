"""Window operators: latest row per key and global ranking.

``global_rank`` replaces ``row_number() over (order by ...)``, which Spark runs
as one task behind an ``Exchange SinglePartition``. It range-partitions on the
sort key instead, numbers rows inside each partition, and adds the running
total of the partition sizes. Inputs of every size take this one path.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.session import checkpoint_root

# Target rows per range partition.
ROWS_PER_RANGE = 2_000_000
# Ranges whose offsets are summed together (two levels hold its square).
RANGES_PER_RUN = 1024
_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition id << 33 | row index


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank_col: str = "_rn"
) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (e.g. date desc).

    Written as ``row_number() ... = 1``: Catalyst plans it as a partial
    ``WindowGroupLimit`` before the shuffle, so each map task ships at most one
    row per key and a hot key cannot swamp its reducer."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def global_rank(
    df: DataFrame, order: Sequence[Column], rank_col: str, *, keys: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``row_number() over (order by <order>)`` as BIGINT, distributed.

    ``keys`` identify a row and must close ``order`` as its tie-break: equal
    sort values then never share one range, however many rows hold them."""
    return global_ranks(df, {rank_col: order}, keys=keys, rows_per_range=rows_per_range)


def global_ranks(
    df: DataFrame, ranks: dict[str, Sequence[Column]], *, keys: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Several global row numbers, one per ``{rank_col: order}``.

    The input is checkpointed to the shared checkpoint folder first, so that
    it is computed once and counting and ranking see the same rows even if a
    stage is recomputed after an executor loss. Each rank range-sorts only the
    keys and its own sort columns and is joined back by the keys."""
    checkpoint_root(df.sparkSession)
    base = df.checkpoint(eager=True)
    n = base.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(n / rows_per_range), min(cores, n))
    out = base
    for rank_col, order in ranks.items():
        place = _ranged_rank(base, order, rank_col, parts, keys)
        place = place.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        out = out.join(place, same).drop(*[f"_{k}" for k in keys])
    return out


def ranks_by_measure(
    df: DataFrame, ranks: dict[str, str], *, keys: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Several global row numbers at once, ``{rank_col: measure}``: each by its measure
    (numeric) descending, NULL last, ties by ``keys`` ascending, NULL last; ``keys`` identify a row.

    Every row becomes one narrow row per rank, and one range sort over (rank,
    measure, keys) numbers them all; equal measures, however many, are split by the keys.
    A row's number is its place in its range plus the rank's rows in the ranges before, of which
    there is one count per rank and range. The numbers of a row are brought together by one
    grouping on the keys."""
    checkpoint_root(df.sparkSession)
    base = df.checkpoint(eager=True)  # computed once, and the same rows for sorting and joining
    names = list(ranks)
    narrow = F.array(*[F.struct(F.lit(i).alias("_r"), F.col(ranks[name]).cast("double").alias("_m")) for i, name in enumerate(names)])
    rows = base.select(*keys, F.explode(narrow).alias("_x")).select(*keys, "_x.*")
    n = base.count() * len(names)
    parts = max(1, math.ceil(n / rows_per_range), min(df.sparkSession.sparkContext.defaultParallelism, n))
    order = [F.col("_r"), F.col("_m").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys]]
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    tagged = sorted_rows.select("_r", *keys, F.monotonically_increasing_id().alias("_rid")).checkpoint(eager=True)
    tagged = tagged.withColumn("_pid", F.shiftright("_rid", 33))
    runs = tagged.groupBy(F.col("_r").alias("_of"), F.col("_pid").alias("_at")).agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row per rank and range: at most rows / rows_per_range of them
    before = F.sum("_n").over(Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_of", "_at", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    placed = tagged.join(runs, (F.col("_r") == F.col("_of")) & (F.col("_pid") == F.col("_at")))
    place = (F.col("_rid") + F.col("_shift")).cast("long")
    found = placed.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*[F.max(F.when(F.col("_r") == i, place)).alias(name) for i, name in enumerate(names)])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return base.join(found, same).drop(*[f"_{k}" for k in keys])


def _running(df: DataFrame, by: str, at: str) -> DataFrame:
    """``(by, at, before)``: the sum of ``n`` over the smaller ``at`` of a group.

    A group has at most RANGES_PER_RUN entries."""
    lists = df.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(at, "n"))).alias("_l"))
    before = F.expr(
        f"transform(_l, (x, i) -> struct(x.{at} as {at}, aggregate(slice(_l, 1, i), 0L, (a, y) -> a + y.n) as before))"
    )
    return lists.select(by, F.explode(before).alias("_x")).select(by, f"_x.{at}", "_x.before")


def _ranged_rank(df: DataFrame, order: Sequence[Column], rank_col: str, parts: int, keys: Sequence[str]) -> DataFrame:
    # Range partitioning keeps equal sort keys in one partition and orders the
    # partitions, so (partition, position inside it) is the global position.
    tagged = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(*keys, F.monotonically_increasing_id().alias("_rid"))
        .checkpoint(eager=True)  # fixes partition ids for counting and ranking
    )
    sizes = tagged.groupBy(F.shiftright("_rid", 33).alias("_pid")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("_run", F.floor(F.col("_pid") / RANGES_PER_RUN))
    runs = sizes.groupBy("_run").agg(F.sum("n").alias("n")).withColumn("_all", F.lit(0))
    inner = _running(sizes, "_run", "_pid").withColumnRenamed("before", "_in")
    outer = _running(runs, "_all", "_run").select("_run", F.col("before").alias("_out"))
    offsets = inner.join(outer, "_run").select("_pid", (F.col("_in") + F.col("_out")).alias("_off"))
    offsets = offsets.checkpoint(eager=True)  # one row per range
    ranked = tagged.withColumn("_pid", F.shiftright("_rid", 33)).join(offsets, "_pid")
    rank = F.col("_off") + F.col("_rid").bitwiseAND(F.lit(_LOW_BITS)) + 1
    return ranked.select(*keys, rank.cast("long").alias(rank_col))
