"""Operator 2: best-fit packing of documents into fixed-size sequences.

Hierarchical residual packing.  Every input partition turns its documents
into pieces and packs them best-fit, largest first.  Nearly full sequences
are final; underfull ones become items of the next round, in which the bins
of FAN_IN neighbouring tasks meet and are packed again, until one task is
left.  Where a task would hold more than TASK_BINS bins, all that are left are
packed at once: best-fit decreasing needs only the number of bins of each
fill, of which there are fewer than ``capacity``, and tells for every rank
within a fill which sequence it goes to.  A bin carries its
members (at most ``capacity``, as each has a token), so no join is needed to
find them again.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import small_batches, stored
from .words import id_cache

FAN_IN = 16
TASK_BINS = 100_000
MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>"
BIN_SCHEMA = f"part bigint, fill int, members array<{MEMBER}>"


def best_fit(items: list[tuple], capacity: int) -> list[tuple[int, list]]:
    """Best-fit decreasing.  An item is (size, tie, members); a bin (fill, members).

    Bins are indexed by their free space, so an item costs a search over at
    most ``capacity`` distinct values and not over the bins."""
    free: list[int] = []  # distinct positive residuals, ascending
    bins_of: dict[int, list[list]] = {}
    bins: list[list] = []
    for size, _, members in sorted(items, key=lambda x: (-x[0], x[1])):
        at = bisect_left(free, size)
        if at == len(free):
            chosen, room = [0, []], capacity
            bins.append(chosen)
        else:
            room = free[at]
            stack = bins_of[room]
            chosen = stack.pop()
            if not stack:
                del bins_of[room]
                free.pop(at)
        chosen[0] += size
        chosen[1].extend(members)
        room -= size
        if room:
            if room not in bins_of:
                bins_of[room] = []
                insort(free, room)
            bins_of[room].append(chosen)
    for _, members in bins:
        at = 0
        for member in members:
            member["offset"] = at
            at += member["length"]
    return [(fill, members) for fill, members in bins]


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[size]`` items of each size, whole runs of equal items and bins at a time.

    Rows (size, first, last, each, base): the items of a size with the ranks ``first`` to
    ``last`` (from 0) go, ``each`` at a time, to the bins from ``base`` on."""
    free: list[int] = []  # distinct positive residuals, ascending
    runs: dict[int, list[tuple[int, int]]] = {}  # (base, number) of the bins of a residual
    rows, bins = [], 0

    def put(room: int, base: int, number: int) -> None:
        if room and number:
            if room not in runs:
                runs[room] = []
                insort(free, room)
            runs[room].append((base, number))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect_left(free, size)
            if at < len(free):
                room = free[at]
                base, number = runs[room].pop()
                if not runs[room]:
                    del runs[room]
                    free.pop(at)
            else:
                room, base, number = capacity, bins, -(-left // (capacity // size))
                bins += number
            each = min(room // size, left)  # a bin stays the best fit until it is full
            used = min(number, left // each)
            rows.append((size, rank, rank + used * each - 1, each, base))
            put(room - each * size, base, used)
            put(room, base + used, number - used)
            rank += used * each
            left -= used * each
    return rows


def _planned(left: DataFrame, capacity: int) -> DataFrame:
    """The bins ``left`` packed at once by ``packing_plan``; no task holds more than a bin besides its batch."""
    spark = left.sparkSession

    def ranked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        seen: dict[int, int] = {}
        for frame in frames:
            ranks = []
            for fill in map(int, frame["fill"]):
                ranks.append(seen.get(fill, 0))
                seen[fill] = ranks[-1] + 1
            yield pd.DataFrame({"part": TaskContext.get().partitionId(), "fill": frame["fill"], "members": frame["members"], "rank": ranks})

    def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, fill, members = None, 0, []
        for frame in frames:
            whole = []
            for bin_id, size, rows in zip(frame["bin"], frame["fill"], frame["members"]):
                if bin_id != at:
                    if members:
                        whole.append((fill, members))
                    at, fill, members = bin_id, 0, []
                for row in rows:
                    member = dict(row) if isinstance(row, dict) else row.asDict()
                    member["offset"] += fill
                    members.append(member)
                fill += int(size)
            yield _bins_frame(0, whole)
        if members:
            yield _bins_frame(0, [(fill, members)])

    # written first: ranks are told in the order in which a task reads its rows
    ranks = stored(left.mapInPandas(ranked, BIN_SCHEMA + ", rank bigint"), "pack-ranks")
    held = stored(ranks.groupBy("part", "fill").agg(F.count("*").alias("n")), "pack-held")
    counts = {r["fill"]: r["n"] for r in held.groupBy("fill").agg(F.sum("n").alias("n")).collect()}
    before = held.withColumn("before", F.sum("n").over(Window.partitionBy("fill").orderBy("part")) - F.col("n")).drop("n")
    plan = spark.createDataFrame(packing_plan(counts, capacity), "size int, first bigint, last bigint, each bigint, base bigint")
    placed = ranks.join(before, ["part", "fill"]).withColumn("rank", F.col("rank") + F.col("before"))
    goes = (F.col("fill") == F.col("size")) & F.col("rank").between(F.col("first"), F.col("last"))
    placed = placed.join(F.broadcast(plan), goes).select(F.expr("base + (rank - first) div each").alias("bin"), "fill", "rank", "members")
    sorted_bins = placed.repartition("bin").sortWithinPartitions("bin", F.desc("fill"), "rank")
    return stored(sorted_bins.mapInPandas(joined, BIN_SCHEMA), "pack-bins")


def _bins_frame(part: int, bins: list[tuple[int, list]]) -> pd.DataFrame:
    return pd.DataFrame({"part": [part] * len(bins), "fill": [b[0] for b in bins], "members": [b[1] for b in bins]})


def _emit(part: int, bins: list[tuple[int, list]], size: int = 2000) -> Iterator[pd.DataFrame]:
    for at in range(0, len(bins), size):
        yield _bins_frame(part, bins[at : at + size])


def _pieces(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids (4 bytes each)."""
    total = len(ids) // 4
    for number, start in enumerate(range(0, total, capacity)):
        length = min(capacity, total - start)
        yield number, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", slack: int | None = None) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids by the tokenizer file ``path`` and then ``end_id``;
    only longer ones are cut, into pieces of ``capacity``.  Bins within
    ``slack`` tokens of the capacity (1/256 of it by default) are final.

    A null or empty text is the ``end_id`` alone.  Null ids and repeated rows
    stay separate documents.  An empty table gives no rows.  Further columns
    of ``docs`` are not read."""
    slack = capacity // 256 if slack is None else slack
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = max(1, slim.rdd.getNumPartitions())
    end = int(end_id).to_bytes(4, "little")

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, cache, items = TaskContext.get().partitionId(), id_cache(path), []
        for frame in frames:
            whole = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = b"".join(b"".join(x) for x in cache.values_of(text or "")) + end
                known = None if pd.isna(doc_id) else int(doc_id)
                for piece, start, length, crc in _pieces(ids, capacity):
                    member = {"doc_id": known, "piece": piece, "start": start, "length": length, "ids_crc32": crc, "offset": 0}
                    if length == capacity:
                        whole.append((length, [member]))
                    else:
                        items.append((length, (-1 if known is None else known, piece), [member]))
            yield from _emit(part, whole)
            if len(items) >= 4 * TASK_BINS:  # a very large partition: pack what is here and keep the underfull
                packed = best_fit(items, capacity)
                yield from _emit(part, [b for b in packed if b[0] >= capacity - slack])
                items = [(f, (m[0]["doc_id"] or -1, m[0]["piece"]), m) for f, m in packed if f < capacity - slack]
        yield from _emit(part, best_fit(items, capacity))

    def again(frame: pd.DataFrame) -> pd.DataFrame:
        items = []
        for fill, members in zip(frame["fill"], frame["members"]):
            rows = [m if isinstance(m, dict) else m.asDict() for m in members]
            lead = rows[0]
            items.append((int(fill), (-1 if lead["doc_id"] is None else lead["doc_id"], lead["piece"]), rows))
        return _bins_frame(int(frame["part"].iloc[0]) // FAN_IN, best_fit(items, capacity))

    full = F.col("fill") >= capacity - slack
    with small_batches(docs.sparkSession):
        bins = stored(slim.mapInPandas(first, BIN_SCHEMA), "pack-bins")
    done = [bins.where(full)]
    left = bins.where(~full)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        above = F.expr(f"part div {FAN_IN}")
        most = left.groupBy(above).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most > TASK_BINS:
            left = _planned(left, capacity)
            break
        merged = left.groupBy(above).applyInPandas(again, BIN_SCHEMA)
        bins = stored(merged, "pack-bins")
        done.append(bins.where(full))
        left = bins.where(~full)
    packed = left
    for table in done:
        packed = packed.unionByName(table)
    # the tables are written, so a row keeps its place and its id in a rerun of a task
    numbered = packed.withColumn("sequence_id", F.monotonically_increasing_id())
    rows = numbered.select("sequence_id", F.explode("members").alias("m"))
    return rows.select(
        F.col("m.doc_id").alias(id_col), "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset"
    )
