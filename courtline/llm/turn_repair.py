"""Operator 11: conversation structure repair by a run-length DP.

Rows are range-sorted by conversation and turn, which splits a hot
conversation, and numbered in a stored table.  Of each conversation, the rows
of one partition become one string of symbols (a character a row); only
conversations that straddle partitions, at most one per boundary, need more:
their strings' min-plus matrices are scanned for the costs behind each string,
and the states that each string leads to for the state before it.  Then every
string's edits are chosen by itself (``turn_runs``).  The repaired texts are
hashed as they stream by, sorted, with each string's edits ahead of its rows:
a digest of a whole conversation is one pass by definition, but no more than a batch
of it is held.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import turn_runs as runs
from .storage import small_batches, stored
from .worker import cache

ROWS_PER_PART = 200_000
SPACES = " \t\n\x0b\x0c\r"  # all but [^\x20\x09-\x0D]
KEPT_STRINGS = 50_000  # short strings whose edits a worker keeps
SHORT = 64

COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
PIECE = "audit string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that CRC-32 of ``conv_id:turn`` deals out."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), (F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20).alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1)
    made = rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)))
    return made.drop("col")


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` by conversation and turn (nulls first; ties by role, then by the digest of
    the row) with rid, rising in that order, and part, the partition."""
    same = F.unhex(F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"), F.length("role"), F.lit(":"), "role", "text"), 256))
    keyed = rows.withColumn("same", same)
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("same")]
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / ROWS_PER_PART))
    ranged = keyed.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("rid", F.monotonically_increasing_id())
    return stored(ranged, "turns").withColumn("part", F.shiftright("rid", 33))


def _symbols(rows: DataFrame) -> DataFrame:
    """conv_id, part, first (the least rid) and symbols, a character per row in order.

    A row is a duplicate if its role and text stand at a smaller rid; the copies of a text
    are counted per partition first, so a text of very many copies is nowhere gathered."""
    copies = rows.groupBy("same", "part").agg(F.min("rid").alias("least"), F.count("*").alias("n"))
    several = copies.groupBy("same").agg(F.min("least").alias("original"), F.sum("n").alias("n")).where("n > 1")
    several = several.select(F.col("same").alias("_same"), "original")
    several = copies.join(several, F.col("same") == F.col("_same")).select("_same", F.col("part").alias("_part"), "original")
    role = F.substring("role", 1, 1)
    cls = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    slim = rows.select("conv_id", "part", "rid", "same", cls.alias("cls"), (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    met = slim.join(several, (F.col("same") == F.col("_same")) & (F.col("part") == F.col("_part")), "left")
    fault = F.when(F.col("blank"), 2).when(F.col("original") < F.col("rid"), 3).when(F.col("cut"), 1).otherwise(0)
    symbol = F.char(F.lit(runs.FIRST_SYMBOL) + 4 * fault + F.col("cls"))
    listed = met.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("rid", symbol.alias("s")))).alias("l"))
    return listed.select("conv_id", "part", F.col("l")[0]["rid"].alias("first"), F.array_join(F.transform("l", lambda x: x["s"]), "").alias("symbols"))


def _straddling(strings: DataFrame, several: DataFrame) -> DataFrame:
    """conv_id, part, togo, state, last for the strings of the conversations in ``several``.

    Two scans over a conversation's strings, of which each has a row of some numbers: the costs
    behind every string, from the last to the first, and the states, from the first on."""

    @F.pandas_udf("array<bigint>")
    def matrix(symbols: pd.Series) -> pd.Series:
        return symbols.map(lambda s: [x for row in runs.matrix_of(s) for x in row])

    @F.pandas_udf("array<bigint>")
    def exits(symbols: pd.Series, togo: pd.Series) -> pd.Series:
        return pd.Series([[runs.audit_of(s, tuple(map(int, t)), state, last=False)[2] for state in runs.STATES] for s, t in zip(symbols, togo)])

    def behind(conv: pd.DataFrame) -> pd.DataFrame:
        conv, togo, found = conv.sort_values("part"), runs.END, []
        for flat in reversed(conv["matrix"].tolist()):
            found.append(list(togo))
            togo = runs.before(tuple(tuple(map(int, flat[4 * p : 4 * p + 4])) for p in runs.STATES), togo)
        return conv[["conv_id", "part"]].assign(togo=found[::-1])

    def ahead(conv: pd.DataFrame) -> pd.DataFrame:
        conv, state, found = conv.sort_values("part"), runs.START, []
        for ways in conv["exits"]:
            found.append(state)
            state = int(ways[state])
        return conv[["conv_id", "part", "togo"]].assign(state=found, last=[False] * (len(found) - 1) + [True])

    mine = stored(strings.join(several, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv"), "turns-straddling")
    costs = mine.select("conv_id", "part", matrix("symbols").alias("matrix")).groupBy("conv_id").applyInPandas(behind, "conv_id bigint, part bigint, togo array<bigint>")
    costs = costs.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "togo")
    met = mine.join(costs, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
    ways = met.select("conv_id", "part", "togo", exits("symbols", "togo").alias("exits")).groupBy("conv_id")
    return ways.applyInPandas(ahead, "conv_id bigint, part bigint, togo array<bigint>, state int, last boolean")


def _piece(symbols: pd.Series, togo: pd.Series, state: pd.Series, last: pd.Series) -> pd.DataFrame:
    held, found = cache("turn_repair"), []
    for s, t, p, z in zip(symbols, togo, state, last):
        if t is None and s in held:
            found.append(held[s])
            continue
        audit, cost, _ = runs.audit_of(s, runs.END if t is None else tuple(map(int, t)), int(p), bool(z))
        row = (audit, *runs.counts_of(s), cost)
        if t is None and len(s) <= SHORT:
            if len(held) >= KEPT_STRINGS:
                held.clear()
            held[s] = row
        found.append(row)
    return pd.DataFrame(found, columns=["audit", *COUNTS], dtype=object)


def _hashes(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: every piece's audit goes ahead of its rows in the stream."""
    heads = pieces.select("conv_id", F.col("first").alias("rid"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    both = heads.unionByName(rows.select("conv_id", "rid", F.lit(1).alias("kind"), "role", "text"))
    order = [F.col("conv_id").asc_nulls_first(), "rid", "kind"]
    streamed = both.repartition("conv_id").sortWithinPartitions(*order)

    def play(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, replay, digest, lines_so_far = None, None, None, 0

        def put(lines: list[str]) -> None:
            nonlocal lines_so_far
            for line in lines:
                digest.update(("\n" if lines_so_far else "").encode() + line.encode("utf-8", "surrogatepass"))
                lines_so_far += 1

        def told(done: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(done, columns=["conv_id", "repaired_sha256"], dtype=object)

        for frame in frames:
            done = []
            for c, kind, role, text in zip(frame["conv_id"].tolist(), frame["kind"].tolist(), frame["role"].tolist(), frame["text"].tolist()):
                c = None if c is None or c != c else int(c)
                if replay is None or c != conv:
                    if replay is not None:
                        put(replay.inserts())
                        done.append((conv, digest.hexdigest()))
                    conv, replay, digest, lines_so_far = c, runs.Replay(), hashlib.sha256(), 0
                if kind == 0:
                    replay.load(text)
                else:
                    put(replay.row(role, text))
            yield told(done)
        if replay is not None:
            put(replay.inserts())
            yield told([(conv, digest.hexdigest())])

    return streamed.drop("rid").mapInPandas(play, "conv_id bigint, repaired_sha256 string")


def _illegal_between(pieces: Column) -> Column:
    """Adjacent rows of illegal roles where one piece ends and the next begins."""
    seams = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x, i: F.concat(pieces[i]["tail"], x["head"]))
    return F.size(F.filter(seams, lambda x: ~x.isin(*sorted(runs.LEGAL)))).cast("long")


def _class(at: Column) -> Column:
    return F.substring(F.lit(runs.CLASSES), (F.ascii(at) - runs.FIRST_SYMBOL) % 4 + 1, F.lit(1))


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of
    every conversation in ``rows`` (conv_id, turn, role, text: no null role or text).

    Rows stand by turn, nulls first; rows of one turn by role, then by digest, so equal rows
    are neighbours.  A null conv_id is a conversation.  Texts count whole, whatever their length;
    an empty table gives no rows; other columns are not read."""
    rows = _ordered(rows.select("conv_id", "turn", "role", "text"))
    strings = stored(_symbols(rows), "turns-strings")
    several = strings.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv_id").alias("_conv"))
    whole = strings.join(several, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_anti")
    whole = whole.select("*", F.lit(None).cast("array<bigint>").alias("togo"), F.lit(0).alias("state"), F.lit(True).alias("last"))
    scanned = _straddling(strings, several).withColumnsRenamed({"conv_id": "_conv", "part": "_part"})
    split = strings.join(scanned, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))).drop("_conv", "_part")
    pieces = whole.unionByName(split).select("conv_id", "part", "first", "symbols", F.pandas_udf(_piece, PIECE)("symbols", "togo", "state", "last").alias("p"))
    pieces = stored(pieces.select("conv_id", "part", "first", "p.*", _class(F.col("symbols")).alias("head"), _class(F.right("symbols", F.lit(1))).alias("tail")), "turns-pieces")
    listed = pieces.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "audit", "head", "tail"))).alias("l"), *(F.sum(c).alias(c) for c in COUNTS))
    counted = listed.select(
        "conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + _illegal_between(F.col("l"))).alias("illegal"), "cost",
        F.array_join(F.transform("l", lambda x: x["audit"]), "").alias("audit"),
    )
    gaps = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    with small_batches(rows.sparkSession):
        hashes = stored(_hashes(rows, pieces), "turns-hashes")
    found = counted
    for other in (gaps, hashes):
        found = found.join(other.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    gaps_or_none = F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps")
    return found.select("conv_id", gaps_or_none, "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """``repair`` of the damaged ``turns``, with a row for every conv_id of ``turns``.

    A null role or text, and a null within the damage's key, is one space.  A
    conversation that lost all its rows has zeros, an empty audit and the digest of the empty string."""
    every = turns.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    found = repair(damaged(turns.withColumns({"conv_id": F.col("conv_id").cast("long"), "turn": F.col("turn").cast("long")})))
    met = every.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return met.select(F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
