"""Operator 3: mixing sources to target weights.

Every source's documents are dealt by hash into blocks of about BLOCK_ROWS.
A source's target is a number of whole passes over its blocks and a part of
one more, so the mix is a number of block draws per source.  A binary tree
over the output shards splits these numbers by the multivariate
hypergeometric law: a node hands its left half a random draw without
replacement of its own counts, seeded by the node, so that each shard finds
its quotas by walking down from the root and no task sees the whole tree.
The shards then take disjoint runs of each source's (randomly filled) blocks
and shuffle their documents locally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored

BLOCK_ROWS = 128
CHUNK_BLOCKS = 1024
SHARD_DRAWS = 64  # block draws of a shard
BROADCAST_SOURCES = 50_000  # source rows (of some 100 bytes) that may be broadcast
WORD = r"[^\x20\x09-\x0D]+"
DRAW = "struct<pass:int,shard:bigint,words:bigint>"


def targets(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """Target words per source: ``share`` of all words by weight, none above ``cap`` times its size.

    The excess over the caps goes to the others by weight, again and again."""
    total, found, open_at = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_at:
        weight = sum(weights[i] for i in open_at)
        over = [i for i in open_at if total * weights[i] / weight > cap * sizes[i]]
        if not over:
            for i in open_at:
                found[i] = total * weights[i] / weight
            break
        for i in over:
            found[i] = cap * sizes[i]
        total -= sum(found[i] for i in over)
        open_at -= set(over)
    return found


def shard_quotas(shard: int, shards: int, counts: list[int], seed: int) -> np.ndarray:
    """Draws of each source in one shard: the walk from the root to its leaf."""
    held, total = np.array(counts, dtype=np.int64), sum(counts)
    first, end = 0, shards
    while end - first > 1:
        middle = (first + end) // 2
        left = total * middle // shards - total * first // shards
        rng = np.random.default_rng([seed, first, end])
        drawn = rng.multivariate_hypergeometric(held, left, method="marginals")
        if shard < middle:
            held, end = drawn, middle
        else:
            held, first = held - drawn, middle
    return held


def plan(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17,
         text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with size, source_size, target and draws.

    Sources, by code point with null last, take the weights in turn.  ``draws``
    (array of pass, shard, words) has an entry for each time the mix takes the
    document; ``words`` is its size, but for the one document of a source at
    which the target ends.  A document without words has size 0 and is drawn
    with its block.  The draws depend on the rows and ``seed`` alone, so reruns
    agree; repeated rows are drawn together.  An empty table gives an empty
    result; columns of the same names are replaced, others kept."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "draws")]
    sized = docs.select(*kept, F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                        F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)).alias("_h"))
    slim = stored(sized.select(F.col(source_col).alias("_source"), "size", "_h"), "mix-sizes")
    sums = slim.groupBy("_source").agg(F.count("*").alias("n"), F.sum("size").alias("words")).collect()  # a row per source
    sums.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    goals = targets([r["words"] for r in sums], [weights[i % len(weights)] for i in range(len(sums))], share, cap)
    sources = []
    for i, (row, goal) in enumerate(zip(sums, goals)):
        passes, rest = divmod(round(goal), row["words"]) if row["words"] else (0, 0)
        sources.append((i, row["_source"], row["words"], float(goal), passes, rest, max(1, -(-row["n"] // BLOCK_ROWS))))
    schema = f"_s int, _source {dict(slim.dtypes)['_source']}, source_size bigint, target double, _passes int, _rest bigint, _blocks bigint"
    known = spark.createDataFrame(sources, schema)
    if len(sources) <= BROADCAST_SOURCES:
        known = F.broadcast(known)

    def with_block(rows: DataFrame, source: str) -> DataFrame:
        return rows.join(known.withColumnRenamed("_source", "_known"), F.col(source).eqNullSafe(F.col("_known"))).withColumn("_block", F.expr("pmod(_h, _blocks)"))

    dealt = with_block(slim, "_source")
    blocks = dealt.groupBy("_s", "_block").agg(F.sum("size").alias("words"), F.first("_passes").alias("passes"), F.first("_rest").alias("rest"))
    blocks = stored(blocks.withColumn("chunk", F.expr(f"_block div {CHUNK_BLOCKS}")), "mix-blocks")
    chunks = blocks.groupBy("_s", "chunk").agg(F.sum("words").alias("words"), F.count("*").alias("n"), F.first("passes").alias("passes"))
    before = "partition by {} order by {} rows between unbounded preceding and 1 preceding"
    chunks = chunks.selectExpr(
        "_s", "chunk", f"coalesce(sum(words) over ({before.format('_s', 'chunk')}), 0) as chunk_words", f"coalesce(sum(n) over ({before.format('_s', 'chunk')}), 0) as chunk_rank",
        "sum(n) over (partition by _s) as source_blocks")
    ranked = blocks.join(chunks, ["_s", "chunk"]).selectExpr(
        "_s", "_block", "words", "passes", "source_blocks",
        f"rest - chunk_words - coalesce(sum(words) over ({before.format('_s, chunk', '_block')}), 0) as left_over",
        f"chunk_rank + row_number() over (partition by _s, chunk order by _block) - 1 as rank")
    # a block's draws: one in every whole pass, one more while the rest of the target lasts
    draws = ranked.select("_s", "_block", "words", "left_over", "source_blocks", "rank", F.explode(F.expr("sequence(0, passes)")).alias("pass"), "passes")
    draws = draws.where("pass < passes or left_over > 0").selectExpr(
        "_s", "_block", "pass", "pass * source_blocks + rank as draw", "case when pass < passes or left_over >= words then null else left_over end as partial")
    draws = stored(draws, "mix-draws")
    counts = {r["_s"]: r["n"] for r in draws.groupBy("_s").agg(F.count("*").alias("n")).collect()}
    drawn = [counts.get(i, 0) for i in range(len(sources))]
    shards = max(1, -(-sum(drawn) // SHARD_DRAWS))

    def quotas(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                quota = shard_quotas(int(shard), shards, drawn, seed)
                used = np.flatnonzero(quota)
                yield pd.DataFrame({"_s": used, "shard": int(shard), "quota": quota[used]})

    leaves = spark.range(0, shards, 1, max(1, min(shards // 64, 4096))).mapInPandas(quotas, "_s int, shard bigint, quota bigint")
    runs = leaves.selectExpr("_s", "shard", "quota", "sum(quota) over (partition by _s order by shard) as upto")
    places = runs.select("_s", "shard", F.explode(F.expr("sequence(upto - quota, upto - 1)")).alias("draw"))
    placed = draws.join(places, ["_s", "draw"])
    per_block = placed.groupBy("_s", "_block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "partial"))).alias("_d"))  # at most cap + 1 entries
    per_block = stored(per_block, "mix-plan")
    # the documents of the one block per source at which the target ends
    ends = per_block.select("_s", "_block", F.explode("_d").alias("d")).where("d.partial is not null").selectExpr("_s", "_block", "d.partial as partial")
    order = "partition by _s, _block order by _h, size"
    cut = dealt.join(F.broadcast(ends) if len(sources) <= BROADCAST_SOURCES else ends, ["_s", "_block"]).groupBy("_s", "_block", "_h", "size", "partial").agg(F.count("*").alias("n"))
    cut = cut.selectExpr("_s", "_block", "_h", "size", "n", f"partial - coalesce(sum(size * n) over ({order} rows between unbounded preceding and 1 preceding), 0) as room")
    # repeated rows are one entry: whole copies share the room, word by word
    cut = cut.selectExpr("_s as _cs", "_h as _ch", "least(size, greatest(0, room div n)) as _cut")
    rows = with_block(sized, source_col).join(per_block.withColumnsRenamed({"_s": "_ps", "_block": "_pb"}), (F.col("_s") == F.col("_ps")) & (F.col("_block") == F.col("_pb")), "left")
    cut = cut.groupBy("_cs", "_ch").agg(F.max("_cut").alias("_cut"))
    ended = rows.withColumn("_end", F.expr("exists(_d, d -> d.partial is not null)"))
    ended = ended.join(F.broadcast(cut) if len(sources) <= BROADCAST_SOURCES else cut, F.col("_end") & (F.col("_s") == F.col("_cs")) & (F.col("_h") == F.col("_ch")), "left")
    words = F.expr(f"cast(filter(transform(_d, d -> struct(d.pass as pass, d.shard as shard, case when d.partial is null then size else coalesce(_cut, 0) end as words)), d -> d.words > 0 or size = 0) as array<{DRAW}>)")
    return ended.withColumn("draws", F.coalesce(words, F.expr(f"cast(array() as array<{DRAW}>)"))).select(*kept, "size", "source_size", "target", "draws")


def mix(docs: DataFrame, text_col: str = "text", **parameters) -> DataFrame:
    """The mixed documents: a row for each draw, with shard and words, dealt by
    shard and shuffled within it.

    A document at which its source's target ends has its text cut behind the
    last word taken; all other texts are whole."""
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "draws", "shard", "words")]
    drawn = plan(docs, text_col=text_col, **parameters).select(*names, "size", F.explode("draws").alias("_draw"))
    head = F.expr(f"concat_ws('', slice(split(`{text_col}`, '(?<=[^\\\\x20\\\\x09-\\\\x0D])(?=[\\\\x20\\\\x09-\\\\x0D])'), 1, int(_draw.words)))")
    cut = drawn.withColumn(text_col, F.when(F.col("_draw.words") < F.col("size"), head).otherwise(F.col(text_col)))
    rows = cut.select(*names, F.col("_draw.shard").alias("shard"), F.col("_draw.words").alias("words"), F.xxhash64("_draw", *[F.col(c) for c in names if c != text_col]).alias("_order"))
    return rows.repartition(F.col("shard")).sortWithinPartitions("shard", "_order").drop("_order")
