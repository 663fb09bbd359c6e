"""Operator 13: a Merkle manifest of a table by nested-struct rollup, with DataFrame functions only.

The rows of a source are ranked by a range sort, and the rank is cut into
digits of base FAN.  A block is LEVELS digits wide: its rows, at most
FAN**LEVELS, are dealt to one task by the rank's upper digits, and the digit
columns are grouped away one after the other, the lowest first, each step
nesting the children's structs in their parent.  As the first grouping's
exchange serves the others, a block costs one shuffle.  The blocks' roots are
the nodes of the next tier, until every source is one block; the subroots
are rolled up likewise.  Proofs are then read off from the top: transform
pairs each child with its siblings and explode hands it the path above it.
A block meets the path of its root by a union and a grouping on the block's
number, so no step joins, and no task holds more than a few blocks' digests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

FAN = 3
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<l: string, r: string>>"  # from the leaf upwards: the siblings' digests before and after


def digest(fields: list[Column]) -> Column:
    """Hex SHA-256 of the fields, each ``-`` if null, else its UTF-8 length, a colon and its text."""
    told = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*told), 256)


def leaves_of(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, source, leaf and, where it differs, the tampered leaf ``bad``.

    Rows whose id has an even CRC-32 lose the line breaks of their text; a null id is not tampered with."""
    fields = [F.col(id_col if f == "doc_id" else f) for f in FIELDS]
    hit = F.crc32(F.col(id_col).cast("string")) % 2 == 0
    tampered = digest([*fields[:-1], F.replace(fields[-1], F.lit("\n"), F.lit(""))])
    changed = hit & F.contains(fields[-1], F.lit("\n"))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), "source", digest(fields).alias("leaf"), F.when(changed, tampered).alias("bad"))


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with no, their rank (from 0) by ``order`` among those of one ``key``,
    and total, the number of these.

    A range sort over key and order splits a hot key; a row's rank is its place in its
    partition plus the key's rows in the partitions before.  The counts have a row per
    partition and key."""
    by = [F.col(c).asc_nulls_first() for c in (key, *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_rid", F.monotonically_increasing_id())
    ranged = stored(ranged, name).withColumn("_part", F.shiftright("_rid", 33))
    runs = ranged.groupBy(key, "_part").agg(F.min("_rid").alias("_first"), F.count("*").alias("_n"))
    of_key = Window.partitionBy(key)
    before = F.sum("_n").over(of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col(key).alias("_key"), F.col("_part").alias("_of"), (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(of_key).alias("total"))
    met = ranged.join(runs, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of")))
    return met.select(*rows.columns, (F.col("_rid") + F.col("_shift")).alias("no"), "total")


def _joined(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda x: x["h"]), "")


def rollup(nodes: DataFrame, key: str, name: str, levels: int = LEVELS) -> list[DataFrame]:
    """The tiers over ``nodes`` (key, no, total, h, row): of each block key, block,
    total, h and the nested kids.  In the last tier every key has one block.

    A level is hashed as long as its nodes are several, so a run of one gets a digest
    below the top and the last node of a key stays as it is."""
    size = FAN**levels
    most = nodes.agg(F.max("total")).first()[0] or 1
    tiers = []
    while True:
        digits = [F.expr(f"no div {FAN**k} % {FAN}").alias(f"d{k}") for k in range(levels)]
        by = [key, "block", "total", *(f"d{k}" for k in reversed(range(levels)))]
        rows = nodes.select(key, F.expr(f"no div {size}").alias("block"), "total", *digits, F.struct("h", "row").alias("kid")).repartition(key, "block")
        for k in range(levels):
            by = by[:-1]
            rows = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(f"d{k}", "kid.*"))).alias("kids"))
            h = F.when(F.col("total") > FAN**k, F.sha2(_joined(F.col("kids")), 256)).otherwise(F.col("kids")[0]["h"])
            rows = rows.select(*by, F.struct(h.alias("h"), "kids").alias("kid"))
        tiers.append(stored(rows.select(key, "block", "total", "kid.h", "kid.kids"), f"{name}-{len(tiers)}"))
        if most <= size:
            return tiers
        most = -(-most // size)
        upper = F.expr(f"(total + {size - 1}) div {size}").alias("total")
        nodes = tiers[-1].select(key, F.col("block").alias("no"), upper, "h", F.lit(None).cast("string").alias("row"))


def _with_siblings(kids: Column) -> Column:
    """Each of ``kids`` with the digests before and after it."""
    return F.transform(
        kids,
        lambda x, i: F.struct(
            x.alias("kid"),
            F.struct(_joined(F.slice(kids, F.lit(1), i)).alias("l"), _joined(F.slice(kids, i + 2, F.lit(FAN))).alias("r")).alias("run"),
        ),
    )


def proven(blocks: DataFrame, key: str, above: list[str], levels: int = LEVELS) -> DataFrame:
    """key, no, h, row and path of the nodes in ``blocks``, whose path leads from
    their roots upwards; the columns ``above`` go with it."""
    rows = blocks.withColumn("no", F.col("block"))
    for k in reversed(range(levels)):
        rows = rows.select(key, "total", *above, "no", "path", F.explode(_with_siblings(F.col("kids"))).alias("x"))
        path = F.when(F.col("total") > FAN**k, F.concat(F.array("x.run"), "path")).otherwise(F.col("path"))
        below = ["x.kid.kids"] if k else ["x.kid.h", "x.kid.row"]
        rows = rows.select(key, "total", *above, (F.col("no") * FAN + F.col(f"x.kid.d{k}")).alias("no"), path.alias("path"), *below)
    return rows.drop("total")


def descended(tiers: list[DataFrame], top: DataFrame, key: str, above: list[str]) -> DataFrame:
    """The nodes of the lowest tier with their whole paths; ``top`` has key, path and
    the columns ``above`` of every key.  A block and its path are two rows of one group."""
    paths = top.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        both = tier.drop("h").unionByName(paths.select(key, "block", "path", *above), allowMissingColumns=True)
        met = both.groupBy(key, "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("total", "kids", "path", *above)))
        nodes = proven(met, key, above)
        paths = nodes.withColumn("block", F.col("no"))
    return nodes


def folded(path: Column, start: Column) -> Column:
    """The root that ``start`` and the siblings along ``path`` give."""
    return F.aggregate(path, start, lambda a, p: F.sha2(F.concat(p["l"], a, p["r"]), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, path (the siblings left
    and right of the way up, level by level), proof_sha256, folded_root and verified.

    Null ids come first in their source and are not tampered with; rows of equal ids stand in the order
    of their leaves (rows that are alike get the proofs of their places).  A null source
    is a source of its own, the first.  Null fields count as ``-``, empty ones as
    ``0:``, texts of any length whole.  A table of one row has no siblings; an empty one
    gives no rows.  Only the five FIELDS are read, whatever other columns there are."""
    leaves = stored(leaves_of(docs, id_col), "merkle-leaves")
    ranked = numbered(leaves, "source", ["doc_id", "leaf"], "merkle-ranked")
    tiers = rollup(stored(ranked.select("source", "no", "total", F.col("leaf").alias("h"), F.struct("doc_id", "bad").alias("row")), "merkle-nodes"), "source", "merkle-tier")
    subroots = tiers[-1].select(F.lit(0).alias("whole"), "source", "h")
    sources = numbered(subroots, "whole", ["source"], "merkle-sources")
    crown = rollup(sources.select("whole", "no", "total", "h", F.struct("source").alias("row")), "whole", "merkle-crown")
    roots = crown[-1].select("whole", F.col("h").alias("root"), F.array().cast(PATH).alias("path"))
    tops = descended(crown, roots, "whole", ["root"])
    tops = tops.select("row.source", F.col("h").alias("subroot"), "root", "path")
    rows = descended(tiers, tops, "source", ["subroot", "root"])
    siblings = F.array_join(F.transform("path", lambda p: F.concat(p["l"], p["r"])), "")
    found = rows.select(
        "row.doc_id", F.col("h").alias("leaf"), "subroot", "root", "path", F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.col("path"), F.coalesce("row.bad", "h")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
