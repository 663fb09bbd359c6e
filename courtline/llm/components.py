"""Distributed union-find, and the candidate rounds of the near-duplicate operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import freed, settled, stored

#: All remaining pairs are tested at once when they are at most this many times the bucket rows.
PAIRS_PER_ROW = 8
#: Growth of the number of nodes per bucket that a round tests against the bucket.
GROWTH = 32
#: Nodes in a bucket from which on its nodes' shingles are counted, unless the operator says otherwise.
CROWD = 16
#: Pairs for each of their nodes beyond which they are verified in two steps.
MANY_PAIRS = 8
#: Shared buckets (16 bytes each) that may be broadcast; beyond that the join is shuffled.
BROADCAST_BUCKETS = 1_000_000


def kept(df: DataFrame) -> DataFrame:
    """A table of its own, which cuts the lineage of a round and takes less disk than a checkpoint."""
    return stored(df, "round")


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for the nodes of ``edges`` (a, b: long).

    Alternates large-star and small-star steps until every node but the roots
    has one edge, to its root.  A step keeps one row per edge: minima are
    combined before the shuffle and joined back, so a node of very many edges
    is never gathered.  The result is read from a stored table."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, e = e, kept(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        freed(last)
        ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("x"))
        open_nodes = ends.groupBy("x.node").agg(F.sum("x.up").alias("up"), F.sum("x.down").alias("down")).where("up > 1 or (up > 0 and down > 0)")
        if not open_nodes.take(1):
            break
    own = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)


def _shared(part: DataFrame) -> DataFrame:
    """The rows (bucket, node) of ``part`` whose bucket holds two nodes or more, kept.

    The shuffle that counts a bucket's nodes also brings its smallest and largest,
    so buckets of two, by far the most, are known without a second one."""
    met = kept(part.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n")).where("n > 1"))
    pairs = met.where("n = 2")
    more = met.where("n > 2").select(F.col("bucket").alias("shared"))
    small = more.count() <= BROADCAST_BUCKETS
    held = part.join(F.broadcast(more) if small else more.hint("shuffle_hash"), F.col("bucket") == F.col("shared")).select("bucket", "node")
    found = kept(pairs.select("bucket", F.col("lo").alias("node")).unionByName(pairs.select("bucket", F.col("hi").alias("node"))).unionByName(held))
    freed(met)
    return found


def shared_buckets(parts: list[DataFrame]) -> DataFrame:
    """The rows (bucket, node) of all ``parts`` whose bucket holds two nodes or more.

    Each part has bands of its own, so that its rows, of which few stay, can
    be shuffled by themselves."""
    return reduce(DataFrame.unionByName, [_shared(part) for part in parts])


def _pairs_possible(a: str, b: str, percent: int) -> str:
    """Exact bounds: the sizes and the numbers of shared shingles allow the similarity."""
    bounds = [
        f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.least, {b}.least)",
        f"{100 + percent} * least({a}.s, {b}.s) >= {percent} * ({a}.least + {b}.least)",
    ]
    return " and ".join(bounds)


def _bitmaps_allow(a: str, b: str, n: str, percent: int, words: int) -> str:
    """An exact bound for two sets of at most ``n`` shingles in all.

    A shingle sets one bit of its set's bitmap (``words`` longs), so every bit
    in which two bitmaps differ stands for a shingle that only one set has."""
    differ = " + ".join(f"bit_count({a}[{k}] ^ {b}[{k}])" for k in range(words))
    return f"{100 + percent} * ({differ}) <= {100 - percent} * ({n})"


def _bounded_rows(buckets: DataFrame, nodes: DataFrame, shingles_of: Callable[[DataFrame], DataFrame], percent: int, crowd: int) -> DataFrame:
    """The bucket rows with z = (n and least, bounds of the size of the node's set; its bitmap if
    ``nodes`` has one; s, an upper bound of what it shares with any node of the bucket),
    without hopeless nodes.  Only rows with hope get the bitmap, by far the widest part.

    In buckets of ``crowd`` nodes or more, shingles that only one of all their
    nodes has cannot be shared: s is n less their number.  A node that has too
    many of its own to be linked with any node of the bucket leaves it, so a
    large group of copies, each with changes of its own, is not compared pair
    by pair."""
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("held"))
    bits = ["bits"] if "bits" in nodes.columns else []
    known = nodes.select("node", "n", F.col("least" if "least" in nodes.columns else "n").alias("least"))
    held = kept(buckets.join(sizes, "bucket").join(known, "node").select("bucket", "node", "n", "least", (F.col("held") >= crowd).alias("crowded")))
    shingles = shingles_of(held.where("crowded").select("node").distinct())
    own = shingles.groupBy("shingle").agg(F.count("*").alias("k"), F.min("node").alias("node")).where("k = 1").groupBy("node").agg(F.count("*").alias("own"))
    rows = held.join(own, "node", "left").withColumn("s", F.when(F.col("crowded"), F.col("n") - F.coalesce("own", F.lit(0))).otherwise(F.col("n")))
    rows = kept(rows.where(f"100 * s >= {percent} * least").select("bucket", "node", "n", "least", "s"))
    freed(held)
    best = rows.groupBy("bucket").agg(F.min("least").alias("least_n"), F.max("s").alias("most_s"), F.count("*").alias("held")).where("held > 1")
    hope = f"{100 + percent} * least(s, most_s) >= {percent} * (least + least_n)"
    hopeful = rows.join(best, "bucket").where(hope).select("bucket", "node", "n", "least", "s")
    if bits:
        hopeful = hopeful.join(nodes.select("node", "bits"), "node")
    return kept(hopeful.select("bucket", "node", F.struct("n", "least", *bits, "s").alias("z")))


def _star_links(pairs: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (a, b) of ``pairs`` with the components of all their links, stored.

    Where pairs are many times their nodes, as among near copies that meet
    several hubs, every node's pair with its partner of most pairs is verified
    first, and of the others only those whose ends are still apart."""
    pairs = kept(pairs)
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")))
    degrees = kept(ends.groupBy("node").agg(F.count("*").alias("degree")))
    if pairs.count() <= MANY_PAIRS * degrees.count():
        return kept(verify(pairs))
    best = ends.join(degrees.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.max(F.struct("degree", "other")).alias("best"))
    star = kept(best.select(F.least("node", "best.other").alias("a"), F.greatest("node", "best.other").alias("b")).distinct())
    links = kept(verify(pairs.join(star, ["a", "b"], "left_semi")))
    roots = connected_components(links)
    side = lambda end: roots.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    apart = pairs.join(star, ["a", "b"], "left_anti").join(side("a"), "a", "left").join(side("b"), "b", "left")
    rest = apart.where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b", "na", "nb")
    return links.unionByName(kept(verify(rest)))


def linked_components(
    buckets: DataFrame, nodes: DataFrame, shingles_of: Callable[[DataFrame], DataFrame], verify: Callable[[DataFrame], DataFrame], percent: int,
    crowd: int = CROWD, words: int = 0,
) -> DataFrame:
    """node, component over all links among the nodes that share a bucket.

    ``buckets`` has bucket and node (long, distinct rows, two or more of each
    bucket, as ``shared_buckets`` gives them), ``nodes`` node, n (size of
    its set or an upper bound of it, with a lower bound as ``least``) and, if ``words`` is not 0, bits (its bitmap: an array of ``words``
    longs in which each shingle sets one bit); ``shingles_of`` gives the rows (node, shingle) of some nodes;
    ``verify`` keeps those of the pairs (a, b, na, nb) whose similarity is
    ``percent`` or more.

    Pairs whose sizes, bitmaps or shared shingles rule a link out are never made; the
    last are counted in the buckets of ``crowd`` nodes or more that the first round leaves open.  The
    first round tests the most typical node of every bucket (that of the
    most buckets) against the others, which settles buckets of
    copies with one pair per row.  In buckets whose nodes are not one
    component after that, more nodes, GROWTH times as many in each round, are
    tested against all nodes of other components and leave the bucket.  Once
    few pairs of different components remain, all of them are tested.  A pair
    goes untested only if its nodes are already in one component.  Nodes that
    share several open buckets meet in the smallest of them only; if one of
    them leaves another, the pair still stands there.

    Bitmaps, by far the widest part, meet the first round's distinct pairs, one
    of each row at most, and the rows of the buckets that are open after it."""
    possible = _pairs_possible("z", "zz", percent)

    def pairs_of(met: DataFrame) -> DataFrame:
        swap = F.col("x") > F.col("y")
        ends = [F.when(swap, F.col(f)).otherwise(F.col(g)) for f, g in (("y", "x"), ("x", "y"), ("zz.n", "z.n"), ("z.n", "zz.n"))]
        return met.select(*(c.alias(name) for c, name in zip(ends, ("a", "b", "na", "nb")))).distinct()

    def alike(pairs: DataFrame) -> DataFrame:
        if not words:
            return pairs
        pairs = kept(pairs)
        ends = kept(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
        found = nodes.select("node", "bits").join(F.broadcast(ends) if ends.count() <= BROADCAST_BUCKETS else ends, "node", "left_semi")
        x, y = (found.select(F.col("node").alias(end), F.col("bits").alias(f"bits_{end}")) for end in ("a", "b"))
        return pairs.join(x, "a").join(y, "b").where(_bitmaps_allow("bits_a", "bits_b", "na + nb", percent, words)).select("a", "b", "na", "nb")

    slim = nodes.drop("bits")
    known = slim.select("node", F.struct("n", F.col("least" if "least" in nodes.columns else "n").alias("least"), F.col("n").alias("s")).alias("z"))
    degrees = buckets.groupBy("node").agg(F.count("*").alias("degree"))
    rows = settled(lambda: kept(buckets.join(degrees.join(known, "node"), "node")), "round")
    best = rows.groupBy("bucket").agg(F.max(F.struct("degree", F.col("node").alias("x"), F.col("z").alias("zz"))).alias("best"))
    hubs = best.select("bucket", "best.x", "best.zz")
    met = rows.withColumnRenamed("node", "y").join(hubs, "bucket")
    pairs = pairs_of(met.where(f"x <> y and {possible}").select("x", "y", F.col("zz").alias("z"), F.col("z").alias("zz")))
    edges = settled(lambda: _star_links(alike(pairs), verify), "edges")
    roots = settled(lambda: connected_components(edges), "roots")
    # the shingles of crowded buckets are counted only where the first round leaves components apart
    rows, tested = met.where("x <> y").select("bucket", F.col("y").alias("node")), 1
    parted = rows.join(roots, "node", "left").groupBy("bucket").agg(F.min(F.coalesce("component", "node")).alias("lo"), F.max(F.coalesce("component", "node")).alias("hi"))
    rows = kept(rows.join(parted.where("lo < hi").select("bucket"), "bucket"))
    rows = settled(lambda: _bounded_rows(rows, slim, shingles_of, percent, crowd), "round")
    while True:
        rows = rows.join(roots, "node", "left").select("bucket", "node", "z", F.coalesce("component", "node").alias("component"))
        parts = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        open_buckets = parts.groupBy("bucket").agg(F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.count("*").alias("parts")).where("parts > 1")
        rows = kept(rows.join(open_buckets.select("bucket", "size", "squares"), "bucket"))
        # every row carries its share of its bucket's pairs of different components
        left = rows.agg(F.count("*").alias("rows"), F.sum(F.expr("(double(size) * size - squares) / (2 * size)")).alias("pairs")).first()
        if not left["rows"]:
            return roots
        last = left["pairs"] <= PAIRS_PER_ROW * left["rows"]
        tested *= GROWTH
        chosen = rows.withColumn("hub", F.lit(True) if last else F.expr(f"pmod(xxhash64(node, {tested}), size) < {tested}"))
        allowed = possible
        # at most one bucket per band and node
        chosen = chosen.join(rows.groupBy("node").agg(F.collect_list("bucket").alias("buckets")), "node")
        if words:
            chosen = chosen.join(nodes.select("node", "bits"), "node").withColumn("z", F.struct("z.n", "z.least", "bits", "z.s")).drop("bits")
            allowed = f"{possible} and {_bitmaps_allow('z.bits', 'zz.bits', 'z.n + zz.n', percent, words)}"
        chosen = kept(chosen)
        first = chosen.where("hub").select(F.col("bucket").alias("at"), F.col("node").alias("x"), F.col("component").alias("cx"), "z", F.col("buckets").alias("of_x"))
        second = chosen.select("bucket", F.col("node").alias("y"), F.col("component").alias("cy"), "hub", F.col("z").alias("zz"), F.col("buckets").alias("of_y"))
        # two chosen nodes meet once
        met = first.join(second, F.expr(f"at = bucket and cx <> cy and (not hub or x < y) and {allowed} and at = array_min(array_intersect(of_x, of_y))"))
        star = roots.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        # stored first: else the pairs are verified once for each use of their edges
        edges = settled(lambda: _star_links(pairs_of(met), verify), "edges")  # noqa: B023 (called at once)
        roots = settled(lambda: connected_components(star.unionByName(edges)), "roots")  # noqa: B023
        if last:
            return roots
        rows = chosen.where("not hub").select("bucket", "node", F.struct("z.n", "z.least", "z.s").alias("z"))
