"""Operator 4: fuzzy line dedup by MinHash, with DataFrame functions only.

A line's shingles are the WIDTH characters from each place of its lower-case
form on, so that every character lies in one; a shorter line is one shingle.
They are cut out of the line's UTF-32 bytes, where a place is found without
counting through the line.  Distinct lines are dealt out once; one pass
explodes their shingle hashes, deals them to CELLS cells by their leading bits
and keeps the least and the largest of each.  The cells are a grid of 6 by 7,
whose lines in four slopes are 28 bands of 6 cells: two bands of a value share
at most one cell.  In a simulation they found 99.8 % of the pairs of similarity 0.8.
Lines of few shingles, which leave cells empty, have 25 minima under different
masks, and the 30 lines of the affine plane of order 5 as bands.  The Jaccard
similarity of the full shingle sets confirms the links, after bitmaps of the
cells have ruled out unlike pairs exactly, and union-find makes components, of which the first line
stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.session import scoped_conf

from .components import kept, linked_components, shared_buckets
from .storage import LITTLE_DISK, freed, settled, stored

WIDTH = 5
ORDER = 5  # a prime
COORDINATES = ORDER * ORDER
PERCENT = 80
CHUNK = 1 << 16  # shingles of a line that are exploded at a time
LONG_LINE = 200_000  # characters from which on a line's set is never held as one array
SEED = 71
NO_ID = (1 << 63) - 1  # stands for a null id, which comes last
BROADCAST_LINES = 500_000  # affected lines (some 60 bytes each) that may be broadcast
CROWD = 256  # nodes of a bucket from which on their shingles are counted; below, bitmaps rule out pairs for less
FINE_PAIRS = 2  # pairs for each of their lines beyond which wider bitmaps, made once per line, precede the sets
FINE_WORDS = 64  # a power of two
PAIRS_PER_TASK = 2000
#: Groups that an aggregation's first table holds, so that those of a task need no second one.
LARGE_TABLE = {"spark.sql.codegen.aggregate.fastHashMap.capacityBit": "19"}
BAND_PARTS = 4  # in which the bands' buckets are shuffled, one after the other
GRID, SLOPED = 6, 7  # columns and rows of the cells' grid; SLOPED is a prime
CELLS = GRID * SLOPED
BIT_WORDS = CELLS // 2  # a cell has 32 bits of a line's bitmap
SLOPES = {"lo": (0, 1), "hi": (2, 3)}  # the slopes of the bands of the cells' least and of their largest hashes
LEAST_CELLS = 4  # that a band of GRID cells needs
LONG, SHORT = 40, 80  # places from which on a line has cells, and up to which it has minima
FEW_CELLS = 35  # up to which the cells of a line of more places tell that it may have fewer than 1.25 * LONG shingles


def plane() -> list[list[int]]:
    """The 30 lines of the affine plane of order 5; point (x, y) is 5 * x + y."""
    sloped = [[ORDER * x + (m * x + b) % ORDER for x in range(ORDER)] for m in range(ORDER) for b in range(ORDER)]
    return sloped + [[ORDER * c + y for y in range(ORDER)] for c in range(ORDER)]


def _masks() -> list[int]:
    """XOR masks for 32-bit hashes with different leading bits: each coordinate looks at its own part of the hashes."""
    return [(k << 27) | (0x9E3779B1 * (k + 1) & (1 << 27) - 1) for k in range(COORDINATES)]


def _codes(line: str) -> Column:
    return F.encode(F.lower(line), "UTF-32")


def shingle_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """The further columns of ``lines`` with h, a row for each place of a shingle, and whether it is the line's first."""
    further = [c for c in lines.columns if c != line]
    coded = lines.select(*further, _codes(line).alias("codes"))
    last = f"greatest(octet_length(codes) div 4 - {WIDTH}, 0)"
    parts = coded.select(*further, "codes", F.explode(F.expr(f"sequence(0, int({last}), {CHUNK})")).alias("at"))
    # a chunk's bytes end with those that its last shingle needs
    parts = parts.select(*further, "at", F.expr(f"substring(codes, 4 * at + 1, {4 * (CHUNK + WIDTH - 1)})").alias("codes"))
    places = parts.select(*further, "at", "codes", F.explode(F.expr(f"sequence(0, int({last}))")).alias("k"))
    return places.select(*further, F.expr(f"xxhash64(substring(codes, 4 * k + 1, {4 * WIDTH}))").alias("h"), F.expr("at + k = 0").alias("begins"))


def shingle_set(line: str) -> Column:
    """The distinct shingle hashes of a line as an array."""
    # bound to a name, so that the line is encoded once and not once per shingle
    return F.array_distinct(
        F.transform(
            F.array(_codes(line)),
            lambda c: F.transform(
                F.sequence(F.lit(1), F.greatest(F.octet_length(c) - (4 * WIDTH - 1), F.lit(1)), F.lit(4)),
                lambda k: F.xxhash64(F.substring(c, k, F.lit(4 * WIDTH))),
            ),
        )[0]
    )


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id (null as the largest), text_hash, line_no (from 0), line and its two
    64-bit hashes; lines of spaces, tabs and carriage returns only are left out."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id")
    slim = docs.select(key, F.xxhash64(text_col).alias("text_hash"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    rows = slim.where(F.length(F.btrim("line", F.lit(" \t\r"))) > 0)
    return rows.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(SEED), "line")})


def minima_bands(line: str) -> Column:
    """The bands of COORDINATES minima of a line's set, for lines of few shingles."""
    masks = ", ".join(f"{m}L" for m in _masks())
    # arrays are bound to names, so that they are worked out once
    minima = F.transform(
        F.array(F.transform(shingle_set(line), lambda h: F.shiftrightunsigned(h, 32))),
        lambda hs: F.transform(F.expr(f"array({masks})"), lambda m: F.array_min(F.transform(hs, lambda h: h.bitwiseXOR(m)))),
    )
    return F.transform(minima, lambda m: F.array(*[F.xxhash64(F.lit(b), *(m[p] for p in points)) for b, points in enumerate(plane())]))[0]


def cell_rows(lines: DataFrame, *further: Column) -> DataFrame:
    """h1, h2, cell, the least and the largest shingle hash of the line's cell and its bitmap; ``further`` aggregates besides."""
    cell = F.shiftrightunsigned(F.shiftrightunsigned("h", 32) * CELLS, 32).cast("int")
    return shingle_rows(lines).withColumn("cell", cell).groupBy("h1", "h2", "cell").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.bit_or(F.expr("1L << int(h & 31)")).alias("seen"), *further)


def cell_bands(cells: DataFrame, *further: Column) -> DataFrame:
    """h1, h2, n_cells, bits (the bitmap) and cell_bands of the lines of ``cells``; ``further`` aggregates besides.

    The cells are a grid of GRID columns of SLOPED.  The lines of a slope are bands; a band's key is a sum of hashes of its
    cells' values, whose last three bits count them.  Bands of fewer than LEAST_CELLS cells are left out."""
    # 57 bits of a hash and a count of 1: six of them fit into a long
    term = lambda v: (F.shiftleft(F.shiftrightunsigned(F.xxhash64("cell", v), 7), 3)).bitwiseOR(F.lit(1))
    at = {m: F.expr(f"pmod(cell % {SLOPED} - {m} * (cell div {SLOPED}), {SLOPED})").alias(f"b{m}") for slopes in SLOPES.values() for m in slopes}
    terms = cells.withColumns({f"t_{v}": term(v) for v in SLOPES} | {f"b{m}": c for m, c in at.items()})
    sums = [F.expr(f"sum(if(b{m} = {b}, t_{v}, 0L))").alias(f"k{m}_{b}") for v, slopes in SLOPES.items() for m in slopes for b in range(SLOPED)]
    words = F.array(*[F.bit_or(F.expr(f"if(cell div 2 = {w}, shiftleft(seen, 32 * (cell % 2)), 0L)")) for w in range(BIT_WORDS)])
    summed = terms.groupBy("h1", "h2").agg(F.count("*").alias("n_cells"), words.alias("bits"), *sums, *further)
    keys = [(m, b) for slopes in SLOPES.values() for m in slopes for b in range(SLOPED)]
    bands = ", ".join(f"if((k{m}_{b} & 7) >= {LEAST_CELLS}, xxhash64({100 + m * SLOPED + b}, k{m}_{b}), null)" for m, b in keys)
    return summed.withColumn("cell_bands", F.expr(f"array_compact(array({bands}))")).drop(*(f"k{m}_{b}" for m, b in keys))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """h1, h2, first (the smallest id), n (occurrences), places, bits and bands of the distinct lines.

    Lines of LONG places or more have the bands of their cells, lines of few shingles those of their minima.
    A set of fewer than LONG shingles is like sets of at most 1.25 times that only: if their lines have more than SHORT
    places, they fill few cells.  So two lines that are alike always have bands of the same kind."""
    rows = lines_of(docs, id_col, text_col).where(F.length("line") <= LONG_LINE)
    lines = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"), F.any_value("line").alias("line"))
    lines = lines.withColumn("places", F.greatest(F.length("line") - (WIDTH - 1), F.lit(1)).cast("long"))
    # all of it stays in the task that the lines were dealt to
    # n and first are named so that both sides of the join need the same columns and the lines are dealt out once
    celled = cell_bands(cell_rows(lines.where("places > 0 and n > 0 and first is not null").select("h1", "h2", "line")))
    met = lines.join(celled, ["h1", "h2"])
    few = (F.col("places") <= SHORT) | (F.col("n_cells") <= FEW_CELLS)
    minima = F.when(few, minima_bands("line")).otherwise(F.expr("array()"))
    none = F.expr("cast(array() as array<bigint>)")
    columns = ["h1", "h2", "first", "n", "places"]
    signed = met.select(*columns, "bits", F.concat(F.when(F.col("places") >= LONG, F.col("cell_bands")).otherwise(none), minima).alias("bands"))
    # very long lines are not shuffled; equal ones meet as cells
    huge = lines_of(docs.where(F.octet_length(text_col) > LONG_LINE), id_col, text_col).where(F.length("line") > LONG_LINE)
    high = F.shiftrightunsigned("h", 32)
    told = [F.min("doc_id").alias("first"), F.count_if("begins").alias("n"), F.count("*").alias("places")]
    cells = cell_rows(huge.select("h1", "h2", "doc_id", "line"), *told, *[F.min(high.bitwiseXOR(F.lit(m))).alias(f"m{k}") for k, m in enumerate(_masks())])
    joined = [F.min("first").alias("first"), F.sum("n").alias("n"), F.sum("places").alias("places"), *[F.min(f"m{k}").alias(f"m{k}") for k in range(COORDINATES)]]
    whole = cell_bands(cells, *joined).withColumn("places", F.expr("places div n"))
    minima = F.array(*[F.xxhash64(F.lit(b), *(F.col(f"m{p}") for p in points)) for b, points in enumerate(plane())])
    return signed.unionByName(whole.select(*columns, "bits", F.concat("cell_bands", F.when(F.col("n_cells") <= FEW_CELLS, minima).otherwise(none)).alias("bands")))


def line_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """w1, w2 (the hashes), root, keep_doc for the lines that have copies, exact or
    fuzzy; keep_doc is the first document that holds a line of the component."""
    # numbered as they are written: later jobs may split the files otherwise
    signed = stored(signatures(docs, id_col, text_col).withColumn("node", F.monotonically_increasing_id()), "line-signatures")
    classes = stored(signed.drop("bands"), "line-classes")
    banded = signed.select("node", F.explode("bands").alias("bucket"))
    buckets = settled(lambda: shared_buckets([banded.where(f"pmod(bucket, {BAND_PARTS}) = {k}") for k in range(BAND_PARTS)]), "line-buckets")
    freed(signed)

    rows = lines_of(docs, id_col, text_col)

    def texts_of(nodes: DataFrame) -> DataFrame:
        """node, line, long; only the lines that are asked for are ever shuffled."""
        wanted = kept(classes.select("node", F.col("h1").alias("w1"), F.col("h2").alias("w2"), "first").join(nodes, "node", "left_semi"))
        small = wanted.count() <= BROADCAST_LINES
        same_line = (F.col("h1") == F.col("w1")) & (F.col("h2") == F.col("w2"))
        found = rows.join(F.broadcast(wanted) if small else wanted, same_line & (F.col("doc_id") == F.col("first")))
        return kept(found.dropDuplicates(["node"]).select("node", "line", (F.length("line") > LONG_LINE).alias("long")))

    def shingles_of(nodes: DataFrame) -> DataFrame:
        lines = texts_of(nodes)
        short = lines.where("not long").select("node", F.explode(shingle_set("line")).alias("shingle"))
        return short.unionByName(shingle_rows(lines.where("long").select("node", "line")).select("node", F.col("h").alias("shingle")).distinct())

    def finely_alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """``pairs`` less those that wider bitmaps and the sets' exact sizes rule out; long lines have none and stay."""
        short = texts.where("not long").select("node", "line")
        places = shingle_rows(short).select("node", F.expr(f"int((h >> 6) & {FINE_WORDS - 1})").alias("word"), F.expr("1L << int(h & 63)").alias("bit"))
        fine = places.groupBy("node").agg(F.array(*[F.bit_or(F.expr(f"if(word = {w}, bit, 0L)")) for w in range(FINE_WORDS)]).alias("fine"))
        fine = kept(fine.join(short.select("node", F.size(shingle_set("line")).alias("n")), "node"))
        x, y = (fine.select(F.col("node").alias(end), F.col("fine").alias(f"f{end}"), F.col("n").alias(f"n{end}")) for end in ("a", "b"))
        differ = F.aggregate(F.zip_with("fa", "fb", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, k: s + k)
        allowed = F.coalesce((100 + PERCENT) * differ <= (100 - PERCENT) * (F.col("na") + F.col("nb")), F.lit(True))
        return pairs.join(x, "a", "left").join(y, "b", "left").where(allowed).select("a", "b")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = kept(pairs.select("a", "b"))
        ends = kept(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
        texts, made = texts_of(ends), pairs.count()
        if made > FINE_PAIRS * ends.count():
            pairs = kept(finely_alike(pairs, texts))
            made = pairs.count()
        # small rows, each of much work: else they would come as one task
        pairs = pairs.repartition(made // PAIRS_PER_TASK + 1, "a", "b")
        # long lines are not shuffled at all
        used = texts.select("node", F.when(~F.col("long"), F.col("line")).alias("line"))
        both = pairs.join(used.select(F.col("node").alias("a"), F.col("line").alias("x")), "a").join(used.select(F.col("node").alias("b"), F.col("line").alias("y")), "b")
        # 100 * same >= PERCENT * (na + nb - same), with both sets worked out once
        alike = F.transform(
            F.array(F.struct(shingle_set("x").alias("x"), shingle_set("y").alias("y"))),
            lambda s: (100 + PERCENT) * F.size(F.array_intersect(s["x"], s["y"])) >= PERCENT * (F.size(s["x"]) + F.size(s["y"])),
        )[0]
        linked = both.where("x is not null and y is not null").where(alike).select("a", "b")
        if not texts.where("long").take(1):
            return linked
        apart = kept(both.where("x is null or y is null").select("a", "b"))
        sets = kept(shingles_of(apart.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
        sizes = sets.groupBy("node").agg(F.count("*").alias("n"))
        left = apart.join(sets.select(F.col("node").alias("a"), "shingle"), "a")
        shared = left.join(sets.select(F.col("node").alias("b"), "shingle"), ["b", "shingle"]).groupBy("a", "b").agg(F.count("*").alias("same"))
        sized = shared.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
        return linked.unionByName(sized.where(f"{100 + PERCENT} * same >= {PERCENT} * (na + nb)").select("a", "b"))

    # a line's set has at most a shingle for each place, at least one for each bit
    least = F.aggregate("bits", F.lit(0).cast("long"), lambda n, word: n + F.bit_count(word))
    sizes = classes.select("node", F.col("places").alias("n"), least.alias("least"), "bits")
    roots = linked_components(buckets, sizes, shingles_of, verify, PERCENT, crowd=CROWD, words=BIT_WORDS)
    rooted = classes.select("node", "h1", "h2", "first", "n").join(F.broadcast(roots) if roots.count() <= BROADCAST_LINES else roots, "node", "left")
    repeated = rooted.where("n > 1 or component is not null").withColumn("root", F.coalesce("component", "node"))
    least = repeated.groupBy("root").agg(F.min("first").alias("keep_doc"))
    return repeated.join(least, "root").select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), "root", "keep_doc")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (null as the largest), text_hash, drops (line numbers) of the documents that lose lines."""
    known = settled(lambda: line_components(docs, id_col, text_col), "line-components")
    small = known.count() <= BROADCAST_LINES
    rows = lines_of(docs, id_col, text_col).select("doc_id", "text_hash", "line_no", "h1", "h2")
    met = rows.join(F.broadcast(known) if small else known, (F.col("h1") == F.col("w1")) & (F.col("h2") == F.col("w2")))
    met = stored(met.select("doc_id", "text_hash", "line_no", "root", "keep_doc"), "line-occurrences")
    first = met.where("doc_id = keep_doc").groupBy(F.col("root").alias("of")).agg(F.min("line_no").alias("keep_line"))
    lost = met.join(first, F.col("root") == F.col("of")).where("doc_id <> keep_doc or line_no <> keep_line")
    return lost.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("drops"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their texts less the repeated lines, n_lines and n_dropped.

    Of the lines of a component (similarity 0.8 or more, over links) the first
    stays, by document id (null last) and line number; rows that repeat an id
    stand at the same place, so their lines stay or go alike.  Lines of
    spaces, tabs and carriage returns only stay.  Null and empty texts are kept as they are, with
    0 and 1 lines; a text whose lines all go becomes empty.  Columns named
    n_lines or n_dropped are replaced, all others kept."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    with scoped_conf(docs.sparkSession, LITTLE_DISK | LARGE_TABLE):
        drops = settled(lambda: dropped_lines(docs, id_col, text_col), "line-drops")
    drops = drops.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_text_hash"})
    rows = docs.select(*names, F.xxhash64(text_col).alias("_hash"))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    joined = rows.join(drops, (key == F.col("_doc_id")) & (F.col("_hash") == F.col("_text_hash")), "left")
    n_dropped = F.coalesce(F.size("drops"), F.lit(0))
    n_lines = F.coalesce(F.size(F.split(F.col(text_col), "\n")), F.lit(0))
    joined = joined.withColumns({"n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(n_lines).cast("long"), "n_dropped": F.when(F.col("drops").isNull(), 0).otherwise(n_dropped).cast("long")})
    # the inner array is bound to a name, so that the text is split once and not once per line
    left = F.expr(
        f"transform(array(split(`{text_col}`, '\\n')), ls -> array_join(transform(array_except(sequence(0, int(n_lines) - 1), drops), i -> ls[i]), '\\n'))[0]"
    )
    return joined.withColumn(text_col, F.when(F.col("n_dropped") > 0, left).otherwise(F.col(text_col))).select(*names, "n_lines", "n_dropped")
