"""Operator 6: near-duplicate documents by circulant MinHash.

A text is the set of its word shingles, as 64-bit hashes.  Texts of equal sets
are one class.  C-MinHash draws all signature coordinates from two
permutations: sigma spreads the shingles over 2**UNIVERSE_BITS places, and
coordinate k is the minimum of pi, circularly shifted by k, over these places.
Since a place's coordinates lie next to each other in pi, a signature is a
gather of runs and a column minimum.  Bands of coordinates give candidate
pairs; bitmaps of 64 * BIT_WORDS places, in which each shingle sets a bit, rule
out unlike ones exactly; the Jaccard similarity of the full sets confirms the
links; union-find makes components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.session import scoped_conf

from .components import kept, linked_components, shared_buckets
from .storage import LITTLE_DISK, freed, settled, small_batches, stored
from .worker import cache

BANDS, ROWS = 20, 5  # a pair of similarity 0.85 shares a band but for 1 in 100,000
UNIVERSE_BITS = 22
BIT_WORDS = 16  # a power of two
SEED = 29
CACHE_WORDS = 100_000
BROADCAST_GONE = 500_000  # dropped rows (16 bytes each) that may be broadcast
BROADCAST_WANTED = 500_000  # rows of a candidate (some 40 bytes each) that may be broadcast
RUN = 8192  # shingles whose runs are held at a time
BAND_PARTS = 2  # in which the bands' buckets are shuffled, one after the other

_pi: dict[int, np.ndarray] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles, A-Z in lower case.

    Fewer words are one shingle; no word, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = cache("near_dedup")
    if len(hashes) > CACHE_WORDS:
        hashes.clear()
    for word in set(words).difference(hashes):
        hashes[word] = xxhash.xxh3_64_intdigest(word)
    at = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(width, len(at))
    n = len(at) - span + 1
    total = np.full(n, span, dtype=np.uint64)
    for k in range(span):
        total = _mix(total + at[k : k + n])
    return np.unique(total)


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    if size not in _pi:
        pi = np.random.default_rng(SEED).permutation(1 << UNIVERSE_BITS).astype(np.uint32)
        _pi[size] = np.lib.stride_tricks.sliding_window_view(np.concatenate((pi, pi[:size])), size)
    places = ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)
    best = _pi[size][places[:RUN]].min(axis=0)
    for at in range(RUN, len(places), RUN):
        np.minimum(best, _pi[size][places[at : at + RUN]].min(axis=0), out=best)
    return best


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature(hashes, bands * rows).astype(np.uint64).reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = _mix(key + parts[:, k])
    return key.view(np.int64)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """BIT_WORDS longs in which each hash sets one bit."""
    words = np.zeros(BIT_WORDS, dtype=np.uint64)
    at = (hashes >> np.uint64(6)) & np.uint64(BIT_WORDS - 1)
    np.bitwise_or.at(words, at.astype(np.int64), np.uint64(1) << (hashes & np.uint64(63)))
    return words.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending arrays of distinct hashes have the Jaccard similarity."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    same = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * same >= percent * (len(a) + len(b) - same)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, text_hash, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their
    shingle sets; component_id is the smallest id of the component and kept
    marks that document.  Null and empty texts have no shingles, are linked
    with nothing and stay.  Rows that repeat an id and a text stay or go
    together.  A null id is never the smallest; if a component has no other,
    component_id is null and its rows stay.  An empty table gives an empty
    result; further columns are not read."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    @F.pandas_udf("n_shingles bigint, digest binary, bands array<bigint>")
    def describe(texts: pd.Series) -> pd.DataFrame:
        found = []
        for text in texts:
            hashes = shingles(text, width)
            digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
            found.append((len(hashes), digest, band_keys(hashes, bands, rows) if len(hashes) else []))
        return pd.DataFrame(found, columns=["n_shingles", "digest", "bands"])

    @F.pandas_udf("digest binary, hashes array<bigint>, bits array<bigint>")
    def full_set(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t, width) for t in texts]
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        return pd.DataFrame({"digest": digests, "hashes": [np.sort(s.view(np.int64)) for s in sets], "bits": [bitmap(s) for s in sets]})

    def components() -> DataFrame:
        classes = described.where("n_shingles > 0").groupBy("digest").agg(F.min("id").alias("first_id"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"))
        # numbered as they are written: later jobs may split the files otherwise
        signed = stored(classes.withColumn("node", F.monotonically_increasing_id()), "near-signatures")
        classes = stored(signed.drop("bands", "n"), "near-classes")
        part = lambda k: F.filter("bands", lambda _, at: at % BAND_PARTS == k)
        # a set's bands differ, so rows are distinct
        buckets = settled(lambda: shared_buckets([signed.select("node", F.explode(part(k)).alias("bucket")) for k in range(BAND_PARTS)]), "near-buckets")
        freed(signed)
        wanted = buckets.select("node").distinct().join(classes.select("node", F.col("digest").alias("_digest"), "first_id"), "node")
        wanted = stored(wanted, "near-wanted")
        small = wanted.count() <= BROADCAST_WANTED
        texts = slim.join(F.broadcast(wanted) if small else wanted, F.col("id").eqNullSafe(F.col("first_id")))
        # written first: else the sets of all documents are made below the join
        texts = stored(texts.select("node", "_digest", "text"), "near-texts")
        sets = texts.withColumn("s", full_set("text")).where("s.digest = _digest").select("node", "s.hashes", "s.bits")
        sets = stored(sets.dropDuplicates(["node"]), "near-sets")
        freed(texts)

        def shingles_of(nodes: DataFrame) -> DataFrame:
            return sets.join(nodes, "node", "left_semi").select("node", F.explode("hashes").alias("shingle"))

        def verify(pairs: DataFrame) -> DataFrame:
            def test(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for frame in frames:
                    yield frame.loc[[similar(x, y, percent) for x, y in zip(frame["x"], frame["y"])], ["a", "b"]]

            pairs = kept(pairs)
            met = kept(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
            few = met.count() <= BROADCAST_WANTED
            # only the sets of the pairs' nodes are shuffled
            used = sets.drop("bits").join(F.broadcast(met) if few else met, "node", "left_semi")
            both = pairs.join(used.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(used.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
            return both.select("a", "b", "x", "y").mapInPandas(test, "a bigint, b bigint")

        sizes = sets.select("node", F.size("hashes").cast("long").alias("n"), "bits")
        roots = linked_components(buckets, sizes, shingles_of, verify, percent, words=BIT_WORDS)
        rooted = classes.select("node", "digest", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("component", "node"))
        least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
        return rooted.select("digest", "root").join(least, "root").select("digest", "component_id")

    with small_batches(docs.sparkSession), scoped_conf(docs.sparkSession, LITTLE_DISK):
        described = stored(slim.withColumn("d", describe("text")).select("id", F.xxhash64("text").alias("text_hash"), "d.*"), "near-described")
        known = settled(components, "near-components")
    result = described.select("id", "text_hash", "n_shingles", "digest").join(known, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return result.select(F.col("id").alias(id_col), "text_hash", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """``docs`` less the rows that ``near_duplicates`` does not keep, all columns as they are."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **parameters)
    gone = stored(found.where("not kept").select(F.col(id_col).alias("_gone_id"), F.col("text_hash").alias("_gone_hash")).distinct(), "near-gone")
    small = gone.count() <= BROADCAST_GONE
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_gone_id")) & (F.xxhash64(text_col) == F.col("_gone_hash"))
    return docs.join(F.broadcast(gone) if small else gone, same, "left_anti")
