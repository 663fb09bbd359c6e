"""Operator 10: toxicity by FTRL-proximal logistic regression.

A text is the set of its hashed word unigrams, bigrams and skip-bigrams (one
or two words left out).  The classifier learns from about MAX_ROWS labelled
rows at most, chosen by a hash of their ids; they are dealt into shards of
about SHARD_ROWS, every shard runs FTRL-proximal (per-coordinate rates, L1)
over its rows, and the shards' sparse weights are averaged.  The weights hold
at most 2**BITS pairs, so they may be collected and broadcast at any corpus
size.  Every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .worker import cache

BITS = 20
MAX_ROWS = 32_768  # labelled rows that teach
SHARD_ROWS = 8192
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.0
#: Odd multipliers for the words of an n-gram, by its kind.
KINDS = ((0x9E3779B97F4A7C15, 0, 0), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 1), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 2), (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 3))
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def _word_hashes(text: str) -> np.ndarray:
    words = _WORD.findall(text.lower())
    hashes = cache("toxicity")
    if len(hashes) > CACHE_WORDS:
        hashes.clear()
    for word in set(words).difference(hashes):
        hashes[word] = xxhash.xxh3_64_intdigest(word)
    return np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def features(text: str | None) -> np.ndarray:
    """The distinct feature numbers of a text, ascending (uint32)."""
    words = _word_hashes(text or "")
    found = []
    for first, second, gap in KINDS:
        grams = words * np.uint64(first)
        if gap:
            grams = grams[:-gap] + words[gap:] * np.uint64(second) if len(words) > gap else grams[:0]
        grams ^= grams >> np.uint64(29)
        found.append(((grams * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.uint32))
    return np.unique(np.concatenate(found))


def train(rows: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over the rows in the given order; the nonzero weights.

    Feature 2**BITS is the intercept."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = np.array([1 << BITS], dtype=np.uint32)
    rows = [np.concatenate((row, bias)) for row in rows]

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, label in zip(rows, labels):
            w = weights(at)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            ni = n[at]
            z[at] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
    used = np.flatnonzero(np.abs(z) > L1)
    return used, weights(used)


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "label", key_col: str = "key") -> dict[str, np.ndarray]:
    """Averaged weights of the shards, as arrays ``at`` and ``weight``.

    ``key_col`` only orders and deals the rows.  Rows with a null label are
    left out; with no rows left the weights are empty and every score is 0.5."""

    @F.pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).astype(np.int32) for t in texts])

    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.xxhash64(F.col(key_col).cast("string")).alias("h"), F.col(label_col).cast("int").alias("y"), F.col(text_col).alias("t"))
    shards = max(1, -(-rows.count() // SHARD_ROWS))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "y"], kind="stable")
        at, weight = train([np.asarray(x, dtype=np.uint32) for x in frame["x"]], list(frame["y"]))
        return pd.DataFrame({"at": at, "weight": weight})

    dealt = rows.select(F.pmod("h", F.lit(shards)).alias("shard"), "h", "y", hashed("t").alias("x"))
    sparse = dealt.groupBy("shard").applyInPandas(one, "at int, weight double")
    mean = sparse.groupBy("at").agg((F.sum("weight") / shards).alias("weight")).where(F.abs("weight") > 1e-3)
    got = mean.orderBy("at").toPandas()  # at most 2**BITS + 1 rows
    return {"at": got["at"].to_numpy(dtype=np.int64), "weight": got["weight"].to_numpy(dtype=np.float32)}


def score(docs: DataFrame, weights: dict[str, np.ndarray], text_col: str = "text", cut: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``cut`` on).

    Whole texts are scored; null counts as empty, which gets the intercept's
    score.  Columns of the same names are replaced; all others are kept."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros((1 << BITS) + 1, dtype=np.float32)
        dense[model.value["at"]] = model.value["weight"]
        for texts in batches:
            sums = np.array([dense[features(t)].sum(dtype=np.float64) for t in texts]) + float(dense[-1])
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35))))

    scored = docs.withColumn("score", toxic(F.col(text_col)))
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def held_out(doc_id) -> F.Column:
    """Rows that never teach: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def teaching_rows(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The labels (doc_id, label) that teach: all of them up to ``max_rows``, else
    a share of about that size, by a hash of the id."""
    taught = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    total = taught.count()
    if total <= max_rows:
        return taught
    return taught.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(max_rows / total * (1 << 30)))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    ``labels`` (doc_id, toxic) teaches from rows that are not held out, about
    ``max_rows`` at most.  A null doc_id is never labelled and not held out;
    repeated labels of a document count each, null ones not at all.  Empty
    documents give an empty result; without labels every score is 0.5."""
    known = docs.select("doc_id", "text")
    taught = teaching_rows(labels.select("doc_id", F.col("toxic").alias("label")), max_rows)
    weights = fit(known.join(F.broadcast(taught), "doc_id").withColumnRenamed("doc_id", "key"))
    return score(known.withColumn("held_out", held_out(F.col("doc_id"))), weights).select("doc_id", "held_out", "score", "predicted")
