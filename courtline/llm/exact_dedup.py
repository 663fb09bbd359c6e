"""Operator 5: exact dedup against a minimal perfect hash of earlier digests.

The index of the documents seen so far is a table of buckets (a bucket is a
range of digest prefixes of about BUCKET_DIGESTS digests).  Each bucket holds
a minimal perfect hash over its distinct digests and, per slot, the full
digest, the winner's doc_id and the number of rows.  New documents are first
grouped by digest; a group's digest is looked up in its bucket's slot and
compared byte by byte.  Members join the slot's group, others stay groups of
their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored

BUCKET_DIGESTS = 20_000
GAMMA = 1.5  # bits per remaining digest in a level
LEVELS = 40
INDEX_SCHEMA = "bucket bigint, sizes array<bigint>, bits binary, digests binary, winners array<bigint>, rows array<bigint>"


def _words(digests: np.ndarray) -> np.ndarray:
    """32-byte digests as rows of four unsigned 64-bit words."""
    return np.frombuffer(digests.tobytes(), dtype="<u8").reshape(-1, 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    mixed = words[:, 1] ^ (words[:, 2] * seed)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(size)).astype(np.int64)


def build_hash(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and bits of a minimal perfect hash over distinct digests.

    In each level the digests alone on their place set its bit; the others
    go on.  A digest's slot is the number of set bits before its own."""
    sizes, bits, left = [], [], words
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, int(GAMMA * len(left)))
        at = _place(left, level, size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    if len(left):
        raise ValueError("digests are not distinct")
    return sizes, np.concatenate(bits) if bits else np.zeros(0, dtype=bool)


def slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 where no level claims it."""
    rank = np.cumsum(bits) - 1
    slot = np.full(len(words), -1, dtype=np.int64)
    open_rows, start = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = start + _place(words[open_rows], level, size)
        hit = bits[at]
        slot[open_rows[hit]] = rank[at[hit]]
        open_rows, start = open_rows[~hit], start + size
    return slot


def digest_groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """digest (32 bytes), winner (the largest id), rows; combined before the shuffle."""
    return (
        docs.select(F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"), F.col(id_col).cast("long").alias("id"))
        .groupBy("digest").agg(F.max("id").alias("winner"), F.count("*").alias("rows"))
    )


def _bucket(digest: str, buckets: int):
    return F.expr(f"pmod(bigint(conv(hex(substring({digest}, 1, 6)), 16, 10)), {buckets}L)")


def build_index(groups: DataFrame) -> tuple[DataFrame, int]:
    """The index table of digest groups (stored) and its number of buckets."""
    buckets = max(1, -(-groups.count() // BUCKET_DIGESTS))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        raw = np.array([np.frombuffer(d, dtype=np.uint8) for d in frame["digest"]])
        words = _words(raw)
        sizes, bits = build_hash(words)
        slot = slots(words, sizes, bits)
        order = np.argsort(slot)
        winners = [None if pd.isna(w) else int(w) for w in frame["winner"].iloc[order]]
        return pd.DataFrame({
            "bucket": [int(frame["bucket"].iloc[0])], "sizes": [sizes], "bits": [np.packbits(bits).tobytes()],
            "digests": [raw[order].tobytes()], "winners": [winners], "rows": [frame["rows"].iloc[order].tolist()],
        })

    dealt = groups.withColumn("bucket", _bucket("digest", buckets))
    return stored(dealt.groupBy("bucket").applyInPandas(build, INDEX_SCHEMA), "dedup-index"), buckets


def look_up(groups: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """``groups`` with old_winner and old_rows from the index, null for nonmembers."""
    schema = "digest binary, winner bigint, rows bigint, old_winner bigint, old_rows bigint"

    def probe(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        new = new[["digest", "winner", "rows"]].copy()
        new["old_winner"] = pd.Series([None] * len(new), dtype="Int64")
        new["old_rows"] = pd.Series([None] * len(new), dtype="Int64")
        if len(new) and len(old):
            shard = old.iloc[0]
            sizes = [int(x) for x in shard["sizes"]]
            bits = np.unpackbits(np.frombuffer(shard["bits"], dtype=np.uint8), count=sum(sizes)).astype(bool)
            held = np.frombuffer(shard["digests"], dtype=np.uint8).reshape(-1, 32)
            raw = np.array([np.frombuffer(d, dtype=np.uint8) for d in new["digest"]])
            slot = slots(_words(raw), sizes, bits)
            member = (slot >= 0) & (held[slot] == raw).all(axis=1)
            at = np.flatnonzero(member)
            winners, rows = list(shard["winners"]), list(shard["rows"])
            new.iloc[at, 3] = pd.array([None if winners[s] is None or pd.isna(winners[s]) else int(winners[s]) for s in slot[at]], dtype="Int64")
            new.iloc[at, 4] = pd.array([int(rows[s]) for s in slot[at]], dtype="Int64")
        new["winner"] = new["winner"].astype("Int64")
        return new

    dealt = groups.withColumn("bucket", _bucket("digest", buckets))
    return dealt.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(probe, schema)


def exact_dedup(batch: DataFrame, history: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``batch`` and ``history``: the id, keep_id, group_size, kept, text_sha256.

    Of the rows with one text, over both tables, those with the largest id
    stay (ties and repeated rows with that id all stay, as they cannot be told
    apart).  A null text counts as empty; a null id never wins unless all of
    the group's are null, then keep_id is null and all stay.  Empty tables are
    allowed.  Further columns are not read."""
    past = stored(digest_groups(history, id_col, text_col), "dedup-history")
    index, buckets = build_index(past)
    found = look_up(digest_groups(batch, id_col, text_col), index, buckets)
    # groups of the batch, members with their history's winner; then the history's groups the batch lacks
    met = stored(found, "dedup-met")
    groups = met.select("digest", F.greatest("winner", "old_winner").alias("keep_id"), (F.col("rows") + F.coalesce("old_rows", F.lit(0))).alias("group_size"))
    earlier = past.join(met.where(F.col("old_rows").isNotNull()).select("digest"), "digest", "left_anti")
    every = stored(groups.unionByName(earlier.select("digest", F.col("winner").alias("keep_id"), F.col("rows").alias("group_size"))), "dedup-groups")
    slim = [d.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest")) for d in (batch, history)]
    rows = slim[0].unionByName(slim[1]).join(every, "digest")
    return rows.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
