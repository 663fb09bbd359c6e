"""Operator 1: exact token counts by a map-side two-tier lookup.

Tier one is a broadcast table (word -> number of tokens) of the corpus's
frequent words.  Tier two is a bounded cache in each Python worker, filled by
encoding the words that the table lacks.  No word is ever shuffled: the
frequent words come from bounded heavy-hitter summaries, one row per input
partition, that are merged in a tree of fixed fan-in.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import CACHED_CHARS, chunks, length_cache, split_words, tokenizer

#: Words in the broadcast table; with at most CACHED_CHARS characters each it stays under 20 MiB.
TABLE_WORDS = 1 << 16
SUMMARY_WORDS = 1 << 16  # words a summary counts at a time
FAN_IN = 16
SUMMARY_SCHEMA = "part int, words array<string>, counts array<bigint>"


def _shrink(counts: Counter, size: int) -> Counter:
    """Keep the ``size`` most frequent words (ties by word)."""
    if len(counts) <= size:
        return counts
    return Counter(dict(heapq.nsmallest(size, counts.items(), key=lambda x: (-x[1], x[0]))))


def _row(part: int, counts: Counter) -> pd.DataFrame:
    return pd.DataFrame({"part": [part], "words": [list(counts)], "counts": [list(counts.values())]})


def frequent_words(docs: DataFrame, text_col: str = "text", size: int = TABLE_WORDS) -> dict[str, int]:
    """About the ``size`` most frequent words of all texts, with their counts.

    A task counts whole texts and keeps its SUMMARY_WORDS most frequent words
    whenever it holds four times as many; only the summaries travel."""
    text = docs.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    parts = max(1, text.rdd.getNumPartitions())

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        counts: Counter = Counter()
        for frame in frames:
            for value in frame["text"]:
                for chunk in chunks(value):
                    counts.update(split_words(chunk))
                if len(counts) > 4 * SUMMARY_WORDS:
                    counts = _shrink(counts, SUMMARY_WORDS)
        short = Counter({w: n for w, n in counts.items() if len(w) <= CACHED_CHARS and n > 1})
        yield _row(TaskContext.get().partitionId(), _shrink(short, size))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        counts: Counter = Counter()
        for words, numbers in zip(frame["words"], frame["counts"]):
            counts.update(dict(zip(words, map(int, numbers))))
        return _row(int(frame["part"].min()) // FAN_IN, _shrink(counts, size))

    summaries = text.mapInPandas(summarise, SUMMARY_SCHEMA)
    while parts > 1:
        summaries = summaries.groupBy(F.expr(f"part div {FAN_IN}")).applyInPandas(merge, SUMMARY_SCHEMA)
        parts = -(-parts // FAN_IN)
    found = summaries.collect()  # one row of at most ``size`` words
    return dict(zip(found[0]["words"], found[0]["counts"])) if found else {}


def token_counts(docs: DataFrame, path: str, text_col: str = "text", limit: int = 2048, table_words: int = TABLE_WORDS) -> DataFrame:
    """``docs`` with n_bytes, n_tokens (long) and over_limit (boolean).

    ``path`` is a tokenizer file whose ids do not depend on white space (see
    ``words``).  Null and empty texts have 0 bytes and 0 tokens; texts of any
    length count in full; repeated rows are counted each; an empty table gives
    an empty result.  Columns of ``docs`` named like the three are replaced,
    all others are kept."""
    spark = docs.sparkSession
    common = list(frequent_words(docs, text_col, table_words))
    lengths = [len(x.ids) for x in tokenizer(path).encode_batch(common, add_special_tokens=False)]
    table = spark.sparkContext.broadcast(dict(zip(common, lengths)))
    version = uuid.uuid4().hex  # a worker may serve several jobs

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = length_cache(path, table.value, version)
        for texts in batches:
            yield pd.Series([0 if t is None else sum(map(sum, cache.values_of(t))) for t in texts], dtype="int64")

    text = F.col(text_col)
    counted = docs.withColumn("n_tokens", count(text)).withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
