"""Operator 9: quality rules with adaptive thresholds.

Four ratios of every text go into quantile sketches by language and source.
A sketch is a histogram over buckets that keep the seven leading bits of an
integer (relative error under 1/64, a few hundred buckets); sketches merge
by adding counts, so they are combined before the shuffle and rolled up from
(lang, source) to lang and to the whole corpus.  A group's cutoffs are its
quartile fences plus a slack; groups of fewer than MIN_DOCS documents use the
next wider group.  The cutoffs are then joined to the documents.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.session import checkpoint_root

from .worker import cache

WINDOW = 5
MIN_DOCS = 100
BROADCAST_GROUPS = 50_000  # cutoff rows (of at most some 200 bytes) that may be broadcast
#: name -> (integer ratio, slack below the lower fence or null, slack above the upper fence)
RULES = {
    "word_length": ("100 * word_chars div n_words", 250, 250),
    "symbols": ("1000 * n_symbols div n_words", None, 100),
    "dup_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", None, 600),
    "repeats": ("1000 * n_repeat_words div n_words", None, 200),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[str]) -> int:
    """Words that lie in a WINDOW-word window found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    at = np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], dtype=np.uint64)
    at *= _MIX  # a bijection of the word numbers, spread by two more such steps
    at ^= at >> np.uint64(32)
    at *= np.uint64(0xD6E8FEB86659FD93)
    at ^= at >> np.uint64(29)
    windows = at[:n].copy()
    for k in range(1, WINDOW):
        windows = windows * np.uint64(0xBF58476D1CE4E5B9) + at[k : k + n]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(windows, twice))
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[starts] += 1
    np.subtract.at(edges, starts + WINDOW, 1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one whole text."""
    words = _WORD.findall(text or "")
    if not words:
        return (0, 0, sum((text or "").count(s) for s in _SYMBOLS), 0, 0, 0)
    seen: set[str] = set()
    lines = again = 0
    for line in text.split("\n"):
        if _WORD.search(line):
            lines += 1
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(text.count(s) for s in _SYMBOLS), lines, again, repeated_words(words))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the COUNTS and base_failed."""

    @F.pandas_udf(", ".join(f"{c} bigint" for c in COUNTS))
    def _counts(texts: pd.Series) -> pd.DataFrame:
        cache("quality")  # holds nothing; frees what other operators have left
        return pd.DataFrame([counts_of(t) for t in texts], columns=list(COUNTS), dtype="int64")

    measured = docs.withColumn("_counts", _counts(F.col(text_col)))
    measured = measured.withColumns({c: F.col(f"_counts.{c}") for c in COUNTS}).drop("_counts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def _bucket(value: str) -> str:
    """The seven leading bits of a non-negative integer, the others zero."""
    shift = f"greatest(length(bin({value})) - 7, 0)"
    return f"shiftleft(shiftright({value}, {shift}), {shift})"


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, rule, bucket, n over the rows that did not fail the base rules."""
    rules = F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), F.expr(f"bigint({r[0]})").alias("v")) for k, r in RULES.items())))
    rows = measured.where(~F.col("base_failed")).select("lang", "source", rules.alias("x"))
    finest = rows.groupBy("lang", "source", F.col("x.rule").alias("rule"), F.expr(_bucket("x.v")).alias("bucket")).agg(F.count("*").alias("n"))
    return finest


def cutoffs(measured: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source (one row per pair) and the lower and upper bound of each rule."""
    checkpoint_root(measured.sparkSession)
    finest = sketches(measured).checkpoint()  # a few hundred buckets per group: the texts are read once
    wider = finest.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("n"))
    widest = wider.groupBy("rule", "bucket").agg(F.sum("n").alias("n"))

    def fences(sketch: DataFrame, keys: list[str], level: str) -> DataFrame:
        by = ", ".join([*keys, "rule"])
        run = sketch.withColumn("up", F.expr(f"sum(n) over (partition by {by} order by bucket)")).withColumn("total", F.expr(f"sum(n) over (partition by {by})"))
        q = run.groupBy(*keys, "rule").agg(
            F.max("total").alias("total"), F.expr("min(bucket) filter (where 4 * up >= total)").alias("q1"), F.expr("min(bucket) filter (where 4 * up >= 3 * total)").alias("q3"))
        bounds = []
        for rule, (_, below, above) in RULES.items():
            if below is not None:
                bounds.append(F.expr(f"max(q1 - 3 * (q3 - q1) - {below}) filter (where rule = '{rule}')").alias(f"{rule}_lo_{level}"))
            bounds.append(F.expr(f"max(q3 + 3 * (q3 - q1) + {above}) filter (where rule = '{rule}')").alias(f"{rule}_hi_{level}"))
        return q.groupBy(*keys).agg(F.max("total").alias(f"total_{level}"), *bounds)

    pair = fences(finest, ["lang", "source"], "pair")
    lang = fences(wider, ["lang"], "lang").withColumnRenamed("lang", "l_lang")
    whole = fences(widest, [], "all").first().asDict()  # one row
    joined = pair.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
    joined = joined.withColumns({name: F.lit(value).cast("long") for name, value in whole.items()})
    chosen = ["lang", "source"]
    for bound in [x for r, (_, lo, _hi) in RULES.items() for x in ([f"{r}_lo"] if lo is not None else []) + [f"{r}_hi"]]:
        chosen.append(F.expr(f"case when total_pair >= {min_docs} then {bound}_pair when total_lang >= {min_docs} then {bound}_lang when total_all >= {min_docs} then {bound}_all end").alias(bound))
    return joined.select(*chosen)


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the COUNTS, base_failed and kept.

    A row is kept if it passes the base rules and every ratio lies within its
    group's cutoffs; without a group of ``min_docs`` documents there are none
    and the base rules decide.  A null language or source is a group of its
    own; null and empty texts count no words and fail; repeated rows are
    judged each.  Columns of ``docs`` with the names of the counts, of
    base_failed or kept are replaced, all others are kept."""
    keep = [c for c in docs.columns if c not in (*COUNTS, "base_failed", "kept")]
    measured = measure(docs.select(*keep), text_col)
    bounds = cutoffs(measured.withColumns({"lang": F.col(lang_col), "source": F.col(source_col)}), min_docs)
    names = [c for c in bounds.columns if c not in ("lang", "source")]
    bounds = bounds.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *(F.col(c).alias(f"_{c}") for c in names)).checkpoint()
    if bounds.count() <= BROADCAST_GROUPS:
        bounds = F.broadcast(bounds)
    same = F.col(lang_col).eqNullSafe(F.col("_lang")) & F.col(source_col).eqNullSafe(F.col("_source"))
    joined = measured.join(bounds, same, "left")
    within = " and ".join(
        f"coalesce({ratio} {'>=' if way == 'lo' else '<='} _{rule}_{way}, true)"
        for rule, (ratio, lo, _) in RULES.items() for way in (("lo", "hi") if lo is not None else ("hi",))
    )
    kept = joined.withColumn("kept", F.expr(f"case when base_failed then false else {within} end"))
    return kept.select(*keep, *COUNTS, "base_failed", "kept")
