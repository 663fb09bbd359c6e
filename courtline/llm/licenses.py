"""Operator 12: license scans by ordered signature rules.

A text becomes its words, lower-cased and one space apart, in which the rules
of ``license_rules`` look for licenses.  An Aho-Corasick pass over the text
finds the rules' keywords, and only rules whose keyword occurs are matched.
Of their places, those of a smaller priority go first; a place that lies
within one kept before, or within a longer one of its own priority, is
suppressed.  Texts are scanned whole, each by itself, in Arrow batches; the
rules are built once per worker.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from itertools import accumulate

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_rules import RULES, Rule
from .worker import cache

#: Fixed values of the base scan: phrase -> label.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BATCH_ROWS = 200

_LOWER = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_PHRASES = [(re.compile(rf"(?<![^ ]){p}(?![^ ])"), label) for p, label in PHRASES.items()]

SCAN = "n_words bigint, base array<struct<word: bigint, label: string>>, found array<struct<first: bigint, last: bigint, label: string, kind: string, weight: double>>"


def normal(text: str | None) -> str:
    """The text's words, one space apart; every byte of a word is one character.

    A-Z are lower-cased; all other ASCII but digits and a-z parts words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    return b" ".join(words).decode("latin-1")


def gate(rules: list[Rule]) -> ahocorasick.Automaton:
    by_keyword = defaultdict(list)
    for number, rule in enumerate(rules):
        by_keyword[rule.keyword].append(number)
    automaton = ahocorasick.Automaton()
    for keyword, numbers in by_keyword.items():
        automaton.add_word(keyword, tuple(numbers))
    automaton.make_automaton()
    return automaton


def _covered(places: list[tuple[int, int, int]], kept: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of ``places`` (start, end, rule) that lie within none of ``kept``."""
    if not kept:
        return places
    kept = sorted(kept)
    starts, ends = [k[0] for k in kept], list(accumulate((k[1] for k in kept), max))
    return [p for p in places if not (at := bisect_right(starts, p[0])) or ends[at - 1] < p[1]]


def suppress(places: list[tuple[int, int, int]], rules: list[Rule] = RULES) -> list[tuple[int, int, int]]:
    """The places (start, end, rule) that stand: by priority, then the longer, then the earlier rule."""
    by_priority = defaultdict(list)
    for place in places:
        by_priority[rules[place[2]].priority].append(place)
    kept: list[tuple[int, int, int]] = []
    for priority in sorted(by_priority):
        reach, stand = -1, []
        for place in sorted(_covered(by_priority[priority], kept), key=lambda p: (p[0], -p[1], p[2])):
            if place[1] > reach:
                stand.append(place)
                reach = place[1]
        kept += stand
    return sorted(kept)


def places_of(words: str, automaton: ahocorasick.Automaton, rules: list[Rule] = RULES) -> list[tuple[int, int, int]]:
    """All matches (start, end, rule) of the rules whose keyword occurs."""
    open_rules = {number for _, numbers in automaton.iter(words) for number in numbers}
    return [(m.start(), m.end(), number) for number in open_rules for m in rules[number].pattern.finditer(words)]


def scan_text(text: str | None, automaton: ahocorasick.Automaton, rules: list[Rule] = RULES) -> tuple:
    """n_words, base places (word, label) and kept detections (first, last word, label, kind, weight)."""
    words = normal(text)
    n_words = words.count(" ") + 1 if words else 0
    base = [(m.start(), label) for pattern, label in _PHRASES for m in pattern.finditer(words)]
    found = suppress(places_of(words, automaton, rules), rules)
    if not base and not found:
        return n_words, [], []
    starts = [0, *(m.end() for m in re.finditer(" ", words))]
    word = lambda at: bisect_right(starts, at) - 1
    told = [(word(s), word(e - 1), rules[k].label, rules[k].kind, rules[k].weight) for s, e, k in found]
    return n_words, sorted((word(s), label) for s, label in base), told


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, base and found.

    base holds each place of the base phrases (its first word and label), found
    the detections that stand (first and last word, label, kind, weight), both in order.
    Null and empty texts have no words; texts are read whole, whatever
    their length; repeated rows are scanned each; equal places of two rules go to the earlier
    rule.  Columns named n_words, base or found are replaced, all others kept."""

    @F.pandas_udf(SCAN)
    def _scan(texts: pd.Series) -> pd.DataFrame:
        held = cache("licenses")
        if "gate" not in held:
            held["gate"] = gate(RULES)
        rows = [scan_text(t, held["gate"]) for t in texts]
        base = [[{"word": w, "label": x} for w, x in r[1]] for r in rows]
        found = [[dict(zip(("first", "last", "label", "kind", "weight"), x)) for x in r[2]] for r in rows]
        return pd.DataFrame({"n_words": [r[0] for r in rows], "base": base, "found": found})

    rest = [c for c in docs.columns if c not in ("n_words", "base", "found")]
    scanned = docs.select(*rest).withColumn("_scan", _scan(F.col(text_col)))
    return scanned.select(*rest, "_scan.n_words", "_scan.base", "_scan.found")


def summary(scanned: DataFrame) -> DataFrame:
    """``scanned`` with n_base, first_word, last_word, base_labels, labels and score.

    The score is the chance that one of the detected licenses holds, 1 less the
    product of the (1 - weight) of the labels, of each its best weight; without any it is 0."""
    base = F.transform("base", lambda x: x["label"])
    told = F.transform("found", lambda x: x["label"])
    words = F.transform("base", lambda x: x["word"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = lambda label: F.array_max(F.transform(F.filter("found", lambda x: x["label"] == label), lambda x: x["weight"]))
    doubt = F.aggregate(F.array_sort(F.array_distinct(told)), F.lit(1.0), lambda a, label: a * (F.lit(1.0) - best(label)))
    return scanned.withColumns({
        "n_base": F.size("base").cast("long"), "first_word": F.array_min(words), "last_word": F.array_max(words),
        "base_labels": joined(base), "labels": joined(F.concat(base, told)), "score": F.lit(1.0) - doubt,
    })
