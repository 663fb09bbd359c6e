"""Quality rules and source mixing against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtline.llm.mixing import mix, plan, shard_quotas, targets
from courtline.llm.quality import RULES, quality_rules
from tests.llm.conftest import SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(covered))


def bucket(v):
    shift = max(v.bit_length() - 7, 0)
    return v >> shift << shift


def brute_quality(rows, min_docs):
    counted = [(lang, source, brute_counts(text)) for _, text, lang, source in rows]
    ratios = lambda c: {
        "word_length": 100 * c[1] // c[0], "symbols": 1000 * c[2] // c[0], "dup_lines": 1000 * c[4] // max(c[3], 1), "repeats": 1000 * c[5] // c[0]}
    failed = [c[0] < 10 or 100 * c[5] > 20 * c[0] for _, _, c in counted]
    groups = defaultdict(lambda: defaultdict(list))
    for (lang, source, c), bad in zip(counted, failed):
        if not bad:
            for rule, v in ratios(c).items():
                for key in ((lang, source), (lang,), ()):
                    groups[key][rule].append(bucket(v))

    def bounds(key, rule):
        values = sorted(groups[key][rule])
        q1, q3 = values[-(-len(values) // 4) - 1], values[-(-3 * len(values) // 4) - 1]
        _, below, above = RULES[rule]
        return (q1 - 3 * (q3 - q1) - below if below is not None else None), q3 + 3 * (q3 - q1) + above

    out = []
    for (lang, source, c), bad in zip(counted, failed):
        kept = not bad
        key = next((k for k in ((lang, source), (lang,), ()) if len(groups[k]["symbols"]) >= min_docs), None)
        if kept and key is not None:
            for rule, v in ratios(c).items():
                low, high = bounds(key, rule)
                kept &= (low is None or v >= low) and v <= high
        out.append((*c, bad, kept))
    return out


@pytest.mark.parametrize("min_docs", [3, 40, 10_000])
def test_quality_rules(small, odd, none, min_docs):
    for docs in (small, odd.withColumn("kept", F.lit("clash"))):
        rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
        got = quality_rules(docs, min_docs=min_docs).collect()
        wanted = [(*row[:1], *row[2:], *found) for row, found in zip(rows, brute_quality(rows, min_docs))]
        mine = [(r.doc_id, r.lang, r.source, r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got]
        assert sorted(mine, key=str) == sorted(wanted, key=str)
    assert quality_rules(none).count() == 0


def test_junk_goes_and_clean_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules(docs).join(labels, "doc_id").where("not base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.02 * counts[(1, True)]
    assert counts.get((0, True), 0) <= 0.1 * counts[(0, False)]


def test_targets_reshare_the_excess():
    assert targets([100, 100, 100], [5, 2, 1], 1.5, 2.0) == [200.0, 2 / 3 * 250, 250 / 3]
    assert targets([], [], 1.5, 2.0) == [] and targets([0], [5], 1.5, 2.0) == [0.0]
    got = targets([10, 1000, 50], [5, 2, 1], 1.5, 2.0)
    assert got[0] == 20 and got[2] == 100 and abs(sum(got) - 1590) < 1e-6


def test_quotas_split_every_draw_once():
    counts = [50, 7, 0, 300]
    parts = [shard_quotas(s, 9, counts, 4) for s in range(9)]
    assert np.sum(parts, axis=0).tolist() == counts
    assert {int(p.sum()) for p in parts} <= {39, 40}


def sizes(docs):
    return [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()]


def test_mix_meets_targets(small):
    known = sizes(small)
    per_source = Counter()
    for _, source, n in known:
        per_source[source] += n
    names = sorted(per_source)
    goal = dict(zip(names, targets([per_source[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))], 1.5, 2.0)))
    rows = plan(small).collect()
    taken = Counter()
    for r in rows:
        n = sum(d.words for d in r.draws)
        assert n <= 2 * r["size"] and r.target == pytest.approx(goal[r.source]) and r.source_size == per_source[r.source]
        taken[r.source] += n
    assert all(abs(taken[s] - goal[s]) <= 1 for s in names)
    assert sorted((r.doc_id, r["size"]) for r in rows) == sorted((i, n) for i, _, n in known)
    again = {r.doc_id: r.draws for r in plan(small.repartition(3)).collect()}
    assert again == {r.doc_id: r.draws for r in rows}
    mixed = mix(small).collect()
    assert sum(r.words for r in mixed) == sum(taken.values())
    whole = {r.doc_id: r.text for r in small.collect()}
    for r in mixed:
        assert len(WORD.findall(r.text or "")) == r.words and (whole[r.doc_id] or "").startswith(r.text or "")


def test_mix_of_odd_rows(spark, odd, none):
    rows = plan(odd.withColumn("size", F.lit("clash"))).collect()
    assert len(rows) == odd.count()
    known = {r.source: r.source_size for r in rows}
    wanted = Counter()
    for _, source, n in sizes(odd):
        wanted[source] += n
    assert known == wanted
    assert mix(odd).count() > 0 and plan(none).count() == 0 and mix(none).count() == 0
    one = spark.createDataFrame([(1, "a b c", "en", "s")], SCHEMA)
    assert [sum(d.words for d in r.draws) for r in plan(one).collect()] == [4]  # 4.5 words, rounded to even
