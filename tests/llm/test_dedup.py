"""Exact, near and line dedup against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from courtline.llm.components import _bounded_rows, connected_components, linked_components
from courtline.llm.exact_dedup import build_hash, exact_dedup, slots
from courtline.llm.line_dedup import dedup_lines
from courtline.llm.near_dedup import drop_near_duplicates, near_duplicates, signature
from tests.llm.conftest import SCHEMA


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 180)] + [(300, 250), (250, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    union = Union({x for p in pairs for x in p})
    for a, b in pairs:
        union.join(a, b)
    assert got == {x: union.find(x) for x in union.up}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("near", [1, 30])
def test_rounds_lose_no_link(spark, near):
    """A hot bucket of 400 nodes, linked only if their numbers are close."""
    rows = [(7, n * 3 % 401) for n in range(1, 401)] + [(8, 1), (8, 2), (9, 5), (9, 300)]
    linked = lambda pairs: pairs.where(F.abs(F.col("a") - F.col("b")) <= near).select("a", "b")
    buckets = spark.createDataFrame(rows, "bucket long, node long")
    nodes = buckets.select("node", F.lit(1).cast("long").alias("n")).distinct()
    shared = lambda some: some.withColumn("shingle", F.lit(5).cast("long"))
    got = {r.node: r.component for r in linked_components(buckets, nodes, shared, linked, 80).collect()}
    assert all(got.get(n, n) == 1 for n in range(1, 401))


def test_minimal_perfect_hash():
    words = np.random.default_rng(5).integers(0, 1 << 63, size=(5000, 4), dtype=np.uint64)
    sizes, bits = build_hash(words)
    assert sorted(slots(words, sizes, bits)) == list(range(5000))
    assert len(build_hash(words[:0])[0]) == 0


def brute_exact(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for i, text in rows:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("cut", [-1, 3, 10**9])
def test_exact_dedup(spark, odd, small, cut):
    for docs in (odd.withColumn("keep_id", F.lit("clash")), small):
        old = F.coalesce(F.col("doc_id") <= cut, F.lit(False))
        got = exact_dedup(docs.where(~old), docs.where(old)).collect()
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert sorted(map(tuple, got), key=str) == brute_exact(rows)


def test_exact_dedup_of_nothing(none):
    assert exact_dedup(none, none).count() == 0


def brute_near(rows, width, percent):
    """component per row number; rows of equal sets are one, links by exact similarity."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset())
    union = Union(range(len(rows)))
    holders = defaultdict(set)
    for n, s in enumerate(sets):
        for x in s:
            holders[x].add(n)
    for n, s in enumerate(sets):
        for m in {m for x in s for m in holders[x] if m < n}:
            same = len(s & sets[m])
            if 100 * same >= percent * (len(s) + len(sets[m]) - same):
                union.join(n, m)
    least = {}
    for n, (i, _) in enumerate(rows):
        root = union.find(n)
        if i is not None:
            least[root] = min(least.get(root, i), i)
    return [(rows[n][0], len(sets[n]), rows[n][0] if not sets[n] else least.get(union.find(n))) for n in range(len(rows))]


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(small, odd, none, width, percent):
    for docs in (small, odd.withColumn("component_id", F.lit("clash"))):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = near_duplicates(docs, width=width, percent=percent).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(brute_near(rows, width, percent), key=str)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_duplicates(none).count() == 0


def test_near_duplicates_of_a_hot_group(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(n, " ".join(base[: k] + [f"x{n}"] + base[k + 1 :]), None, None) for n, k in enumerate([n % 60 for n in range(300)])]
    rows += [(1000 + n, f"other text number {n} that shares no words {n * 7}", None, None) for n in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = near_duplicates(docs, width=3, percent=85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_near([r[:2] for r in rows], 3, 85))
    kept = drop_near_duplicates(docs, width=3, percent=85)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, size=3000, dtype=np.uint64)
    b = np.concatenate((a[:2400], rng.integers(0, 1 << 63, size=600, dtype=np.uint64)))
    same = (signature(a, 512) == signature(b, 512)).mean()
    assert abs(same - 2400 / 3600) < 0.09


#: The five characters from each place on; a shorter line is one shingle.
SHINGLE = regex.compile(r"(?s)(?=(.{5}|\A.{1,4}\Z)).")


def brute_lines(rows):
    """Texts after line dedup, and the lines dropped."""
    places = defaultdict(list)
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            if line.strip(" \t\r"):
                places[line].append((i is None, i or 0, n))
    sets = {line: frozenset(SHINGLE.findall(line.lower())) for line in places}
    union, holders = Union(places), defaultdict(set)
    for line, s in sets.items():
        for x in s:
            holders[x].add(line)
    for line, s in sets.items():
        for other in {o for x in s for o in holders[x] if o < line}:
            same = len(s & sets[other])
            if 100 * same >= 80 * (len(s) + len(sets[other]) - same):
                union.join(line, other)
    keep = {}
    for line, found in places.items():
        root = union.find(line)
        keep[root] = min([*found, *([keep[root]] if root in keep else [])])
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        left = [x for n, x in enumerate(lines) if not x.strip(" \t\r") or keep[union.find(x)] == (i is None, i or 0, n)]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def test_line_dedup(small, odd, none):
    for docs in (small, odd.withColumn("n_lines", F.lit("clash"))):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = dedup_lines(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()
        assert sorted(map(tuple, got), key=str) == brute_lines(rows)
    assert dedup_lines(none).count() == 0


def test_line_dedup_of_fuzzy_and_repeated_lines(spark):
    line = "a long line of words that is repeated with a small change in document number "
    rows = [(n, f"first {n * 7919} alone {n}\n{line}{n}\n\n{line}{n}", None, None) for n in range(30)]
    rows += [(99, "".join(f"only line {k * 104729} of its kind\n" for k in range(2000)), None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = dedup_lines(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got), key=str) == brute_lines([r[:2] for r in rows])


def test_line_dedup_runs_no_python(spark, small):
    plan = dedup_lines(small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_only_rows_with_hope_get_their_bitmap(spark, monkeypatch):
    """Bitmaps are not stored with each bucket row before hopeless nodes have left."""
    stored_rows = []

    def spy(df):
        stored_rows.append(df.schema.simpleString())
        return df.localCheckpoint()

    monkeypatch.setattr("courtline.llm.components.kept", spy)
    buckets = spark.createDataFrame([(7, 1), (7, 2), (8, 3), (8, 4)], "bucket long, node long")
    nodes = spark.createDataFrame([(1, 10, [3]), (2, 10, [3]), (3, 10, [3]), (4, 2, [3])], "node long, n long, bits array<bigint>")
    rows = _bounded_rows(buckets, nodes, lambda some: spark.createDataFrame([], "node long, shingle long"), 80, 16)
    assert sorted((r.bucket, r.node, r.z.n, r.z.bits, r.z.s) for r in rows.collect()) == [(7, 1, 10, [3], 10), (7, 2, 10, [3], 10), (8, 3, 10, [3], 10), (8, 4, 2, [3], 2)]
    assert ["bits" in s for s in stored_rows] == [False, False, True]
