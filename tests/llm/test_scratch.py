"""Tables that the deduplications need on the way do not stay on disk."""

import os
import random

import pytest
from pyspark.sql import functions as F

from courtline.llm import components, line_dedup
from courtline.llm.components import linked_components, shared_buckets
from courtline.llm.line_dedup import dedup_lines
from courtline.llm.near_dedup import near_duplicates
from courtline.llm.storage import freed, settled, stored
from courtline.session import scratch_root
from tests.llm.conftest import SCHEMA


def tables(spark):
    root = scratch_root(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


@pytest.fixture
def copies(spark):
    line = "a long line of words that is repeated with a small change in document number "
    return spark.createDataFrame([(n, f"alone {n * 7919}\n{line}{n}", None, None) for n in range(30)], SCHEMA)


def test_settled_keeps_its_result_only(spark):
    before = tables(spark)

    def make():
        first = stored(spark.range(5), "first")
        inner = settled(lambda: stored(first, "second").where("id > 1"), "inner")
        assert {t.split("-")[0] for t in tables(spark) - before} == {"first", "inner"}
        freed(first)
        assert {t.split("-")[0] for t in tables(spark) - before} == {"inner"}
        return stored(inner, "third")

    assert sorted(r.id for r in settled(make, "result").collect()) == [2, 3, 4]
    assert {t.split("-")[0] for t in tables(spark) - before} == {"third"}


def test_line_dedup_leaves_its_drops_only(spark, copies):
    before = tables(spark)
    assert dedup_lines(copies).where("n_dropped > 0").count() == 29
    assert sorted(t.rpartition("-")[0] for t in tables(spark) - before) == ["line-drops"]


def test_near_duplicates_leave_two_tables(spark, copies):
    before = tables(spark)
    assert near_duplicates(copies, width=3, percent=60).where("kept").count() == 1
    assert sorted(t.rpartition("-")[0] for t in tables(spark) - before) == ["near-components", "near-described"]


def test_buckets_are_shared_within_parts(spark):
    parts = [spark.createDataFrame(rows, "bucket long, node long") for rows in ([(1 << 40, 1), (1 << 40, 2), (2, 3), (3, 4)], [(-5, 1), (-5, 3), (-5, 4), (-6 << 30, 2)])]
    got = sorted(map(tuple, shared_buckets(parts).select("bucket", "node").collect()))
    assert got == [(-5, 1), (-5, 3), (-5, 4), (1 << 40, 1), (1 << 40, 2)]


def test_bitmaps_stay_out_of_settled_buckets(spark, monkeypatch):
    """Rows of buckets that are one component after the first round are never stored with a bitmap."""
    held = []

    def spy(df):
        held.append((df.schema.simpleString(), df.count()))
        return df.localCheckpoint()

    monkeypatch.setattr(components, "kept", spy)
    buckets = spark.createDataFrame([(b, n) for b in range(8) for n in (1, 2, 3)] + [(9, 4), (9, 5)], "bucket long, node long")
    nodes = spark.createDataFrame([(n, 10, [7]) for n in (1, 2, 3)] + [(4, 10, [1023]), (5, 10, [1023 << 20])], "node long, n long, bits array<bigint>")
    none = spark.createDataFrame([], "node long, shingle long")
    got = linked_components(buckets, nodes, lambda some: none, lambda pairs: pairs.select("a", "b"), 80, words=1).collect()
    assert {r.node: r.component for r in got} == {1: 1, 2: 1, 3: 1}
    assert sum(rows for schema, rows in held if "bits" in schema) <= 2


def test_edges_of_a_round_are_verified_once(spark):
    """The pairs of the later rounds are not verified again for each use of their links."""
    verified = spark.sparkContext.accumulator(0)

    def verify(pairs):
        def close(frames):
            for frame in frames:
                verified.add(len(frame))
                yield frame.loc[(frame["a"] - frame["b"]).abs() <= 1, ["a", "b"]]

        return pairs.mapInPandas(close, "a bigint, b bigint")

    buckets = spark.createDataFrame([(7, n) for n in range(6)], "bucket long, node long")
    nodes = buckets.select("node", F.lit(1).cast("long").alias("n"))
    shared = lambda some: some.withColumn("shingle", F.lit(5).cast("long"))
    got = linked_components(buckets, nodes, shared, verify, 80).collect()
    assert {r.component for r in got} == {0} and verified.value <= 15


def test_near_copies_that_meet_many_hubs_are_verified_in_two_steps(spark):
    """Twenty buckets of the same thirty nodes, each with a hub of its own: one pair per node settles them."""
    verified = spark.sparkContext.accumulator(0)

    def verify(pairs):
        def all_linked(frames):
            for frame in frames:
                verified.add(len(frame))
                yield frame[["a", "b"]]

        return pairs.mapInPandas(all_linked, "a bigint, b bigint")

    buckets = spark.createDataFrame([(b, n) for b in range(20) for n in (*range(30), 100 + b)], "bucket long, node long")
    nodes = buckets.select("node").distinct().withColumn("n", F.lit(1).cast("long"))
    shared = lambda some: some.withColumn("shingle", F.lit(5).cast("long"))
    got = linked_components(buckets, nodes, shared, verify, 80).collect()
    assert len(got) == 50 and {r.component for r in got} == {0} and verified.value <= 50


def test_no_link_is_lost_among_shared_buckets(spark, monkeypatch):
    """Rounds of two nodes, in which nodes share several buckets, against brute force."""
    monkeypatch.setattr(components, "GROWTH", 2)
    monkeypatch.setattr(components, "PAIRS_PER_ROW", 0)
    monkeypatch.setattr(components, "MANY_PAIRS", 1)
    rng = random.Random(5)
    held = {b: rng.sample(range(40), 14) for b in range(8)}
    root = list(range(40))
    for a in range(39):
        if any(a in h and a + 1 in h for h in held.values()):
            root = [root[a] if r == root[a + 1] else r for r in root]
    buckets = spark.createDataFrame([(b, n) for b, h in held.items() for n in h], "bucket long, node long")
    nodes = spark.createDataFrame([(n, 10) for n in range(40)], "node long, n long")
    shared = lambda some: some.withColumn("shingle", F.lit(5).cast("long"))
    got = linked_components(buckets, nodes, shared, lambda pairs: pairs.where("b - a = 1").select("a", "b"), 80).collect()
    assert {r.node: r.component for r in got if r.node != r.component} == {n: r for n, r in enumerate(root) if n != r}


def test_texts_are_fetched_for_possible_links_only(spark, monkeypatch):
    """Lines that share a bucket but differ too much are ruled out before their text is read again."""
    fetched = []

    def spied(make):
        def spy(df, *name):
            if "line" in df.columns:
                fetched.append(df.count())
            return make(df, *name)

        return spy

    for name in ("stored", "kept"):
        monkeypatch.setattr(line_dedup, name, spied(getattr(line_dedup, name)))
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    lines = [start + letters(20) for start in (letters(40) for _ in range(20)) for _ in range(3)]
    copies = ["a line with a near copy of many words here", "a line with a near copy of many words here."]
    docs = spark.createDataFrame([(k, x, None, None) for k, x in enumerate(lines + copies)], SCHEMA)
    assert [r.doc_id for r in dedup_lines(docs).where("n_dropped > 0").collect()] == [61]
    assert sum(fetched) <= 4


def test_shingles_are_counted_in_open_buckets_only(spark):
    """Crowded buckets that one round of pairs makes one component need no shingles."""
    counted = []

    def shingles_of(some):
        counted.append(some.count())
        return some.withColumn("shingle", F.lit(5).cast("long"))

    buckets = spark.createDataFrame([(b, 40 * b + n) for b in range(3) for n in range(40)], "bucket long, node long")
    nodes = buckets.select("node", F.lit(1).cast("long").alias("n"))
    got = linked_components(buckets, nodes, shingles_of, lambda pairs: pairs.where("a >= 40").select("a", "b"), 80, crowd=16).collect()
    assert {r.node: r.component for r in got} == {n: n // 40 * 40 for n in range(40, 120)}
    assert counted == [39]  # of the open bucket, less its hub
