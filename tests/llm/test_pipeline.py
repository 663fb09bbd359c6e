"""The pipeline against brute force, stage by stage, and the registered queries."""

from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from pyspark.sql import functions as F
from courtline.llm.near_dedup import BANDS, ROWS
from courtline.llm.queries import ORACLE, QUERIES
from courtline.llm.storage import stored
from tests.llm.test_dedup import brute_lines, brute_near
from tests.llm.test_quality_mix import WORD, brute_quality
from tests.llm.test_tokens import ids_of

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    names = {n: [k for k in QUERIES if k.startswith(f"op{n}_")] for n in range(1, 14)}
    assert all(len(found) == 1 for found in names.values())
    assert set(ORACLE) <= set(QUERIES) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        kept.append(docs)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    assert all(d.columns == source.columns for d in kept[:-1])
    rows = {r.doc_id: r for r in source.collect()}
    order = list(rows.values())
    good = [r for r, found in zip(order, brute_quality([(r.doc_id, r.text, r.lang, r.source) for r in order], 100)) if found[-1]]
    assert sorted(r.doc_id for r in kept[0].collect()) == sorted(r.doc_id for r in good)
    left = [(i, text) for i, text, _, dropped in brute_lines([(r.doc_id, r.text) for r in good]) if not dropped or text]
    assert sorted((r.doc_id, r.text) for r in kept[1].collect()) == sorted(left)
    assert all(r.n_chars == len(r.text) for r in kept[1].collect())
    single = [(i, text) for (i, text), (_, _, root) in zip(left, brute_near(left, 5, 80)) if i == root]
    assert sorted((r.doc_id, r.text) for r in kept[2].collect()) == sorted(single)
    texts, mixed = dict(single), kept[3].collect()
    times = Counter(r.doc_id for r in mixed)
    assert set(times) <= set(texts) and max(times.values()) <= 2
    words = sum(len(WORD.findall(r.text)) for r in mixed)
    assert abs(words - 1.5 * sum(len(WORD.findall(t)) for t in texts.values())) <= 20
    assert all(texts[r.doc_id].startswith(r.text) for r in mixed)
    packed = kept[4].collect()
    assert sum(r.length for r in packed) == sum(len(ids_of(r.text)) + 1 for r in mixed)
    fills = Counter()
    for r in packed:
        fills[r.sequence_id] += r.length
    assert max(fills.values()) <= 4096 and len(fills) <= 1.05 * sum(fills.values()) / 4096 + 1


def test_run_gives_the_last_stage(spark):
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and result.count() > 0


CLASHES = ("size", "target", "source_size", "draws", "shard", "words", "kept", "n_words", "drops", "n_dropped", "_source", "line", "node", "_h")


def test_stages_of_odd_and_empty_documents(spark, odd, none):
    """Rows without words go, the long and the repeated text stay once, whatever further columns there are."""
    for docs, left in ((odd, 3), (none, 0)):
        docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit(f"given {c}") for c in CLASHES})
        names, counts = docs.columns, []
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), "test-odd")
            counts.append(docs.count())
            if len(counts) < len(corpus_pipeline.STAGES):
                assert docs.columns == names
                assert all(r[c] == f"given {c}" for r in docs.collect() for c in CLASHES)
        assert counts[0] <= left and (counts[-1] > 0) == (left > 0)


def test_near_dedup_stage_misses_few_pairs_at_its_threshold(spark, monkeypatch):
    given = {}
    monkeypatch.setattr(corpus_pipeline, "drop_near_duplicates", lambda docs, **parameters: given.update(parameters))
    corpus_pipeline.drop_copies(spark, None, SF)
    bands, rows = given.get("bands", BANDS), given.get("rows", ROWS)
    assert (1 - (given["percent"] / 100) ** rows) ** bands <= 1e-5
