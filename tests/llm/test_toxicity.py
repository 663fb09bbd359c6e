"""Toxicity: held-out accuracy and odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from courtline.llm.toxicity import features, teaching_rows, toxicity, train


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    hits = sum(r.predicted and r.toxic for r in held)
    assert hits >= 0.95 * sum(r.predicted for r in held)
    assert hits >= 0.6 * sum(r.toxic for r in held)
    ranked = sorted(held, key=lambda r: r.score)
    places = [k for k, r in enumerate(ranked) if r.toxic]
    n = len(places)
    assert (sum(places) - n * (n - 1) / 2) / (n * (len(ranked) - n)) > 0.95


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"text number {i} idiot" if i % 2 else f"text number {i}") for i in range(60)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(toxicity(docs, labels).collect()) == sorted(toxicity(docs, flipped).collect())


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (6, None, None), (None, 1, 1), (77, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity(odd.withColumn("score", F.lit("clash")), labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity(odd, labels.where("false")).collect()} == {0.5}
    assert toxicity(none, labels).count() == 0


def test_teaching_sample_is_bounded(spark):
    labels = spark.range(0, 30_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("label"))
    assert 1500 < teaching_rows(labels, 2000).count() < 2500
    assert teaching_rows(labels, 10**6).count() == labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1).count()


def test_training_finds_the_word():
    texts = [(f"a b c{k} {'scum' if k % 3 == 0 else 'fine'} d", int(k % 3 == 0)) for k in range(300)]
    at, weight = train([features(t) for t, _ in texts], [y for _, y in texts])
    dense = np.zeros((1 << 20) + 1)
    dense[at] = weight
    score = lambda t: dense[features(t)].sum() + dense[-1]
    assert score("you scum there") > 0 > score("you fine there")
    assert len(features("")) == 0 and len(features(None)) == 0
