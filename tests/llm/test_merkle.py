"""The Merkle manifest against trees built by hand and against SQL."""

import hashlib
import zlib

import duckdb
from pyspark.sql import functions as F

from courtline.llm.merkle import FAN, LEVELS, leaves_of, manifest, numbered, rollup
from courtline.llm.oracles import ORACLE
from courtline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    told = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)]
    return sha("".join(told))


def tree(level):
    """The root and, of every node, the siblings left and right on its way up."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, p in enumerate(at):
            run = level[p // 3 * 3 : p // 3 * 3 + 3]
            paths[k].append(("".join(run[: p % 3]), "".join(run[p % 3 + 1 :])))
            at[k] = p // 3
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    found, by = [], {}
    for row in rows:
        by.setdefault(row.source, []).append(row)
    if not by:
        return []
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for of_source in by.values():
        of_source.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = {s: tree([leaf(r, r.text) for r in by[s]]) for s in order}
    root, tops = tree([trees[s][0] for s in order])
    for s, top in zip(order, tops):
        for row, low in zip(by[s], trees[s][1]):
            text = row.text
            if text and row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(row, text)
            for left, right in low + top:
                folded = sha(left + folded + right)
            proof = sha("".join(a + b for a, b in low + top))
            found.append((row.doc_id, leaf(row, row.text), trees[s][0], root, proof, folded, folded == root))
    return sorted(found, key=str)


def check(docs):
    rows = manifest(docs).select(*COLUMNS).collect()
    assert sorted(map(tuple, rows), key=str) == brute(docs.collect())
    return rows


def test_query_against_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op13_merkle_manifest"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(ORACLE["op13_merkle_manifest"])
    assert got.columns == [d[0] for d in want.description]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str) == brute(spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert 0 < sum(r[-1] for r in rows) < len(rows)


def test_a_hot_source_takes_several_tiers(spark):
    n = FAN ** (2 * LEVELS) + 5
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("line\n"), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 50 == 0, F.concat(F.lit("s"), F.col("id"))).otherwise("hot").alias("source"), F.lit(6).cast("long").alias("n_chars"),
    )
    nodes = numbered(leaves_of(docs), "source", ["doc_id", "leaf"], "t").select("source", "no", "total", F.col("leaf").alias("h"), F.struct("doc_id").alias("row"))
    tiers = rollup(nodes, "source", "t")
    assert len(tiers) == 2 and tiers[-1].count() == -(-n // 50) + 1
    check(docs)


def test_every_shape_of_tree(spark):
    sizes = [1, 2, 3, 4, 9, 10, 28, 81, 82]
    check(spark.createDataFrame([(100 * n + i, f"text\n{i}", "en", f"s{n}", i) for n in sizes for i in range(n)], SCHEMA))
    check(spark.createDataFrame([(i, f"text\n{i}", "en", "s", i) for i in range(10)], SCHEMA))


def test_odd_rows(spark, odd, none):
    docs = odd.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit("clash") for c in ("leaf", "path", "no", "total", "block", "kids")})
    rows = check(docs)
    assert len(rows) == docs.count()
    alone = spark.createDataFrame([(None, None, None, None, None)], SCHEMA)
    row = check(alone)[0]
    assert row.leaf == row.subroot == row.root == sha("-----") and row.proof_sha256 == sha("") and row.verified
    assert manifest(none.withColumn("n_chars", F.lit(1).cast("long"))).count() == 0


def test_tampering_is_found(spark):
    rows = manifest(spark.createDataFrame([(i, "a\nb" if i % 3 else "ab", "en", f"s{i % 4}", 3) for i in range(60)], SCHEMA)).collect()
    hit = {i for i in range(60) if i % 3 and zlib.crc32(str(i).encode()) % 2 == 0}
    assert {r.doc_id for r in rows if not r.verified} == hit
    assert len({r.root for r in rows}) == 1 and len({r.subroot for r in rows}) == 4


def test_no_join_reads_the_proofs_off(spark, small):
    """The proofs' plan has unions and groupings, no join and no Python."""
    plan = manifest(small)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Generate" in plan
