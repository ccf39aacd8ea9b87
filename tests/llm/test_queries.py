"""The registered queries and the pipeline over the smallest test tables."""

import os
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from shopscope.llm import toxicity
from shopscope.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_registered():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")]
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        files = f"{folder}/{t}.parquet" + ("/*.parquet" if os.path.isdir(f"{folder}/{t}.parquet") else "")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{files}'")
    found = QUERIES[name](spark, folder)
    columns = ", ".join(sorted(found.columns))
    theirs = sorted(con.execute(f"SELECT {columns} FROM ({ORACLE_SQL[name]})").fetchall(), key=str)
    assert sorted((tuple(r) for r in found.select(*sorted(found.columns)).collect()), key=str) == theirs


def test_shapes(spark, folder):
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name in ("op1_wavelet_tokens", "op3_maxent_scores", "op5_piece_counts", "op8_entropy_mix", "op9_hyperminhash", "op13_bitmap_manifest"):
        assert QUERIES[name](spark, folder).count() == n


def test_toxicity_query(spark, folder):
    rows = QUERIES["op4_subword_toxicity"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_pipeline_stages_act(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("kept", F.lit(1)).withColumn("score", F.lit("x")).cache()
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder).cache()
        assert after.columns == columns, name
        assert after.select("doc_id").distinct().join(docs.select("doc_id").distinct(), "doc_id", "left_anti").isEmpty(), name
        assert 0 < after.count() and (name == "source_mixing" or after.count() <= before), name
        docs, before = after, after.count()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert out.count() == before


def test_pipeline_filters_match_brute_force(spark, folder):
    """What the deterministic filters drop, by definition, from the documents that the classifier keeps."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit_on(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score(docs, model).filter("score < 0.3").collect()}
    kept = corpus_pipeline.STAGES[0][1](spark, docs, folder)
    assert {r.doc_id for r in kept.collect()} == clean
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    low = {k: k + 32 for k in range(65, 91)}
    sets = {}
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate(low))
        sets[doc_id] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= corpus_pipeline.NEAR * len(x | y):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    assert {r.doc_id for r in corpus_pipeline.STAGES[1][1](spark, kept, folder).collect()} == {d for d in ids if find(d) == d}


def test_pipeline_of_odd_rows(spark, folder, texts, odd):
    docs = texts([*odd, (70, "a b c d e f g"), (71, "a b c d e f g")])
    near = corpus_pipeline.STAGES[1][1](spark, docs, folder)
    assert sorted(r.doc_id or 0 for r in near.collect()) == [1, 2, 3, 4, 4, 5, 6, 7, 70]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, texts([]), folder).count() == 0
