"""The registered queries and the pipeline on the small test tables."""

import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import exact, jaccard, toxicity
from tallyloom.llm.queries import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    answer = duck.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(answer.fetchall())


def test_search_finds_nine_of_ten(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = {}
    for r in QUERIES["op4_permutation_index"](spark, DATA).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in got:
        far = ((x - x[ids == q]) ** 2).sum(axis=1)
        hits += len({int(ids[k]) for k in [k for k in np.lexsort((ids, far)) if ids[k] != q][:10]} & got[q])
    assert len(got) == (ids % 100 == 0).sum() and hits >= 0.9 * 10 * len(got)


@pytest.mark.parametrize("name", ["op5_compression_toxicity", "op8_co_trained_quality"])
def test_every_document_is_scored(spark, name):
    out = QUERIES[name](spark, DATA)
    assert out.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert out.filter("score < 0 OR score > 1 OR score IS NULL OR predicted <> cast(score >= 0.5 AS int)").count() == 0


def test_pipeline_follows_its_decisions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stage = lambda k, df: corpus_pipeline.stage_table(corpus_pipeline.STAGES[k][1](spark, df, DATA))
    clean = stage(0, docs)
    scores = toxicity.toxicity(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert {r[0] for r in clean.select("doc_id").collect()} == {r[0] for r in scores.filter("predicted = 0").select("doc_id").collect()}
    single = stage(1, clean)
    assert single.select("text").distinct().count() == single.count() == clean.select("text").distinct().count()
    near = stage(2, single)
    assert jaccard.near_duplicates(near).filter("doc_id <> component_id").count() == 0
    assert exact.content_sort(near).filter("group_size > 1").count() == 0
    mixed = stage(3, near)
    assert mixed.columns == docs.columns and mixed.join(near, "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, DATA)
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.filter("n <> end OR n > 4096").count() == 0
    assert packed.groupBy("doc_id").agg(F.count_if(F.col("piece") == 0).alias("n")).join(mixed.groupBy("doc_id").count(), "doc_id").filter("n <> count").count() == 0
