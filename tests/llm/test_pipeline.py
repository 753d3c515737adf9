"""The registered queries against their SQL, recall of the search, and the pipeline's stages."""

from __future__ import annotations

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from entitymill.llm import toxicity
from entitymill.llm.queries import ORACLES, QUERIES
from entitymill.plans.registry import RAW
from tools.check import kinds, rows_of

from .test_long_lines import brute_force
from .test_near_copies import first_of_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in RAW:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = QUERIES[name](spark, sf_dir)
    columns, got = rows_of(frame.columns, frame.collect())
    found = con.execute(ORACLES[name])
    names, wanted = rows_of([d[0] for d in found.description], found.fetchall())
    assert columns == names and got == wanted and kinds(got) == kinds(wanted)


def test_search_recall(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = QUERIES["op3_nearest"](spark, sf_dir).toPandas()
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("embedding IS NOT NULL").toPandas()
    ids, vectors = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    hits = 0
    for query, found in got.groupby("query_id"):
        distance = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(1))
        distance[ids == query] = np.inf
        hits += len(set(ids[np.lexsort((ids, distance))[:10]]) & set(found["vec_id"]))
    assert hits >= 0.9 * len(got)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "", "en", "s", 0), (10_000, "solo", "en", "s", 4)], docs.schema)
    before = docs.unionByName(odd)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        kept[name] = (before, after := after.cache())
        before = after
    start, after = kept["toxicity"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.score_documents(start, labels).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, s in scores.items() if s < toxicity.THRESHOLD}
    start, after = kept["line dedup"]
    rows = sorted(((r.doc_id, r.text or "") for r in start.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert sorted(repr((r.doc_id, r.text or "")) for r in after.collect()) == sorted(
        map(repr, brute_force(rows, corpus_pipeline.LONG_LINES)))
    start, after = kept["SimHash near-dedup"]
    rows = [(r.doc_id, r.text) for r in start.collect()]
    assert sorted(repr(r.doc_id) for r in after.collect()) == sorted(repr(rows[i][0]) for i in first_of_groups(rows))
    start, after = kept["benchmark decontamination"]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(repr(r.doc_id) for r in after.collect()) == sorted(
        repr(r.doc_id) for r in start.collect() if not shares_a_window(r.text, items))
    assert kept["SentencePiece encoding"][1].count() == kept["benchmark decontamination"][1].count()


def shares_a_window(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    own = words(text)
    for item in items:
        cut = words(item)
        size = min(10, len(cut))
        windows = {tuple(cut[i : i + size]) for i in range(len(cut) - size + 1)} if cut else set()
        if any(tuple(own[i : i + size]) in windows for i in range(len(own) - size + 1)):
            return True
    return False


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables_and_nulls(spark, sf_dir, name, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)
    assert stage(spark, docs.limit(0), sf_dir).count() == 0
    nulls = spark.createDataFrame([(None,) * 5, (7, None, None, None, None), (8, "clean words here", None, None, None)], docs.schema)
    got = stage(spark, nulls.withColumn("key", F.lit(1)).withColumn("score", F.lit("x")), sf_dir)
    ids = {r.doc_id for r in got.collect()}
    # rows without words are copies of each other: the near-copy stage keeps the first of them
    assert ids == ({7, 8} if name == "SimHash near-dedup" else {None, 7, 8})


def test_pipeline_runs(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 100
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
