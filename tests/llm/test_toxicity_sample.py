"""The bound of the toxicity sample where a doc_id is repeated."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitymill.llm import toxicity


def test_sample_is_bounded_in_rows(spark):
    ids = range(40)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(i, f"other {i} {n}") for i in (3, 5, 6) for n in range(200)]
                                 + [(7, None), (None, "no id")], "doc_id long, text string").repartition(4)
    learnt = {r.doc_id for r in labels.where(~toxicity.held_out()).collect()}
    got = toxicity.training_sample(docs, labels).collect()
    assert len(got) == len(learnt)
    least = {r.doc_id: r.row.text for r in docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct(F.xxhash64("text").alias("tie"), "text")).alias("row")).collect()}
    assert sorted(((r.text, r.toxic) for r in got), key=repr) == sorted(((least[i], i % 2) for i in learnt), key=repr)
    assert toxicity.training_sample(docs, labels, 9).count() == 9
