"""The audited upsert reads its batch once, for the upsert and for the log."""

from __future__ import annotations

from types import SimpleNamespace

from entitymill.plans import resolving, tracked
from entitymill.plans.catalogue import QUERIES

BATCH = "record_id long, company_name string, phone string, email string, state string"


def test_the_batch_is_read_once(spark, sf_dir, monkeypatch):
    read = []

    def batch(t):
        read.append(t)
        return spark.createDataFrame([(1, "a", "1", None, "CA"), (2, "b", None, "b@b", "TX")], BATCH)

    def upsert(records, *rest):
        return SimpleNamespace(assignments=records.selectExpr("record_id", "record_id + 10 AS entity_id", "record_id = 1 AS is_new"))

    monkeypatch.setattr(resolving, "batch", batch)
    monkeypatch.setattr(tracked, "batch", batch)
    monkeypatch.setattr(resolving.upserting, "upsert", upsert)
    found = {tuple(r) for r in QUERIES["x09_audited_upsert"](spark, sf_dir).collect()}
    assert found == {(11, 1, "INSERT", '{"company_name":"a","phone":"1","email":null,"state":"CA"}'),
                     (12, 2, "MERGE", '{"company_name":"b","phone":null,"email":"b@b","state":"TX"}')}
    assert len(read) == 1
