"""Stand-ins that are written: their rows come from tasks of about equal size, whatever the files of the base table."""

from __future__ import annotations

from pyspark.sql import functions as F

from entitymill.plans import registry


def test_rows_of_one_base_file_are_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "TASK_ROWS", 100)
    rows = [(i if i % 50 else None, 1, float(i)) for i in range(950)] + [(7, 1, 7.0)] * 50
    base = spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double")
    base.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    tables = registry.Tables(spark, str(tmp_path))
    written = tables.dealers
    sizes = [r["count"] for r in written.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 120
    plain = tables._derived("dealers")
    assert written.count() == 1000
    assert written.exceptAll(plain).count() == 0 and plain.exceptAll(written).count() == 0
