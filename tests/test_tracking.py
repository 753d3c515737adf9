"""Change log, rollback, files, streams."""

import os

from pyspark.sql import functions as F

from entitymill.operators import funnel, history
from entitymill.sources import files, listings, registries, sinks
from entitymill.streaming import imports as streamed


def test_update_logs_changed_fields_only(spark):
    schema = "id LONG, company_name STRING, state STRING, city STRING"
    old = spark.createDataFrame([(1, "ABC Solar", "FL", "Miami"), (2, "Same", "FL", None), (3, "Gone", "TX", "A")], schema)
    new = spark.createDataFrame([(1, "ABC Solar", "FL", "Tampa"), (2, "Same", "FL", None), (4, "New", "CA", "B")], schema)
    got = {r.id: r for r in history.change_log(old, new, "id", ["company_name", "state", "city"]).collect()}
    assert set(got) == {1, 3, 4}
    assert (got[1].change_type, got[1].old_values, got[1].new_values) == ("UPDATE", {"city": "Miami"}, {"city": "Tampa"})
    assert got[3].change_type == "DELETE" and got[3].new_values is None
    assert got[4].change_type == "INSERT" and got[4].new_values["city"] == "B"


def test_rollback_deletes_what_the_import_inserted(spark):
    rows = spark.createDataFrame([(1, None), (2, 0), (3, 1)], "id LONG, is_deleted INT")
    inserted = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id LONG, import_id STRING")
    got = {r.id: (r.is_deleted, r.deletion_reason) for r in history.rollback(rows, inserted, "import_id", "a").collect()}
    assert got == {1: (1, "Rollback of import a"), 2: (0, None), 3: (1, None)}


def test_csv_by_name_with_bom_and_long_rows(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("﻿name,phone\n\"Smith, Inc\",1\n", encoding="utf-8")
    b.write_text("phone,email,name\n2,x@y.z,Jones\n", encoding="utf-8")
    rows = {r.name: (r.phone, r.email) for r in files.read_header_csv(spark, str(a), str(b)).collect()}
    assert rows == {"Smith, Inc": ("1", None), "Jones": ("2", "x@y.z")}
    c = tmp_path / "c.csv"
    c.write_text("a,b\n1,2\n1,2,3\n4\n")
    got = [tuple(r) for r in files.read_csv_skipping_long_rows(spark, str(c), ["a", "b"]).collect()]
    assert got == [("1", "2"), ("4", None)]


def test_short_rows_and_json_shapes(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text('a,"b, c",3\nshort,1\n"say ""x""",,9\n')
    got = [tuple(r) for r in files.read_wide_rows(spark, str(path), {0: "x", 1: "y"}, fewest=3).collect()]
    assert got == [("a", "b, c"), ('say "x"', "")]
    for name, body in {"l": '[{"n": "a"}, {"n": "b"}]', "d": '{"dealers": [{"n": "c"}]}', "e": '{"data": [{"n": "d"}]}'}.items():
        (tmp_path / f"{name}.json").write_text(body)
    schema = spark.createDataFrame([], "n STRING").schema
    names = {r.n for r in files.read_json_records(spark, str(tmp_path / "*.json"), schema).collect()}
    assert names == {"a", "b", "c", "d"}
    (tmp_path / "many.txt").write_text('[{"n": "a"}, {"n": "b"}]\n{"data": [{"n": "c"}]}\n{"n": "d"}\n')
    names = [r.n for r in files.read_json_records(spark, str(tmp_path / "many.txt"), schema, per_line=True).collect()]
    assert sorted(names) == ["a", "b", "c", "d"]


def test_file_names(spark):
    rows = spark.createDataFrame([("lists_20251126_073159.json",), ("x_20251126.csv",), ("20251126_x.csv",), ("plain.csv",)], "f STRING")
    got = rows.select(F.date_format(files.file_stamp("f"), "yyyyMMdd HHmmss").alias("t"), files.file_group("f").alias("g")).collect()
    assert [r.t for r in got] == ["20251126 073159", "20251126 000000", "20251126 000000", None]
    assert [r.g for r in got][:2] == ["lists", "x"]
    newest = files.newest_checkpoint(spark.createDataFrame([("checkpoint_9.csv",), ("checkpoint_10.csv",)], "f STRING"), "f")
    assert newest.first().f == "checkpoint_10.csv"


def test_texas_prefers_the_business(spark):
    columns = ["LICENSE TYPE", "LICENSE NUMBER", "LICENSE EXPIRATION DATE", "COUNTY", "NAME", "PHONE NUMBER", "BUSINESS NAME",
               "BUSINESS ADDRESS-LINE1", "BUSINESS ADDRESS-LINE2", "BUSINESS CITY, STATE ZIP", "BUSINESS COUNTY", "BUSINESS ZIP", "BUSINESS PHONE"]
    rows = [("A/C Contractor", "1", "2025-01-31", "Bexar", "Pat Doe", "111", "", "1 Main", "", "AUSTIN, TX 78701", "Travis", "", "222"),
            ("Sign Maker", "2", "soon", "Bexar", "Pat Doe", "111", "Doe Air", "1 Main", "Suite 2", "bad", "", "78702", "")]
    got = registries.texas(spark.createDataFrame(rows, columns)).orderBy("license_number").collect()
    assert (got[0].licensee_name, got[0].phone, got[0].city, got[0].zip, got[0].license_type) == ("Pat Doe", "222", "AUSTIN", "78701", "HVAC")
    assert (got[1].licensee_name, got[1].phone, got[1].city, got[1].state, got[1].zip) == ("Doe Air", "111", None, "TX", "78702")
    assert got[1].expiration_date is None and got[1].street == "1 Main Suite 2" and got[1].county == "Bexar"


def test_kw_cells(spark):
    cells = ["kW Installed in 202410,106,563", "C&I kW Installed in 2024116,909.53", "202410,106,563", "5,000 kW", "none"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i INT, c STRING")
    got = [r.k for r in rows.orderBy("i").select(listings.kw_of_cell("c").alias("k")).collect()]
    assert got == [10106563, 116909, 10106563, 5000, 0]


def test_page_record_reads_the_card(spark):
    html = '<h1>Best Power</h1><div>Gold Dealer 12.5 miles</div><p>150 Nardi Lane, Martinez, CA 94553</p><a href="x">w</a> (925) 555-0100'
    row = listings.page_record(spark.createDataFrame([(1, "https://www.best.com/x", html)], "page_id LONG, url STRING, html STRING")).first()
    assert (row.host, row.heading, row.tier, row.miles, row.city, row.state, row.zip, row.links, row.phone) == (
        "best.com", "Best Power", "Gold Dealer", 12.5, "Martinez", "CA", "94553", 1, "(925) 555-0100")


def test_stage_lag_crosses_hours_and_days(spark):
    rows = [(1, 7, "2024-01-01 00:10:00", "A"), (2, 7, "2024-01-01 00:50:00", "B"), (3, 7, "2024-01-03 01:00:00", "C"), (4, 8, "2024-01-01 00:00:00", "A")]
    df = spark.createDataFrame(rows, "event_id LONG, e LONG, at STRING, s STRING").withColumn("at", F.col("at").cast("timestamp"))
    got = {r.event_id: (r.stage_from, r.hours_in_previous) for r in funnel.time_in_previous_stage(df, "e", "at", "s").collect()}
    assert got == {1: (None, None), 2: ("A", 0), 3: ("B", 48), 4: (None, None)}


def test_csv_sink_keeps_the_asked_columns(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_csv(spark.createDataFrame([(1, "x", "y")], "a INT, b STRING, c STRING"), path, ["c", "missing", "a"])
    back = files.read_header_csv(spark, path)
    assert back.columns == ["c", "missing", "a"] and tuple(back.first()) == ("y", None, "1")


def test_stream_restart_repeats_nothing(spark, tmp_path):
    inbox, master, mark = (str(tmp_path / p) for p in ("in", "master", "mark"))
    schema = "pos LONG, key STRING"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream = streamed.read_arriving(spark, inbox, spark.createDataFrame([], schema).schema)
        streamed.import_into_master(stream, master, mark, "key", "pos")
        return sorted((r.key, r.pos) for r in spark.read.parquet(master).collect())

    assert arrive([(1, "a"), (2, "a"), (3, "b")]) == [("a", 1), ("b", 3)]
    assert arrive([(4, "b"), (5, "c")]) == [("a", 1), ("b", 3), ("c", 5)]
    assert arrive([]) == [("a", 1), ("b", 3), ("c", 5)]
    assert len([d for d in os.listdir(master) if d.startswith("batch=")]) >= 2
