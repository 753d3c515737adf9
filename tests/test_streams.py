"""Streams: imports with a manifest, keys per window, keyed stage times."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest

from entitymill.operators.funnel import time_in_previous_stage
from entitymill.streaming import imports as streamed, stages

START = datetime(2024, 1, 1)
EVENTS = "event_id LONG, who LONG, ts TIMESTAMP, stage STRING"


def at(hours):
    return START + timedelta(hours=hours)


class Inbox:
    """Files that arrive one after the other, each in a run of its own."""

    def __init__(self, spark, tmp_path, schema):
        self.spark, self.root, self.schema = spark, str(tmp_path), schema

    def arrive(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def stream(self, files_per_batch=1):
        schema = self.spark.createDataFrame([], self.schema).schema
        return streamed.read_arriving(self.spark, f"{self.root}/in", schema, files_per_batch)


def test_manifest_skips_files_that_came_before(spark, tmp_path):
    inbox = Inbox(spark, tmp_path, "pos LONG, key STRING")
    master = f"{tmp_path}/master"

    def run():
        streamed.import_into_master(inbox.stream(100), master, f"{tmp_path}/mark", "key", "pos", buckets=4)
        return sorted((r.key, r.pos) for r in spark.read.parquet(master).collect())

    def statuses():
        return sorted(r.status for r in spark.read.parquet(streamed.manifest_of(master)).where("row_count > 1").collect())

    first = [(1, "a"), (2, "b"), (3, None)]
    inbox.arrive(first)
    assert run() == [("a", 1), ("b", 2)] and statuses() == ["imported"]
    inbox.arrive(first[::-1])  # the same rows in another order, under another name
    assert run() == [("a", 1), ("b", 2)] and statuses() == ["imported", "repeated"]
    inbox.arrive([(0, "a"), (9, "c")])
    inbox.arrive([(9, "c"), (0, "a")])  # twice in one batch
    assert run() == [("a", 1), ("b", 2), ("c", 9)]
    assert statuses() == ["imported", "imported", "repeated", "repeated"]
    assert run() == [("a", 1), ("b", 2), ("c", 9)]  # nothing new: nothing happens


def test_a_batch_that_runs_again_repeats_nothing(spark, tmp_path):
    inbox = Inbox(spark, tmp_path, "pos LONG, key STRING")
    master, mark = f"{tmp_path}/master", f"{tmp_path}/mark"
    inbox.arrive([(1, "a"), (2, "b")])
    streamed.import_into_master(inbox.stream(100), master, mark, "key", "pos")
    inbox.arrive([(3, "b"), (4, "c")])
    streamed.import_into_master(inbox.stream(100), master, mark, "key", "pos")
    done = sorted(map(tuple, spark.read.parquet(master).select("pos", "key", "batch").collect()))
    # the last batch was written, but the run was lost before it could say so
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{mark}/commits/{name}"):
            os.remove(f"{mark}/commits/{name}")
    streamed.import_into_master(inbox.stream(100), master, mark, "key", "pos")
    assert sorted(map(tuple, spark.read.parquet(master).select("pos", "key", "batch").collect())) == done
    manifest = spark.read.parquet(streamed.manifest_of(master)).where("row_count > 0")
    assert manifest.where("status = 'imported'").count() == manifest.select("path").distinct().count()


def test_keys_leave_the_state_with_their_window(spark, tmp_path):
    inbox = Inbox(spark, tmp_path, "key STRING, ts TIMESTAMP")
    seen = []

    def run(rows):
        inbox.arrive(rows)
        kept = streamed.distinct_keys_per_window(inbox.stream(), ["key"], "ts", "1 day", "1 hour")
        query = (kept.writeStream.format("parquet").option("path", f"{tmp_path}/out")
                 .option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start())
        query.awaitTermination()
        seen.append([p["stateOperators"][0] for p in query.recentProgress])
        return sorted((r.window_start.day, r.key) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run([("a", at(1)), ("a", at(2)), ("b", at(3))]) == [(1, "a"), (1, "b")]
    assert run([("a", at(4)), ("c", at(50))]) == [(1, "a"), (1, "b"), (3, "c")]
    # the watermark has passed the first day: its keys are gone from the state, its events come too late
    assert run([("a", at(5)), ("a", at(49)), ("c", at(51))]) == [(1, "a"), (1, "b"), (3, "a"), (3, "c")]
    assert sum(p["numRowsDroppedByWatermark"] for p in seen[2]) == 1
    assert seen[2][-1]["numRowsTotal"] == 2


def timed(spark, tmp_path, files, keep, late_by="2 hours"):
    inbox = Inbox(spark, tmp_path, EVENTS)
    with stages.keyed_state(spark):
        for rows in files:
            inbox.arrive(rows)
            streamed.write_stream(
                stages.stage_times(inbox.stream(), "who", "ts", "stage", late_by, keep), f"{tmp_path}/out", f"{tmp_path}/mark")
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    return {(r.event_id, r.status): (r.who, r.stage_from, r.stage, r.hours_in_previous) for r in rows}


def test_stage_times_with_late_and_repeated_events(spark, tmp_path):
    got = timed(spark, tmp_path, [
        [(2, 7, at(3), "B"), (1, 7, at(1), "A"), (3, 8, at(1), "A")],
        [(2, 7, at(3), "B"), (4, 7, at(2), "X"), (5, 7, at(9), "C")],
        [(6, 7, at(1), "too late"), (7, 8, at(9), "B")],
    ], timedelta(days=9))
    assert got == {
        (1, "in order"): (7, None, "A", None), (2, "in order"): (7, "A", "B", 2), (3, "in order"): (8, None, "A", None),
        (4, "late"): (7, None, "X", None), (5, "in order"): (7, "B", "C", 6), (7, "in order"): (8, "A", "B", 8)}


def test_idle_entities_are_forgotten(spark, tmp_path):
    got = timed(spark, tmp_path, [
        [(1, 7, at(0), "A"), (2, 8, at(0), "A")], [(3, 8, at(20), "B")], [(4, 8, at(30), "C")], [(5, 7, at(31), "B")],
    ], timedelta(hours=24), "1 hour")
    assert got[5, "in order"] == (7, None, "B", None) and got[4, "in order"] == (8, "B", "C", 10)


@pytest.mark.parametrize("files", [1, 3])
def test_stage_times_equal_the_batch_operator(spark, tmp_path, files):
    rows = [(i, i * 7 % 5, at(i // 3), "ABC"[i * i % 3]) for i in range(90)]
    got = timed(spark, tmp_path, [rows[len(rows) * k // files : len(rows) * (k + 1) // files] for k in range(files)],
                timedelta(days=30))
    batch = time_in_previous_stage(spark.createDataFrame(rows, EVENTS), "who", "ts", "stage")
    want = {(r.event_id, "in order"): (r.who, r.stage_from, r.stage_to, r.hours_in_previous) for r in batch.select(
        "event_id", "who", "stage_from", "stage_to", "hours_in_previous").collect()}
    assert got == want
