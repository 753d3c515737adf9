"""Funnel events as a stream: counts over time, and time between stages."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import setting


def stage_counts(events: DataFrame, at: str, stage: str, window: str, late_by: str) -> DataFrame:
    """Events per stage and time window; a window comes out once the watermark has passed it."""
    return (
        events.withWatermark(at, late_by)
        .groupBy(F.window(at, window).alias("w"), stage)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("window_start"), stage, "events")
    )


class StageTimer(StatefulProcessor):
    """Keeps the last event of an entity and tells how long each event's entity was in the stage before."""

    def __init__(self, event: str, entity: str, at: str, stage: str, keep: timedelta):
        self.event, self.entity, self.at, self.stage = event, entity, at, stage
        self.keep_ms = int(keep.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "micros bigint, event_id bigint, stage string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        frame["micros"] = frame[self.at].astype("datetime64[us]").astype("int64")
        frame = frame.sort_values(["micros", self.event], kind="stable")
        last = self.last.get() if self.last.exists() else None
        before, out = last, []
        for micros, event, stage in zip(frame["micros"], frame[self.event], frame[self.stage]):
            place = (micros, event)
            if last is not None and place == tuple(last[:2]):
                continue  # the same event again
            if last is not None and place < tuple(last[:2]):
                out.append((event, key[0], None, stage, None, "late"))
                continue
            hours = None if last is None else (micros // 1_000_000 - last[0] // 1_000_000) // 3600
            out.append((event, key[0], None if last is None else last[2], stage, hours, "in order"))
            last = (int(micros), int(event), stage)
        if last is not before:
            self.last.update(tuple(last))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(last[0] // 1000 + self.keep_ms)
        columns = ["event_id", self.entity, "stage_from", self.stage, "hours_in_previous", "status"]
        # hours have nulls: kept as objects, so that they do not turn into floats
        yield pd.DataFrame(out, columns=columns, dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def stage_times(
    events: DataFrame, entity: str, at: str, stage: str, late_by: str, keep: timedelta, event: str = "event_id"
) -> DataFrame:
    """event_id, entity, stage_from, stage, hours_in_previous, status of every event of a stream.

    The state is one row per entity: its last event. A batch's work depends on the batch alone. Of the
    events of a batch an entity's are taken in the order of time and id. An event behind the
    entity's last one comes out as `late`, without a stage before, and changes nothing; the last event
    again is left out; what is older than the watermark (`late_by` behind the newest event) Spark
    drops. An entity without events for `keep` is forgotten: its next event is a first one.
    Needs the RocksDB state store (see `keyed_state`). An entity's events of one batch meet in one
    task; the batch size bounds them.
    """
    rows = events.withWatermark(at, late_by).select(event, entity, at, stage)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = (f"event_id bigint, {entity} {kinds[entity]}, stage_from string, {stage} string, "
              "hours_in_previous bigint, status string")
    return rows.groupBy(entity).transformWithStateInPandas(
        StageTimer(event, entity, at, stage, keep), outputStructType=schema, outputMode="Append", timeMode="EventTime")


def keyed_state(spark: SparkSession):
    """The state store that keyed state needs, for streams started inside the block."""
    return setting(spark, "spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
