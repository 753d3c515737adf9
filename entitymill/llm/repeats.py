"""Which windows of a text can occur again: the step that both repeat finders start with.

A scan cuts every text into runs of consecutive windows that share the place of their least gram
(the minimiser). Equal windows have equal minimisers at the same offset, so a window whose
minimiser occurs once in the corpus occurs once itself. Only the others go on, and only their
texts are shuffled to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from . import textbytes as tb

RUN = "struct<anchor:int,first:int,last:int,hot:boolean>"


def repeated_runs(texts: DataFrame, scan: Callable, hot_rows: int) -> DataFrame:
    """(key, runs) of the texts that hold a repeated minimiser.

    scan: mapInArrow function from (key, text) to (mark, key, anchor, first, last). Minimisers
    with more than hot_rows occurrences are flagged hot: their windows go to repeated_hot
    instead of a bucket, so that no group takes them all.
    """
    schema = f"mark bigint, key {tb.KEY_TYPE}, anchor int, first int, last int"
    found = keep_table(texts.mapInArrow(scan, schema), "minimisers")
    # written, so that the join reads two bare shuffles and can split a hot minimiser
    again = keep_table(
        found.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("mark", (F.col("n") > hot_rows).alias("hot")), "repeated")
    runs = found.join(again, "mark").groupBy("key").agg(
        F.collect_set(F.struct("anchor", "first", "last", "hot")).alias("runs"))
    return keep_table(runs, "runs")


def digest(content: bytes) -> bytes:
    """Stands for the whole content: 128 bits of a cryptographic hash."""
    return hashlib.blake2b(content, digest_size=16).digest()


# What senders add to their rows: the digest of a hot run (cold rows: null), the batch that sent the row, and
# the run itself.
HOT_TYPE = "run binary, batch bigint, content binary"
HOT_FIELDS = [pa.field("run", pa.binary()), pa.field("batch", pa.int64()), pa.field("content", pa.binary())]


def batch_numbers() -> Iterator[int]:
    """Numbers for the batches of a task that no other task of the stage gives."""
    return count(TaskContext.get().partitionId() << 32)


def _windows(cut: Callable[[bytes], Iterator[bytes]]):
    """Different hot runs to their windows, one row per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                some = batch.slice(low, 500)
                found = [[digest(w) for w in cut(c)] for c in some.column("content").to_pylist()]
                sizes = [len(x) for x in found]
                owner = np.repeat(np.arange(len(found)), sizes)
                offsets = np.arange(len(owner)) - np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
                yield pa.RecordBatch.from_arrays(
                    [some.column("run").take(pa.array(owner)), pa.array([d for x in found for d in x], pa.binary()),
                     pa.array(offsets, pa.int32()), some.column("n").take(pa.array(owner))],
                    ["run", "digest", "offset", "n"])

    return run


def _place(table: pa.Table) -> pa.Table:
    """The spans of a batch's hot runs at their places, joined per text."""
    table = table.combine_chunks()
    keys, firsts = table.column("keys").combine_chunks(), table.column("firsts").combine_chunks()
    low, high = (table.column(c).to_numpy() for c in ("low", "high"))
    rows = np.arange(len(table))
    return spans_of_places(keys.flatten(), firsts.flatten().to_numpy().astype(np.int64),
                           np.repeat(rows, np.diff(firsts.offsets.to_numpy())), rows, low, high)


def repeated_hot(sent: DataFrame, cut: Callable[[bytes], Iterator[bytes]], length: int) -> DataFrame:
    """Spans (key, low, high) of the windows of hot runs that occur again.

    sent: a written table; its hot rows hold run, batch, content, keys and firsts. cut: the windows of a
    run's content in order. Equal runs of a batch are one row, and only one row of all those of a run
    is cut into windows, however many batches sent it. Digests of windows are counted with partial sums, and the flag
    goes back to the runs and from these to their places: places never have to meet but those of
    one batch, where the spans of a text are joined, and both joins read bare shuffles, which can
    split a hot digest or run. All windows of a run hold its anchor, so they overlap: the first
    and the last repeated one bound what is repeated.
    """
    hot = sent.where("run IS NOT NULL").select("run", "batch", "content", "keys", "firsts")
    runs = hot.groupBy("run").agg(F.first("content").alias("content"), F.sum(F.size("keys")).alias("n"))
    windows = keep_table(
        runs.mapInArrow(_windows(cut), "run binary, digest binary, offset int, n bigint"), "windows")
    again = keep_table(
        windows.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest"), "again").hint("merge")
    found = keep_table(windows.join(again, "digest").groupBy("run").agg(
        F.min("offset").cast("long").alias("low"), (F.max("offset") + length).cast("long").alias("high")),
        "found").hint("merge")
    placed = hot.select("run", "batch", "keys", "firsts").join(found, "run").select("batch", "keys", "firsts", "low", "high")
    return placed.groupBy("batch").applyInArrow(_place, f"key {tb.KEY_TYPE}, low bigint, high bigint")


def bucket_count(runs: DataFrame, windows_per_bucket: int) -> int:
    """Buckets so that one holds about windows_per_bucket windows; hot ones go to no bucket."""
    size = lambda r: F.when(r["hot"], 0).otherwise(r["last"] - r["first"] + 1)
    total = runs.select(
        F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + size(r)).alias("n")
    ).agg(F.sum("n")).first()[0]
    floor = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, -(-(total or 0) // windows_per_bucket))


def spans_of_places(
    keys: pa.Array, base: np.ndarray, owner: np.ndarray, entry: np.ndarray, low: np.ndarray, high: np.ndarray
) -> pa.Table:
    """Spans (entry, low, high) put at every place of their entry, joined per text.

    keys, base, owner: text, position and entry of each place. Joining here keeps periodic texts,
    where spans by the thousand overlap, at a few rows.
    """
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], entry)
    count = np.searchsorted(owner[order], entry, "right") - first
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    place = order[np.repeat(first, count) + step]
    low, high = base[place] + np.repeat(low, count), base[place] + np.repeat(high, count)
    doc = keys.field("doc_id")
    known = pc.is_valid(doc).to_numpy(zero_copy_only=False)[place]
    doc = pc.fill_null(doc, 0).to_numpy()[place]
    tie = keys.field("tie").to_numpy()[place]
    order = np.lexsort((tie, doc, known))
    place, low, high = place[order], low[order], high[order]
    new = np.zeros(len(order), np.int64)
    for column in (known[order], doc[order], tie[order]):
        new[1:] |= column[1:] != column[:-1]
    text = np.cumsum(new)
    # texts far apart on one line of numbers
    low, high = tb.merge_spans(low + (text << 40), high + (text << 40))
    at = place[np.searchsorted(text, low >> 40)]
    return pa.table({"key": keys.take(pa.array(at)), "low": low & ((1 << 40) - 1),
                     "high": high - (low >> 40 << 40)})


def spans_by_text(spans: DataFrame) -> DataFrame:
    """(key, spans) from (key, low, high): the repeated parts of each text, bounded by the text."""
    return spans.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
