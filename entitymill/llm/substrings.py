"""Substring dedup with super-k-mers over words.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A window is `window` consecutive words of one text.
Consecutive windows with the same minimiser form a super-k-mer. It travels as one packed string
(its words joined by a space) to the bucket of its minimiser; there the windows of all packed
strings are sorted as whole strings and equal neighbours are counted. Each word under a window
that occurs again, in any text, is removed. Nothing rests on hashes: they choose minimisers and
buckets, equality is that of the sorted strings. Only the windows of hot minimisers (below) are
counted by a cryptographic digest of 128 bits.

Scale: the texts are scanned once for minimisers, and shuffled to their repeated ones and to
their removed spans. Equal packed strings of a batch travel once with their places. A minimiser
with more than `hot_rows` occurrences goes to no bucket: the digests of its windows are counted
with partial sums, and the flag is joined back to the runs and to their places, which never meet.
What one bucket holds is bounded by `windows_per_bucket` and by `hot_rows` runs of one minimiser.

Defined cases: null, empty and blank texts have no words and stay as they are (the kept text is
empty); texts shorter than a window lose nothing; repeated rows are copies of each other, so
they lose all their windows; a null doc_id is an id like any other; other columns are ignored.
Kept words are joined by one space.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from . import textbytes as tb
from .repeats import (
    HOT_FIELDS, HOT_TYPE, batch_numbers, bucket_count, digest, repeated_hot, repeated_runs, spans_by_text, spans_of_places,
)

WINDOW = 35
GRAM = 8
HOT_ROWS = 2_000
WINDOWS_PER_BUCKET = 150_000


def _scan(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, table = tb.not_blank(), tb.byte_values()
        for batch in batches:
            for low, _, data, offsets in tb.slices(batch.column("text")):
                starts, ends, first = tb.word_bounds(data, offsets, flags)
                grams = tb.window_hashes(tb.word_hashes(data, starts, ends, table), gram)
                row, anchor, begin, end = tb.minimiser_runs(grams, first, gram, window)
                base = first[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[anchor].view(np.int64)), batch.column("key").take(pa.array(row + low)),
                     *(pa.array((x - base).astype(np.int32)) for x in (anchor, begin, end))],
                    ["mark", "key", "anchor", "first", "last"])

    return run


def _pack(window: int, gram: int, buckets: int):
    """Super-k-mers of the repeated runs; equal ones of a batch as one row with their places.

    Hot runs go without a bucket, each with its digest.
    """
    key = pa.struct([("doc_id", pa.int64()), ("tie", pa.int64())])
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.list_(key)),
                        ("firsts", pa.list_(pa.int32())), *HOT_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in zip(batch_numbers(), batches, strict=False):
            packed: dict[tuple[int | None, bytes], list[tuple[int, int]]] = {}
            texts, runs = batch.column("text"), batch.column("runs")
            for row in range(len(batch)):
                words = texts[row].as_py().encode().split()
                for r in runs[row].as_py():
                    mark = b" ".join(words[r["anchor"] : r["anchor"] + gram])
                    one = b" ".join(words[r["first"] : r["last"] + window])
                    bucket = None if r["hot"] else zlib.crc32(mark) % buckets
                    packed.setdefault((bucket, one), []).append((row, r["first"]))
            if not packed:
                continue
            places = list(packed.values())
            rows = pa.array([r for p in places for r, _ in p])
            firsts = pa.array([s for p in places for _, s in p], pa.int32())
            ends = pa.array(np.cumsum([0, *map(len, places)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in packed], pa.int32()),
                 pa.ListArray.from_arrays(ends, batch.column("key").take(rows).cast(key)),
                 pa.ListArray.from_arrays(ends, firsts),
                 pa.array([digest(x) if b is None else None for b, x in packed], pa.binary()),
                 pa.array([number] * len(packed), pa.int64()), pa.array([x for _, x in packed], pa.binary())],
                schema=schema)

    return run


def windows_of(packed: bytes, window: int) -> list[bytes]:
    cuts = [-1, *(i for i, c in enumerate(packed) if c == 32), len(packed)]
    return [packed[cuts[i] + 1 : cuts[i + window]] for i in range(len(cuts) - window)]


def repeated_windows(packed: list[bytes], copies: np.ndarray, window: int) -> list[np.ndarray]:
    """For each packed string the flags of its windows that occur more than once.

    copies: how often each string occurs.
    """
    windows: list[bytes] = []
    counts = []
    for text in packed:
        found = windows_of(text, window)
        windows += found
        counts.append(len(found))
    again = np.repeat(copies > 1, counts)
    order = sorted(range(len(windows)), key=windows.__getitem__)
    same = np.fromiter((windows[a] == windows[b] for a, b in pairwise(order)), bool, max(len(order) - 1, 0))
    order = np.asarray(order, np.int64)
    again[order[:-1][same]] = True
    again[order[1:][same]] = True
    return np.split(again, np.cumsum(counts)[:-1])


def _count(window: int):
    """One bucket: spans of the repeated windows, for every place of a super-k-mer."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        # the same string may come from many tasks
        seen: dict[bytes, list[int]] = {}
        for i, text in enumerate(table.column("content").to_pylist()):
            seen.setdefault(text, []).append(i)
        keys, firsts = table.column("keys").combine_chunks(), table.column("firsts").combine_chunks()
        ends = firsts.offsets.to_numpy()
        sizes = np.diff(ends)
        owner = np.empty(len(table), np.int64)
        for entry, rows in enumerate(seen.values()):
            owner[rows] = entry
        copies = np.bincount(owner, sizes, len(seen))
        entry, low, high = [], [], []
        for i, again in enumerate(repeated_windows(list(seen), copies, window)):
            begin = np.flatnonzero(again)
            begin, end = tb.merge_spans(begin, begin + window)
            entry += [i] * len(begin)
            low.append(begin)
            high.append(end)
        return spans_of_places(
            keys.flatten(), firsts.flatten().to_numpy().astype(np.int64), np.repeat(owner, sizes),
            np.array(entry, np.int64), np.concatenate(low), np.concatenate(high))

    return run


def repeated_spans(
    texts: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_rows: int = HOT_ROWS,
    windows_per_bucket: int = WINDOWS_PER_BUCKET,
) -> DataFrame:
    """(key, spans) of (key, text): runs of words under windows that occur again."""
    runs = repeated_runs(texts, _scan(window, gram), hot_rows)
    buckets = bucket_count(runs, windows_per_bucket)
    packed = keep_table(texts.join(runs, "key").select("key", "text", "runs").mapInArrow(
        _pack(window, gram, buckets),
        f"bucket int, keys array<{tb.KEY_TYPE}>, firsts array<int>, {HOT_TYPE}"), "packed")
    cold = packed.where("bucket IS NOT NULL").select("bucket", "content", "keys", "firsts")
    spans = cold.groupBy("bucket").applyInArrow(
        _count(window), f"key {tb.KEY_TYPE}, low bigint, high bigint")
    return spans_by_text(spans.unionByName(repeated_hot(packed, lambda c: windows_of(c, window), window)))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column("text"), batch.column("spans")
        out: list[list] = [[], [], [], []]
        for row in range(len(batch)):
            words = (texts[row].as_py() or "").encode().split()
            cut = spans[row].as_py() or []
            low, high = tb.merge_spans(np.array([s["low"] for s in cut], np.int64),
                                       np.array([s["high"] for s in cut], np.int64))
            kept, at = [], 0
            for a, b in zip(low.tolist(), high.tolist(), strict=True):
                kept += words[at:a]
                at = b
            kept = b" ".join(kept + words[at:])
            for values, x in zip(out, (len(words), int((high - low).sum()), hashlib.sha256(kept).hexdigest(),
                                       kept), strict=True):
                values.append(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
             pa.array(out[2], pa.string()), pa.array(out[3], pa.binary()).cast(pa.string())],
            ["key", "n_words", "n_removed", "kept_sha256", "kept"])


def dedup_substrings(docs: DataFrame, **settings: int) -> DataFrame:
    """key, doc_id, n_words, n_removed, kept_sha256 and kept text of every document row."""
    texts = tb.keyed_texts(docs)
    spans = repeated_spans(texts, **settings)
    done = texts.join(spans, "key", "left").select("key", "text", "spans").mapInArrow(
        _remove, f"key {tb.KEY_TYPE}, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return done.select("key", F.col("key.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept")
