"""Suffix-array dedup: a distributed merge sort of sampled suffixes that knows common prefixes.

Texts are UTF-8 bytes. Every byte under a `window`-byte string that starts anywhere else as well
is removed; matches never cross texts.

Which suffixes are sorted. Each window has a content-chosen anchor, its least `gram`-byte gram,
so equal windows have their anchors at the same offset. Only suffixes that begin at an anchor
whose gram occurs again are sorted: forwards from the anchor, and backwards before it. Two windows
with the anchor at offset o are equal just if their forward suffixes share `window - o` bytes and
their backward ones share o bytes.

How they are sorted. A task sorts the suffixes of a batch per bucket (of the anchor's gram) into
a run and front-codes it: of each suffix only what differs from the one before it travels. The
receiver merges the runs of its bucket with a loser tree whose nodes remember the common prefix
with the last winner, so known prefixes are neither sent nor compared again, and the merge yields
the common prefix of all neighbours. For each offset those lengths cut both orders into classes;
windows in the same forward and backward class as another one are the repeated ones.

Scale: sampling leaves about 2 / (window - gram) suffixes per byte, and of these only the
repeated ones travel. An anchor with more than `hot_rows` occurrences goes to no bucket: 128-bit
digests of its windows are counted with partial sums, and the flag is joined back to the runs and to
their places, which never meet. What a bucket holds is bounded by `windows_per_bucket` and by `hot_rows` runs
of one anchor.

Defined cases: null and empty texts have no bytes; texts shorter than a window lose nothing;
repeated rows are copies of each other; a null doc_id is an id like any other; other columns are
ignored. A removed span may cut a character, so the kept part is binary.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from . import textbytes as tb
from .repeats import (
    HOT_FIELDS, HOT_TYPE, batch_numbers, bucket_count, digest, repeated_hot, repeated_runs, spans_by_text, spans_of_places,
)

WINDOW = 400
GRAM = 48
HOT_ROWS = 50_000
WINDOWS_PER_BUCKET = 3_000_000
# Suffixes of one run: bounds the memory of a sender.
RUN_SUFFIXES = 20_000


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of a and b, of which `known` bytes are known."""
    n = min(len(a), len(b))
    while known < n:
        end = min(known + 64, n)
        x, y = a[known:end], b[known:end]
        if x != y:
            unequal = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return end - (unequal.bit_length() + 7) // 8
        known = end
    return n


def front_code(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted strings: the length shared with the one before, and the rest."""
    shared = [0, *map(common_prefix, strings[:-1], strings[1:])] if strings else []
    return shared, [s[n:] for s, n in zip(strings, shared, strict=True)]


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge front-coded runs with a loser tree over common prefixes.

    Returns (run, place in the run) in sorted order, equal strings in order of their runs, and the
    length that each string shares with the one before it. A contender carries the length it
    shares with the last winner. Of two contenders the one that shares more is the smaller; only
    if both share the same length are bytes compared, from there on.
    """
    width = 1
    while width < len(runs):
        width *= 2
    strings: list[bytes | None] = [None] * width  # current string of each run; None: used up
    shared, place = [0] * width, [0] * width
    for r, (_, rests) in enumerate(runs):
        if rests:
            strings[r] = rests[0]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared length becomes that with the winner."""
        x, y = strings[a], strings[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        n = common_prefix(x, y, shared[a])
        if n == len(x) == len(y):
            first = a < b
        else:
            first = n == len(x) or (n < len(y) and x[n] < y[n])
        winner, loser = (a, b) if first else (b, a)
        shared[loser] = n
        return winner, loser

    losers = [0] * width

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1)
    order: list[tuple[int, int]] = []
    lengths: list[int] = []
    while strings[top] is not None:
        order.append((top, place[top]))
        lengths.append(shared[top])
        place[top] += 1
        lcps, rests = runs[top]
        if place[top] < len(rests):
            n = lcps[place[top]]
            strings[top], shared[top] = strings[top][:n] + rests[place[top]], n
        else:
            strings[top] = None
        node = (top + width) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2
    return order, lengths


def _scan(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = tb.byte_values()
        for batch in batches:
            for low, _, data, offsets in tb.slices(batch.column("text")):
                grams = tb.window_hashes(table[data], gram)
                row, anchor, begin, end = tb.minimiser_runs(grams, offsets, gram, window)
                base = offsets[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[anchor].view(np.int64)), batch.column("key").take(pa.array(row + low)),
                     *(pa.array((x - base).astype(np.int32)) for x in (anchor, begin, end))],
                    ["mark", "key", "anchor", "first", "last"])

    return run


_RUN = "lcps array<int>, rests array<binary>, at array<int>"
_SENT = f"bucket int, least array<int>, most array<int>, owner array<int>, keys array<{tb.KEY_TYPE}>, anchor array<int>, " + (
    f"ahead struct<{_RUN.replace(' array', ':array')}>, behind struct<{_RUN.replace(' array', ':array')}>, ") + (
    f"firsts array<int>, {HOT_TYPE}")


def _send(window: int, gram: int, buckets: int):
    """A front-coded run of forward and one of backward suffixes per bucket and batch.

    Hot runs are rows of their own, without a bucket.
    """

    def coded(strings: list[bytes]) -> dict:
        order = sorted(range(len(strings)), key=strings.__getitem__)
        lcps, rests = front_code([strings[i] for i in order])
        return {"lcps": lcps, "rests": rests, "at": order}

    def packed(held: dict[int, dict], hot: dict[bytes, list], number: int, schema: pa.Schema) -> pa.RecordBatch:
        rows = []
        for content, places in hot.items():
            keys, firsts = zip(*places, strict=True)
            rows.append({"run": digest(content), "batch": number, "content": content, "keys": keys, "firsts": firsts})
        for bucket, entries in held.items():
            least, most, ahead, behind = zip(*entries, strict=True)
            places = [(entry, *p) for entry, found in enumerate(entries.values()) for p in found]
            owner, keys, anchor = zip(*places, strict=True)
            rows.append({"bucket": bucket, "least": least, "most": most, "owner": owner, "keys": keys,
                         "anchor": anchor, "ahead": coded(ahead), "behind": coded(behind)})
        return pa.RecordBatch.from_pylist(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = pa.struct([("doc_id", pa.int64()), ("tie", pa.int64())])
        ints = pa.list_(pa.int32())
        one = pa.struct([("lcps", ints), ("rests", pa.list_(pa.binary())), ("at", ints)])
        schema = pa.schema([("bucket", pa.int32()), ("least", ints), ("most", ints), ("owner", ints),
                            ("keys", pa.list_(key)), ("anchor", ints), ("ahead", one), ("behind", one),
                            ("firsts", ints), *HOT_FIELDS])
        numbers = batch_numbers()
        for batch in batches:
            # per bucket: offsets and suffixes of an entry, and all its places
            held: dict[int, dict[tuple, list]] = {}
            hot: dict[bytes, list] = {}  # hot runs with their places
            count = 0
            for text, key_, runs in zip(*(batch.column(c) for c in ("text", "key", "runs")), strict=True):
                data, key_ = text.as_py().encode(), key_.as_py()
                for r in runs.as_py():
                    a, first, last = r["anchor"], r["first"], r["last"]
                    if r["hot"]:
                        places = hot.setdefault(data[first : last + window], [])
                        count += not places
                        places.append((key_, first))
                    else:
                        entry = (a - last, a - first, data[a : last + window], data[first:a][::-1])
                        bucket = zlib.crc32(data[a : a + gram]) % buckets
                        places = held.setdefault(bucket, {}).setdefault(entry, [])
                        count += not places
                        places.append((key_, a))
                    if count >= RUN_SUFFIXES:
                        yield packed(held, hot, next(numbers), schema)
                        held, hot, count = {}, {}, 0
            if count:
                yield packed(held, hot, next(numbers), schema)

    return run


def repeated_offsets(
    ahead: tuple[np.ndarray, np.ndarray], behind: tuple[np.ndarray, np.ndarray],
    least: np.ndarray, most: np.ndarray, window: int,
) -> Iterator[tuple[int, np.ndarray]]:
    """For each offset of the anchor the entries whose window there equals another one's.

    ahead, behind: the sorted order of the entries and the length each shares with the one before;
    least, most: the offsets that an entry has windows for.
    """
    n = len(least)
    if not n:
        return
    by_offset = np.argsort(least, kind="stable")
    opened = least[by_offset]
    classes = [np.empty(n, np.int64), np.empty(n, np.int64)]
    for offset in range(int(least.min()), int(most.max()) + 1):
        here = by_offset[: np.searchsorted(opened, offset, "right")]
        here = here[most[here] >= offset]
        if len(here) < 2:
            continue
        for (order, shared), depth, number in zip(
            (ahead, behind), (window - offset, offset), classes, strict=True
        ):
            number[order] = np.cumsum(shared < depth)
        both = classes[0][here] * (n + 1) + classes[1][here]
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        again = np.zeros(len(here), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        yield offset, here[again]


def _receive(window: int):
    """One bucket: merge the runs both ways and report the spans of repeated windows."""

    def merged(table: pa.Table, name: str, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        runs = table.column(name).to_pylist()
        order, shared = merge_runs([(r["lcps"], r["rests"]) for r in runs])
        places = [r["at"] for r in runs]
        return np.array([base[r] + places[r][i] for r, i in order], np.int64), np.array(shared, np.int64)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        flat = {c: table.column(c).combine_chunks().flatten() for c in ("least", "most", "owner", "anchor", "keys")}
        least, most, owner, anchor = (flat[c].to_numpy().astype(np.int64) for c in ("least", "most", "owner", "anchor"))
        sizes = np.array([len(x) for x in table.column("least")])
        base = np.cumsum(sizes) - sizes
        owner += np.repeat(base, [len(x) for x in table.column("owner")])
        ahead, behind = merged(table, "ahead", base), merged(table, "behind", base)
        # an entry with several places repeats all its windows
        several = np.flatnonzero(np.bincount(owner, minlength=len(least)) > 1)
        entry, low, high = [several], [-most[several]], [window - least[several]]
        for offset, entries in repeated_offsets(ahead, behind, least, most, window):
            entry.append(entries)
            low.append(np.full(len(entries), -offset))
            high.append(np.full(len(entries), window - offset))
        entry, low, high = map(np.concatenate, (entry, low, high))
        # the spans of an entry joined before they are put at its places
        low, high = tb.merge_spans(low + (entry << 40) + window, high + (entry << 40) + window)
        entry = low >> 40
        return spans_of_places(flat["keys"], anchor, owner, entry, low - (entry << 40) - window,
                               high - (entry << 40) - window)

    return run


def repeated_spans(
    texts: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_rows: int = HOT_ROWS,
    windows_per_bucket: int = WINDOWS_PER_BUCKET,
) -> DataFrame:
    """(key, spans) of (key, text): byte runs under windows that start elsewhere too."""
    runs = repeated_runs(texts, _scan(window, gram), hot_rows)
    buckets = bucket_count(runs, windows_per_bucket)
    sent = keep_table(
        texts.join(runs, "key").select("key", "text", "runs").mapInArrow(_send(window, gram, buckets), _SENT), "sent")
    cold = sent.where("bucket IS NOT NULL").drop("firsts", *(f.name for f in HOT_FIELDS))
    spans = cold.groupBy("bucket").applyInArrow(
        _receive(window), f"key {tb.KEY_TYPE}, low bigint, high bigint")

    def cut(run: bytes) -> list[bytes]:
        return [run[i : i + window] for i in range(len(run) - window + 1)]

    return spans_by_text(spans.unionByName(repeated_hot(sent, cut, window)))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column("text"), batch.column("spans")
        out: list[list] = [[], [], [], [], []]
        for row in range(len(batch)):
            data = (texts[row].as_py() or "").encode()
            cut = spans[row].as_py() or []
            low, high = tb.merge_spans(np.array([s["low"] for s in cut], np.int64),
                                       np.array([s["high"] for s in cut], np.int64))
            edges = [0, *np.stack([low, high], 1).ravel().tolist(), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            for values, x in zip(out, (len(data), len(data) - len(kept), len(low),
                                       hashlib.sha256(kept).hexdigest(), kept), strict=True):
                values.append(x)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), *map(pa.array, out, types)],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup_bytes(docs: DataFrame, **settings: int) -> DataFrame:
    """key, doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept bytes of every document row."""
    texts = tb.keyed_texts(docs)
    spans = repeated_spans(texts, **settings)
    done = texts.join(spans, "key", "left").select("key", "text", "spans").mapInArrow(
        _remove, f"key {tb.KEY_TYPE}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                 "kept_sha256 string, kept binary")
    return done.select("key", F.col("key.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                       "kept_sha256", "kept")
