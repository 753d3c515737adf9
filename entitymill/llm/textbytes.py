"""Texts of an Arrow batch as one byte array: words, rolling hashes and sliding minima in NumPy.

Everything works on slices of a batch with a few megabytes, so that the arrays stay small
whatever the batch holds. Hashes only choose positions and find candidates; what an operator
reports is compared on the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19
# Positions in the low bits of a minimum's key, hash bits above them.
POSITION_BITS = 24
LONGEST = 1 << 22

KEY_TYPE = "struct<doc_id:bigint,tie:bigint>"


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identifies a row even where doc_id is null or repeated; struct equality is null-safe."""
    return F.struct(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text).cast("string")).alias("tie"),
    ).alias("key")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(key, text) of a documents table, whatever other columns it has."""
    return docs.select(row_key(), F.col("text").cast("string").alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about `limit` bytes."""
    data, offsets = utf8(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def byte_values(seed: int = 1) -> np.ndarray:
    """A 64-bit value for each byte."""
    return mix(np.arange(256, dtype=np.uint64) + np.uint64(seed << 20))


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` values, built from runs of doubling length."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    total, done, power, length = None, 0, values, 1
    while True:
        if size & length:
            if total is None:
                total = power
            else:
                n = len(values) - done - length + 1
                total = mix(total[:n] * np.uint64(2 * length + 1)) + power[done : done + n]
            done += length
        if done == size:
            return mix(total[: len(values) - size + 1] + np.uint64(size))
        power = mix(power[:-length] * np.uint64(2 * length + 1)) + power[length:]
        length *= 2


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value in each window of `width`; the leftmost of equal ones.

    The choice depends on nothing but the values in the window, so equal windows choose alike.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if len(values) > LONGEST + 2 * width:
        cuts = range(0, n, LONGEST)
        return np.concatenate([sliding_argmin(values[c : min(c + LONGEST, n) + width - 1], width) + c for c in cuts])
    low = np.uint64((1 << POSITION_BITS) - 1)
    keys = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    length = 1
    while length * 2 <= width:
        keys = np.minimum(keys[:-length], keys[length:])
        length *= 2
    keys = np.minimum(keys[:n], keys[width - length : width - length + n])
    return (keys & low).astype(np.int64)


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Byte start and end of every word, and the number of the first word of each row.

    is_word: a flag for each byte value. Rows never share a word.
    """
    inside = is_word[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = inside[heads]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    tails = heads if not len(heads) else offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[tails] = inside[tails]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A hash of the bytes of every word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    total = np.cumsum(lengths)
    place = np.arange(total[-1]) - np.repeat(total - lengths, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), 0x5851F42D4C957F2D, np.uint64))
    values = table[data[place + np.repeat(starts, lengths)]] * powers[place]
    return mix(np.add.reduceat(values, total - lengths) + lengths.astype(np.uint64))


def lower_ascii() -> np.ndarray:
    """Byte map that lower-cases A-Z and nothing else."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def alphanumeric() -> np.ndarray:
    """Flags of the bytes of [0-9a-z] and of everything beyond ASCII."""
    flags = np.zeros(256, bool)
    flags[48:58] = flags[97:123] = flags[128:] = True
    return flags


def not_blank() -> np.ndarray:
    """Flags of all bytes but space and tab to carriage return."""
    flags = np.ones(256, bool)
    flags[9:14] = flags[32] = False
    return flags


def minimiser_runs(
    hashes: np.ndarray, bounds: np.ndarray, gram: int, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows that share the place of their least gram.

    hashes: of every gram of `gram` units; bounds: first unit of each row, and the end.
    Returns row, place of the gram, first and last window start, all as places in the slice.
    A row with fewer than `window` units has no window.
    """
    places = sliding_argmin(hashes, window - gram + 1)
    n = len(places)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    row = np.searchsorted(bounds, np.arange(n), "right") - 1
    whole = np.arange(n) + window <= bounds[row + 1]
    starts = np.flatnonzero(whole)
    if not len(starts):
        return starts, starts, starts, starts
    anchor, owner = places[starts], row[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return owner[first], anchor[first], starts[first], starts[last]


def merge_spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open spans as maximal spans; touching ones join."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return low[first], reach[np.append(first[1:], len(low)) - 1]
