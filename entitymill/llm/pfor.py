"""Patched frame of reference: streams of unsigned 32-bit numbers in indexed blocks.

A stream is: count (u64), block size (u32), number of blocks (u32), the start of every block and
of the end as u64 from the end of this index, then the blocks. A block is: least value (u32),
width (u8), number of exceptions (u32), the low `width` bits of (value - least) packed most
significant bit first, then the exceptions as places (u32) and the bits above the width (u32).
The width is the smallest that holds the given share of the block's numbers. Little endian.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 2048
SHARE = 0.95
_HEAD = struct.Struct("<QII")
_BLOCK = struct.Struct("<IBI")


def _encode_block(values: np.ndarray, share: float) -> bytes:
    least = int(values.min())
    above = values - np.uint32(least)
    rank = min(int(np.ceil(share * len(values))), len(values)) - 1
    width = int(np.partition(above, max(rank, 0))[max(rank, 0)]).bit_length()
    places = np.flatnonzero(above >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = np.unpackbits(above.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    packed = np.packbits(bits[:, 32 - width :]).tobytes()
    patches = places.astype("<u4").tobytes()
    if len(places):
        patches += (above[places] >> np.uint32(width)).astype("<u4").tobytes()
    return _BLOCK.pack(least, width, len(places)) + packed + patches


def encode(values: np.ndarray, block: int = BLOCK, share: float = SHARE) -> bytes:
    """The stream of some uint32 numbers."""
    values = np.ascontiguousarray(values, np.uint32)
    blocks = [_encode_block(values[i : i + block], share) for i in range(0, len(values), block)]
    starts = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return b"".join([_HEAD.pack(len(values), block, len(blocks)), starts.tobytes(), *blocks])


def _decode_block(data: memoryview, count: int) -> np.ndarray:
    least, width, patched = _BLOCK.unpack_from(data)
    at = _BLOCK.size
    end = at + (count * width + 7) // 8
    bits = np.zeros((count, 32), np.uint8)
    if width:
        packed = np.frombuffer(data[at:end], np.uint8)
        bits[:, 32 - width :] = np.unpackbits(packed, count=count * width).reshape(count, width)
    above = np.packbits(bits, axis=1).view(">u4").ravel().astype(np.uint32)
    if patched:
        places = np.frombuffer(data[end : end + 4 * patched], "<u4")
        high = np.frombuffer(data[end + 4 * patched : end + 8 * patched], "<u4")
        above[places] |= high << np.uint32(width)
    return above + np.uint32(least)


def decode(stream: bytes, low: int = 0, high: int | None = None) -> np.ndarray:
    """The numbers from place low up to high; only the blocks that hold them are unpacked."""
    data = memoryview(stream)
    count, block, blocks = _HEAD.unpack_from(data)
    high = count if high is None else min(high, count)
    if low >= high:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(data[_HEAD.size : _HEAD.size + 8 * (blocks + 1)], "<u8")
    body = data[_HEAD.size + 8 * (blocks + 1) :]
    first, last = low // block, (high - 1) // block
    parts = [_decode_block(body[int(starts[b]) : int(starts[b + 1])], min(block, count - b * block))
             for b in range(first, last + 1)]
    return np.concatenate(parts)[low - first * block : high - first * block]
