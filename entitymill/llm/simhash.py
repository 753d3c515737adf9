"""SimHash near-dedup with Golay-code fuzzy hashing.

The fingerprint of a text has 64 bits: over the XXH64 (seed 42) of its `shingle`-word shingles,
repeats included, a bit is 1 if it is set in more than half of them. Words are
`[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a text of fewer words is one shingle; a text
without words has the fingerprint zero and is linked like any other.

Fingerprints link at `MOST_ERRORS` = 3 or fewer differing bits. They are cut into segments of
22, 21 and 21 bits, each a word of the Golay code (padded with zeros). Three errors fall on three
segments in one of these ways, and each gives keys on which two such fingerprints meet:

- two segments are free of errors: both of them exactly (43 bits);
- one segment is free, another has exactly one error: the free one exactly, and for the other
  the nearby codeword indices, which two words at distance 1 share (34 bits);
- all three have exactly one error: the codeword indices of all three (36 bits).

An odd number of errors flips the parity of a segment, so only words of even weight give all
nearby codewords, odd ones give the nearest. Fingerprints of a key are compared bit by bit;
within a key only links that join something new are reported, never all pairs. Components over
the distinct fingerprints give each document the smallest doc_id that it can reach.

Scale: copies are one fingerprint before anything is compared. About 50 keys of eight bytes per
distinct fingerprint are shuffled, and a task streams through its sorted keys. Only distinct
fingerprints that agree in at least 33 bits of key share one, so a key holds few of them even
where a third of all documents are near copies.

Defined cases: null and empty texts have no words; repeated rows get the same component; a null
doc_id counts as no id for the component, and a component of such rows only has a null id; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cluster import connected_components
from ..session import keep_table
from . import golay
from . import textbytes as tb

SHINGLE = 3
SEED = 42
MOST_ERRORS = 3
_SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift and width


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(len(words) - shingle + 1, 1)
    starts = (ends - lengths)[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=True)], ">u8")
    counts = np.zeros(64, np.int64)
    for low in range(0, n, 200):  # sums of a byte hold 255
        bits = np.unpackbits(hashes[low : low + 200].view(np.uint8).reshape(-1, 8), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("text")), np.uint64,
                                 len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every document row; fp is the fingerprint as a signed long."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_fingerprints(shingle), "doc_id bigint, fp bigint")


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the fingerprint, key) for every key of unsigned fingerprints.

    A key is a 64-bit scramble of its kind and parts; the comparison of what meets is exact.
    """
    words = [(prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
             for shift, width in _SEGMENTS]
    odd = [np.bitwise_count(w.astype(np.uint64)).astype(np.int64) & 1 for w in words]
    codes = []
    for word, parity in zip(words, odd, strict=True):
        near = golay.nearby(word)
        near[parity == 1, 1:] = -1
        codes.append(near)
    places, keys = [], []

    def add(kind: int, exact: np.ndarray, parts: list[np.ndarray]) -> None:
        at = np.arange(len(prints))
        key = tb.mix(exact.astype(np.uint64) + np.uint64((kind + 1) << 52))
        for part in parts:  # every combination of the parts' codewords
            row, column = np.nonzero(part[at] >= 0)
            key = tb.mix(key[row] * np.uint64(3) + part[at[row], column].astype(np.uint64) + np.uint64(1))
            at = at[row]
        places.append(at)
        keys.append(key)

    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        add(kind, words[i] << 22 | words[j], [])
    for kind, (i, j) in enumerate(permutations(range(3), 2)):
        add(3 + kind, words[i], [codes[j]])
    # partners have all parities flipped: count them from the first segment's
    flips = (odd[0] ^ odd[1]) << 1 | (odd[0] ^ odd[2])
    add(9, flips, codes)
    return np.concatenate(places), np.concatenate(keys)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy().view(np.uint64)
        for low in range(0, len(prints), 2000):
            part = prints[low : low + 2000]
            at, keys = fuzzy_keys(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(part[at].view(np.int64))], ["key", "fp"])


def links_within(prints: np.ndarray, most: int = MOST_ERRORS) -> list[tuple[int, int]]:
    """Links between distinct fingerprints of one key that connect all that are linked there.

    A spanning forest: at most one link per fingerprint, found by growing each tree over what is
    not yet reached.
    """
    out = []
    left = prints
    while len(left) > 1:
        grow, left = [left[0]], left[1:]
        while grow and len(left):
            here = grow.pop()
            near = np.bitwise_count(left ^ here) <= most
            if near.any():
                grow += list(left[near])
                out += [(int(here), int(x)) for x in left[near]]
                left = left[~near]
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows sorted by key; the last key of a batch waits for the next batch."""

    def of(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        same = keys[1:] == keys[:-1]
        cuts = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        found = [x for low, high in zip(cuts[::2], cuts[1::2], strict=True)
                 for x in links_within(np.unique(prints[low : high + 1]))]
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        prints = np.concatenate([prints, batch.column("fp").to_numpy().view(np.uint64)])
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if cut:
            yield of(keys[:cut], prints[:cut])
            keys, prints = keys[cut:], prints[cut:]
    yield of(keys, prints)


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """(a, b) links that connect all fingerprints of (fp) within three bits of each other."""
    keyed = prints.select("fp").mapInArrow(_keys, "key bigint, fp bigint")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_links, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document row."""
    found = keep_table(fingerprints(docs, shingle), "fingerprints")
    # nulls last, so that a class without any id still has a place
    classes = keep_table(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    links = keep_table(fingerprint_links(classes), "links")
    groups = keep_table(
        connected_components(classes.select(F.col("fp").alias("id")),
                             links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        .join(classes.select(F.col("fp").alias("id"), "least"), "id"), "groups")
    best = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    # written, so that the joins read bare shuffles and can split a class of many copies
    member = keep_table(groups.join(best, "component").select(F.col("id").alias("fp"), "component_id"), "member")
    return found.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
