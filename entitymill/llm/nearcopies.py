"""Near copies of documents: similarity of their word shingles, compared exactly.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a text's shingles are the set of its runs of
`SHINGLE` words, a text of fewer words is one shingle. Two texts are near copies if their sets have
a Jaccard similarity of `SIMILAR_OF` / `SIMILAR_PARTS` = 0.8 or more. Groups are what such pairs
connect.

Candidates come from SimHash first: fingerprints of the same shingles (`simhash`), linked at three or fewer
differing bits by their Golay keys, find the nearest copies. At a similarity of 0.8 two fingerprints differ in
ten bits on average, in up to eighteen, so candidates also meet on bands of `ROWS` minima of the shingles'
hashes. Both kinds are compared exactly. Of two texts at
0.8 one pair in eight million shares none of the `BANDS` bands, at 0.85 one in 10^10; this is the
only approximation. Shingle equality is that of 64-bit hashes, set equality likewise.

Comparison: equal sets are one class first. Classes of one fingerprint are compared with the least of them,
and the least ones of linked fingerprints with each other. In each band the member that meets most others is
compared with all; then, wherever a band still holds members of different groups, its members' sets
go to one task, or to tiles of two chunks each if they are many, and are compared in arrays across the
groups. Only links that connect something leave the task, never pairs. So every candidate pair is
compared or already connected.

Scale: of each text its bands leave the scan. Texts are shuffled once, and only those that meet
another are kept with their shingles. A task holds two chunks of `CHUNK_SHINGLES` shingles; bands with
the same members are one. A band of very many unlike texts of unlike groups is the one case whose
comparisons (not rows of pairs) grow with its square, spread over its tiles.

Defined cases: texts without words are one class; a group's first row is that of the smallest
doc_id, null last, then the smallest hash of the text; rows with the same key are one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cluster import connected_components
from ..session import keep_table
from . import simhash
from . import textbytes as tb

SHINGLE = 5
SIMILAR_OF, SIMILAR_PARTS = 4, 5
BANDS, ROWS = 40, 5
CHUNK_SHINGLES = 1 << 19

_FACTORS = tb.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) << np.uint64(32)) | np.uint64(1)


def _shingles(data: np.ndarray, offsets: np.ndarray, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row of a slice."""
    data = tb.lower_ascii()[data]
    starts, ends, first = tb.word_bounds(data, offsets, tb.not_blank())
    words = tb.word_hashes(data, starts, ends, tb.byte_values())
    runs = tb.window_hashes(words, shingle)
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= shingle:
            out.append(np.unique(runs[low : high - shingle + 1]))
        else:  # no words, or all of them as one run
            out.append(tb.window_hashes(words[low:high], high - low) if high > low else np.zeros(0, np.uint64))
    return out


def _bands(sets: list[np.ndarray]) -> np.ndarray:
    """(rows, BANDS) keys; sets must not be empty."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for at, factor in enumerate(_FACTORS):
        band = at // ROWS
        keys[:, band] = tb.mix(keys[:, band] * np.uint64(3) + np.minimum.reduceat(joined * factor, starts)
                               + np.uint64(band))
    return keys


def _sketch(shingle: int):
    kind = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tb.slices(batch.column("text")):
                sets = _shingles(data, offsets, shingle)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [[]] * len(sets)
                if full:
                    for i, keys in zip(full, _bands([sets[i] for i in full]).view(np.int64), strict=True):
                        bands[i] = keys
                ids = [int(tb.mix(np.bitwise_xor.reduce(tb.mix(s), keepdims=True) + np.add.reduce(s))[0]) if len(s)
                       else 0 for s in sets]
                texts = batch.column("text").slice(low, high - low).to_pylist()
                prints = np.fromiter((simhash.fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(low, high - low), pa.array(np.array(ids, np.uint64).view(np.int64)),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(bands, kind), pa.array(prints.view(np.int64))],
                    ["key", "id", "n", "bands", "fp"])

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tb.slices(batch.column("text")):
                sets = [s.view(np.int64) for s in _shingles(data, offsets, shingle)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, high - low), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    return run


def order(key: str = "key") -> Column:
    """Order of rows: doc_id with null last, then the hash of the text."""
    return F.struct(F.col(key)["doc_id"].isNull().alias("absent"), F.col(key).alias("key"))


def _fits(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(a, b) * SIMILAR_PARTS >= F.greatest(a, b) * SIMILAR_OF


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (u, v) of pairs whose sets are similar."""
    one, two = (sets.select(F.col("id").alias(x), F.col("shingles").alias(f"of_{x}")) for x in "uv")
    shared = F.size(F.array_intersect("of_u", "of_v"))
    # shared / (u + v - shared) >= 4 / 5, without a division
    alike = shared * (SIMILAR_OF + SIMILAR_PARTS) >= (F.size("of_u") + F.size("of_v")) * SIMILAR_OF
    return pairs.join(one.hint("merge"), "u").join(two.hint("merge"), "v").where(alike).select("u", "v")


def _simhash_pairs(classes: DataFrame) -> DataFrame:
    """(u, v): classes (id, n, fp) of the same or of linked fingerprints, at most one pair per class and link."""
    least = keep_table(classes.where("n > 0").groupBy("fp").agg(F.min(F.struct("id", "n")).alias("r")), "fingerprints")
    same = classes.join(least, "fp").select(F.col("id").alias("u"), "n", F.col("r.id").alias("v"), F.col("r.n").alias("m"))
    one, two = (least.select(F.col("fp").alias(c), F.col("r.id").alias(x), F.col("r.n").alias(size))
                for c, x, size in (("a", "u", "n"), ("b", "v", "m")))
    linked = simhash.fingerprint_links(least.select("fp")).join(one, "a").join(two, "b").select("u", "n", "v", "m")
    return same.where("u <> v").unionAll(linked).where(_fits("n", "m")).select("u", "v")


def _tiles(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """(band, one, two, chunk, id, component): the members of a band in tiles of two chunks each.

    A band is cut into chunks of about `CHUNK_SHINGLES` shingles; nearly all are one chunk and one tile.
    """
    chunks = F.ceil(F.col("mass") / CHUNK_SHINGLES).cast("int")
    member = placed.join(mixed, "band").select(
        "band", "id", "component", F.greatest(chunks, F.lit(1)).alias("chunks")).withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    return member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "band", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"), "chunk", "id", "component")


def links_across(ids: np.ndarray, groups: np.ndarray, chunks: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between similar sets of different groups, as many as connect what is linked here.

    Rows of two chunks are compared between the chunks, rows of one chunk with each other. Each set is
    compared in one step with all later ones that it is not yet connected with.
    """
    lengths = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(lengths) - lengths
    marks = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
    tree = np.unique(groups, return_inverse=True)[1]
    two = len(np.unique(chunks)) == 2
    out = []
    for at in range(len(ids) - 1):
        fits = np.minimum(lengths, lengths[at]) * SIMILAR_PARTS >= np.maximum(lengths, lengths[at]) * SIMILAR_OF
        fits &= tree != tree[at]
        fits[: at + 1] = False
        if two:
            fits &= chunks != chunks[at]
        if not fits.any():
            continue
        own = codes[starts[at] : starts[at] + lengths[at]]
        marks[own] = 1
        shared = np.add.reduceat(marks[codes], starts)
        marks[own] = 0
        alike = shared * (SIMILAR_OF + SIMILAR_PARTS) >= (lengths + lengths[at]) * SIMILAR_OF
        for other in np.flatnonzero(fits & alike).tolist():
            if tree[other] != tree[at]:
                out.append((int(ids[at]), int(ids[other])))
                tree[tree == tree[other]] = tree[at]
    return out


def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile to the links that connect its groups; one tile is held at a time."""
    tile, rows = None, []

    def found() -> pa.RecordBatch:
        ids, groups, chunks, sets = zip(*rows, strict=True)
        pairs = np.array(links_across(np.array(ids), np.array(groups), np.array(chunks), list(sets)),
                         np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    for batch in batches:
        tiles = zip(*(batch.column(c).to_pylist() for c in ("band", "one", "two")), strict=True)
        lists = batch.column("shingles")
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        ids, groups, chunks = (batch.column(c).to_pylist() for c in ("id", "component", "chunk"))
        for at, here in enumerate(tiles):
            if here != tile and rows:
                yield found()
                rows = []
            tile = here
            rows.append((ids[at], groups[at], chunks[at], values[ends[at] : ends[at + 1]]))
    if rows:
        yield found()


def first_rows(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(key): of each group of near copies the first row's key."""
    texts = tb.keyed_texts(docs)
    sketch = keep_table(texts.mapInArrow(
        _sketch(shingle), f"key {tb.KEY_TYPE}, id bigint, n bigint, bands array<bigint>, fp bigint"), "sketches")
    classes = keep_table(sketch.groupBy("id").agg(
        F.min(order()).alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("fp").alias("fp")),
        "near-classes")
    alike = keep_table(_simhash_pairs(classes), "simhash-pairs")
    banded = keep_table(classes.select("id", "n", F.explode("bands").alias("band")), "bands")
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = keep_table(banded.join(shared, "band"), "met")
    # texts are looked at again only where they meet another
    busy = keep_table(met.groupBy("id").agg(F.sum("members").alias("degree")), "busy")
    looked_at = busy.select("id").unionAll(alike.select("u")).unionAll(alike.select("v")).distinct()
    wanted = classes.join(looked_at, "id").select("id", F.col("least.key").alias("key"))
    sets = keep_table(
        texts.join(wanted.hint("merge"), "key").select("id", "text")
        .mapInArrow(_sets(shingle), "id bigint, shingles array<bigint>").dropDuplicates(["id"]), "shingle-sets")
    nodes = classes.select("id")

    hubs = met.join(busy, "id").groupBy("band").agg(F.max(F.struct("degree", "id", "n")).alias("hub"))
    stars = met.join(hubs.select("band", F.col("hub.id").alias("v"), F.col("hub.n").alias("m")), "band")
    stars = keep_table(stars.where(F.col("id") != F.col("v")).where(_fits("n", "m")).select(
        F.col("id").alias("u"), "v").distinct(), "stars")
    links = keep_table(_similar(stars.unionAll(alike).distinct(), sets), "star-links")
    groups = keep_table(connected_components(nodes, links), "star-groups")

    # bands that hold several groups: their members are compared across groups, bands of the same members once
    placed = keep_table(met.join(groups, "id").select("band", "component", "id", "n"), "placed")
    mixed = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.sum("n").alias("mass"),
        F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("id")).alias("all_ids")).where("low < high")
    mixed = keep_table(mixed.groupBy("members", "all_ids").agg(
        F.min("band").alias("band"), F.first("mass").alias("mass")).select("band", "mass"), "mixed-bands")
    tiled = keep_table(_tiles(placed, mixed), "tiles")
    more = keep_table(
        tiled.join(sets.hint("merge"), "id").repartition("band", "one", "two").sortWithinPartitions("band", "one", "two")
        .mapInArrow(_tile_links, "u bigint, v bigint").distinct(), "cross-links")
    groups = keep_table(connected_components(nodes, links.unionAll(more)), "near-groups")
    return groups.join(classes.select("id", "least"), "id").groupBy("component").agg(
        F.min("least").alias("least")).select("least.key")
