"""Searches among similar names of a block whose answer is less than all similar pairs.

The first or the most similar known name of every new one, or links that connect what is similar, are
at most one row per name and tile, while the similar pairs of a block may grow with its square. So the names of a
block meet in tiles: `CHUNK` new names are held as arrays, the block's known names stream past them in
their order. Names meet if length and letter counts (see pairs.py) allow the threshold, which is lossless;
only these are compared letter by letter. A new name leaves the tile's work once it has its answer.

Comparisons of letter counts grow with the new names times the known ones that are looked at; tiles bound the memory
of a task and spread a hot block. With many known names the least ones come first, and only new names
without an answer meet the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..session import keep_table, setting
from .cluster import connected_components
from .pairs import SLACK, letter_counts
from .skew import lookup_join

CHUNK = 4096
SLICE = 64
# with more known names than this the least sixteenth of them is looked at first
FIRST_KNOWN = 100_000


def _common(where: dict[str, int], size: int, other: str) -> int:
    """Length of the longest common subsequence with a name of `size` letters, given their places as bits."""
    full = (1 << size) - 1
    row = full
    for ch in other:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _places(name: str) -> dict[str, int]:
    where: dict[str, int] = {}
    for i, ch in enumerate(name):
        where[ch] = where.get(ch, 0) | (1 << i)
    return where


def _ratio(new: str, known: str, where: dict[str, int], kind: str, threshold: float) -> float:
    """The ratio (indel: 0..100, block: 0..1) if it reaches the threshold, else -1."""
    size = len(new) + len(known)
    common = _common(where, len(new), known)
    if kind == "indel":
        ratio = 200.0 * common / size
        return ratio if ratio >= threshold * 100.0 else -1.0
    if 2 * common < threshold * size - SLACK:  # matching blocks are a common subsequence
        return -1.0
    ratio = SequenceMatcher(None, new, known).ratio()
    return ratio if ratio >= threshold else -1.0


@pandas_udf(T.StructType([T.StructField("high", T.LongType()), T.StructField("low", T.LongType())]))
def _letters(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([letter_counts(n) for n in batch], columns=["high", "low"])


def _with_letters(df: DataFrame) -> DataFrame:
    rows = df.where("block IS NOT NULL AND name <> ''")
    return rows.withColumn("x", _letters("name")).select(*rows.columns, "x.*")


class _Chunk:
    """The new names of a tile; subclasses say what a similar known name does."""

    def __init__(self, rows: list[tuple], kind: str, threshold: float):
        # rows: name, high, low, at, grp
        self.kind, self.threshold = kind, threshold
        self.names = [r[0] for r in rows]
        self.high, self.low = (np.array([r[i] for r in rows], np.int64).view(np.uint64) for i in (1, 2))
        self.at = np.array([r[3] for r in rows], np.int64)
        self.group = np.array([r[4] for r in rows], np.int64)
        self.size = np.array([len(n) for n in self.names], np.int64)
        self.places: dict[int, dict[str, int]] = {}
        self.active = np.arange(len(rows))
        longest = 2 * max(map(len, self.names))
        self._allow(longest)

    def _allow(self, longest: int) -> None:
        total = np.arange(longest + 1)
        self.most = np.minimum(np.floor(total * (1.0 - self.threshold) + SLACK), 255).astype(np.uint8)

    def ratio(self, i: int, known: str) -> float:
        where = self.places.get(i)
        if where is None:
            where = self.places[i] = _places(self.names[i])
        return _ratio(self.names[i], known, where, self.kind, self.threshold)

    def meet(self, names: list[str], high: np.ndarray, low: np.ndarray, at: np.ndarray, group: np.ndarray) -> None:
        """Known names in the order of `at`."""
        size = np.array([len(n) for n in names], np.int64)
        if len(names) and len(self.most) <= int(size.max()) + int(self.size.max()):
            self._allow(int(size.max()) + int(self.size.max()))
        self.regroup(group)
        for start in range(0, len(names), SLICE):
            here = slice(start, start + SLICE)
            a = self.active
            if not len(a):
                return
            apart = np.bitwise_count(self.high[a] ^ high[here, None]) + np.bitwise_count(self.low[a] ^ low[here, None])
            fits = apart <= self.most[self.size[a] + size[here, None]]
            fits &= self.open(a, at[here, None], here)
            for k, j in zip(*(x.tolist() for x in np.nonzero(fits)), strict=True):
                self.look(int(a[j]), start + k, names, at, int(apart[k, j]))
            self.settle(int(at[min(start + SLICE, len(names)) - 1]))

    def regroup(self, group: np.ndarray) -> None:
        pass

    def settle(self, at: int) -> None:
        pass


class _First(_Chunk):
    """The known name of the least `at` below the new one's; among equals of `at` the least ratio."""

    def __init__(self, *args):
        super().__init__(*args)
        self.found: dict[int, tuple[int, float]] = {}

    def open(self, a, at, here):
        return at < self.at[a]

    def look(self, i, k, names, at, apart):
        before = self.found.get(i)
        if before is None or before[0] == at[k]:
            ratio = self.ratio(i, names[k])
            if ratio >= 0 and (before is None or ratio < before[1]):
                self.found[i] = (int(at[k]), ratio)

    def settle(self, at):
        if self.found:
            done = np.array([i for i in self.active.tolist() if i in self.found and self.found[i][0] < at], np.int64)
            if len(done):
                self.active = np.setdiff1d(self.active, done, assume_unique=True)

    def result(self):
        return [(self.names[i], at, ratio) for i, (at, ratio) in self.found.items()]


class _Best(_First):
    """The most similar known name; ties go to the least `at`."""

    def look(self, i, k, names, at, apart):
        before = self.found.get(i)
        size = len(self.names[i]) + len(names[k])
        # known names come in the order of `at`: only a higher ratio counts
        if before is None or 100.0 * (size - apart) / size > before[1]:
            ratio = self.ratio(i, names[k])
            if ratio >= 0 and (before is None or ratio > before[1]):
                self.found[i] = (int(at[k]), ratio)

    def settle(self, at):
        done = np.array([i for i in self.active.tolist() if i in self.found and self.found[i][1] >= 100.0], np.int64)
        if len(done):
            self.active = np.setdiff1d(self.active, done, assume_unique=True)


class _Joined(_Chunk):
    """Links to known names of a lesser `at` and another group, as many as connect the groups that meet here."""

    def __init__(self, *args):
        super().__init__(*args)
        self.moved: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def _root(self, group: int) -> int:
        while group in self.moved:
            group = self.moved[group]
        return group

    def regroup(self, group):
        values, place = np.unique(group, return_inverse=True)
        self.here = np.array([self._root(g) for g in values.tolist()], np.int64)[place]

    def open(self, a, at, here):
        return (at < self.at[a]) & (self.group[a] != self.here[here, None])

    def look(self, i, k, names, at, apart):
        old, new = int(self.here[k]), int(self.group[i])
        if old != new and self.ratio(i, names[k]) >= 0:
            self.links.append((int(self.at[i]), int(at[k])))
            self.moved[new] = old
            self.group[self.group == new] = old
            self.here[self.here == new] = old


class _All(_Chunk):
    """All similar pairs of different names."""

    def __init__(self, *args):
        super().__init__(*args)
        self.pairs: list[tuple[str, int, float]] = []

    def open(self, a, at, here):
        return self.at[a] != at

    def look(self, i, k, names, at, apart):
        ratio = self.ratio(i, names[k])
        if ratio >= 0:
            self.pairs.append((self.names[i], int(at[k]), ratio))

    def result(self):
        return self.pairs


def _search(chunk_type: type[_Chunk], kind: str, threshold: float, joined: bool) -> Callable:
    columns = ["block", "u", "v"] if joined else ["block", "name", "at", "ratio"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by tile, new names before known ones and these by `at`; one chunk is held at a time."""
        tile, waiting, chunk = None, [], None

        def results() -> Iterator[pa.RecordBatch]:
            if chunk is None:
                return
            if joined:
                u, v = (pa.array([x[i] for x in chunk.links], pa.int64()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array([tile[0]] * len(u), pa.string()), u, v], columns)
            else:
                out = chunk.result()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tile[0]] * len(out), pa.string()), pa.array([r[0] for r in out], pa.string()),
                     pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.float64())], columns)

        for batch in batches:
            if not len(batch):
                continue
            blocks, chunks, sides, names = (batch.column(c).to_pylist() for c in ("block", "chunk", "side", "name"))
            high, low, at, group = (batch.column(c).to_numpy() for c in ("high", "low", "at", "grp"))
            marks = list(zip(blocks, chunks, sides, strict=True))
            starts = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
            for low_end, high_end in zip(starts[:-1], starts[1:], strict=True):
                here = slice(low_end, high_end)
                if marks[low_end][:2] != tile:
                    yield from results()
                    tile, waiting, chunk = marks[low_end][:2], [], None
                if marks[low_end][2] == 0:
                    waiting += zip(names[here], high[here].tolist(), low[here].tolist(), at[here].tolist(),
                                   group[here].tolist(), strict=True)
                    continue
                if chunk is None and waiting:
                    chunk = chunk_type(waiting, kind, threshold)
                if chunk is not None:
                    chunk.meet(names[here], high[here].view(np.uint64), low[here].view(np.uint64), at[here], group[here])
        yield from results()

    return run


def _tiles(new: DataFrame, known: DataFrame) -> DataFrame:
    """(block, chunk, side, name, high, low, at, grp): chunks of new names (side 0), each with all known ones (1)."""
    columns = ["block", "name", "high", "low", "at", "grp"]
    many = new.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    asked = lookup_join(new, many, "block", "name").withColumn(
        "chunk", F.pmod(F.xxhash64("name"), F.col("chunks")).cast("int"))
    held = lookup_join(known, many, "block", "name").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return asked.select("chunk", F.lit(0).alias("side"), *columns).unionAll(
        held.select("chunk", F.lit(1).alias("side"), *columns))


def _run(new: DataFrame, known: DataFrame, threshold: float, kind: str, chunk_type: type[_Chunk], name: str) -> DataFrame:
    joined = chunk_type is _Joined
    schema = "block string, u bigint, v bigint" if joined else "block string, name string, at bigint, ratio double"
    # the work of a tile grows with the pairs, not with the bytes: small partitions must not be merged
    with setting(new.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        tiled = _tiles(new, known).repartition("block", "chunk").sortWithinPartitions("block", "chunk", "side", "at")
        return keep_table(tiled.mapInArrow(_search(chunk_type, kind, threshold, joined), schema), name)


def _prepared(new: DataFrame, known: DataFrame, group: bool = False) -> tuple[DataFrame, DataFrame]:
    last = F.lit((1 << 63) - 1)
    parts = []
    for df in (new, known):
        at = F.coalesce(F.col("at").cast("long"), last) if "at" in df.columns else last
        grp = F.col("grp").cast("long") if group else F.lit(0).cast("long")
        parts.append(keep_table(_with_letters(df.select(
            F.col("block").cast("string").alias("block"), "name", at.alias("at"), grp.alias("grp"))), "tile-names"))
    return parts[0], parts[1]


def first_similar(new: DataFrame, known: DataFrame, threshold: float, kind: str) -> DataFrame:
    """(block, name, at, ratio): the least `at` of a known name similar to the new one, for each that has any.

    new: distinct block, name and maybe at, then only known names of a lesser one count. known: block, name, at.
    kind: block (new name first) or indel; an empty name is similar to nothing.
    """
    new, known = _prepared(new, known)
    if known.count() <= FIRST_KNOWN:
        return _run(new, known, threshold, kind, _First, "first-similar")
    cut = known.approxQuantile("at", [1 / 16], 0.01)[0]
    early = _run(new, known.where(F.col("at") <= cut), threshold, kind, _First, "first-similar")
    rest = new.join(early.select("block", "name"), ["block", "name"], "left_anti")
    return early.unionAll(_run(rest, known.where(F.col("at") > cut), threshold, kind, _First, "first-similar"))


def similar_pairs(named: DataFrame, threshold: float, kind: str) -> DataFrame:
    """(block, name, other): all pairs of different names of a block that are similar, by their number quadratic.

    named: distinct block, name and at, which no two names of a block share.
    """
    named = keep_table(named.select("block", "name", "at"), "named")
    found = _run(*_prepared(named, named), threshold, kind, _All, "similar-pairs")
    return found.select("block", "name", "at").join(
        named.select("block", F.col("name").alias("other"), "at"), ["block", "at"]).select("block", "name", "other")


def most_similar(new: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(block, name, at, ratio): of the known names with the highest Indel ratio the least `at`."""
    new, known = _prepared(new, known)
    return _run(new, known, threshold, "indel", _Best, "most-similar")


def similar_links(named: DataFrame, links: DataFrame, threshold: float, kind: str) -> DataFrame:
    """(u, v) links that connect all names of a block that are similar, the later one taken as the new one.

    named: distinct block, name and at, the id of a node. links: (u, v) known already; what they connect is
    not compared. First every name is linked to the first similar one before it, which
    connects nearly all; then names of different components are compared.
    """
    named = keep_table(named.select("block", "name", F.col("at").cast("long").alias("at")), "named")
    early = first_similar(named, named, threshold, kind)
    early = named.withColumnRenamed("at", "u").join(early, ["block", "name"]).select("u", F.col("at").alias("v"))
    early = keep_table(early, "early-links")
    nodes = reduce(DataFrame.unionAll, [named.select(F.col("at").alias("id")), *(
        links.select(F.col(c).cast("long").alias("id")) for c in ("u", "v"))]).distinct()
    groups = keep_table(connected_components(nodes, links.select("u", "v").unionAll(early)), "name-groups")
    placed = named.join(groups.select(F.col("id").alias("at"), F.col("component").alias("grp")), "at")
    # a block of one component has nothing left to compare, nor have two names of its largest one
    sizes = placed.groupBy("block", "grp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("block").agg(F.count(F.lit(1)).alias("groups"), F.max(F.struct("n", "grp")).alias("top"))
    placed = keep_table(
        placed.join(largest.where("groups > 1").select("block", F.col("top.grp").alias("top")), "block")
        .select("block", "name", "at", "grp", (F.col("grp") == F.col("top")).alias("in_top")), "mixed-names")
    new, known = _prepared(_sided(placed, False), _sided(placed, True), group=True)
    return early.unionAll(_run(new, known, threshold, kind, _Joined, "cross-links").select("u", "v"))


def _sided(placed: DataFrame, known: bool) -> DataFrame:
    """Every block as two: names of its largest component meet the others, the others meet all.

    One component may hold most of a block; its names need not meet, nor be sent to, one another.
    """
    to_top, to_rest = (F.concat("block", F.lit(f"|{half}")) for half in ("top", "rest"))
    if known:
        halves = F.array_compact(F.array(F.when(~F.col("in_top"), to_top), to_rest))
    else:
        halves = F.array(F.when(F.col("in_top"), to_top).otherwise(to_rest))
    return placed.select(F.explode(halves).alias("block"), "name", "at", "grp")
