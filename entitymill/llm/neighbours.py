"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by a codebook of its own (k-means on a bounded
sample of `SAMPLE` vectors). A cell is a pair of centroids; every vector is an entry of one cell.
A query visits the cells by the sum of its two half distances: a heap walks the pairs of the two
sorted centroid lists in that order (the multi-sequence algorithm) until the cells hold `share` of
all entries and `least` of them. All entries of the visited cells are reranked by the exact
Euclidean distance in double precision on the original vectors.

`share` is what keeps the recall: nearly unclustered vectors of many dimensions have their
neighbours spread over much of the space, so that a fixed number of candidates would lose them as
the table grows. It is a parameter; recall is measured against brute force in the tests.

Scale: equal vectors are one entry with the `top + 1` smallest ids, which is all that ties to
smaller ids can ask for; a vector that a third of all rows share is one entry. Cells are dealt to groups;
a query travels once to each group with the list of cells that it visits there. Entries (of one cell) and queries
travel as blocks of `BLOCK` rows; a task compares block by block in arrays and passes on
the best `top` per query, so neither rows of pairs nor a whole cell exist anywhere. The tables of
centroids and cell sizes are bounded by the codebooks, whatever the data.

Defined cases: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part; fewer candidates than `top` give fewer rows; a query's own
row is no candidate, its copies are; rows with a null id take no part; equal rows count once, an
id with several vectors is a candidate with each; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep_table

CENTROIDS = 32
SAMPLE = 20_000
TOP = 10
SHARE = 0.5
LEAST = 1500
BLOCK = 512
# Rows of a cell that one task cuts into blocks, and floats of one array of differences.
DEALT = 16 * BLOCK
TOGETHER = 4_000_000
# Groups of cells: so many, or more so that one has about as many entries.
GROUPS = 64
GROUP_ENTRIES = 16_384


def usable_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part, v in double precision."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite.alias("v") & F.exists(v, lambda x: x != 0.0))
    return kept


def _most_common_length(vectors: DataFrame) -> int:
    row = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return row["n"] if row else 0


def kmeans(points: np.ndarray, k: int, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Centroids of the points; at most k, and no more than there are points."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        own = np.argmin(_squares(points, centres), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=len(centres))
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances for choosing cells."""
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None]


def _halves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = (points.shape[1] + 1) // 2
    return points[:, :middle], points[:, middle:]


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_codebooks(entries: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> list[np.ndarray]:
    """The two codebooks, from at most `sample` vectors chosen by a hash."""
    rows = entries.orderBy(F.xxhash64("v")).limit(sample).select("v").toArrow()
    return [kmeans(half, centroids) for half in _halves(_matrix(rows.column("v")))]


def visiting_order(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in order of the summed distance until they hold `wanted` entries.

    first, second: distances to the centroids of the halves; sizes: entries of the cell (i, j).
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a], second[b]
    heap, out, held = [(x[0] + y[0], 0, 0)], [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if sizes[cell]:
            out.append(cell)
            held += int(sizes[cell])
        # each pair is reached from one side only
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return out


def _assign(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = books.value
        for batch in batches:
            a, b = (np.argmin(_squares(h, c), axis=1)
                    for h, c in zip(_halves(_matrix(batch.column("v"))), (first, second), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a * len(second) + b), batch.column("ids"), batch.column("v")], ["cell", "ids", "v"])

    return run


def _visit(books, sizes: np.ndarray, wanted: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = books.value
        for batch in batches:
            x, y = (_squares(h, c) for h, c in zip(_halves(_matrix(batch.column("v"))), (first, second), strict=True))
            visits = [np.array(visiting_order(x[i], y[i], sizes, wanted), np.int64) for i in range(len(batch))]
            cells = np.concatenate([np.zeros(0, np.int64), *visits])
            row = np.repeat(np.arange(len(batch)), [len(v) for v in visits])
            order = np.lexsort((cells, cells % groups, row))
            cells, row = cells[order], row[order]
            group = cells % groups
            cuts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(group, prepend=-1) != 0))
            at = pa.array(row[cuts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[cuts]), batch.column("id").take(at), batch.column("v").take(at),
                 pa.ListArray.from_arrays(pa.array(np.append(cuts, len(cells)), pa.int32()), pa.array(cells))],
                ["grp", "id", "v", "cells"])

    return run


def _blocks(rows: DataFrame, key: str, columns: list[str], side: str, salts: int) -> DataFrame:
    """Rows of a key as blocks: a key is dealt to so many tasks, each cuts what it has."""
    salt = F.pmod(F.xxhash64(*columns), F.lit(salts)).alias("salt")
    kinds = ", ".join(f"`{side}_{c}` array<{rows.schema[c].dataType.simpleString()}>" for c in columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by key: each run of a key in a batch, in pieces of a block."""
        for batch in batches:
            keys = batch.column(key).to_numpy()
            edges = np.flatnonzero(np.append(np.insert(keys[1:] != keys[:-1], 0, True), True)) if len(keys) else []
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                for at in range(low, high, BLOCK):
                    part = batch.slice(at, min(BLOCK, high - at))
                    ends = pa.array([0, len(part)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(key).slice(0, 1),
                         *(pa.ListArray.from_arrays(ends, part.column(c)) for c in columns)],
                        [key, *(f"{side}_{c}" for c in columns)])

    dealt = rows.withColumn("salt", salt).repartition(key, "salt").sortWithinPartitions(key).drop("salt")
    return dealt.select(key, *columns).mapInArrow(cut, f"{key} bigint, {kinds}")


def best_in(
    queries: np.ndarray, own: np.ndarray, entries: np.ndarray, ids: np.ndarray, owner: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query place, candidate id and distance of the best `top` in a block, ties to smaller ids.

    ids: candidates, owner: the entry of each.
    """
    out = []
    step = max(TOGETHER // max(entries.size, 1), 1)
    for low in range(0, len(queries), step):
        part = queries[low : low + step]
        distance = np.sqrt(((entries[None] - part[:, None]) ** 2).sum(axis=2))[:, owner].ravel()
        query, flat = np.repeat(np.arange(len(part)), len(ids)), np.tile(ids, len(part))
        keep = np.flatnonzero(flat != own[low + query])
        query, flat, distance = query[keep], flat[keep], distance[keep]
        order = np.lexsort((flat, distance, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[place < top]
        out.append((low + query[order], flat[order], distance[order]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _compare(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                visited = batch.column("query_cells")[row].values
                asker = np.repeat(np.arange(len(visited)), visited.value_lengths().to_numpy())
                here = asker[visited.flatten().to_numpy() == batch.column("cell")[row].as_py()]
                if not len(here):
                    continue
                queries, entries = (_matrix(batch.column(c)[row].values) for c in ("query_v", "entry_v"))
                queries, own = queries[here], batch.column("query_id")[row].values.to_numpy()[here]
                ids = batch.column("entry_ids")[row].values
                owner = np.repeat(np.arange(len(ids)), ids.value_lengths().to_numpy())
                query, found, distance = best_in(queries, own, entries, ids.flatten().to_numpy(), owner, top)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[query]), pa.array(found), pa.array(distance)], ["query_id", "vec_id", "score"])

    return run


def _first_ids(rows: DataFrame, top: int) -> DataFrame:
    """(v, ids): distinct vectors with their top + 1 smallest ids; the limit is pushed before the shuffle."""
    order = Window.partitionBy("v").orderBy("id")
    few = rows.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= top + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def search(
    vectors: DataFrame, queries: DataFrame, top: int = TOP, share: float = SHARE, least: int = LEAST,
    centroids: int = CENTROIDS, sample: int = SAMPLE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest `top` of (id, v) for each query (id, v)."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    length = _most_common_length(vectors)
    if not length:
        return empty
    same = F.size("v") == length
    entries = keep_table(_first_ids(vectors.where(same), top), "entries")
    books = spark.sparkContext.broadcast(fit_codebooks(entries, centroids, sample))
    index = keep_table(entries.mapInArrow(_assign(books), "cell bigint, ids array<bigint>, v array<double>"), "index")
    # centroids squared rows at most
    sizes = np.zeros(len(books.value[0]) * len(books.value[1]), np.int64)
    for r in index.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    wanted = max(int(np.ceil(share * sizes.sum())), least, top + 1)
    asked = queries.where(same).distinct()
    groups = min(max(GROUPS, -(-int(sizes.sum()) // GROUP_ENTRIES)), len(sizes))
    visits = asked.mapInArrow(_visit(books, sizes, wanted, groups), "grp bigint, id bigint, v array<double>, cells array<bigint>")
    # a query is as many rows as it visits groups, which no estimate knows: neither side is ever broadcast
    pairs = _blocks(visits, "grp", ["id", "v", "cells"], "query", -(-asked.count() // DEALT) or 1).join(
        _blocks(index, "cell", ["ids", "v"], "entry", -(-int(sizes.max()) // DEALT))
        .withColumn("grp", F.pmod("cell", F.lit(groups))).hint("merge"), "grp")
    found = pairs.select("cell", "query_id", "query_cells", "query_v", "entry_ids", "entry_v").mapInArrow(
        _compare(top), "query_id bigint, vec_id bigint, score double")
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
