"""Clustering by signals: leaders in order (sequential semantics) and connected components."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from .skew import lookup_join

# What the rounds leave for one task: some 100 MB of keys, or 16 MB of links.
FINISH_ROWS = 200_000
FINISH_LINKS = 1_000_000


def keep_leaders(
    positions: DataFrame, members: DataFrame, name_edges: DataFrame | None = None, finish_rows: int = FINISH_ROWS
) -> DataFrame:
    """Decides for every pos whether a sequential scan would keep it.

    A row is dropped when an earlier kept row shares a key with it, or holds a key its own key
    points to. `positions`: pos. `members`: pos, key. `name_edges`: key, other_key, meaning
    that a kept earlier row with other_key drops a row with key.

    This is the lexicographically first independent set. Each round works on the rows that are still
    open, and on the least open and least newly kept position of every key, so no pairs of rows are built:
    rows with nothing open before them are kept, rows behind a kept one are dropped. What is open
    shrinks from round to round; once it has at most `finish_rows` members and edges, one task
    scans the rest in order. So a long chain costs no more rounds than a short one.
    """
    spark = positions.sparkSession
    open_members = keep_table(members.select("pos", "key").distinct(), "open-members")
    empty = spark.createDataFrame([], "key string, other_key string")
    edges = empty if name_edges is None else name_edges.select("key", "other_key").where("key <> other_key").distinct()
    edges = keep_table(edges, "open-edges")
    dropped = []
    # every round decides the first open position at least, so this ends
    while open_members.count() + edges.count() > finish_rows:
        least = _over_edges(open_members.groupBy("key").agg(F.min("pos").alias("at")), edges)
        waits = lookup_join(open_members, least, "key", "pos").groupBy("pos").agg(F.min("at").alias("at"))
        first = keep_table(waits.where("at >= pos").select("pos"), "kept-now")
        kept_at = _over_edges(
            open_members.join(first, "pos").groupBy("key").agg(F.min("pos").alias("at")), edges)
        hit = lookup_join(open_members, kept_at, "key", "pos").where("at < pos").select("pos").distinct()
        hit = keep_table(hit, "dropped-now")
        dropped.append(hit)
        decided = first.unionAll(hit)
        open_members = keep_table(open_members.join(decided, "pos", "left_anti"), "open-members")
        still = open_members.select("key").distinct()
        edges = keep_table(
            edges.join(still, "key", "left_semi").join(still.toDF("other_key"), "other_key", "left_semi")
            .select("key", "other_key"), "open-edges")
    rest = open_members.select("pos", "key", F.lit(None).cast("string").alias("other_key")).unionAll(
        edges.select(F.lit(None).cast("long"), "key", "other_key"))
    dropped.append(keep_table(rest.repartition(1).mapInArrow(_scan_in_order, "pos bigint"), "dropped-last"))
    gone = reduce(DataFrame.unionAll, dropped).select("pos", F.lit(False).alias("kept"))
    return positions.select("pos").distinct().join(gone, "pos", "left").select(
        "pos", F.coalesce("kept", F.lit(True)).alias("kept"))


def _over_edges(least: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, at): the least position of the key itself and of all keys that it points to."""
    over = edges.join(least.withColumnRenamed("key", "other_key"), "other_key").select("key", "at")
    return least.unionByName(over).groupBy("key").agg(F.min("at").alias("at"))


def _scan_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members and edges of the rows that are left, to the positions that a scan in order drops."""
    keys_of, points_to = defaultdict(list), defaultdict(list)
    for batch in batches:
        for pos, key, other in zip(*(batch.column(c).to_pylist() for c in ("pos", "key", "other_key")), strict=True):
            if other is None:
                keys_of[pos].append(key)
            else:
                points_to[key].append(other)
    held, dropped = set(), []
    for pos in sorted(keys_of):
        if any(k in held or any(o in held for o in points_to.get(k, ())) for k in keys_of[pos]):
            dropped.append(pos)
        else:
            held.update(keys_of[pos])
    yield pa.RecordBatch.from_arrays([pa.array(dropped, pa.int64())], ["pos"])


def drop_reasons(
    decided: DataFrame, members: DataFrame, name_edges: DataFrame | None, ranks: dict[str, int]
) -> DataFrame:
    """For dropped rows the strongest signal that hits a kept earlier row.

    Keys carry their signal as prefix up to the first colon; ranks order the signals.
    """
    kept = decided.where("kept").select("pos")
    least = members.join(kept, "pos").groupBy("key").agg(F.min("pos").alias("kept_pos"))
    if name_edges is not None:
        over = name_edges.join(least.withColumnRenamed("key", "other_key"), "other_key")
        least = (
            least.unionByName(over.select("key", "kept_pos"))
            .groupBy("key")
            .agg(F.min("kept_pos").alias("kept_pos"))
        )
    dropped = members.join(decided.where("NOT kept").select("pos"), "pos")
    hits = lookup_join(dropped, least, "key", "pos").where("kept_pos < pos")
    signal = F.split_part("key", F.lit(":"), F.lit(1))
    rank = F.coalesce(*[F.when(signal == s, F.lit(r)) for s, r in ranks.items()])
    best = F.min(F.struct(rank.alias("rank"), signal.alias("reason"), F.col("kept_pos")))
    return hits.groupBy("pos").agg(best.alias("b")).select("pos", "b.reason", "b.kept_pos")


def key_links(members: DataFrame) -> DataFrame:
    """Star links: every row of a key to the least row of that key, never all pairs."""
    least = members.groupBy("key").agg(F.min("id").alias("hub"))
    linked = lookup_join(members.select("id", "key"), least, "key", "id")
    return linked.where("id <> hub").select(F.col("id").alias("u"), F.col("hub").alias("v"))


def connected_components(nodes: DataFrame, links: DataFrame, finish_links: int = FINISH_LINKS) -> DataFrame:
    """(id, component) with the least id of the component."""
    roots = moved_nodes(links, finish_links).select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.select("id").join(roots, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )


def moved_nodes(links: DataFrame, finish_links: int = FINISH_LINKS) -> DataFrame:
    """(u, v): every linked node but the least of its component, and that least one.

    Every round puts the least neighbour in the place of a node, so that only links between
    different nodes stay; rounds that shrink the links little give way to large-star / small-star ones.
    Once there are at most `finish_links` links, one task joins up what they connect.
    """
    pairs = _different(links.select(F.col("u").cast("long"), F.col("v").cast("long")))
    steps, before, n = [], None, pairs.count()
    while n > finish_links and (before is None or 4 * n < 3 * before):
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the joins read bare shuffles and can split a hot node
        step = keep_table(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("place")), "places")
        steps.append(step)
        half = pairs.join(step, "u").select(F.col("place").alias("u"), "v")
        other = step.select(F.col("u").alias("v"), F.col("place").alias("other"))
        pairs = _different(half.join(other, "v").select("u", F.col("other").alias("v")))
        before, n = n, pairs.count()
    found = _star_rounds(pairs, finish_links)
    for step in reversed(steps):
        found = keep_table(
            step.join(found.toDF("place", "least"), "place", "left")
            .select("u", F.coalesce("least", "place").alias("v")).where("u <> v"), "moved")
    return found


def _different(links: DataFrame) -> DataFrame:
    return keep_table(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")


def _star_rounds(pairs: DataFrame, finish_links: int) -> DataFrame:
    """Links (u > v, written) to (node, least node of its component), by large-star / small-star rounds."""
    before = None
    while True:  # links only move to smaller nodes, so this ends
        state = pairs.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("h"),
        ).first()
        if state.n <= finish_links:
            return keep_table(pairs.repartition(1).mapInArrow(_join_up, "u bigint, v bigint"), "stars")
        if state == before:
            return pairs
        before = state
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            lookup_join(both.where("v > u"), low, "u", "v")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup_join(large, least, "u", "v")
        pairs = keep_table(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(), "links"
        )


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links to (node, least node of its component), by arrays of least neighbours and pointer jumps."""
    sides = [[b.column(c).to_numpy() for c in ("u", "v")] for b in batches if len(b)]
    if not sides:
        return
    u, v = (np.concatenate(x) for x in zip(*sides, strict=True))
    ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = place[: len(u)], place[len(u) :]
    root = np.arange(len(ids))
    while len(u):
        one, two = root[u], root[v]
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while not np.array_equal(jump := root[root], root):
            root = jump
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    moved = np.flatnonzero(root != np.arange(len(ids)))
    yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], ["u", "v"])
