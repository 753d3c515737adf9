"""Prefix trie of conversations by fixed-length block hashing.

A conversation c is rebuilt from the first h turns of conversation c - c % 20 and its own turns after
its first h (h = crc32 of the decimal id, modulo 4). A node is a sequence of first turns that some
conversation starts with; its members are all that do.

Method: turns are cut into blocks of `BLOCK`. Conversations are grouped by the digests of successive
blocks: a group is a distinct block below a distinct sequence of blocks, with the number of its
members and the least of them, so that members are counted once a block instead of once a turn. Where
all members of a group go on in the same block, the turn boundaries inside hold the same members and
are read off that block. Only where siblings diverge are boundaries refined: the sibling blocks, each
standing for all its members, are grouped by the digests of their first turns. Grouping is by digests
of 128 bits: the exclusive-or of one value per turn, made of its place and the MD5 of role and text, so
that a digest of many turns is an aggregate and a long conversation can be cut anywhere.

What a subtree sums up needs no walk through it. A node belongs to its least member; the nodes of one
owner are the end of its path. Everything below a node is what its members own, but for what the
node's own owner owns above it, which is a running sum along that path.

Scale: texts are read twice and never shuffled, only their digests. Turns are numbered in
range partitions, and running values are carried over stripes of `STRIPE` places, so that a
conversation with a third of all turns is spread. Groups are aggregated on the map side; joins on
parents, who may have any number of children, read two written tables and can be split. The ids that
end at a node are joined in chunks of `CHUNK` ids and hashed as a stream: one node's chunks pass
through one task in order (SHA-256 allows nothing else), which holds one chunk at a time.

Defined cases: rows without conv_id are left out; null turns come first, rows of one turn are
ordered by the MD5 of their role and text (equal ones are interchangeable); null role or text is
empty; a conversation may end up without turns and is a member of the root alone; a table without
conversations gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep_table

BLOCK = 4
STRIPE = 4096
CHUNK = 4096
FAMILY, MOST_SHARED = 20, 3
WORDS = r"[^\x20\x09-\x0D]+"
NODE = ["depth", "a", "b"]


def before(rows: DataFrame, group: str, place: str, fold: Callable, columns: list[str], name: str) -> DataFrame:
    """Adds before_<column>: the fold of a column over the group's rows at smaller places."""
    cut = rows.withColumn("_stripe", F.floor(F.col(place) / STRIPE).cast("long"))
    inside = Window.partitionBy(group, "_stripe").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    local = keep_table(cut.select("*", *[fold(c).over(inside).alias(f"_{c}") for c in columns]), name)
    # one row per stripe; most groups have a single one, which nothing stands before
    stripes = Window.partitionBy(group).orderBy("_stripe").rowsBetween(Window.unboundedPreceding, -1)
    totals = local.groupBy(group, "_stripe").agg(*[fold(c).alias(c) for c in columns])
    earlier = totals.select(group, "_stripe", *[fold(c).over(stripes).alias(f"_all_{c}") for c in columns])
    joined = local.join(earlier.where("_stripe > 0"), [group, "_stripe"], "left")
    for c in columns:
        parts = [F.coalesce(x, F.lit(0).cast("long")) for x in (F.col(f"_{c}"), F.col(f"_all_{c}"))]
        both = parts[0].bitwiseXOR(parts[1]) if fold is F.bit_xor else parts[0] + parts[1]
        joined = joined.withColumn(f"before_{c}", both)
    return joined.select(*rows.columns, *[f"before_{c}" for c in columns])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(c, pos, x, y, words): every turn's place from 1, its digest in two longs, its words."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("digest")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    half = lambda at: F.conv(F.substring("digest", at, 16), 16, -10).cast("long")
    ordered = keep_table(
        turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
            "c", half(1).alias("x"), half(17).alias("y"), "words", F.monotonically_increasing_id().alias("row"))
        .withColumn("part", F.shiftright("row", 33)), "ordered-turns")
    # a conversation is a run of rows in a partition, or in several that follow each other
    runs = ordered.groupBy("c", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("c", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return ordered.join(runs, ["c", "part"]).select(
        "c", (F.col("row") - F.col("first") + F.col("offset") + 1).alias("pos"), "x", "y", "words")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, i, len, x, y, words) of the rebuilt conversations, and (c, len) of all of them."""
    heads = turns.where(f"c % {FAMILY} = 0 AND pos <= {MOST_SHARED}").groupBy(F.col("c").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "x", "y", "words"))).alias("head"))
    shared = F.crc32(F.col("c").cast("string")) % (MOST_SHARED + 1)
    family = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own")).select(
        "c", "own", shared.alias("h"), (F.col("c") - F.col("c") % FAMILY).alias("base"))
    taken = F.slice(F.coalesce("head", F.array().cast(dict(heads.dtypes)["head"])), F.lit(1), F.col("h").cast("int"))
    convs = keep_table(
        family.join(heads, "base", "left").select("c", "h", "own", taken.alias("head")).select(
            "c", "h", "head",
            (F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("len")),
        "conversations")
    first = convs.select("c", "len", F.explode("head").alias("t")).select(
        "c", F.col("t.pos").alias("i"), "len", "t.x", "t.y", "t.words")
    own = turns.join(convs.select("c", "h", "len", F.size("head").alias("taken")), "c").where("pos > h").select(
        "c", (F.col("pos") - F.col("h") + F.col("taken")).alias("i"), "len", "x", "y", "words")
    return first.unionByName(own), convs.select("c", "len")


def block_rows(turns: DataFrame) -> DataFrame:
    """(c, k, len, a, b, end_a, end_b, turns): every block with the digests before and after it."""
    values = turns.select(
        "c", "len", F.floor((F.col("i") - 1) / BLOCK).cast("long").alias("k"), "i", "words",
        F.xxhash64("x", "y", "i").alias("a"), F.xxhash64("i", "y", "x").alias("b"))
    blocks = values.groupBy("c", "k").agg(
        F.min("len").alias("len"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
        F.sort_array(F.collect_list(F.struct("i", "a", "b", "words"))).alias("turns"))
    chained = before(blocks, "c", "k", F.bit_xor, ["a", "b"], "chained-blocks")
    ended = lambda x: F.col(f"before_{x}").bitwiseXOR(F.col(x)).alias(f"end_{x}")
    return keep_table(chained.select(
        "c", "k", "len", F.col("before_a").alias("a"), F.col("before_b").alias("b"), ended("a"), ended("b"), "turns"),
        "blocks")


def _boundaries() -> Column:
    """The turn boundaries of a block: place, digests up to it and up to the turn before, words."""
    def upto(j: Column, x: str) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), j), F.col(x), lambda s, t: s.bitwiseXOR(t[x]))

    return F.explode(F.transform(F.sequence(F.lit(1), F.size("turns")), lambda j: F.struct(
        (F.col("k") * BLOCK + j).alias("depth"), upto(j, "a").alias("a"), upto(j, "b").alias("b"),
        upto(j - 1, "a").alias("up_a"), upto(j - 1, "b").alias("up_b"),
        F.element_at("turns", j)["words"].alias("words")))).alias("t")


def _at_boundaries(groups: DataFrame, folds: dict[str, Callable]) -> DataFrame:
    """Block groups (with `diverges`) to nodes: read off where siblings agree, refined elsewhere."""
    steps = groups.select(*folds, "diverges", _boundaries()).select(*folds, "diverges", "t.*")
    columns = [*NODE, "up_a", "up_b", "words"]
    refined = steps.where("diverges").groupBy(*columns).agg(*[f(c).alias(c) for c, f in folds.items()])
    return steps.where("NOT diverges").select(*columns, *folds).unionByName(refined)


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and chunk: SHA-256 over each node's chunks, comma between them."""
    kind = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
    node, digest = None, None
    for batch in batches:
        out = []
        for *key, ids in zip(*(batch.column(x).to_pylist() for x in (*NODE, "ids")), strict=True):
            if key != node:
                if digest is not None:
                    out.append(dict(zip(kind.names, [*node, digest.hexdigest()], strict=True)))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist(out, kind)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(kind.names, [*node, digest.hexdigest()], strict=True))], kind)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) from the conversations that end at each node."""
    chunks = ends.groupBy(*NODE, F.floor(F.col("c") / CHUNK).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("c")).cast("array<string>"), ",").alias("ids"))
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").mapInArrow(
        _end_hashes, "depth bigint, a bigint, b bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    turns = keep_table(numbered_turns(conversations), "numbered-turns")
    rebuilt, convs = rebuilt_turns(turns)
    blocks = block_rows(rebuilt)
    zero = [F.lit(0).cast("long").alias(x) for x in NODE]

    identity = ["k", "a", "b", "end_a", "end_b"]
    groups = keep_table(blocks.groupBy(*identity).agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("least"), F.first("turns").alias("turns")), "block-groups")
    several = keep_table(groups.groupBy("k", "a", "b").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1")
                         .select("k", "a", "b", F.lit(True).alias("diverges")), "diverging")
    groups = keep_table(groups.join(several, ["k", "a", "b"], "left").withColumn(
        "diverges", F.coalesce("diverges", F.lit(False))), "sibling-blocks")
    found = _at_boundaries(groups, {"n": F.sum, "least": F.min})
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).where("n > 0").select(
        *zero, F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"),
        F.lit(0).cast("long").alias("words"), "n", "least")
    nodes = keep_table(found.unionByName(root), "nodes")

    # what a node is worth itself, and what its owner owns above it
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    valued = nodes.join(children, NODE, "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n") - 1) * F.col("words")).alias("worth"))
    owned = keep_table(before(valued, "least", "depth", F.sum, ["worth"], "valued-nodes"), "owned-nodes")
    owners = keep_table(
        owned.groupBy(F.col("least").alias("c")).agg(
            F.sum("worth").alias("worth"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
        .where("worth > 0 OR leaves > 0"), "owners")

    # what a node's members own, summed up over blocks and boundaries as the members were
    sums = {"worth": F.sum, "leaves": F.sum}
    by_block = blocks.select("c", *identity).join(owners, "c").groupBy(*identity).agg(
        *[f(c).alias(c) for c, f in sums.items()])
    with_sums = groups.join(by_block, identity, "left").withColumns(
        {c: F.coalesce(c, F.lit(0).cast("long")) for c in sums})
    below = _at_boundaries(with_sums, sums).select(
        *NODE, F.col("worth").alias("all_worth"), F.col("leaves").alias("n_leaves"))
    whole = owners.agg(F.coalesce(F.sum("worth"), F.lit(0)).alias("all_worth"), F.sum("leaves").alias("n_leaves"))
    below = keep_table(below.unionByName(whole.select(*zero, "all_worth", "n_leaves").where("n_leaves > 0")), "below")

    ends = blocks.where(F.col("k") * BLOCK + F.size("turns") == F.col("len")).select(
        F.col("len").alias("depth"), F.col("end_a").alias("a"), F.col("end_b").alias("b"), "c")
    hashes = end_hashes(ends.unionByName(convs.where("len = 0").select(*zero, "c")))

    # a parent may have a third of all nodes as children: two written tables, so the join can be split
    above = keep_table(nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"),
                                    F.col("b").alias("up_b"), F.col("least").alias("parent_conv_id")), "parents")
    placed = keep_table(owned.join(above, ["depth", "up_a", "up_b"], "left"), "placed-nodes")
    return placed.join(below, NODE).join(hashes, NODE, "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        "n_leaves", (F.col("all_worth") - F.col("before_worth")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
