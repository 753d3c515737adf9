"""Leaders by similar names and exact keys, in bands of positions that grow.

The rows of the first band are decided among themselves. Of a later band the rows that share a key with a kept row
or resemble one go first, and only what is left is compared with each other. So the work follows the
kept rows, not the similar pairs, which may grow with the square of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from .cluster import keep_leaders
from .nametiles import first_similar, similar_pairs
from .skew import lookup_join

FIRST_BAND, GROWTH = 10_000, 4


def _names(rows: DataFrame) -> DataFrame:
    return rows.where("state IS NOT NULL AND fuzzy_name IS NOT NULL").groupBy(
        F.col("state").alias("block"), F.col("fuzzy_name").alias("name")).agg(F.min("pos").alias("at"))


def banded_leaders(
    rows: DataFrame, members: DataFrame, edge_keys: Callable[[DataFrame], DataFrame], threshold: float, kind: str,
) -> DataFrame:
    """(pos, kept) as keep_leaders would decide with all edges between similar names.

    rows: pos, state, fuzzy_name. members: pos, key, with a key for equal names. edge_keys turns pairs (block, name,
    other) into the edges (key, other_key); `kind` (block or indel) is the ratio of a later and a kept name.
    """
    rows = keep_table(rows.select("pos", "state", "fuzzy_name"), "leader-rows")
    members = keep_table(members.select("pos", "key").distinct(), "leader-members")
    count, shares = rows.count(), []
    size = FIRST_BAND
    while size < count:
        shares.append(size / count)
        size *= GROWTH
    cuts = sorted({int(x) for x in rows.approxQuantile("pos", shares, 0.001)}) if shares else []
    kept: list[DataFrame] = []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        within = F.lit(True)
        if low is not None:
            within &= F.col("pos") > low
        if high is not None:
            within &= F.col("pos") <= high
        left, keys = rows.where(within), members.where(within)
        if kept:
            leaders = reduce(DataFrame.unionAll, kept)
            held = members.join(leaders, "pos").select("key").distinct()
            hit = keep_table(lookup_join(keys, held, "key", "pos").select("pos").distinct(), "leader-hits")
            left = keep_table(left.join(hit, "pos", "left_anti"), "leader-left")
            near = first_similar(_names(left).drop("at"), _names(rows.join(leaders, "pos")), threshold, kind)
            near = left.join(near.select(F.col("block").alias("state"), F.col("name").alias("fuzzy_name")),
                             ["state", "fuzzy_name"]).select("pos")
            left = keep_table(left.join(near, "pos", "left_anti"), "leader-left")
            keys = keys.join(left.select("pos"), "pos", "left_semi")
        decided = keep_leaders(left, keys, edge_keys(similar_pairs(_names(left), threshold, kind)))
        kept.append(keep_table(decided.where("kept").select("pos"), "leaders"))
    leaders = reduce(DataFrame.unionAll, kept).withColumn("kept", F.lit(True))
    return rows.select("pos").distinct().join(leaders, "pos", "left").select(
        "pos", F.coalesce("kept", F.lit(False)).alias("kept"))


def first_edges(rows: DataFrame, decided: DataFrame, threshold: float, kind: str) -> DataFrame:
    """(block, name, other): of the names of dropped rows the kept name that resembles it and stands first."""
    kept = keep_table(_names(rows.join(decided.where("kept").select("pos"), "pos")), "kept-names")
    asked = _names(rows.join(decided.where("NOT kept").select("pos"), "pos")).drop("at")
    found = first_similar(asked, kept, threshold, kind)
    return found.select("block", "name", "at").join(
        kept.select("block", F.col("name").alias("other"), "at"), ["block", "at"]).select("block", "name", "other")
