"""Candidate pairs of similar names inside a block, found by joins and without loss.

Both similarities in use are at most 2 * LCS / (a + b), a and b being the name lengths. If that is at
least t, at most k = (1 - t) * (a + b) letters lie outside the common subsequence. Of k + 1 segments of
the longer name that do not overlap, each such letter breaks one at most, so one segment stands
unbroken in the shorter name, shifted by d places where |d| letters were put in or left out before it
and |b - a - d| behind it.

The segments are two-letter grams. Which k + 1 of a name's grams stand for it is a choice by cost: those
that together occur least often, by the counts of the most frequent grams. Only they are joined with
the grams of shorter names; place and length are checked in the join. So are the letters: a letter outside
the common subsequence changes one count of one letter by one, and a name carries its counts, up to
four of each of 32 kinds, as 128 bits of which as many differ. A pair of names is looked at once,
whichever of them is new.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import cut_lineage, keep_table, setting

# counts of so many grams are known to the choice; all others count as rarer than these
COMMON_GRAMS = 4096
SLACK = 1e-9


def _grams(names: DataFrame) -> DataFrame:
    """Rows of names with every two-letter gram (gram) and its place from 0 (pos)."""
    places = F.when(F.length("name") > 1, F.sequence(F.lit(0), F.length("name") - 2))
    return names.withColumn("pos", F.explode(places)).withColumn(
        "gram", F.substring("name", F.col("pos") + 1, F.lit(2)))


def _common_counts(names: DataFrame) -> dict[str, int]:
    """Counts of the most frequent grams; a list of fixed size."""
    rows = (
        _grams(names).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "gram").limit(COMMON_GRAMS).collect()
    )
    return {r.gram: r.n for r in rows}


def cheapest_segments(name: str, wanted: int, counts: dict[str, int], rare: int) -> list[int]:
    """Places of `wanted` grams that do not overlap and together occur least often."""
    costs = [counts.get(name[i : i + 2], rare) for i in range(len(name) - 1)]
    # best[p]: least cost of the grams so far within the first p letters
    best: list[float] = [0.0] * (len(name) + 1)
    taken: list[list[bool]] = []
    for _ in range(wanted):
        row: list[float] = [float("inf")] * (len(name) + 1)
        took = [False] * (len(name) + 1)
        for p in range(2, len(name) + 1):
            here = best[p - 2] + costs[p - 2]
            took[p] = here < row[p - 1]
            row[p] = here if took[p] else row[p - 1]
        best = row
        taken.append(took)
    if best[-1] == float("inf"):
        raise ValueError("the name is too short for so many segments")
    places, p = [], len(name)
    for took in reversed(taken):
        while not took[p]:
            p -= 1
        p -= 2
        places.append(p)
    return places[::-1]


@cache
def segments_needed(length: int, threshold: float) -> int:
    """One more than the letters that a similar name of at most this length can leave out or put in.

    As many as the difference of the lengths, and two for every letter in place of another one.
    """
    most = 0
    for shorter in range(length, 0, -1):
        gap, within = length - shorter, int((1.0 - threshold) * (length + shorter) + SLACK)
        if gap > within:
            break
        most = max(most, within - (within - gap) % 2)
    return most + 1


def letter_counts(name: str) -> tuple[int, int]:
    """Up to four of each of 32 kinds of letters: one bit for each, in two signed longs."""
    seen = [0] * 32
    for letter in name:
        seen[ord(letter) % 32] += 1
    bits = 0
    for n in seen:
        bits = bits << 4 | (1 << min(n, 4)) - 1
    return tuple(x - (1 << 64) if x >> 63 else x for x in (bits >> 64, bits & (1 << 64) - 1))


def _indexed(names: DataFrame, threshold: float) -> DataFrame:
    """Adds the letter counts (high, low) and the places of the grams that stand for the name."""
    counts = _common_counts(names)
    rare = min(counts.values(), default=1)

    @pandas_udf("high bigint, low bigint, places array<int>")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([
                (*letter_counts(n), cheapest_segments(
                    n, segments_needed(len(n), threshold), counts, rare) if len(n) > 1 else [])
                for n in batch], columns=["high", "low", "places"])

    return names.withColumn("x", described("name")).select(*names.columns, "x.*")


def candidate_pairs(new: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(block, new_name, known_name) of all distinct names that may reach the threshold.

    Inputs hold block and name. Equal names in a block are always among the pairs. The pair
    join reads two plain shuffles, so adaptive execution splits a hot (block, gram). Its work
    grows with the pairs, not with the bytes: small partitions must not be merged, and the
    pairs are kept, as they cost more than they hold.
    """
    if threshold <= 0.8:  # at 0.8 "ab" and "axb" are similar without a gram in common
        raise ValueError("the segments are lossless for thresholds above 0.8 only")
    with setting(new.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        return cut_lineage(_meeting_names(new, known, threshold))


def _meeting_names(new: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    named = lambda df, side: df.where("block IS NOT NULL AND name IS NOT NULL").select(
        "block", "name", F.lit(side).alias("side")
    )
    # 1: new, 2: known, 3: both
    names = keep_table(
        named(new, 1).unionAll(named(known, 2)).groupBy("block", "name").agg(F.bit_or("side").alias("side")),
        "names",
    )
    index = keep_table(_indexed(names, threshold), "name-index")
    longer = index.withColumn("pos", F.explode("places")).select(
        "block", F.substring("name", F.col("pos") + 1, F.lit(2)).alias("gram"), F.struct("name", "pos", "side", "high", "low").alias("long"))
    shorter = _grams(index).select("block", "gram", F.struct("name", "pos", "side", "high", "low").alias("short"))
    a, b = F.length("long.name"), F.length("short.name")
    most = F.floor((a + b) * (1.0 - threshold) + SLACK)
    shift = F.col("short.pos") - F.col("long.pos")
    apart = F.bit_count(F.col("long.high").bitwiseXOR(F.col("short.high"))) + F.bit_count(
        F.col("long.low").bitwiseXOR(F.col("short.low")))
    # only a new and a known name meet, and each way of being both meets once
    ways = [((1, 3), (2, 3)), ((2,), (1, 3)), ((3,), (1,))]
    joined = reduce(DataFrame.unionAll, [
        longer.where(F.col("long.side").isin(*long)).join(
            shorter.where(F.col("short.side").isin(*short)), ["block", "gram"])
        # of two equally long names each stands for itself: one of them is enough
        .where((a > b) | ((a == b) & (F.col("long.name") > F.col("short.name"))))
        .where((F.abs(shift) + F.abs(b - a - shift) <= most) & (apart <= most))
        for long, short in ways])
    met = joined.select("block", "long.name", "long.side", F.col("short.name").alias("other"),
                        F.col("short.side").alias("other_side")).distinct()
    named_so = F.array_compact(F.array(
        F.when((F.col("side") != 2) & (F.col("other_side") != 1),
               F.struct(F.col("name").alias("new_name"), F.col("other").alias("known_name"))),
        F.when((F.col("other_side") != 2) & (F.col("side") != 1),
               F.struct(F.col("other").alias("new_name"), F.col("name").alias("known_name")))))
    similar = met.select("block", F.explode(named_so).alias("p")).select("block", "p.new_name", "p.known_name")
    equal = index.where("side = 3").select(
        "block", F.col("name").alias("new_name"), F.col("name").alias("known_name")
    )
    return similar.unionAll(equal)
