"""The two name similarities. Spark has neither, so both run as Arrow-batched pandas UDFs.

They are meant for candidate pairs only; operators/pairs.py finds those with joins.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of a."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.DoubleType())
def _matching_blocks_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)],
        dtype="float64",
    )


@F.pandas_udf(T.LongType())
def _lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [_common_subsequence(x, y) if x and y else 0 for x, y in zip(a, b)], dtype="int64"
    )


def block_ratio(new: Column, known: Column) -> Column:
    """Matching-blocks ratio 0..1; the order of the two names matters, 0 if one is missing."""
    return _matching_blocks_ratio(new, known)


def indel_ratio(a: Column, b: Column) -> Column:
    """200 * LCS / (len a + len b), 0..100, 0 if one side is missing."""
    size = F.length(a) + F.length(b)
    return F.coalesce(F.lit(200.0) * _lcs_length(a, b) / F.nullif(size, F.lit(0)), F.lit(0.0))
