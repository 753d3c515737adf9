"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    broadcast: bool = True,
) -> DataFrame:
    """Join many rows to a table with one row per key, splitting the hot keys.

    Adaptive execution splits a skewed shuffle only when the join reads two bare shuffles; here
    the table is an aggregate on the same key, so the split is done by hand. Keys with more
    than `hot_rows` rows get as many salts as they hold multiples of it, and only their table
    rows are repeated. At most rows/hot_rows keys can be hot, which bounds the broadcast.

    broadcast: the table may be broadcast where Spark takes it for small; not for one whose size
    as a file (packed, compressed) says little of its size in memory.
    """
    hot = (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(key, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    left = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), salts).cast("int"))
        .drop("_salts")
    )
    right = (
        table.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return left.join(right if broadcast else right.hint("merge"), [key, "_salt"], how).drop("_salt")
