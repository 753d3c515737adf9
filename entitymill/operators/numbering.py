"""Row numbers, top-k and quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(df: DataFrame, order: str, stride: int = 1_000_000, name: str = "row_number") -> DataFrame:
    """1-based number by a unique integer column, without pulling all rows into one task.

    Rows are cut into strides of the order column; the strides' counts are summed up, and the
    rows are numbered inside their stride. A stride can hold at most `stride` rows.
    """
    cut = df.withColumn("_stride", F.floor(F.col(order) / stride).cast("long"))
    sizes = cut.groupBy("_stride").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_stride").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_stride", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_stride").orderBy(order)
    return (
        cut.join(offsets, "_stride")
        .withColumn(name, F.row_number().over(inside) + F.col("_offset"))
        .drop("_stride", "_offset")
    )


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows; the order must end in a unique column."""
    return df.orderBy(*order).limit(n)


def quota_per_group(df: DataFrame, quotas: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """The first q rows of every group, q from a small quota table.

    `most` is the largest quota: each task first keeps its own `most` best per hash slice of a
    group, so that a huge group is cut down before it meets in one task.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(order), F.lit(64)))
    part = Window.partitionBy(group, "_slice").orderBy(order)
    few = sliced.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= most)
    whole = Window.partitionBy(group).orderBy(order)
    ranked = few.drop("_slice", "_r").withColumn("rank_in_group", F.row_number().over(whole))
    return ranked.join(quotas, group).where(F.col("rank_in_group") <= F.col("quota"))


def newest_per_group(
    df: DataFrame, group: str, order: list[Column], unique: str, n: int, slices: int = 64
) -> DataFrame:
    """The first n rows of every group. Hash slices of a group are cut to n rows each first."""
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(unique), F.lit(slices)))
    few = sliced.withColumn(
        "_r", F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order))
    ).where(F.col("_r") <= n)
    return (
        few.drop("_slice", "_r")
        .withColumn("rank_in_group", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
        .where(F.col("rank_in_group") <= n)
    )
