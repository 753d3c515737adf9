"""Writers for the file shapes that consumers of the marts expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Chosen columns in order; other columns are left out, absent ones are written empty."""
    present = [
        F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns
    ]
    df.select(*present).write.option("header", True).option("escape", '"').csv(path)


def write_json_with_header(df: DataFrame, path: str, **header: object) -> None:
    """Records as JSON lines, next to a one-row header with the totals of what was written."""
    df.write.json(f"{path}/records")
    # a record is a line; the plan of df does not run again
    head = df.sparkSession.read.text(f"{path}/records").agg(F.count(F.lit(1)).alias("total_records"))
    head.select("*", *[F.lit(v).alias(k) for k, v in header.items()]).write.json(f"{path}/metadata")


def write_per_value(df: DataFrame, path: str, column: str) -> None:
    """One folder per value of the column, such as one per tier."""
    df.write.partitionBy(column).option("header", True).csv(path)
