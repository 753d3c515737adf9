"""Readers for the file shapes that registries, directories and rankings arrive in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import as_col

COMMA_OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'

# Words in file names, and the keys a JSON payload may sit under.
STATE_FILE_WORDS = {"CA": ["CA", "CALIF"], "FL": ["FL", "FLOR"], "TX": ["TX", "TEXAS"]}
SOURCE_TYPE_WORDS = [
    ("oem_dealer", ["oem", "cummins", "carrier"]),
    ("license_contractor", ["license", "contractor"]),
    ("mep_list", ["mep"]),
]
JSON_LIST_KEYS = ["dealers", "contractors", "data"]
FILE_STAMPS = [
    (r"_([0-9]{8}_[0-9]{6})\.", "yyyyMMdd_HHmmss"),
    (r"_([0-9]{8})\.", "yyyyMMdd"),
    (r"([0-9]{8}_[0-9]{6})_", "yyyyMMdd_HHmmss"),
    (r"([0-9]{8})_", "yyyyMMdd"),
]


def read_header_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """CSV with a header; each path keeps its own column order, columns are united by name."""
    parts = [spark.read.option("header", True).option("escape", '"').csv(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv_skipping_long_rows(
    spark: SparkSession, path: str, columns: list[str], header: bool = True
) -> DataFrame:
    """Rows with more fields than the header are skipped, short rows are filled with NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_overflow"]])
    rows = spark.read.schema(schema).option("header", header).option("escape", '"').csv(path)
    return rows.where("_overflow IS NULL").drop("_overflow")


def read_positional_csv(spark: SparkSession, path: str, meaning: dict[int, str]) -> DataFrame:
    """Headerless CSV whose columns are known by position."""
    width = max(meaning) + 1
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.schema(schema).option("escape", '"').csv(path)
    return rows.select(*[F.col(f"_c{i}").alias(name) for i, name in meaning.items()])


def read_wide_rows(
    spark: SparkSession, path: str, meaning: dict[int, str], fewest: int = 10
) -> DataFrame:
    """As read_positional_csv, but rows with fewer than `fewest` fields are dropped.

    The CSV reader fills short rows up, so the fields are counted on the text line.
    """
    fields = F.split("value", COMMA_OUTSIDE_QUOTES)
    rows = spark.read.text(path).select(fields.alias("f")).where(F.size("f") >= fewest)
    bare = F.regexp_replace
    return rows.select(
        *[
            bare(bare(F.get("f", F.lit(i)), r'^"|"$', ""), '""', '"').alias(name)
            for i, name in meaning.items()
        ]
    )


def read_json_records(
    spark: SparkSession, path: str, record: T.StructType, per_line: bool = False
) -> DataFrame:
    """JSON documents that are a list of records, or hold the list under a known key.

    A file is one document, or holds one per line, which a large file needs to be read in parts.
    """
    nested = [T.StructField(k, T.ArrayType(record)) for k in JSON_LIST_KEYS]
    schema = T.StructType([*record.fields, *nested])
    docs = spark.read.schema(schema).option("multiLine", not per_line).json(path)
    own = F.struct(*[F.col(f.name) for f in record.fields])
    records = F.coalesce(*[F.col(k) for k in JSON_LIST_KEYS], F.array(own))
    return docs.select(F.inline(records))


def newest_file(spark: SparkSession, pattern: str) -> DataFrame:
    """Path and time of the latest matching file; file contents are not read."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    return files.agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path"),
        F.max("modificationTime").alias("modified"),
    )


def newest_checkpoint(names: DataFrame, column: str) -> DataFrame:
    """The name with the highest checkpoint number."""
    number = F.regexp_extract(column, r"checkpoint_([0-9]+)", 1)
    return names.agg(F.max_by(column, F.try_to_number(number, F.lit("999999999"))).alias(column))


def file_stamp(name: str) -> Column:
    """Time stamp in a file name; date only means midnight, no stamp or a bad one is NULL."""
    found = [
        F.try_to_timestamp(F.nullif(F.regexp_extract(name, p, 1), F.lit("")), F.lit(fmt))
        for p, fmt in FILE_STAMPS
    ]
    return F.coalesce(*found)


def file_group(name: str) -> Column:
    stem = F.regexp_replace(as_col(name), r"\.[^.]*$", "")
    return F.regexp_replace(stem, r"_[0-9]{8}(_[0-9]{6})?", "")


def state_of_file(name: str) -> Column:
    stem = F.upper(F.regexp_replace(as_col(name), r"\.[^.]*$", ""))
    result = F.lit(None).cast("string")
    for state, words in reversed(STATE_FILE_WORDS.items()):
        hit = reduce(lambda a, b: a | b, [stem.contains(w) for w in words])
        result = F.when(hit, state).otherwise(result)
    return result


def source_type_of(name: str, first_row_source: str) -> Column:
    lowered = F.lower(as_col(name))
    result = F.coalesce(F.nullif(as_col(first_row_source), F.lit("")), F.lit("unknown"))
    for kind, words in reversed(SOURCE_TYPE_WORDS):
        hit = reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])
        result = F.when(hit, kind).otherwise(result)
    return result


def run_progress(lines: DataFrame, run: str, text: str, total_units: int) -> DataFrame:
    """Units done, records collected and percent of a run from its log lines.

    Both counters only grow within a run, so the last value is the largest.
    """
    step = F.when(
        F.col(text).contains("Scraping ZIP"),
        F.nullif(F.regexp_extract(text, r"\[([0-9]+)/", 1), F.lit("")),
    )
    found = F.when(
        F.col(text).contains("Found") & F.col(text).contains("dealers"),
        F.nullif(F.regexp_extract(text, r"Total:\s*([0-9]+)", 1), F.lit("")),
    )
    return (
        lines.groupBy(run)
        .agg(
            F.coalesce(F.max(step.cast("long")), F.lit(0)).alias("completed"),
            F.coalesce(F.max(found.cast("long")), F.lit(0)).alias("collected"),
        )
        .withColumn("percent", F.col("completed") * F.lit(100.0) / F.lit(float(total_units)))
    )
