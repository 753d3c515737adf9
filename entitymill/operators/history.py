"""Change log, soft deletes, rollback and the import manifest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .numbering import newest_per_group


def _digest_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash, size and rows of each file, from its lines in order; one batch is held at a time.

    The line feed between two lines is hashed with the second one; the file size tells whether
    one follows the last line.
    """
    path, size, digest, taken, rows = None, 0, None, 0, 0

    def finished() -> pa.RecordBatch:
        if taken < size:
            digest.update(b"\n")
        return pa.RecordBatch.from_pydict(
            {"path": [path], "file_hash": [digest.hexdigest()], "size_bytes": pa.array([size], pa.int64()),
             "row_count": pa.array([rows], pa.int64())})

    for batch in batches:
        names = batch.column("path").to_pylist()
        lines = batch.column("line").to_pylist()
        sizes = batch.column("size").to_pylist()
        at = 0
        while at < len(names):
            end = at
            while end < len(names) and names[end] == names[at]:
                end += 1
            if names[at] != path:
                if path is not None:
                    yield finished()
                path, size, digest, taken, rows = names[at], sizes[at], hashlib.sha256(), 0, 0
            piece = b"\n" * (rows > 0) + b"\n".join(lines[at:end])
            digest.update(piece)
            taken += len(piece)
            rows += end - at
            at = end
    if path is not None:
        yield finished()


def file_fingerprints(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """path, file_hash (SHA-256 of the bytes), size_bytes and row_count of each file below path.

    A file may have any size: Spark cuts it at line ends, its lines are put in order again and
    hashed as a stream, as SHA-256 is sequential; different files go to different tasks. Bytes
    that are no UTF-8 and carriage returns count as they are. A file without a byte has no row in
    the result: Spark's readers pass over it. A single line has to fit in memory.
    """
    lines = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"),
        F.col("value").cast("binary").alias("line"))
    return lines.repartition("path").sortWithinPartitions("path", "block", "place").mapInArrow(
        _digest_lines, "path string, file_hash string, size_bytes bigint, row_count bigint")


def not_yet_imported(candidates: DataFrame, manifest: DataFrame, key: str = "file_hash") -> DataFrame:
    return candidates.join(manifest.select(key), key, "left_anti")


def import_records(rows: DataFrame, file: str, merged: str) -> DataFrame:
    """Manifest rows with outcome counts of finished imports."""
    return rows.groupBy(file).agg(
        F.lit("completed").alias("status"), F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~F.col(merged)).alias("rows_new"), F.count_if(F.col(merged)).alias("rows_merged"),
    )


def change_log(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """INSERT, UPDATE and DELETE between two snapshots; an update keeps only the changed fields.

    Values are maps of text. NULL equals NULL and differs from any value.
    """
    both = old.select(key, F.struct(*fields).alias("o")).join(
        new.select(key, F.struct(*fields).alias("n")), key, "full_outer"
    )

    def values(side: str, only_changed: bool) -> Column:
        entries = []
        for f in fields:
            entry = F.struct(F.lit(f).alias("key"), F.col(f"{side}.{f}").cast("string").alias("value"))
            changed = ~F.col(f"o.{f}").eqNullSafe(F.col(f"n.{f}"))
            entries.append(F.when(changed, entry) if only_changed else entry)
        return F.map_from_entries(F.array_compact(F.array(*entries)))

    kind = (
        F.when(F.col("o").isNull(), "INSERT").when(F.col("n").isNull(), "DELETE").otherwise("UPDATE")
    )
    update = kind == "UPDATE"
    logged = both.select(
        key,
        kind.alias("change_type"),
        F.when(update, values("o", True)).when(kind == "DELETE", values("o", False)).alias("old_values"),
        F.when(update, values("n", True)).when(kind == "INSERT", values("n", False)).alias("new_values"),
    )
    return logged.where((F.col("change_type") != "UPDATE") | (F.size("new_values") > 0))


def merge_log(assignments: DataFrame, records: DataFrame, values: list[str]) -> DataFrame:
    """INSERT and MERGE entries of an upsert: which record went to which entity, and its values."""
    entries = F.map_from_entries(
        F.array(*[F.struct(F.lit(v), F.col(v).cast("string")) for v in values])
    )
    kind = F.when(F.col("is_new"), "INSERT").otherwise("MERGE")
    return assignments.join(records, "record_id").select(
        "entity_id", "record_id", kind.alias("change_type"), entries.alias("new_values")
    )


def history_of(log: DataFrame, entity: str, value: int, at: str, payload: str, schema: str) -> DataFrame:
    """The entity's entries, newest first, with the payload read from JSON."""
    return (
        log.where(F.col(entity) == value)
        .withColumn("values", F.from_json(payload, schema))
        .orderBy(F.desc(at))
    )


def soft_delete(entities: DataFrame, doomed: DataFrame) -> DataFrame:
    """Marks live entities of (id, reason) as deleted; rows stay."""
    live = F.coalesce(F.col("is_deleted"), F.lit(0)) == 0
    hit = live & F.col("reason").isNotNull()
    return entities.join(doomed, "id", "left").select(
        *[F.col(c) for c in entities.columns if c != "is_deleted"],
        F.when(hit, 1).otherwise(F.coalesce("is_deleted", F.lit(0))).alias("is_deleted"),
        F.when(hit, F.col("reason")).alias("deletion_reason"),
    )


def rollback(entities: DataFrame, inserted: DataFrame, import_column: str, import_id: str) -> DataFrame:
    """Soft-deletes everything that one import inserted; inserted holds id and the import."""
    doomed = inserted.where(F.col(import_column) == import_id).select("id").distinct()
    return soft_delete(entities, doomed.withColumn("reason", F.lit(f"Rollback of import {import_id}")))


def run_ledger(runs: DataFrame, group: str, at: str, run_id: str, newest: int) -> DataFrame:
    return newest_per_group(runs, group, [F.desc(at), F.desc(run_id)], run_id, newest)
