"""Incremental import of arriving files into a keyed master table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import first_per_key
from ..session import keep_table

BUCKETS = 64
MANIFEST = "path string, file_hash string, row_count bigint, status string, batch int"


def read_arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """Rows of files that arrive in a folder, with the path each came from."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        .withColumn("path", F.col("_metadata.file_path"))
    )


def file_contents(rows: DataFrame) -> DataFrame:
    """(path, file_hash, row_count) of the files that the rows came from.

    The hash is over the file's rows in any order: a file under another name, or written in another
    order, is the same file. Needs the column `path`.
    """
    content = F.struct(*[c for c in rows.columns if c != "path"])
    return rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("row_count"), F.bit_xor(F.xxhash64(content)).alias("x"),
        F.sum(F.xxhash64(F.lit(1), content).cast("decimal(20,0)")).alias("s"),
    ).select("path", "row_count", F.sha2(F.concat_ws("|", "row_count", "x", "s"), 256).alias("file_hash"))


def manifest_of(master: str) -> str:
    """Folder of the manifest: path, file_hash, row_count and status of every file that arrived."""
    return f"{master.rstrip('/')}-manifest"


def import_into_master(
    arriving: DataFrame, master: str, checkpoint: str, key: str, order: str, buckets: int = BUCKETS
) -> None:
    """Takes in all files that wait, keeping the first record of every key.

    `arriving` has the column `path` (see `read_arriving`). Files whose content was taken in before, by
    an earlier batch or by an earlier file of the batch, are skipped; the manifest beside the master says
    what became of every file. Records lie in `buckets` folders by the hash of their key, and a batch reads those
    buckets alone that its keys fall into. Each micro-batch writes its own folders, overwrites them when it
    is run again and only looks at folders of earlier batches, so a restart after a lost executor
    repeats no record and no manifest row.
    """
    manifest = manifest_of(master)
    place = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")

    def take_in(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows = keep_table(rows, "arrived")
        files = file_contents(rows)
        seen = files.select("path", "file_hash", "row_count", F.lit(None).cast("long").alias("done"))
        if batch_id > 0:
            done = spark.read.schema(MANIFEST).parquet(manifest).where(F.col("batch") < batch_id)
            done = done.where("status = 'imported'").groupBy("file_hash").agg(F.min("batch").alias("done"))
            seen = files.join(done, "file_hash", "left")
        first = seen.groupBy("file_hash").agg(F.min("path").alias("first"))
        status = F.when(F.col("done").isNotNull() | (F.col("path") != F.col("first")), "repeated").otherwise("imported")
        marked = keep_table(seen.join(first, "file_hash").select("path", "file_hash", "row_count", status.alias("status")),
                            "marked-files")
        wanted = rows.join(marked.where("status = 'imported'").select("path"), "path", "left_semi").drop("path")
        fresh = keep_table(first_per_key(wanted, [key], order).withColumn("bucket", place), "fresh")
        if batch_id > 0:
            # at most `buckets` numbers
            touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]
            known = spark.read.schema(
                T.StructType([*fresh.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(master).where(
                F.col("bucket").isin(touched) & (F.col("batch") < batch_id)).select("bucket", key)
            fresh = fresh.join(known, ["bucket", key], "left_anti")
        fresh.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(master)
        marked.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(manifest)

    query = (
        arriving.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_master(spark: SparkSession, master: str, schema: T.StructType) -> DataFrame:
    """The records taken in so far, with the columns of schema."""
    return spark.read.schema(schema).parquet(master).select(*schema.names)


def distinct_keys(events: DataFrame, keys: list[str], at: str, within: str) -> DataFrame:
    """First event per key on a stream; state is dropped after the watermark delay."""
    return events.withWatermark(at, within).dropDuplicatesWithinWatermark(keys)


def write_stream(result: DataFrame, path: str, checkpoint: str) -> None:
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def distinct_keys_per_window(events: DataFrame, keys: list[str], at: str, window: str, late_by: str) -> DataFrame:
    """window_start and keys, once for every time window in which an event has them.

    The window is part of what is kept, so its keys leave the state once the watermark, `late_by` behind
    the newest event, has passed its end. Events older than the watermark are dropped.
    """
    return (
        events.withWatermark(at, late_by)
        .select(*keys, F.window(at, window).alias("window"))
        .dropDuplicates([*keys, "window"])
        .select(F.col("window.start").alias("window_start"), *keys)
    )
