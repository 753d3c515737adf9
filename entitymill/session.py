"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "entitymill", cpus: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: what the session names, else (local runs only) a temp folder.

    On a cluster the folder must be shared storage, so a missing setting is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_KEY, None
    )
    if not configured:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder")
        configured = tempfile.mkdtemp(prefix="entitymill-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise on reliable storage, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs started inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder for written intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{os.urandom(6).hex()}")


# Folders written by keep_table that this process still has to delete: path -> session.
_KEPT: dict[str, SparkSession] = {}


# For rows of megabytes: the writer looks at its size after every row instead of a hundred, and a
# reader, which takes a row group at once, gets few of them.
HUGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}


def keep_table(df: DataFrame, name: str, huge_rows: bool = False) -> DataFrame:
    """Write an intermediate table as Parquet in the shared folder and read it back.

    Cheaper than a checkpoint for wide rows (columnar, compressed) and as safe: a lost executor
    costs no recomputation. The folder is deleted when the process ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.options(compression="zstd", **(HUGE_ROWS if huge_rows else {})).parquet(path)
    _KEPT[path] = spark
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def drop_kept() -> None:
    """Delete the folders of keep_table; a stopped session still has its gateway."""
    while _KEPT:
        path, spark = _KEPT.popitem()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)
        except Exception:  # the JVM has gone: nothing left to ask
            continue
