"""Registry that pairs each Spark query with the SQL text that checks it."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from . import standins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RAW = ("region nation customer supplier part orders lineitem events documents embeddings "
       "pages benchmark labels conversations").split()


# Base rows that one task turns into rows of a written stand-in: a few seconds of string expressions.
TASK_ROWS = 50_000

# Stand-ins already written by this application: (application, data folder, table) -> path.
_WRITTEN: dict[tuple[str, str, str], str] = {}


class Tables:
    """The given tables and the stand-ins derived from them, as attributes.

    The contact stand-ins take long string expressions. They are written once per application,
    row for row, to the shared checkpoint folder, so that queries scan Parquet with column
    pruning and filter pushdown. Their base rows are dealt out evenly first: the base tables are
    few bytes with many rows, so that one task would read most of them, and later one task most of
    what was written. The light ones stay expressions over their base table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in RAW:
            return self.raw(name)
        if name not in standins.TABLES:
            raise AttributeError(name)
        if name not in standins.HEAVY:
            return self._derived(name)
        return self.spark.read.parquet(self._written(name))

    def _derived(self, name: str, base: Callable[[str], DataFrame] | None = None) -> DataFrame:
        body = standins.TABLES[name]
        used = {field for _, field, _, _ in Formatter().parse(body) if field}
        return self.spark.sql(body, **{t: (base or self.raw)(t) for t in used})

    def _dealt(self, name: str) -> DataFrame:
        """A given table, dealt out to tasks of so many rows."""
        rows = self.raw(name)
        tasks = -(-rows.count() // TASK_ROWS)
        return rows.repartition(tasks) if tasks > 1 else rows

    def _written(self, name: str) -> str:
        app = self.spark.sparkContext.applicationId
        key = (app, self.sf_dir, name)
        if key not in _WRITTEN:
            root = ensure_checkpoint_dir(self.spark)
            folder = hashlib.md5(self.sf_dir.encode()).hexdigest()[:12]
            path = os.path.join(root, "standins", app, folder, name)
            self._derived(name, self._dealt).write.mode("overwrite").parquet(path)
            _WRITTEN[key] = path
        return _WRITTEN[key]


def with_standins(sql: str) -> str:
    """Put the stand-ins that the text names in front of it as common table expressions."""
    used = [n for n in standins.TABLES if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    head = "WITH " + ",\n".join(standins.cte(n) for n in used)
    body = sql.strip()
    recursive = re.match(r"WITH\s+RECURSIVE\s+", body, re.I)
    if recursive:
        return "WITH RECURSIVE" + head[4:] + ",\n" + body[recursive.end():]
    plain = re.match(r"WITH\s+", body, re.I)
    if plain:
        return head + ",\n" + body[plain.end():]
    return head + "\n" + body


def query(name: str, oracle: str | None = None):
    """Register fn(Tables) -> DataFrame under the inventory id, with its check if SQL can state it."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_standins(oracle)
        return fn

    return register
