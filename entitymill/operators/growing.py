"""Deduplication with an index that grows: what a merged row brings along finds further rows.

Strong keys (phone, e-mail, name and state) merge at once. Weak keys (a mail domain, a number under
which many unlike names stand) merge only where the names are similar: a row is compared with the
name of the first entity that holds the key. Merging moves entities behind earlier ones, and so
changes which one is first; the rounds go on until no row finds anything new.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import block_ratio
from ..session import keep_table
from .cluster import connected_components, key_links, moved_nodes
from .skew import lookup_join

NAME_FLOOR = 0.5


def split_shared(members: DataFrame, rows: DataFrame, most_names: int) -> tuple[DataFrame, DataFrame]:
    """(own, shared) of members (id, key): a key is shared if more than `most_names` names stand under it.

    rows: id, name. The names of a key are counted in two steps, so no task gathers a hot key's rows.
    """
    named = members.join(rows.select("id", "name"), "id").where("name IS NOT NULL")
    many = keep_table(
        named.select("key", "name").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("names"))
        .where(F.col("names") > most_names).select("key", F.lit(True).alias("many")), "shared-keys")
    marked = lookup_join(members, many, "key", "id", "left")
    return marked.where("many IS NULL").drop("many"), marked.where("many").drop("many")


def growing_components(rows: DataFrame, strong: DataFrame, weak: DataFrame, floor: float = NAME_FLOOR) -> DataFrame:
    """(id, component): the least id of everything that a row is merged with.

    rows: id, name (missing: similar to nothing). strong: id, key. weak: id, key, first_only.
    An entity holds the weak keys of all its rows, but those marked first_only only through its
    first row, whose name also is the entity's name.

    A round compares each (weak key, name, entity) once with one name. Every round that finds a link
    merges two entities at least, so this ends. The first round joins up rows, the later ones only the
    entities that the links name; an entity's rows with one weak key and one name are one row of `held`.
    """
    rows = rows.select("id", "name")
    found = keep_table(
        connected_components(rows, key_links(keep_table(strong.select("id", "key").distinct(), "growing-strong"))),
        "growing-found")
    # always: some row holds the key whatever comes first; first: the entity's first row does
    held = keep_table(
        weak.select("id", "key", "first_only").join(rows.join(found, "id"), "id").groupBy("key", "name", "component")
        .agg(F.max(~F.col("first_only")).alias("always"), F.max(F.col("id") == F.col("component")).alias("first")),
        "growing-held")
    first_names = keep_table(
        rows.join(held.select(F.col("component").alias("id")).distinct(), "id").toDF("hub", "hub_name"), "growing-names")
    while True:
        hubs = held.where("always OR first").groupBy("key").agg(F.min("component").alias("hub")).join(first_names, "hub")
        near = keep_table(
            lookup_join(held.where("name IS NOT NULL").select("key", "name", "component"), hubs, "key", "component")
            .where("component <> hub").where(block_ratio(F.col("name"), F.col("hub_name")) >= floor)
            .select(F.col("component").alias("u"), F.col("hub").alias("v")).distinct(), "growing-near")
        if near.isEmpty():
            return found
        moved = moved_nodes(near).toDF("component", "least")
        found = keep_table(
            found.join(moved, "component", "left").select("id", F.coalesce("least", "component").alias("component")),
            "growing-found")
        held = keep_table(
            held.join(moved, "component", "left")
            .groupBy("key", "name", F.coalesce("least", "component").alias("component"))
            .agg(F.max("always").alias("always"), F.max(F.col("first") & F.col("least").isNull()).alias("first")),
            "growing-held")


@dataclass
class Merged:
    entities: DataFrame  # component, records, the first row's columns, the largest value, n_<kind> of every kind
    values: DataFrame  # component, kind, value, records: every different value of a set


def _of_kind(kind: str, column: str, dtype: str) -> Column:
    values = F.col(column) if dtype.startswith("array") else F.array(column)
    pairs = F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value")))
    return F.coalesce(pairs, F.array().cast("array<struct<kind:string,value:string>>"))


def merge_rows(rows: DataFrame, found: DataFrame, sets: dict[str, str], first: list[str], largest: str) -> Merged:
    """One entity per component, and the sets of its rows as a child table.

    rows: id, the columns of `first` (taken from the first row), `largest` (its maximum), and for each
    kind of `sets` a column of one value or an array of them. Missing and empty values count for nothing.
    A set is rows of the child table and no list in a cell, so an entity of a third of all rows is in no one task.
    """
    placed = keep_table(rows.join(found, "id"), "merged-rows")
    kinds = dict(placed.dtypes)
    listed = F.flatten(F.array(*[_of_kind(kind, column, kinds[column]) for kind, column in sets.items()]))
    values = keep_table(
        placed.select("component", F.explode(F.array_distinct(listed)).alias("s")).select("component", "s.*")
        .where("value <> ''").groupBy("component", "kind", "value").agg(F.count(F.lit(1)).alias("records")),
        "merged-values")
    counts = values.groupBy("component").agg(*[F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in sets])
    entities = placed.groupBy("component").agg(
        F.count(F.lit(1)).alias("records"), F.min_by(F.struct(*first), "id").alias("f"),
        F.max(largest).alias(f"max_{largest}"))
    return Merged(entities.join(counts, "component", "left").select(
        "component", "records", "f.*", f"max_{largest}",
        *[F.coalesce(f"n_{kind}", F.lit(0)).alias(f"n_{kind}") for kind in sets]), values)
