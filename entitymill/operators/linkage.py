"""Record linkage: tiered exact keys in one join, fuzzy names for what is left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import company_key
from ..functions.similarity import block_ratio
from ..session import cut_lineage
from .nametiles import first_similar, most_similar
from .pairs import candidate_pairs  # noqa: F401
from .skew import lookup_join

FUZZY_THRESHOLD = 0.85
DOMAIN_NAME_THRESHOLD = 0.5


def key_index(parts: list[tuple[DataFrame, str, str, str, int]]) -> DataFrame:
    """key -> best entity. Each part is (frame with entity_id and pos, column, signal, tier, rank).

    Within a rank the least pos wins; lower ranks win over higher ones.
    """
    long = [
        df.where(F.col(column).isNotNull()).select(
            F.concat(F.lit(f"{signal}:"), F.col(column)).alias("key"),
            F.struct(
                F.lit(rank).alias("rank"), F.col("pos").cast("long").alias("pos"),
                F.col("entity_id").cast("long").alias("entity_id"), F.lit(tier).alias("tier"),
            ).alias("hit"),
        )
        for df, column, signal, tier, rank in parts
    ]
    rows = reduce(lambda a, b: a.unionAll(b), long)
    return rows.groupBy("key").agg(F.min("hit").alias("hit"))


def keyed_hits(records: DataFrame, record_id: str, signals: dict[str, str], index: DataFrame,
               carry: list[str] | None = None) -> DataFrame:
    """Every signal of every record that finds an entity: one row per record and signal."""
    keys = F.array(
        *[F.concat(F.lit(f"{signal}:"), F.col(column)) for signal, column in signals.items()]
    )
    exploded = records.select(record_id, *(carry or []), F.explode(F.array_compact(keys)).alias("key"))
    return lookup_join(exploded, index, "key", record_id).select(
        record_id, *(carry or []), "key", "hit.*"
    )


def best_hit(hits: DataFrame, record_id: str) -> DataFrame:
    """The strongest hit per record with its signal and value."""
    best = F.min(F.struct("rank", "pos", "entity_id", "tier", "key")).alias("b")
    return hits.groupBy(record_id).agg(best).select(
        record_id,
        F.col("b.entity_id").alias("entity_id"),
        F.col("b.tier").alias("match_type"),
        F.regexp_replace("b.key", "^[a-z]+:", "").alias("match_value"),
    )


def match_by_keys(records: DataFrame, record_id: str, signals: dict[str, str], index: DataFrame) -> DataFrame:
    return best_hit(keyed_hits(records, record_id, signals, index), record_id)


def _owners(entities: DataFrame) -> DataFrame:
    return entities.groupBy("block", "name").agg(F.min("entity_id").alias("at"))


def fuzzy_first(records: DataFrame, entities: DataFrame, kind: str, threshold: float) -> DataFrame:
    """record_id -> the least entity of the block whose name is similar enough.

    Both inputs hold block and name (records: record_id; entities: entity_id). Distinct names
    are compared once, and only until the first similar one. `kind` names the ratio: block or indel.
    """
    records, entities = cut_lineage(records), cut_lineage(entities)
    reached = first_similar(records.select("block", "name").distinct(), _owners(entities), threshold, kind)
    return records.join(reached, ["block", "name"]).select(
        "record_id", F.col("at").alias("entity_id"), "ratio"
    )


def fuzzy_best(records: DataFrame, entities: DataFrame, threshold: float) -> DataFrame:
    """record_id -> entity with the highest Indel ratio over all blocks; ties go to the least id.

    Records and entities may come in several blocks each.
    """
    records, entities = cut_lineage(records), cut_lineage(entities)
    reached = most_similar(records.select("block", "name").distinct(), _owners(entities), threshold)
    best = F.max(F.struct("ratio", (-F.col("at")).alias("neg_id")))
    return (
        records.join(reached, ["block", "name"])
        .groupBy("record_id")
        .agg(best.alias("b"))
        .select("record_id", (-F.col("b.neg_id")).alias("entity_id"), F.col("b.ratio").alias("ratio"))
    )


def match_records(
    records: DataFrame, entities: DataFrame, contacts: DataFrame, block: Column | str = "state"
) -> DataFrame:
    """Priority match: phone, e-mail, domain with a similar name, similar name in the block.

    block: names are compared within equal values of it, over columns of records and entities.
    The state by default; a finer one is faster and finds less.

    records: record_id, phone, email, domain, name_key, state. entities: entity_id and the same.
    contacts: contact_id, entity_id, phone, email. Fuzzy sees only what no key has matched.
    """
    index = key_index([
        (entities.withColumn("pos", F.col("entity_id")), "phone", "phone", "phone", 1),
        (contacts.withColumn("pos", F.col("contact_id")), "phone", "phone", "phone", 2),
        (entities.withColumn("pos", F.col("entity_id")), "email", "email", "email", 3),
        (contacts.withColumn("pos", F.col("contact_id")), "email", "email", "email", 4),
        (entities.withColumn("pos", F.col("entity_id")), "domain", "domain", "domain", 5),
    ])
    # hits and matches are read more than once: kept, not worked out again
    hits = cut_lineage(
        keyed_hits(
            records, "record_id", {"phone": "phone", "email": "email", "domain": "domain"}, index,
            carry=["name_key"],
        )
    )
    # a domain counts only when its first entity has a similar name
    names = entities.select("entity_id", F.col("name_key").alias("known_key"))
    unsure = (
        hits.where("tier = 'domain'")
        .join(names, "entity_id")
        .where(
            block_ratio(company_key("name_key"), F.col("known_key")) >= DOMAIN_NAME_THRESHOLD
        )
        .drop("known_key")
    )
    keyed = cut_lineage(
        best_hit(hits.where("tier <> 'domain'").unionByName(unsure), "record_id")
    )
    rest = records.join(keyed.select("record_id"), "record_id", "left_anti")
    fuzzy = fuzzy_first(
        in_block(rest, "record_id", block), in_block(entities, "entity_id", block),
        "block", FUZZY_THRESHOLD,
    ).select(
        "record_id", "entity_id", F.lit("fuzzy_name").alias("match_type"),
        F.format_string("%.2f", "ratio").alias("match_value"),
    )
    return keyed.unionByName(fuzzy)


def in_block(df: DataFrame, id_column: str, block: Column | str = "state") -> DataFrame:
    """Names and their blocks; names are compared once more normalised."""
    block = F.col(block) if isinstance(block, str) else block
    return df.select(id_column, block.alias("block"), company_key("name_key").alias("name")).where(
        "block IS NOT NULL AND name IS NOT NULL")


def with_source_type(entities: DataFrame, matched: DataFrame) -> DataFrame:
    """source_type becomes 'both' for licence holders that a dealer record has matched."""
    marks = matched.select(F.col("entity_id").alias("id"), F.lit(True).alias("_hit")).distinct()
    return entities.join(marks, "id", "left").withColumn(
        "source_type",
        F.when(F.col("_hit") & (F.col("source_type") == "state_license"), "both").otherwise(
            F.col("source_type")
        ),
    ).drop("_hit")
