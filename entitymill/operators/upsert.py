"""Incremental upsert of a record batch into the master table and its children."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import company_key
from ..functions.similarity import block_ratio
from ..functions.text import fingerprint
from ..session import cut_lineage
from .cluster import connected_components, key_links
from .keyed import first_per_key, new_children
from .linkage import (
    DOMAIN_NAME_THRESHOLD,
    FUZZY_THRESHOLD,
    in_block,
    match_records,
)
from .nametiles import similar_links
from .skew import lookup_join

MERGED_CONFIDENCE = 70
NEW_CONFIDENCE = 80


@dataclass
class Upsert:
    assignments: DataFrame  # record_id, entity_id, is_new, match_type, match_value
    entities: DataFrame  # rows to insert
    contacts: DataFrame
    licences: DataFrame


def batch_links(records: DataFrame) -> DataFrame:
    """Links that connect batch rows: equal phone or e-mail, similar names, first of the domain.

    Merged rows hand their phone and e-mail to the entity, so these links are transitive.
    """
    members = records.select(
        F.col("record_id").alias("id"),
        F.explode(
            F.array_compact(
                F.array(
                    F.concat(F.lit("phone:"), "phone"),
                    F.concat(F.lit("email:"), "email"),
                    F.concat(F.lit("name:"), "state", F.lit("|"), "name_key"),
                )
            )
        ).alias("key"),
    )
    exact = key_links(members)
    blocked = in_block(records, "record_id")
    named = blocked.groupBy("block", "name").agg(F.min("record_id").alias("at"))
    first = (
        records.where("domain IS NOT NULL")
        .groupBy("domain")
        .agg(F.min_by(F.struct("record_id", "name_key"), "record_id").alias("f"))
        .select("domain", F.col("f.record_id").alias("hub"), F.col("f.name_key").alias("hub_key"))
    )
    near = lookup_join(records.where("domain IS NOT NULL"), first, "domain", "record_id").where(
        (F.col("record_id") > F.col("hub"))
        & (block_ratio(company_key("name_key"), F.col("hub_key")) >= DOMAIN_NAME_THRESHOLD)
    )
    known = cut_lineage(exact.unionAll(near.select(F.col("record_id").alias("u"), F.col("hub").alias("v"))))
    # the later name is compared with the earlier one, as in a sequential load
    return known.unionAll(similar_links(named, known, FUZZY_THRESHOLD, "block"))


def upsert(records: DataFrame, entities: DataFrame, contacts: DataFrame, licences: DataFrame) -> Upsert:
    """Match against the master, cluster the batch, then append children without repeats.

    records: record_id, company_name, contact_name, email, phone, domain, name_key, state, city,
    zip, license_type, license_category, license_number. New entities take the least record id
    of their cluster, shifted behind the largest entity id.
    """
    records, entities = cut_lineage(records), cut_lineage(entities)
    matched = cut_lineage(match_records(records, entities, contacts))
    to_master = key_links(
        matched.select(
            F.col("record_id").alias("id"), F.concat(F.lit("m:"), "entity_id").alias("key")
        )
    )
    clusters = connected_components(
        records.select(F.col("record_id").alias("id")), batch_links(records).unionAll(to_master)
    )
    placed = cut_lineage(
        clusters.join(matched.withColumnRenamed("record_id", "id"), "id", "left")
    )
    owners = placed.groupBy("component").agg(F.min("entity_id").alias("owner"))
    top = entities.agg(F.coalesce(F.max("entity_id"), F.lit(0)).alias("top"))
    assignments = cut_lineage(
        lookup_join(placed, owners, "component", "id", "left")
        .join(F.broadcast(top))
        .select(
            F.col("id").alias("record_id"),
            F.coalesce("owner", F.col("top") + 1 + F.col("component")).alias("entity_id"),
            (F.col("owner").isNull() & (F.col("id") == F.col("component"))).alias("is_new"),
            F.coalesce(
                "match_type",
                F.when(F.col("owner").isNull() & (F.col("id") == F.col("component")), "new").otherwise("batch"),
            ).alias("match_type"),
            "match_value",
        )
    )
    joined = records.join(assignments.select("record_id", "entity_id", "is_new"), "record_id")
    new_entities = joined.where("is_new").select(
        "entity_id", "company_name", "name_key", "city", "state", "zip", "phone", "email", "domain"
    )
    contact_rows = joined.where("contact_name IS NOT NULL OR email IS NOT NULL").select(
        "record_id", "entity_id", "contact_name", "email", "phone",
        F.when(F.col("is_new"), NEW_CONFIDENCE).otherwise(MERGED_CONFIDENCE).alias("confidence"),
    )
    with_mail = new_children(contact_rows, contacts, ["entity_id", "email"], "record_id")
    no_mail = contact_rows.where("email IS NULL")
    licence_rows = joined.where("license_type IS NOT NULL AND state IS NOT NULL").select(
        "record_id", "entity_id", "state", F.upper("license_type").alias("license_type"),
        "license_category", F.coalesce("license_number", F.lit("")).alias("license_number"),
    )
    new_licences = new_children(
        licence_rows, licences, ["entity_id", "state", "license_type", "license_number"], "record_id"
    )
    return Upsert(assignments, new_entities, with_mail.unionByName(no_mail), new_licences)


def record_fingerprint():
    return fingerprint(["company_name", "contact_name", "email", "phone", "state", "license_type"])
