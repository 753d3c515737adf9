"""What a source adds to the master: entities that no name has found, contacts of those that were found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from .keyed import new_children
from .numbering import number_rows
from .skew import lookup_join


def new_entities(unmatched: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities to insert, record_id -> entity_id): one new entity per name and state.

    unmatched: record_id, company_name, name_key, state. entities: entity_id, the master's.
    Ids follow the highest one in the order of the groups' first records, without gaps, and are the same
    in every run; equal names without a state are one entity, records without a name none.
    Returns entity_id, company_name (the first record's), name_key, state, first_record_id, records.
    """
    named = unmatched.where("name_key IS NOT NULL").withColumn(
        "_key", F.concat(F.coalesce("state", F.lit("")), F.lit("|"), "name_key"))
    groups = named.groupBy("_key").agg(
        F.min("record_id").alias("first_record_id"),
        F.min_by(F.struct("company_name", "name_key", "state"), "record_id").alias("f"),
        F.count(F.lit(1)).alias("records"))
    numbered = number_rows(keep_table(groups, "new-groups"), "first_record_id", name="_n")
    top = entities.agg(F.coalesce(F.max("entity_id"), F.lit(0)).alias("top"))  # one row
    inserted = keep_table(
        numbered.join(F.broadcast(top)).select(
            (F.col("top") + F.col("_n")).alias("entity_id"), "f.*", "first_record_id", "records", "_key"), "new-entities")
    placed = lookup_join(named.select("record_id", "_key"), inserted.select("_key", "entity_id"), "_key", "record_id")
    return inserted.drop("_key"), placed.select("record_id", "entity_id")


def new_contacts(matched: DataFrame, contacts: DataFrame) -> DataFrame:
    """Contacts to insert for matched records that name a person, the first record of each first.

    matched: record_id, entity_id, contact_name, email, confidence. contacts: entity_id, contact_name, email.
    An entity has an address once; people without an address are told apart by name.
    """
    people = matched.where("contact_name IS NOT NULL")
    with_mail = new_children(
        people.where("email IS NOT NULL"), contacts.where("email IS NOT NULL"), ["entity_id", "email"], "record_id")
    by_name = new_children(people.where("email IS NULL"), contacts, ["entity_id", "contact_name"], "record_id")
    return with_mail.unionByName(by_name).select("entity_id", "contact_name", "email", "confidence", "record_id")
