"""Keyed views of the stand-ins that many queries start from, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domains, names, phones, text
from . import duck


def keyed_dealers(t, *extra: str) -> DataFrame:
    wanted = ["dealer_id", "name", "city", "state", "zip", "tier", "brand", *extra]
    return t.dealers.select(
        *dict.fromkeys(wanted),
        phones.phone10("phone").alias("phone_key"),
        domains.root_domain("website").alias("domain_key"),
        domains.email_key("email").alias("email_key"),
        F.lower(text.strip("name")).alias("plain_name"),
    )


DK = f"""dk AS (SELECT *, {duck.phone10('phone')} AS phone_key, {duck.root_domain('website')} AS domain_key,
    {duck.email_key('email')} AS email_key, {duck.strip('lower(name)')} AS plain_name FROM dealers)"""


def keyed_registry(t) -> DataFrame:
    """Licence rows with their match keys."""
    return t.registry.select(
        "row_no", "registry_state", "state", "city", "zip", "type_code", "license_number",
        text.clean("business_name").alias("business_name"),
        phones.phone10("business_phone").alias("phone_key"),
        domains.email_domain("email").alias("domain_key"),
    )


RK = f"""rk AS (SELECT *, {duck.phone10('business_phone')} AS phone_key,
    {duck.email_domain('email')} AS domain_key FROM registry)"""


def master(t) -> DataFrame:
    """Master rows with entity_id and the match keys."""
    return t.contractors.select(
        F.col("id").alias("entity_id"), "company_name", "city", "state", "zip", "source_type",
        F.col("primary_phone").alias("phone"), F.col("primary_email").alias("email"),
        F.col("primary_domain").alias("domain"), names.company_key("company_name").alias("name_key"),
    )


MK = f"mk AS (SELECT *, {duck.company_key('company_name')} AS name_key FROM contractors)"


def master_contacts(t) -> DataFrame:
    return t.contacts.select(
        "contact_id", F.col("contractor_id").alias("entity_id"), "contact_name", "phone",
        domains.email_key("email").alias("email"),
    )
