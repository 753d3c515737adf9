"""Segment exports: audiences, prospect lists and lead payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import phones
from ..functions.domains import guessed_mailbox, mail_suffix
from ..functions.fixed_values import BRAND_TYPE
from ..functions.scores import percent
from ..functions.text import as_col, clean, first_filled
from .quality import PRIMARY_MARKETS, SECONDARY_MARKETS

# What a new lead starts with.
LEAD_DEFAULTS = {
    "status_label": "new", "icp_tier": "silver", "fit_score": 50, "qualification_score": 0,
}
DIRECTORY_DEFAULTS = {"enrichment_status": "pending", "crm_status": "not_synced"}
HIGH_TIERS = ["PLATINUM", "GOLD"]


def search_audience(df: DataFrame) -> DataFrame:
    """PLATINUM and GOLD entities with a guessed mailbox."""
    return df.where(F.col("icp_tier").isin(HIGH_TIERS)).select(
        "entity_key", guessed_mailbox("domain").alias("email"), phones.digits("phone").alias("phone"),
        F.lit("US").alias("country"), "zip", F.col("name").alias("company"), "icp_tier", "icp_score",
        "brand_count", "brands",
    )


def social_audience(df: DataFrame, tier: str = "PLATINUM") -> DataFrame:
    return df.where(F.col("icp_tier") == tier).select(
        "entity_key", F.col("name").alias("company_name"), phones.digits("phone").alias("phone"),
        mail_suffix("domain").alias("email_domain"), "city", "state", "zip", "icp_score",
        "brand_count", "brands",
    )


def customer_match(df: DataFrame) -> DataFrame:
    """E.164 phones; the address comes without mail and person names."""
    return df.select(
        "entity_key", F.lit("").alias("email"), F.coalesce(phones.e164(phones.phone10("phone")), F.lit("")).alias("phone"),
        F.lit("").alias("first_name"), F.lit("").alias("last_name"), F.lit("US").alias("country"), "zip",
    )


def multi_brand_audience(df: DataFrame) -> DataFrame:
    return df.where("brand_count >= 2").select("entity_key", "phone", F.lit("US").alias("country"), "zip")


def overlap_segments(overlap: DataFrame) -> DataFrame:
    """Which of the overlap lists a phone belongs to: one row per phone and list."""
    lists = F.array_compact(
        F.array(
            F.when(F.col("num_overlaps") >= 4, "high_overlap"),
            F.when(F.col("num_licences") >= 2, "multi_state"),
            F.when((F.col("num_brands") >= 2) & (F.col("num_licences") >= 2), "multi_brand_multi_state"),
        )
    )
    return overlap.select("phone", "num_brands", "num_licences", "num_overlaps", F.explode(lists).alias("segment"))


def executive_summary(df: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))

    def part(states: list[str]) -> Column:
        return F.count_if(F.col("state").isin(states))

    return df.agg(
        rows.alias("total"), part(PRIMARY_MARKETS).alias("primary_markets"),
        part(SECONDARY_MARKETS).alias("secondary_markets"),
        F.count_if(F.col("brand_count") >= 2).alias("multi_brand"),
        percent(F.count_if(F.col("brand_count") >= 2), rows).alias("multi_brand_pct"),
        percent(part(PRIMARY_MARKETS), rows).alias("primary_pct"),
    )


def brand_payload(df: DataFrame) -> DataFrame:
    """Lead rows for the lead store: fixed defaults, source by brand, flags by brand type."""
    kind = F.coalesce(*[F.when(F.col("brand") == b, k) for b, k in BRAND_TYPE.items()])
    name = clean("name")
    return df.where(name.isNotNull()).select(
        "dealer_id", name.alias("company_name"),
        phones.display(phones.local_phone10("phone")).alias("contact_phone"),
        clean("email").alias("contact_email"),
        F.concat(F.lit("OEM:"), "brand").alias("source"),
        *[F.lit(v).alias(k) for k, v in LEAD_DEFAULTS.items()],
        F.coalesce(kind == "hvac", F.lit(False)).alias("has_hvac"), F.lit(False).alias("has_plumbing"),
        F.coalesce(kind.isin("generator", "battery"), F.lit(False)).alias("has_electrical"),
        F.coalesce(kind.isin("solar", "battery"), F.lit(False)).alias("has_solar"),
        F.coalesce(kind.isin("generator", "battery", "solar"), F.lit(False)).alias("has_energy"),
        F.lit(False).alias("is_atl"),
    )


def staged_rows(df: DataFrame, source_type: str, columns: list[str], brand_columns: list[str]) -> DataFrame:
    """Rows as staged for review: the raw row as JSON and the brands of its flag columns."""
    raw = F.to_json(F.struct(*[F.col(c) for c in columns]))
    brands = F.array_compact(F.array(*[F.nullif(F.col(c), F.lit("")) for c in brand_columns]))
    return df.withColumns({
        "raw_data": raw, "brand_list": F.array_join(brands, ","),
        "source": F.coalesce("source", F.lit(source_type)),
    })


def directory_leads(df: DataFrame, name_key: Column) -> DataFrame:
    """Directory lead: toll-free and unusable phones stay as written, presence flags, statuses."""
    phone = clean("phone")
    return df.select(
        "dealer_id", first_filled("name", "contact_name").alias("company_name"), name_key.alias("normalized_name"),
        F.coalesce(phones.display(phones.local_phone10("phone")), phone).alias("phone"),
        clean("email").alias("email"), clean("website").alias("website"),
        F.col("brand").alias("brand_name"), clean("tier").alias("brand_tier"),
        phone.isNotNull().alias("has_phone"), clean("email").isNotNull().alias("has_email"),
        clean("website").isNotNull().alias("has_website"),
        *[F.lit(v).alias(k) for k, v in DIRECTORY_DEFAULTS.items()],
    )


def ready_to_enrich(leads: DataFrame) -> DataFrame:
    return leads.where("enrichment_status = 'pending' AND (phone IS NOT NULL OR email IS NOT NULL)")


def ready_to_sync(leads: DataFrame, score: str) -> DataFrame:
    ready = as_col("enrichment_status").isin("enriched", "verified") & as_col("crm_status").isin(
        "not_synced", "needs_update"
    )
    return leads.where(ready).orderBy(F.desc_nulls_last(score))


def json_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Lists and maps as JSON text, for flat files."""
    return df.withColumns({c: F.to_json(c) for c in columns})


def flattened(df: DataFrame, nested: str) -> DataFrame:
    rest = [c for c in df.columns if c != nested]
    return df.select(*rest, f"{nested}.*")
