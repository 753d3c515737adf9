"""Row filters and searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import SREC_STATES
from ..functions.text import as_col, join_sorted

NAME_TRADES = {
    "has_electrical": "electric|electrical",
    "has_hvac": "hvac|heating|cooling|air cond",
    "has_solar": "solar|photovoltaic",
    "has_plumbing": "plumb",
}


def live(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    return df.where(F.coalesce(F.col(flag), F.lit(0)) == 0)


def contact_presence(df: DataFrame, phone="primary_phone", email="primary_email") -> DataFrame:
    p, e = F.col(phone).isNotNull(), F.col(email).isNotNull()
    return df.agg(
        F.count(phone).alias("with_phone"),
        F.count(email).alias("with_email"),
        F.count_if(p & e).alias("with_both"),
        F.count_if(~p & ~e).alias("with_neither"),
    )


def in_states(df: DataFrame, states: list[str], column: str = "state") -> DataFrame:
    return df.where(F.col(column).isin(states))


def is_srec_state(c) -> Column:
    return as_col(c).isin(SREC_STATES)


def priority_distribution(df: DataFrame, priorities: DataFrame) -> DataFrame:
    """Rows in listed states by priority; the (state, priority) table is the caller's."""
    by_state = df.groupBy("state").agg(F.count("*").alias("n"))
    return (
        by_state.join(priorities, "state")
        .groupBy("priority")
        .agg(F.sum("n").cast("long").alias("entities"))
    )


def search(
    entities: DataFrame, licences: DataFrame, text: str, phone: str | None, limit: int
) -> DataFrame:
    """Name or e-mail substring, or exact phone; the first hits by id with their categories."""
    needle = text.lower()
    hit = F.contains(F.lower("company_name"), F.lit(needle)) | F.contains(
        F.lower("primary_email"), F.lit(needle)
    )
    if phone:
        hit = F.coalesce(hit, F.lit(False)) | (F.col("primary_phone") == phone)
    found = entities.where(hit).orderBy("id").limit(limit).select("id", "company_name")
    categories = (
        licences.join(F.broadcast(found.select("id")), F.col("contractor_id") == F.col("id"))
        .groupBy("id")
        .agg(join_sorted(F.collect_set("license_category"), ",").alias("categories"))
    )
    return found.join(categories, "id", "left")


def of_types(df: DataFrame, types: list[str], column: str = "license_type") -> DataFrame:
    return df.where(F.col(column).isin(types))


def trades_from_name(column: str) -> list[Column]:
    return [F.col(column).rlike(f"(?i){p}").alias(flag) for flag, p in NAME_TRADES.items()]


def of_access_tier(config: DataFrame, tier: str) -> DataFrame:
    return config.where(F.col("access_tier") == tier)
