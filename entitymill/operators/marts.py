"""Aggregate marts. Children are folded per entity before any join with the entity table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import BRAND_CATEGORIES
from ..functions.scores import div_half_up, percent
from ..functions.text import join_sorted


def distinct_list(column: str, separator: str = ",") -> Column:
    return join_sorted(F.collect_set(column), separator)


def folded(children: DataFrame, owner: str, column: str, list_name: str, count_name: str) -> DataFrame:
    """Sorted distinct values and their number per owner; the values are a small vocabulary."""
    return children.groupBy(owner).agg(
        distinct_list(column).alias(list_name), F.countDistinct(column).alias(count_name)
    )


def with_at_least(
    entities: DataFrame, children: DataFrame, owner: str, column: str, fewest: int,
    list_name: str, count_name: str,
) -> DataFrame:
    """Entities with at least so many distinct child values."""
    groups = folded(children, owner, column, list_name, count_name).where(F.col(count_name) >= fewest)
    return entities.join(groups, entities["id"] == groups[owner]).drop(owner)


def cross_state(entities: DataFrame, licences: DataFrame) -> DataFrame:
    groups = (
        licences.groupBy(F.col("contractor_id").alias("id"))
        .agg(
            distinct_list("state").alias("states"), F.countDistinct("state").alias("state_count"),
            distinct_list("license_category").alias("categories"),
            F.countDistinct("license_category").alias("category_count"),
        )
        .where("state_count > 1")
    )
    return entities.join(groups, "id").orderBy(F.desc("state_count"), F.desc("category_count"), "id")


def by_state(entities: DataFrame) -> DataFrame:
    return entities.groupBy("state").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("primary_email").alias("with_email"),
        F.count("primary_phone").alias("with_phone"),
    )


def stats_bundle(entities: DataFrame, licences: DataFrame, merges: DataFrame, state: str | None = None) -> DataFrame:
    """One row of headline counts, for one state or for all."""
    held = licences if state is None else licences.where(F.col("state") == state)
    own = entities if state is None else entities.where(F.col("state") == state)
    per_entity = held.groupBy(F.col("contractor_id").alias("id")).agg(
        F.countDistinct("license_category").alias("n")
    )
    mail = entities.select("id", F.col("primary_email").isNotNull().alias("mail"))
    counts = per_entity.join(mail, "id").agg(
        F.count_if(F.col("n") >= 2).alias("multi_license"),
        F.count_if(F.col("n") >= 3).alias("unicorns"),
        F.count_if((F.col("n") >= 2) & F.col("mail")).alias("multi_license_with_email"),
    )
    totals = own.agg(
        F.count(F.lit(1)).alias("total_contractors"),
        F.count("primary_email").alias("with_email"),
        F.count("primary_phone").alias("with_phone"),
    )
    logged = merges.agg(F.count(F.lit(1)).alias("total_dedup_matches"))
    one = totals.join(F.broadcast(counts)).join(F.broadcast(logged))
    return one.withColumn("state", F.lit(state or "ALL"))


def category_distribution(licences: DataFrame) -> DataFrame:
    return licences.groupBy("license_category").agg(
        F.countDistinct("contractor_id").alias("entities")
    )


def category_state_matrix(licences: DataFrame, states: list[str]) -> DataFrame:
    pairs = licences.groupBy("license_category", "state").agg(
        F.countDistinct("contractor_id").alias("n")
    )
    wide = pairs.groupBy("license_category").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("state") == s, F.col("n"))), F.lit(0)).alias(s.lower())
            for s in states
        ],
        F.sum("n").alias("total"),
    )
    return wide


def category_buckets(licences: DataFrame) -> DataFrame:
    counts = licences.groupBy("contractor_id").agg(F.countDistinct("license_category").alias("n"))
    bucket = (
        F.when(F.col("n") >= 4, "4+ categories").when(F.col("n") == 3, "3 categories")
        .when(F.col("n") == 2, "2 categories").otherwise("1 category")
    )
    return counts.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("entities"))


def multi_state_rollup(licences: DataFrame) -> DataFrame:
    """Phones licensed in two or more states; the best-scored record names the business."""
    best = F.max_by(
        F.struct("business_name", "state", "icp_tier"), F.struct("base_score", -F.col("row_no"))
    )
    return (
        licences.where("phone_key IS NOT NULL")
        .groupBy("phone_key")
        .agg(
            best.alias("b"),
            F.countDistinct("state").alias("state_count"),
            distinct_list("state", ", ").alias("states_licensed"),
            F.sum("license_count").alias("total_licenses"),
            *[F.bool_or(f).alias(f) for f in ("has_electrical", "has_hvac", "has_solar", "is_multi_trade")],
            F.max("tenure_days").alias("max_tenure_days"),
            F.max("base_score").alias("max_score"),
        )
        .where("state_count >= 2")
        .select(
            "phone_key", F.col("b.business_name").alias("business_name"),
            F.col("b.state").alias("primary_state"), F.col("b.icp_tier").alias("best_tier"),
            "state_count", "states_licensed", F.col("total_licenses").cast("long").alias("total_licenses"),
            "has_electrical", "has_hvac", "has_solar", "is_multi_trade", "max_tenure_days", "max_score",
        )
    )


def top_values(df: DataFrame, column: str, n: int, name: str = "rows") -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), column)
        .limit(n)
    )


def with_share(counts: DataFrame, column: str, name: str = "pct") -> DataFrame:
    """Adds each row's share of the total; meant for small count tables."""
    whole = counts.agg(F.sum(column).alias("_whole"))
    return counts.join(F.broadcast(whole)).withColumn(
        name, percent(F.col(column), F.col("_whole"))
    ).drop("_whole")


def brand_count_profile(scored: DataFrame) -> DataFrame:
    """Per brand count of multi-brand entities: how many, average score, most frequent tier."""
    multi = scored.where("brand_count >= 2")
    tiers = multi.groupBy("brand_count", "icp_tier").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score_hundredths").alias("s")
    )
    return tiers.groupBy("brand_count").agg(
        F.sum("n").alias("entities"),
        (div_half_up(F.sum("s"), F.sum("n") * 10) / F.lit(10.0)).alias("avg_score"),
        F.max_by("icp_tier", F.struct("n", "icp_tier")).alias("top_tier"),
        F.max("n").alias("top_tier_rows"),
    )


def brand_stats(certifications: DataFrame, entities: DataFrame) -> DataFrame:
    """Certified live entities per brand with states, last date and contact counts."""
    own = entities.where(F.coalesce("is_deleted", F.lit(0)) == 0).select(
        F.col("id").alias("contractor_id"), "state", "primary_phone", "primary_email"
    )
    return certifications.join(own, "contractor_id").groupBy("brand").agg(
        F.count(F.lit(1)).alias("certifications"),
        F.countDistinct("state").alias("states"),
        F.max("scraped_on").alias("last_seen"),
        F.count("primary_phone").alias("with_phone"),
        F.count("primary_email").alias("with_email"),
    )


def clean_leads(entities: DataFrame, certifications: DataFrame, licences: DataFrame) -> DataFrame:
    """Live named entities with brand and category lists; an empty list when there are none."""
    brands = folded(certifications, "contractor_id", "brand", "brands", "brand_count")
    cats = folded(licences, "contractor_id", "license_category", "categories", "category_count")
    live = entities.where((F.coalesce("is_deleted", F.lit(0)) == 0) & F.col("company_name").isNotNull())
    return (
        live.join(brands, live["id"] == brands["contractor_id"], "left").drop("contractor_id")
        .join(cats, live["id"] == cats["contractor_id"], "left").drop("contractor_id")
        .fillna("", subset=["brands", "categories"])
        .fillna(0, subset=["brand_count", "category_count"])
    )


def import_summary(imports: DataFrame) -> DataFrame:
    return imports.where("status = 'completed'").groupBy("source_type").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows_read").alias("total_rows"),
        F.sum("rows_new").alias("new_rows"),
        F.sum("rows_merged").alias("merged_rows"),
        F.max("imported_on").cast("string").alias("last_import"),
    )


def brand_category_counts(certifications: DataFrame) -> DataFrame:
    """Distinct brands per product category and the number of categories, per entity."""
    held = certifications.select("contractor_id", "brand").distinct()
    wide = held.groupBy("contractor_id").agg(
        *[
            F.count_if(F.col("brand").isin(brands)).alias(f"{kind}_brands")
            for kind, brands in BRAND_CATEGORIES.items()
        ],
        F.count(F.lit(1)).alias("brand_total"),
    )
    kinds = [F.when(F.col(f"{k}_brands") > 0, 1).otherwise(0) for k in BRAND_CATEGORIES]
    return wide.withColumn("brand_categories", sum(kinds[1:], kinds[0]))


def ranking_totals(linked: DataFrame) -> DataFrame:
    """linked rankings (entity_id, kw_installed, list_name) folded per entity."""
    return linked.where("entity_id IS NOT NULL").groupBy("entity_id").agg(
        F.sum("kw_installed").alias("kw_installed"), F.count(F.lit(1)).alias("list_count")
    )


def brand_tiers(certifications: DataFrame) -> DataFrame:
    """Brand to tier map per entity; the latest certificate of a brand gives its tier."""
    latest = certifications.groupBy("contractor_id", "brand").agg(
        F.max_by("certification_tier", "cert_id").alias("tier")
    )
    entries = F.array_sort(F.collect_list(F.struct("brand", "tier")))
    return latest.groupBy("contractor_id").agg(F.map_from_entries(entries).alias("tiers"))


def multi_licence_by(rows: DataFrame, key: Column) -> DataFrame:
    """Company or mail key with two or more categories: what it holds, who and where it is.

    first_names are the three least names; the address is the least one, as files have no order.
    """
    keyed = rows.withColumn("key", key).where("key IS NOT NULL")
    # the limit of three is applied before rows of a key meet
    least = Window.partitionBy("key").orderBy("contact_name")
    named = (
        keyed.where("contact_name IS NOT NULL").select("key", "contact_name").distinct()
        .withColumn("n", F.row_number().over(least)).where("n <= 3")
        .groupBy("key").agg(join_sorted(F.collect_list("contact_name"), "; ").alias("first_names"))
    )
    held = (
        keyed.withColumn("email", F.upper("email")).groupBy("key")
        .agg(
            F.countDistinct("license_category").alias("category_count"),
            distinct_list("license_category", ", ").alias("categories"),
            distinct_list("license_type", ", ").alias("types"),
            distinct_list("email", ", ").alias("emails"),
            distinct_list("company_name", "; ").alias("companies"),
            F.min(F.concat_ws(", ", "address", "city", "state", "zip")).alias("address"),
        )
        .where("category_count >= 2")
    )
    return held.join(named, "key", "left")


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Entity counts by source type in two snapshots."""
    both = before.select("source_type", F.lit(0).alias("side")).unionAll(
        after.select("source_type", F.lit(1).alias("side"))
    )
    return both.groupBy("source_type").agg(
        F.count_if(F.col("side") == 0).alias("before_rows"),
        F.count_if(F.col("side") == 1).alias("after_rows"),
    ).withColumn("change", F.col("after_rows") - F.col("before_rows"))
