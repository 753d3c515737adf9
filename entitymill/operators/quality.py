"""Completeness, coverage, inventory, freshness and collector health."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import div_half_up, percent
from .marts import distinct_list, folded
from .scoring import contact_share_score

# Default quality by kind of source, freshness limits in days, gates in percent.
LICENCE_QUALITY, BRAND_QUALITY, RANKING_QUALITY = 50, 70, 90
FRESH_DAYS, STALE_DAYS = 7, 30
COVERAGE_GATE = 95.0
PRIMARY_MARKETS = ["CA", "TX", "FL", "PA", "MA", "NJ"]
SECONDARY_MARKETS = ["NY", "OH", "MD", "DC", "DE", "NH", "RI", "CT", "IL"]


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """Filled count and percent per field, from one pass."""
    filled = [F.count(F.nullif(F.trim(F.col(f).cast("string")), F.lit(""))).alias(f) for f in fields]
    one = df.agg(F.count(F.lit(1)).alias("_all"), *filled)
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields])
    return one.select("_all", F.inline(rows)).select(
        "field", "filled", percent(F.col("filled"), F.col("_all")).alias("pct")
    )


def coverage(df: DataFrame, key: str, targets: int) -> DataFrame:
    """Distinct keys with results against the number aimed at, and whether the gate is met."""
    found = df.agg(F.countDistinct(F.nullif(F.trim(key), F.lit(""))).alias("covered"))
    share = percent(F.col("covered"), F.lit(targets))
    return found.select(
        "covered", F.lit(targets).cast("long").alias("targets"), share.alias("pct"),
        (share >= COVERAGE_GATE).alias("gate_met"),
    )


def geography(df: DataFrame, top: int = 10) -> DataFrame:
    state = F.nullif(F.upper(F.trim("state")), F.lit(""))
    counts = df.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.agg(F.sum("rows").alias("_all"))
    return (
        counts.where("state IS NOT NULL")
        .join(F.broadcast(whole))
        .select("state", "rows", percent(F.col("rows"), F.col("_all")).alias("pct"))
        .orderBy(F.desc("rows"), "state")
        .limit(top)
    )


def inventory_by_source(entities: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    live = entities.where(F.coalesce("is_deleted", F.lit(0)) == 0)
    return live.groupBy(F.coalesce("source_type", F.lit("unknown")).alias("source_name")).agg(
        F.lit("CONTRACTOR_DB").alias("source_type"),
        rows.alias("record_count"),
        F.count("primary_email").alias("with_email_count"),
        F.count("primary_phone").alias("with_phone_count"),
        contact_share_score(F.count("primary_email"), F.count("primary_phone"), rows).alias("quality_score"),
    )


def _live_children(children: DataFrame, entities: DataFrame) -> DataFrame:
    live = entities.where(F.coalesce("is_deleted", F.lit(0)) == 0).select(
        F.col("id").alias("contractor_id")
    )
    return children.join(live, "contractor_id", "left_semi")


def inventory_by_licence_state(licences: DataFrame, entities: DataFrame) -> DataFrame:
    return (
        _live_children(licences, entities).where("state IS NOT NULL").groupBy("state")
        .agg(
            F.countDistinct("contractor_id").alias("record_count"),
            F.count(F.lit(1)).alias("licences"),
            distinct_list("license_category").alias("categories"),
        )
        .select(
            F.concat(F.lower("state"), F.lit("_license")).alias("source_name"),
            F.lit("STATE_LICENSE").alias("source_type"), "record_count", "licences", "categories",
            F.lit(LICENCE_QUALITY).alias("quality_score"),
        )
    )


def inventory_by_brand(certifications: DataFrame, entities: DataFrame) -> DataFrame:
    return (
        _live_children(certifications, entities).where("brand IS NOT NULL").groupBy("brand")
        .agg(F.countDistinct("contractor_id").alias("record_count"), F.count(F.lit(1)).alias("items"))
        .select(
            F.replace(F.lower("brand"), F.lit(" "), F.lit("_")).alias("source_name"),
            F.lit("OEM").alias("source_type"), "record_count", "items",
            F.lit(BRAND_QUALITY).alias("quality_score"),
        )
    )


def inventory_by_ranking(linked: DataFrame) -> DataFrame:
    return linked.groupBy("list_name").agg(
        F.count(F.lit(1)).alias("record_count"), F.count("entity_id").alias("matched")
    ).select(
        F.concat(F.lit("ranking_"), F.lower("list_name")).alias("source_name"),
        F.lit("THIRD_PARTY").alias("source_type"), "record_count", "matched",
        F.lit(RANKING_QUALITY).alias("quality_score"),
    )


def inventory_by_folder(files: DataFrame) -> DataFrame:
    """Rows and distinct states per folder; files carry _metadata.file_path as `path`."""
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    return files.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("record_count"), F.countDistinct("state").alias("states")
    )


def inventory_upsert(current: DataFrame, found: DataFrame) -> DataFrame:
    """New figures replace old ones by source name and type; sources not seen stay."""
    keys = ["source_name", "source_type"]
    figures = ["record_count", "with_email_count", "with_phone_count", "quality_score"]
    both = current.alias("o").join(found.alias("n"), keys, "full_outer")
    return both.select(
        *keys,
        *[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in figures],
        F.when(F.col("n.record_count").isNull(), "kept")
        .when(F.col("o.record_count").isNull(), "inserted")
        .otherwise("updated").alias("outcome"),
    )


def inventory_summary(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("source_type").agg(
        F.count(F.lit(1)).alias("sources"),
        F.sum("record_count").alias("total_records"),
        F.sum("with_email_count").alias("with_email"),
        F.sum("with_phone_count").alias("with_phone"),
        (div_half_up(F.sum("quality_score") * 10, F.count("quality_score")) / F.lit(10.0)).alias("avg_quality"),
    ).orderBy(F.desc("total_records"))


def freshness(df: DataFrame, last_updated: str, as_of: Column) -> DataFrame:
    days = F.datediff(as_of, F.col(last_updated))
    return df.withColumn("days_old", days).withColumn(
        "freshness_status",
        F.when(F.col("days_old") <= FRESH_DAYS, "FRESH").when(F.col("days_old") <= STALE_DAYS, "STALE").otherwise("OUTDATED"),
    )


def collector_health(collectors: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    ok = F.col("status") == "SUCCESS"
    folded_runs = runs.groupBy("collector_name").agg(
        F.max(F.when(ok, F.col("run_date"))).alias("last_success"),
        F.count_if(ok).alias("successful_runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        F.sum("record_count").alias("records"),
    )
    return collectors.join(folded_runs, "collector_name", "left").select(
        "collector_name", "collector_type", "status",
        F.datediff(as_of, "last_success").alias("days_since_run"),
        F.coalesce("successful_runs", F.lit(0)).alias("successful_runs"),
        F.coalesce("failed_runs", F.lit(0)).alias("failed_runs"),
        F.coalesce("records", F.lit(0)).alias("records"),
    )


def collector_status(collectors: DataFrame) -> DataFrame:
    return collectors.groupBy("collector_type").agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("WORKING", "BROKEN", "UNTESTED")],
        F.count(F.lit(1)).alias("total"),
    )


def derived_status(collectors: DataFrame, records: DataFrame) -> DataFrame:
    """Records make a collector WORKING; none and never validated makes it BROKEN."""
    n = F.coalesce("records", F.lit(0))
    return collectors.join(records, "collector_name", "left").select(
        "collector_name", n.alias("records"),
        F.when((n > 0) | (F.col("validated") == 1), "WORKING").otherwise("BROKEN").alias("status"),
    )


def pipeline_health(
    entities: DataFrame, licences: DataFrame, certifications: DataFrame, collectors: DataFrame
) -> DataFrame:
    """The one-row overview; each table is read once."""
    rows = F.count(F.lit(1))
    own = entities.where(F.coalesce("is_deleted", F.lit(0)) == 0).agg(
        rows.alias("total_contractors"), F.count("primary_email").alias("with_email"),
        F.count("primary_phone").alias("with_phone"),
        percent(F.count("primary_email"), rows).alias("email_rate"),
        percent(F.count("primary_phone"), rows).alias("phone_rate"),
    )
    held = folded(licences, "contractor_id", "license_category", "l", "n").agg(
        F.count_if(F.col("n") >= 2).alias("multi_license_count"), F.count_if(F.col("n") >= 3).alias("unicorn_count")
    )
    brands = folded(certifications, "contractor_id", "brand", "l", "n").agg(
        F.count_if(F.col("n") >= 2).alias("multi_brand_count")
    )
    state = collectors.agg(
        *[F.count_if(F.col("status") == s).alias(f"collectors_{s.lower()}") for s in ("WORKING", "BROKEN", "UNTESTED")]
    )
    return reduce(lambda a, b: a.join(F.broadcast(b)), [own, held, brands, state])


def state_coverage(entities: DataFrame, top: int = 20) -> DataFrame:
    live = entities.where((F.coalesce("is_deleted", F.lit(0)) == 0) & F.col("state").isNotNull())
    return live.groupBy("state").agg(
        F.count(F.lit(1)).alias("entities"), F.count("primary_email").alias("with_email"),
        F.count("primary_phone").alias("with_phone"),
    ).orderBy(F.desc("entities"), "state").limit(top)


def expected_vs_actual(actual: DataFrame, expected: DataFrame, tolerance_pct: int = 5) -> DataFrame:
    """Metric by metric, whether the value lies within the tolerance of what was expected."""
    gap = F.abs(F.col("actual") - F.col("expected"))
    return expected.join(actual, "metric", "left").select(
        "metric", "expected", "actual",
        F.coalesce(gap * 100 <= F.col("expected") * tolerance_pct, F.lit(False)).alias("within"),
    )


def scope_by_state(rows: DataFrame, in_scope: Column) -> DataFrame:
    return rows.groupBy("registry_state").agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(in_scope).alias("scope_records"),
        percent(F.count_if(in_scope), F.count(F.lit(1))).alias("scope_pct"),
    )


def cost_rates(costs: DataFrame) -> DataFrame:
    """Cents per record and records per hour by activity; hours in whole hundredths."""
    return costs.groupBy("activity").agg(
        F.sum("records").alias("records"),
        (div_half_up(F.sum("cost_cents") * 100, F.sum("records")) / F.lit(100.0)).alias("cents_per_record"),
        div_half_up(F.sum("records") * 100, F.sum("hours_hundredths")).alias("records_per_hour"),
    )


def recent_imports(imports: DataFrame, top: int = 10) -> DataFrame:
    return imports.orderBy(F.desc("imported_on"), F.desc("import_id")).limit(top)
