"""Marts (A*), quality (Q*), funnel (R*) and segment exports (E*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed, names, text
from ..functions.scores import tier_of
from ..operators import enrich, exports, funnel, keyed, marts, numbering, quality
from ..session import scratch_dir
from . import duck
from .linking import named_rankings
from .loading import LOAD_SQL, loaded_registries
from .registry import query
from .resolving import OVERLAP, SOURCES, overlap, phone_sources
from .scored import CLASSED, G01_SQL, classed, name_scored
from .shared import DK, MK, keyed_dealers, master

CAT_LIST = "string_agg(DISTINCT license_category, ',' ORDER BY license_category)"
ENTITY = ["id", "company_name", "city", "state", "primary_phone", "primary_email"]


def _multi_sql(fewest: int) -> str:
    return f"""SELECT {', '.join('c.' + c for c in ENTITY)}, l.categories, l.category_count FROM contractors c JOIN (SELECT contractor_id,
        {CAT_LIST} AS categories, count(DISTINCT license_category) AS category_count FROM licenses GROUP BY 1
        HAVING count(DISTINCT license_category) >= {fewest}) l ON l.contractor_id = c.id"""


def multi_category(t, fewest: int):
    return marts.with_at_least(
        t.contractors.select(*ENTITY), t.licenses, "contractor_id", "license_category", fewest, "categories", "category_count"
    )


@query("a01_multi_category", _multi_sql(2))
def a01(t):
    return multi_category(t, 2)


@query("a02_three_categories", _multi_sql(3))
def a02(t):
    return multi_category(t, 3)


@query(
    "a03_multi_brand",
    f"""SELECT {', '.join('c.' + c for c in ENTITY)}, o.brands, o.brand_count FROM contractors c JOIN (SELECT contractor_id,
        string_agg(DISTINCT brand, ',' ORDER BY brand) AS brands, count(DISTINCT brand) AS brand_count FROM certifications GROUP BY 1
        HAVING count(DISTINCT brand) >= 2) o ON o.contractor_id = c.id""",
)
def a03(t):
    return marts.with_at_least(
        t.contractors.select(*ENTITY), t.certifications, "contractor_id", "brand", 2, "brands", "brand_count"
    )


@query(
    "a04_cross_state",
    f"""SELECT c.id, c.company_name, l.* EXCLUDE (contractor_id) FROM contractors c JOIN (SELECT contractor_id,
        string_agg(DISTINCT state, ',' ORDER BY state) AS states, count(DISTINCT state) AS state_count, {CAT_LIST} AS categories,
        count(DISTINCT license_category) AS category_count FROM licenses GROUP BY 1 HAVING count(DISTINCT state) > 1) l
        ON l.contractor_id = c.id""",
)
def a04(t):
    return marts.cross_state(t.contractors.select("id", "company_name"), t.licenses)


@query(
    "a05_by_state",
    """SELECT state, count(*) AS total, count(primary_email) AS with_email, count(primary_phone) AS with_phone
       FROM contractors GROUP BY state""",
)
def a05(t):
    return marts.by_state(t.contractors)


def _stats_sql(state: str | None) -> str:
    own = f"WHERE state = '{state}'" if state else ""
    return f"""WITH {DK}, n AS (SELECT contractor_id AS id, count(DISTINCT license_category) AS n FROM licenses {own} GROUP BY 1),
        merges AS (SELECT count(*) AS m FROM (SELECT phone_key IS NOT NULL AND row_number() OVER (PARTITION BY phone_key ORDER BY dealer_id) > 1 AS later FROM dk) WHERE later)
        SELECT (SELECT count(*) FROM contractors {own}) AS total_contractors, (SELECT count(primary_email) FROM contractors {own}) AS with_email,
        (SELECT count(primary_phone) FROM contractors {own}) AS with_phone, (SELECT count(*) FROM n WHERE n >= 2) AS multi_license,
        (SELECT count(*) FROM n WHERE n >= 3) AS unicorns, (SELECT count(*) FROM n JOIN contractors c USING (id) WHERE n >= 2 AND c.primary_email IS NOT NULL)
        AS multi_license_with_email, (SELECT m FROM merges) AS total_dedup_matches, '{state or 'ALL'}' AS state"""


def _stats(t, state):
    marked = keyed.mark_later(keyed_dealers(t).select("dealer_id", "phone_key"), "phone_key", "dealer_id")
    return marts.stats_bundle(t.contractors, t.licenses, marked.where("is_duplicate"), state)


@query("a06_stats", _stats_sql(None))
def a06(t):
    return _stats(t, None)


@query("a06b_stats_of_state", _stats_sql("FL"))
def a06b(t):
    return _stats(t, "FL")


@query(
    "a07_category_distribution",
    "SELECT license_category, count(DISTINCT contractor_id) AS entities FROM licenses GROUP BY 1",
)
def a07(t):
    return marts.category_distribution(t.licenses)


@query(
    "a08_category_state_matrix",
    """WITH p AS (SELECT license_category, state, count(DISTINCT contractor_id) AS n FROM licenses GROUP BY 1, 2)
       SELECT license_category, CAST(coalesce(sum(n) FILTER (state = 'FL'), 0) AS BIGINT) AS fl, CAST(coalesce(sum(n) FILTER (state = 'CA'), 0) AS BIGINT) AS ca,
       CAST(coalesce(sum(n) FILTER (state = 'TX'), 0) AS BIGINT) AS tx, CAST(sum(n) AS BIGINT) AS total FROM p GROUP BY 1""",
)
def a08(t):
    return marts.category_state_matrix(t.licenses, ["FL", "CA", "TX"])


@query(
    "a09_category_buckets",
    """SELECT CASE WHEN n >= 4 THEN '4+ categories' WHEN n = 3 THEN '3 categories' WHEN n = 2 THEN '2 categories' ELSE '1 category' END AS bucket,
       count(*) AS entities FROM (SELECT count(DISTINCT license_category) AS n FROM licenses GROUP BY contractor_id) GROUP BY 1""",
)
def a09(t):
    return marts.category_buckets(t.licenses)


ROLLUP = f"""{CLASSED}, ru AS (SELECT phone_key, first(business_name ORDER BY base_score DESC, row_no) AS business_name, first(state ORDER BY base_score DESC, row_no) AS primary_state,
    first(icp_tier ORDER BY base_score DESC, row_no) AS best_tier, count(DISTINCT state) AS state_count, string_agg(DISTINCT state, ', ' ORDER BY state) AS states_licensed,
    CAST(sum(license_count) AS BIGINT) AS total_licenses, bool_or(has_electrical) AS has_electrical, bool_or(has_hvac) AS has_hvac, bool_or(has_solar) AS has_solar,
    bool_or(is_multi_trade) AS is_multi_trade, max(tenure_days) AS max_tenure_days, max(base_score) AS max_score
    FROM classed WHERE phone_key IS NOT NULL GROUP BY phone_key HAVING count(DISTINCT state) >= 2)"""


@query("a10_multi_state_rollup", f"WITH {ROLLUP} SELECT * FROM ru")
def a10(t):
    return marts.multi_state_rollup(classed(t))


@query(
    "a11_state_combinations",
    f"""WITH {ROLLUP} SELECT states_licensed, count(*) AS rows FROM ru GROUP BY 1 ORDER BY rows DESC, states_licensed LIMIT 5""",
)
def a11(t):
    return marts.top_values(marts.multi_state_rollup(classed(t)), "states_licensed", 5)


@query(
    "a12_brand_count_share",
    f"""WITH {DK}, o AS ({OVERLAP}), c AS (SELECT brand_count, count(*) AS entities FROM o GROUP BY 1)
        SELECT brand_count, entities, {duck.percent('entities', '(SELECT CAST(sum(entities) AS BIGINT) FROM c)')} AS pct FROM c""",
)
def a12(t):
    counts = overlap(t).groupBy("brand_count").agg(F.count(F.lit(1)).alias("entities"))
    return marts.with_share(counts, "entities")


@query(
    "a13_brand_combinations",
    f"""WITH {DK}, o AS ({OVERLAP}) SELECT brands, count(*) AS rows FROM o WHERE brand_count >= 2 GROUP BY 1 ORDER BY rows DESC, brands LIMIT 10""",
)
def a13(t):
    return marts.top_values(overlap(t).where("brand_count >= 2"), "brands", 10)


@query(
    "a13b_brand_count_profile",
    f"""WITH {G01_SQL}, tiers AS (SELECT brand_count, icp_tier, count(*) AS n, CAST(sum(score_hundredths) AS BIGINT) AS s FROM final WHERE brand_count >= 2 GROUP BY 1, 2)
        SELECT brand_count, CAST(sum(n) AS BIGINT) AS entities, {duck.div_half_up('CAST(sum(s) AS BIGINT)', 'CAST(sum(n) AS BIGINT) * 10')} / 10.0::DOUBLE AS avg_score,
        first(icp_tier ORDER BY n DESC, icp_tier DESC) AS top_tier, max(n) AS top_tier_rows FROM tiers GROUP BY 1""",
)
def a13b(t):
    return marts.brand_count_profile(name_scored(t))


@query(
    "a14_tier_share",
    f"""WITH {G01_SQL}, c AS (SELECT icp_tier, count(*) AS entities FROM final GROUP BY 1)
        SELECT icp_tier, entities, {duck.percent('entities', '(SELECT CAST(sum(entities) AS BIGINT) FROM c)')} AS pct FROM c""",
)
def a14(t):
    counts = name_scored(t).groupBy("icp_tier").agg(F.count(F.lit(1)).alias("entities"))
    return marts.with_share(counts, "entities")


@query(
    "a15_top_places_and_brands",
    f"""WITH {DK}, o AS ({OVERLAP}), s AS (SELECT 'state' AS kind, state AS item, count(*) AS rows FROM o GROUP BY 2 ORDER BY rows DESC, item LIMIT 10),
        c AS (SELECT 'city' AS kind, city AS item, count(*) AS rows FROM o GROUP BY 2 ORDER BY rows DESC, item LIMIT 20),
        b AS (SELECT 'brand' AS kind, item, count(*) AS rows FROM (SELECT unnest(string_split(brands, ', ')) AS item FROM o) GROUP BY 2 ORDER BY rows DESC, item LIMIT 10)
        SELECT * FROM s UNION ALL SELECT * FROM c UNION ALL SELECT * FROM b""",
)
def a15(t):
    rows = overlap(t)
    named = rows.select(F.explode(F.split("brands", ", ")).alias("brand"))

    def top(df, column, n):
        return marts.top_values(df, column, n).select(
            F.lit(column).alias("kind"), F.col(column).alias("item"), "rows"
        )

    return top(rows, "state", 10).unionAll(top(rows, "city", 20)).unionAll(top(named, "brand", 10))


@query(
    "a16_brand_stats",
    """SELECT brand, count(*) AS certifications, count(DISTINCT c.state) AS states, max(scraped_on) AS last_seen, count(primary_phone) AS with_phone,
       count(primary_email) AS with_email FROM certifications o JOIN contractors c ON c.id = o.contractor_id WHERE coalesce(is_deleted, 0) = 0 GROUP BY brand""",
)
def a16(t):
    return marts.brand_stats(t.certifications, t.contractors)


@query(
    "a17_clean_leads",
    f"""SELECT c.id, c.company_name, coalesce(b.brands, '') AS brands, coalesce(b.n, 0) AS brand_count, coalesce(l.categories, '') AS categories,
        coalesce(l.n, 0) AS category_count FROM contractors c LEFT JOIN (SELECT contractor_id, string_agg(DISTINCT brand, ',' ORDER BY brand) AS brands, count(DISTINCT brand) AS n
        FROM certifications GROUP BY 1) b ON b.contractor_id = c.id LEFT JOIN (SELECT contractor_id, {CAT_LIST} AS categories, count(DISTINCT license_category) AS n
        FROM licenses GROUP BY 1) l ON l.contractor_id = c.id WHERE coalesce(is_deleted, 0) = 0 AND company_name IS NOT NULL""",
)
def a17(t):
    return marts.clean_leads(
        t.contractors.select("id", "company_name", "is_deleted"), t.certifications, t.licenses
    ).drop("is_deleted")


@query(
    "a18_import_summary",
    """SELECT source_type, count(*) AS batches, CAST(sum(rows_read) AS BIGINT) AS total_rows, CAST(sum(rows_new) AS BIGINT) AS new_rows,
       CAST(sum(rows_merged) AS BIGINT) AS merged_rows, CAST(max(imported_on) AS VARCHAR) AS last_import FROM imports WHERE status = 'completed' GROUP BY 1""",
)
def a18(t):
    return marts.import_summary(t.imports)


@query(
    "a19_profession_counts",
    "SELECT registry_state, type_code, upper(trim(status)) AS status, count(*) AS rows FROM registry GROUP BY 1, 2, 3",
)
def a19(t):
    return t.registry.groupBy("registry_state", "type_code", F.upper(text.strip("status")).alias("status")).agg(
        F.count(F.lit(1)).alias("rows")
    )


KINDS = list(fixed.BRAND_CATEGORIES)


@query(
    "a20_brand_categories",
    "SELECT contractor_id, "
    + ", ".join(f"count(DISTINCT brand) FILTER (brand IN ({duck.quoted(v)})) AS {k}_brands" for k, v in fixed.BRAND_CATEGORIES.items())
    + ", count(DISTINCT brand) AS brand_total, CAST("
    + " + ".join(f"CASE WHEN count(*) FILTER (brand IN ({duck.quoted(v)})) > 0 THEN 1 ELSE 0 END" for v in fixed.BRAND_CATEGORIES.values())
    + " AS INT) AS brand_categories FROM certifications GROUP BY 1",
)
def a20(t):
    return marts.brand_category_counts(t.certifications)


LINKED = f"""{MK}, r AS (SELECT ranking_id, list_name, kw_installed, headquarters_state AS hs, {duck.company_key('company_name')} AS name_key FROM rankings),
    linked AS (SELECT r.ranking_id, any_value(r.list_name) AS list_name, any_value(r.kw_installed) AS kw_installed, min(mk.id) AS entity_id FROM r
    LEFT JOIN mk ON mk.name_key = r.name_key AND (mk.state = r.hs OR r.hs IS NULL) GROUP BY 1)"""


def linked_rankings(t):
    ranks = named_rankings(t)
    links = enrich.rank_links(ranks, master(t))
    return ranks.select("ranking_id", "list_name", "kw_installed").join(links, "ranking_id")


@query(
    "a21_ranking_totals",
    f"WITH {LINKED} SELECT entity_id, CAST(sum(kw_installed) AS BIGINT) AS kw_installed, count(*) AS list_count FROM linked WHERE entity_id IS NOT NULL GROUP BY 1",
)
def a21(t):
    return marts.ranking_totals(linked_rankings(t))


@query(
    "a22_brand_tiers",
    """WITH l AS (SELECT contractor_id, brand, max_by(certification_tier, cert_id) AS tier FROM certifications GROUP BY 1, 2)
       SELECT contractor_id, string_agg(brand || '=' || tier, ';' ORDER BY brand) AS tiers, count(*) AS brands FROM l GROUP BY 1""",
)
def a22(t):
    held = marts.brand_tiers(t.certifications)
    pairs = F.transform(F.map_entries("tiers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return held.select(
        "contractor_id", F.array_join(F.array_sort(pairs), ";").alias("tiers"), F.size("tiers").cast("long").alias("brands")
    )


FL_ROWS = f"fl AS ({LOAD_SQL['FL']})"


def _florida(t):
    return loaded_registries(t).where("source = 'FL_License'")


def _multi_by(key: str) -> str:
    return f"""WITH {FL_ROWS}, k AS (SELECT *, {key} AS key FROM fl WHERE {key} IS NOT NULL),
        first3 AS (SELECT key, contact_name FROM (SELECT DISTINCT key, contact_name FROM k WHERE contact_name IS NOT NULL)
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY contact_name) <= 3),
        n AS (SELECT key, string_agg(contact_name, '; ' ORDER BY contact_name) AS first_names FROM first3 GROUP BY 1),
        h AS (SELECT key, count(DISTINCT license_category) AS category_count, string_agg(DISTINCT license_category, ', ' ORDER BY license_category) AS categories,
        string_agg(DISTINCT license_type, ', ' ORDER BY license_type) AS types, coalesce(string_agg(DISTINCT upper(email), ', ' ORDER BY upper(email)), '') AS emails,
        coalesce(string_agg(DISTINCT company_name, '; ' ORDER BY company_name), '') AS companies, min(concat_ws(', ', address, city, state, zip)) AS address
        FROM k GROUP BY 1 HAVING count(DISTINCT license_category) >= 2)
        SELECT h.*, n.first_names FROM h LEFT JOIN n USING (key)"""


@query("a23_multi_licence_by_company", _multi_by(duck.company_key_cut("company_name", fixed.CUT_ANYWHERE_SHORT)))
def a23(t):
    return marts.multi_licence_by(
        _florida(t), names.company_key_cut_anywhere("company_name", fixed.CUT_ANYWHERE_SHORT)
    )


@query("a23b_multi_licence_by_email", _multi_by("upper(email)"))
def a23b(t):
    return marts.multi_licence_by(_florida(t), F.upper("email"))


@query(
    "a24_before_after",
    """SELECT source_type, count(*) FILTER (side = 0) AS before_rows, count(*) FILTER (side = 1) AS after_rows, count(*) FILTER (side = 1) - count(*) FILTER (side = 0) AS change
       FROM (SELECT source_type, 0 AS side FROM contractors UNION ALL SELECT CASE WHEN source_type = 'state_license' AND id IN (SELECT contractor_id FROM certifications)
       THEN 'both' ELSE source_type END, 1 FROM contractors) GROUP BY 1""",
)
def a24(t):
    from ..operators.linkage import with_source_type

    before = t.contractors.select("id", "source_type")
    hits = t.certifications.select(F.col("contractor_id").alias("entity_id"))
    return marts.before_after(before, with_source_type(before, hits))


# --- quality -------------------------------------------------------------------------------------------

CHECKED = ["name", "phone", "email", "city", "state", "zip", "website"]
AS_OF = "2002-01-15"


@query(
    "q01_completeness",
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(nullif(trim({f}), '')) AS filled, {duck.percent(f'''count(nullif(trim({f}), ''))''', 'count(*)')} AS pct FROM dealers"
        for f in CHECKED
    ),
)
def q01(t):
    return quality.completeness(t.dealers, CHECKED)


@query(
    "q02_coverage",
    f"""SELECT count(DISTINCT scraped_from_zip) AS covered, CAST(264 AS BIGINT) AS targets, {duck.percent('count(DISTINCT scraped_from_zip)', '264')} AS pct,
        {duck.percent('count(DISTINCT scraped_from_zip)', '264')} >= 95 AS gate_met FROM dealers""",
)
def q02(t):
    return quality.coverage(t.dealers, "scraped_from_zip", 264)


@query(
    "q03_geography",
    f"""SELECT upper(trim(state)) AS state, count(*) AS rows, {duck.percent('count(*)', '(SELECT count(*) FROM dealers)')} AS pct FROM dealers GROUP BY 1
        ORDER BY rows DESC, state LIMIT 10""",
)
def q03(t):
    return quality.geography(t.dealers)


@query(
    "q04_inventory_by_source",
    """SELECT coalesce(source_type, 'unknown') AS source_name, 'CONTRACTOR_DB' AS source_type, count(*) AS record_count, count(primary_email) AS with_email_count,
       count(primary_phone) AS with_phone_count, CAST((count(primary_email) + count(primary_phone)) * 100 // (2 * count(*)) AS BIGINT) AS quality_score
       FROM contractors WHERE coalesce(is_deleted, 0) = 0 GROUP BY 1""",
)
def q04(t):
    return quality.inventory_by_source(t.contractors)


LIVE = "contractor_id IN (SELECT id FROM contractors WHERE coalesce(is_deleted, 0) = 0)"


@query(
    "q05_inventory_by_licence_state",
    f"""SELECT lower(state) || '_license' AS source_name, 'STATE_LICENSE' AS source_type, count(DISTINCT contractor_id) AS record_count, count(*) AS licences,
        {CAT_LIST} AS categories, 50 AS quality_score FROM licenses WHERE {LIVE} GROUP BY state""",
)
def q05(t):
    return quality.inventory_by_licence_state(t.licenses, t.contractors)


@query(
    "q06_inventory_by_brand",
    f"""SELECT replace(lower(brand), ' ', '_') AS source_name, 'OEM' AS source_type, count(DISTINCT contractor_id) AS record_count, count(*) AS items, 70 AS quality_score
        FROM certifications WHERE {LIVE} GROUP BY brand""",
)
def q06(t):
    return quality.inventory_by_brand(t.certifications, t.contractors)


@query(
    "q06b_inventory_by_ranking",
    f"""WITH {LINKED} SELECT 'ranking_' || lower(list_name) AS source_name, 'THIRD_PARTY' AS source_type, count(*) AS record_count, count(entity_id) AS matched, 90 AS quality_score
        FROM linked GROUP BY list_name""",
)
def q06b(t):
    return quality.inventory_by_ranking(linked_rankings(t))


@query(
    "q07_inventory_by_folder",
    """SELECT 'source_file=' || source_file AS folder, count(*) AS record_count, count(DISTINCT state) AS states
       FROM dealers GROUP BY 1""",
)
def q07(t):
    path = scratch_dir(t.spark, "q07")
    t.dealers.select("source_file", "dealer_id", "state").write.partitionBy("source_file").option("header", True).csv(path)
    rows = t.spark.read.option("header", True).csv(path)
    return quality.inventory_by_folder(rows.select("state", F.col("_metadata.file_path").alias("path")))


@query(
    "q08_inventory_upsert",
    """WITH n AS (SELECT source_type AS source_name, 'CONTRACTOR_DB' AS source_type, count(*) AS record_count, count(primary_email) AS with_email_count, count(primary_phone) AS with_phone_count,
         CAST((count(primary_email) + count(primary_phone)) * 100 // (2 * count(*)) AS BIGINT) AS quality_score FROM contractors WHERE coalesce(is_deleted, 0) = 0 GROUP BY 1),
       o AS (SELECT source_name, source_type, record_count, with_email_count, with_phone_count, CAST(age_days AS BIGINT) AS quality_score FROM inventory UNION ALL
         SELECT 'both', 'CONTRACTOR_DB', 1, 1, 1, 1)
       SELECT coalesce(n.source_name, o.source_name) AS source_name, coalesce(n.source_type, o.source_type) AS source_type, coalesce(n.record_count, o.record_count) AS record_count,
       coalesce(n.with_email_count, o.with_email_count) AS with_email_count, coalesce(n.with_phone_count, o.with_phone_count) AS with_phone_count,
       coalesce(n.quality_score, o.quality_score) AS quality_score, CASE WHEN n.record_count IS NULL THEN 'kept' WHEN o.record_count IS NULL THEN 'inserted' ELSE 'updated' END AS outcome
       FROM o FULL OUTER JOIN n ON n.source_name = o.source_name AND n.source_type = o.source_type""",
)
def q08(t):
    one = F.lit(1).cast("long")
    known = t.contractors.where("source_type = 'both'").select(
        F.col("source_type").alias("source_name"), F.lit("CONTRACTOR_DB").alias("source_type"),
        one.alias("record_count"), one.alias("with_email_count"), one.alias("with_phone_count"), one.alias("quality_score"),
    ).distinct()
    current = t.inventory.select(
        "source_name", "source_type", "record_count", "with_email_count", "with_phone_count",
        F.col("age_days").cast("long").alias("quality_score"),
    ).unionByName(known)
    return quality.inventory_upsert(current, quality.inventory_by_source(t.contractors))


@query(
    "q09_inventory_summary",
    f"""SELECT source_type, count(*) AS sources, CAST(sum(record_count) AS BIGINT) AS total_records, CAST(sum(with_email_count) AS BIGINT) AS with_email,
        CAST(sum(with_phone_count) AS BIGINT) AS with_phone, {duck.div_half_up('CAST(sum(age_days) AS BIGINT) * 10', 'count(*)')} / 10.0::DOUBLE AS avg_quality FROM inventory GROUP BY 1""",
)
def q09(t):
    return quality.inventory_summary(t.inventory.withColumnRenamed("age_days", "quality_score"))


@query(
    "q10_freshness",
    f"""SELECT import_id, CAST(date_diff('day', imported_on, DATE '{AS_OF}') AS INT) AS days_old, CASE WHEN date_diff('day', imported_on, DATE '{AS_OF}') <= 7 THEN 'FRESH'
        WHEN date_diff('day', imported_on, DATE '{AS_OF}') <= 30 THEN 'STALE' ELSE 'OUTDATED' END AS freshness_status FROM imports""",
)
def q10(t):
    return quality.freshness(t.imports, "imported_on", F.lit(AS_OF).cast("date")).select(
        "import_id", "days_old", "freshness_status"
    )


@query(
    "q11_collector_health",
    f"""SELECT c.collector_name, c.collector_type, c.status, CAST(date_diff('day', max(r.run_date) FILTER (r.status = 'SUCCESS'), DATE '{AS_OF}') AS INT) AS days_since_run,
        count(*) FILTER (r.status = 'SUCCESS') AS successful_runs, count(*) FILTER (r.status = 'FAILED') AS failed_runs, CAST(coalesce(sum(r.record_count), 0) AS BIGINT) AS records
        FROM collectors c LEFT JOIN collector_runs r USING (collector_name) GROUP BY 1, 2, 3""",
)
def q11(t):
    return quality.collector_health(t.collectors, t.collector_runs, F.lit(AS_OF).cast("date"))


@query(
    "q12_collector_status",
    """SELECT collector_type, count(*) FILTER (status = 'WORKING') AS working, count(*) FILTER (status = 'BROKEN') AS broken, count(*) FILTER (status = 'UNTESTED') AS untested,
       count(*) AS total FROM collectors GROUP BY 1""",
)
def q12(t):
    return quality.collector_status(t.collectors)


@query(
    "q13_derived_status",
    """WITH r AS (SELECT collector_name, CAST(sum(record_count) AS BIGINT) AS records FROM collector_runs WHERE status = 'SUCCESS' AND record_count > 40 GROUP BY 1)
       SELECT collector_name, coalesce(records, 0) AS records, CASE WHEN coalesce(records, 0) > 0 OR validated = 1 THEN 'WORKING' ELSE 'BROKEN' END AS status
       FROM collectors LEFT JOIN r USING (collector_name)""",
)
def q13(t):
    good = t.collector_runs.where("status = 'SUCCESS' AND record_count > 40")
    records = good.groupBy("collector_name").agg(F.sum("record_count").alias("records"))
    return quality.derived_status(t.collectors, records)


@query(
    "q14_pipeline_health",
    f"""WITH l AS (SELECT count(DISTINCT license_category) AS n FROM licenses GROUP BY contractor_id), b AS (SELECT count(DISTINCT brand) AS n FROM certifications GROUP BY contractor_id),
        c AS (SELECT * FROM contractors WHERE coalesce(is_deleted, 0) = 0)
        SELECT (SELECT count(*) FROM c) AS total_contractors, (SELECT count(primary_email) FROM c) AS with_email, (SELECT count(primary_phone) FROM c) AS with_phone,
        (SELECT {duck.percent('count(primary_email)', 'count(*)')} FROM c) AS email_rate, (SELECT {duck.percent('count(primary_phone)', 'count(*)')} FROM c) AS phone_rate,
        (SELECT count(*) FROM l WHERE n >= 2) AS multi_license_count, (SELECT count(*) FROM l WHERE n >= 3) AS unicorn_count, (SELECT count(*) FROM b WHERE n >= 2) AS multi_brand_count,
        (SELECT count(*) FROM collectors WHERE status = 'WORKING') AS collectors_working, (SELECT count(*) FROM collectors WHERE status = 'BROKEN') AS collectors_broken,
        (SELECT count(*) FROM collectors WHERE status = 'UNTESTED') AS collectors_untested""",
)
def q14(t):
    return quality.pipeline_health(t.contractors, t.licenses, t.certifications, t.collectors)


@query(
    "q15_state_coverage",
    """SELECT state, count(*) AS entities, count(primary_email) AS with_email, count(primary_phone) AS with_phone FROM contractors WHERE coalesce(is_deleted, 0) = 0
       GROUP BY state ORDER BY entities DESC, state LIMIT 20""",
)
def q15(t):
    return quality.state_coverage(t.contractors)


@query(
    "q16_expected_vs_actual",
    """WITH a AS (SELECT license_category AS metric, count(*) AS actual FROM licenses GROUP BY 1), e AS (SELECT license_category AS metric, count(DISTINCT license_id) + count(DISTINCT state) * 3 AS expected
       FROM licenses GROUP BY 1) SELECT metric, expected, actual, abs(actual - expected) * 100 <= expected * 5 AS within FROM e JOIN a USING (metric)""",
)
def q16(t):
    actual = t.licenses.groupBy(F.col("license_category").alias("metric")).agg(F.count(F.lit(1)).alias("actual"))
    expected = t.licenses.groupBy(F.col("license_category").alias("metric")).agg(
        (F.countDistinct("license_id") + F.countDistinct("state") * 3).alias("expected")
    )
    return quality.expected_vs_actual(actual, expected)


@query(
    "q17_scope_by_state",
    f"""SELECT registry_state, count(*) AS total_records, count(*) FILTER (s) AS scope_records, {duck.percent('count(*) FILTER (s)', 'count(*)')} AS scope_pct
        FROM (SELECT registry_state, regexp_matches(business_name, '(?i)electric|hvac|heating|solar') AS s FROM registry) GROUP BY 1""",
)
def q17(t):
    return quality.scope_by_state(t.registry, F.col("business_name").rlike("(?i)electric|hvac|heating|solar"))


@query(
    "q17b_cost_rates",
    f"""SELECT category AS activity, CAST(sum(billable_units) AS BIGINT) AS records, {duck.div_half_up('CAST(sum(amount_cents) AS BIGINT) * 100', 'CAST(sum(billable_units) AS BIGINT)')} / 100.0::DOUBLE AS cents_per_record,
        {duck.div_half_up('CAST(sum(billable_units) AS BIGINT) * 100', 'count(*) * 25')} AS records_per_hour FROM costs GROUP BY 1""",
)
def q17b(t):
    rows = t.costs.select(
        F.col("category").alias("activity"), F.col("billable_units").alias("records"),
        F.col("amount_cents").alias("cost_cents"), F.lit(25).alias("hours_hundredths"),
    )
    return quality.cost_rates(rows)


@query(
    "q18_recent_imports",
    "SELECT import_id, file_name, source_type, status, rows_new, rows_merged FROM imports ORDER BY imported_on DESC, import_id DESC LIMIT 10",
)
def q18(t):
    return quality.recent_imports(t.imports).select("import_id", "file_name", "source_type", "status", "rows_new", "rows_merged")


# --- funnel --------------------------------------------------------------------------------------------

TOTAL = "(acquisition_cost_cents + enrichment_cost_cents + outreach_cost_cents)"


@query(
    "r01_stage_metrics",
    f"""SELECT stage, count(*) AS lead_count, {duck.div_half_up(f'CAST(sum({TOTAL}) AS BIGINT)', 'count(*)')} / 100.0::DOUBLE AS avg_cost_per_lead,
        CAST(sum({TOTAL}) AS BIGINT) / 100.0::DOUBLE AS total_cost, {duck.div_half_up('CAST(sum(days_to_contact) AS BIGINT) * 10', 'count(days_to_contact)')} / 10.0::DOUBLE AS avg_days_to_contact,
        {duck.div_half_up('CAST(sum(days_to_response) AS BIGINT) * 10', 'count(days_to_response)')} / 10.0::DOUBLE AS avg_days_to_response FROM attribution GROUP BY stage""",
)
def r01(t):
    return funnel.stage_metrics(t.attribution)


@query(
    "r02_monthly_costs",
    f"""WITH u AS (SELECT *, amount_cents // nullif(billable_units, 0) AS unit FROM costs) SELECT strftime(cost_date, '%Y-%m') AS month, category,
        CAST(sum(amount_cents) AS BIGINT) / 100.0::DOUBLE AS total_cost_usd, CAST(sum(billable_units) AS BIGINT) AS total_units,
        {duck.div_half_up('CAST(sum(unit) AS BIGINT) * 100', 'count(unit)')} / 10000.0::DOUBLE AS avg_cost_per_unit FROM u GROUP BY 1, 2""",
)
def r02(t):
    return funnel.monthly_costs(t.costs)


def _spent(category: str) -> str:
    return f"(SELECT CAST(coalesce(sum(amount_cents), 0) AS BIGINT) FROM costs WHERE category = '{category}') / 100.0::DOUBLE AS {category}_cost"


ROI_PARTS = """w AS (SELECT CAST(coalesce(sum(amount_cents), 0) AS BIGINT) AS won, count(*) AS n FROM opportunities WHERE stage = 'WON'),
    s AS (SELECT CAST(coalesce(sum(amount_cents), 0) AS BIGINT) AS cents FROM costs), l AS (SELECT count(*) AS n FROM contractors WHERE coalesce(is_deleted, 0) = 0)"""


@query(
    "r03_return_on_investment",
    f"""WITH {ROI_PARTS} SELECT (SELECT cents FROM s) / 100.0::DOUBLE AS total_investment_usd, {', '.join(_spent(c) for c in funnel.COST_CATEGORIES)},
        (SELECT n FROM l) AS total_leads, (SELECT count(*) FROM attribution WHERE stage = 'ENRICHED') AS enriched_leads,
        (SELECT count(*) FROM attribution WHERE stage IN ('CONTACTED', 'RESPONDED', 'DEMO_SET')) AS active_leads,
        (SELECT count(*) FROM opportunities WHERE stage NOT IN ('WON', 'LOST')) AS open_opportunities,
        (SELECT CAST(coalesce(sum(amount_cents), 0) AS BIGINT) FROM opportunities WHERE stage NOT IN ('WON', 'LOST')) / 100.0::DOUBLE AS pipeline_value_usd,
        (SELECT n FROM w) AS closed_won_count, (SELECT won FROM w) / 100.0::DOUBLE AS closed_won_value_usd,
        (SELECT count(*) FROM opportunities WHERE stage = 'LOST') AS closed_lost_count,
        (SELECT CASE WHEN won < cents THEN -{duck.percent('cents - won', 'cents')} ELSE {duck.percent('won - cents', 'cents')} END FROM w, s) AS roi_percentage,
        (SELECT {duck.div_half_up('cents * 100', 'l.n')} / 10000.0::DOUBLE FROM s, l) AS cost_per_lead_usd,
        (SELECT {duck.div_half_up('cents', 'w.n')} / 100.0::DOUBLE FROM s, w) AS cost_per_closed_deal_usd""",
)
def r03(t):
    return funnel.return_on_investment(t.costs, t.attribution, t.opportunities, t.contractors)


def _stages(values: list[str]) -> str:
    return f"(SELECT count(*) FROM attribution WHERE stage IN ({duck.quoted(values)}))"


RATES = [
    ("Raw -> Enriched", "(SELECT count(*) FROM attribution WHERE stage <> 'RAW_LEAD')", "(SELECT count(*) FROM attribution)"),
    ("Enriched -> Contacted", _stages(funnel.PAST_CONTACT), "(SELECT count(*) FROM attribution WHERE stage <> 'RAW_LEAD')"),
    ("Contacted -> Response", _stages(funnel.PAST_RESPONSE), _stages(funnel.PAST_CONTACT)),
    ("Response -> Demo", _stages(funnel.PAST_DEMO), _stages(funnel.PAST_RESPONSE)),
    ("Demo -> Closed Won", "(SELECT count(*) FROM opportunities WHERE stage = 'WON')", "(SELECT count(*) FROM opportunities WHERE stage IN ('WON', 'LOST'))"),
]


@query(
    "r04_conversion_rates",
    f"SELECT *, {duck.percent('numerator', 'denominator')} AS conversion_rate_pct FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS conversion, {a} AS numerator, {b} AS denominator" for n, a, b in RATES) + ")",
)
def r04(t):
    return funnel.conversion_rates(t.attribution, t.opportunities)


@query("r05_total_cost", f"SELECT contractor_id, {TOTAL} AS total_cost_cents FROM attribution")
def r05(t):
    return t.attribution.select("contractor_id", funnel.total_cost().alias("total_cost_cents"))


@query("r06_unit_cost", "SELECT cost_id, amount_cents // nullif(billable_units, 0) AS cost_per_unit_cents FROM costs")
def r06(t):
    return t.costs.select("cost_id", funnel.unit_cost("amount_cents", "billable_units").alias("cost_per_unit_cents"))


# --- segment exports -------------------------------------------------------------------------------------

CONTACT = """ca AS (SELECT entity_key, min_by(coalesce(phone, '~'), dealer_id) AS p0, min_by(coalesce(domain_key, '~'), dealer_id) AS d0, min_by(zip, dealer_id) AS zip
    FROM (SELECT *, coalesce('phone_' || phone_key, 'domain_' || domain_key) AS entity_key FROM dk) WHERE entity_key IS NOT NULL GROUP BY 1),
    aud AS (SELECT final.*, nullif(p0, '~') AS phone, nullif(d0, '~') AS domain, zip FROM final JOIN ca USING (entity_key))"""


def audience(t):
    """Scored entities with the phone, domain and zip code of their first record."""
    rows = keyed_dealers(t, "phone").withColumn("entity_key", keyed.contact_key("phone_key", "domain_key"))
    first = rows.where("entity_key IS NOT NULL").groupBy("entity_key").agg(
        F.min_by(F.struct("phone", F.col("domain_key").alias("domain"), "zip"), "dealer_id").alias("c")
    )
    return name_scored(t).join(first.select("entity_key", "c.*"), "entity_key")


@query(
    "e01_search_audience",
    f"""WITH {G01_SQL}, {CONTACT} SELECT entity_key, 'info@' || domain AS email, {duck.digits('phone')} AS phone, 'US' AS country, zip, name AS company, icp_tier, icp_score, brand_count, brands
        FROM aud WHERE icp_tier IN ('PLATINUM', 'GOLD')""",
)
def e01(t):
    return exports.search_audience(audience(t))


@query(
    "e02_social_audience",
    f"""WITH {G01_SQL}, {CONTACT} SELECT entity_key, name AS company_name, {duck.digits('phone')} AS phone, '@' || domain AS email_domain, city, state, zip, icp_score, brand_count, brands
        FROM aud WHERE icp_tier = 'SILVER'""",
)
def e02(t):
    return exports.social_audience(audience(t), "SILVER")


@query(
    "e03_customer_match",
    f"""WITH {G01_SQL}, {CONTACT}, pick AS (SELECT * FROM aud WHERE icp_tier = 'GOLD' UNION ALL SELECT * FROM (SELECT * FROM aud WHERE icp_tier = 'SILVER' ORDER BY score_hundredths DESC, entity_key LIMIT 150))
        SELECT entity_key, '' AS email, coalesce('+1' || {duck.phone10('phone')}, '') AS phone, '' AS first_name, '' AS last_name, 'US' AS country, zip FROM pick""",
)
def e03(t):
    rows = audience(t)
    silver = numbering.top_n(rows.where("icp_tier = 'SILVER'"), 150, F.desc("score_hundredths"), F.asc("entity_key"))
    return exports.customer_match(rows.where("icp_tier = 'GOLD'").unionByName(silver))


@query("e04_multi_brand_audience", f"WITH {G01_SQL}, {CONTACT} SELECT entity_key, phone, 'US' AS country, zip FROM aud WHERE brand_count >= 2")
def e04(t):
    return exports.multi_brand_audience(audience(t))


@query(
    "e05_overlap_segments",
    f"""WITH {SOURCES} SELECT phone, num_brands, num_licences, num_overlaps, 'high_overlap' AS segment FROM grouped WHERE num_overlaps >= 4 UNION ALL
        SELECT phone, num_brands, num_licences, num_overlaps, 'multi_state' FROM grouped WHERE num_licences >= 2 UNION ALL
        SELECT phone, num_brands, num_licences, num_overlaps, 'multi_brand_multi_state' FROM grouped WHERE num_brands >= 2 AND num_licences >= 2""",
)
def e05(t):
    return exports.overlap_segments(phone_sources(t))


@query(
    "e06_high_tier_prospects",
    f"SELECT id, company_name, lead_score, {duck.tier('lead_score')} AS icp_tier FROM contractors WHERE lead_score >= 60 ORDER BY lead_score DESC, id",
)
def e06(t):
    scored = t.contractors.select("id", "company_name", "lead_score", tier_of(F.col("lead_score")).alias("icp_tier"))
    return scored.where(F.col("icp_tier").isin(exports.HIGH_TIERS)).orderBy(F.desc("lead_score"), "id")


def _in(states: list[str]) -> str:
    return f"count(*) FILTER (state IN ({duck.quoted(states)}))"


@query(
    "e07_executive_summary",
    f"""WITH {DK}, o AS ({OVERLAP}) SELECT count(*) AS total, {_in(quality.PRIMARY_MARKETS)} AS primary_markets, {_in(quality.SECONDARY_MARKETS)} AS secondary_markets,
        count(*) FILTER (brand_count >= 2) AS multi_brand, {duck.percent('count(*) FILTER (brand_count >= 2)', 'count(*)')} AS multi_brand_pct,
        {duck.percent(_in(quality.PRIMARY_MARKETS), 'count(*)')} AS primary_pct FROM o""",
)
def e07(t):
    return exports.executive_summary(overlap(t))


@query("e08_multi_licence_export", f"SELECT * FROM ({_multi_sql(2)}) WHERE primary_email IS NOT NULL")
def e08(t):
    return multi_category(t, 2).where("primary_email IS NOT NULL").orderBy(F.desc("category_count"), "company_name", "id")


LEADS = f"""leads AS (SELECT dealer_id, {duck.company_key('name')} AS normalized_name, brand, state, review_count, nullif(trim(phone), '') AS phone, {duck.clean('email')} AS email,
    CASE dealer_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'enriched' ELSE 'verified' END AS enrichment_status,
    CASE dealer_id % 4 WHEN 0 THEN 'not_synced' WHEN 1 THEN 'needs_update' ELSE 'synced' END AS crm_status FROM dealers)"""


def leads(t):
    third, fourth = F.col("dealer_id") % 3, F.col("dealer_id") % 4
    return t.dealers.select(
        "dealer_id", names.company_key("name").alias("normalized_name"), "brand", "state", "review_count",
        text.clean("phone").alias("phone"), text.clean("email").alias("email"),
        F.when(third == 0, "pending").when(third == 1, "enriched").otherwise("verified").alias("enrichment_status"),
        F.when(fourth == 0, "not_synced").when(fourth == 1, "needs_update").otherwise("synced").alias("crm_status"),
    )


@query("e09_ready_to_enrich", f"WITH {LEADS} SELECT dealer_id FROM leads WHERE enrichment_status = 'pending' AND (phone IS NOT NULL OR email IS NOT NULL)")
def e09(t):
    return exports.ready_to_enrich(leads(t)).select("dealer_id")


@query(
    "e09b_ready_to_sync",
    f"WITH {LEADS} SELECT dealer_id, review_count FROM leads WHERE enrichment_status IN ('enriched', 'verified') AND crm_status IN ('not_synced', 'needs_update')",
)
def e09b(t):
    return exports.ready_to_sync(leads(t), "review_count").select("dealer_id", "review_count")


@query(
    "e10_one_lead_per_key",
    f"""WITH {LEADS} SELECT dealer_id, normalized_name, brand, state FROM leads WHERE normalized_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY normalized_name, brand, state ORDER BY dealer_id) = 1""",
)
def e10(t):
    rows = leads(t).select("dealer_id", "normalized_name", "brand", "state")
    return keyed.first_per_key(rows, ["normalized_name", "brand", "state"], "dealer_id")
