"""Scores (G*) and capabilities (C*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed, places
from ..functions.licences import class_codes, class_flags, class_pairs
from ..functions.phones import phone10
from ..functions.text import clean
from ..operators import capabilities, enrich, marts, scoring
from ..operators.skew import lookup_join
from . import duck
from .linking import MASTER_LIST, master_rows
from .registry import query
from .resolving import OVERLAP, overlap
from .shared import DK, RK, keyed_dealers

AS_OF = "2005-06-30"
SCORED_COLUMNS = [
    "entity_key", "resimercial_score", "resimercial_evidence", "multi_brand_score",
    "multi_brand_evidence", "trade_score", "trade_evidence", "service_score", "service_evidence",
    "score_hundredths", "icp_score", "icp_tier",
]


def name_score_sql(source: str, with_hvac: bool) -> str:
    hvac = "coalesce(has_hvac, false)" if with_hvac else "false"
    kind = "generator/HVAC dealer" if with_hvac else "generator dealer"
    com, res = duck.has_any("name", fixed.COMMERCIAL_WORDS), duck.has_any("name", fixed.RESIDENTIAL_WORDS)
    backup = f"({duck.has_any('brands', fixed.GENERATOR_WORDS)} OR {hvac})"
    trades = ", ".join(
        f"CASE WHEN {duck.has_any('name', w)}{' OR ' + hvac if t == 'Mechanical' else ''} THEN '{t}' END"
        for t, w in fixed.TRADE_WORDS.items()
    )
    single = "'Single trade: ' || array_to_string(tr, ', ')"
    if with_hvac:
        single = f"CASE WHEN {hvac} THEN 'HVAC contractor (Mechanical)' ELSE {single} END"
    return f"""base AS (SELECT *, {com} AS com, {res} AS res, {backup} AS backup,
        {duck.has_any('tier', fixed.MARKET_TIER_WORDS)} AS mt, {duck.has_any('tier', fixed.SERVICE_TIER_WORDS)} AS st,
        list_filter([{trades}], lambda x: x IS NOT NULL) AS tr, {duck.found('name', fixed.MAINTENANCE_WORDS)} AS sv,
        {duck.has_any('name', fixed.ALL_TRADE_PHRASES)} AS allp, contains(lower(name), 'solutions') AS sol FROM {source}),
        dims AS (SELECT *,
        CASE WHEN com AND res THEN 100 WHEN com THEN 70 WHEN res THEN 60 WHEN mt AND backup THEN 75 WHEN backup THEN 50 ELSE 40 END AS resimercial_score,
        CASE WHEN com AND res THEN 'Explicit commercial + residential in name' WHEN com THEN 'Commercial indicator in name'
             WHEN res THEN 'Residential indicator in name' WHEN mt AND backup THEN 'Elite {kind} (likely serves both markets)'
             WHEN backup THEN '{kind[0].upper() + kind[1:]} (mixed market)' ELSE 'Market scope unclear' END AS resimercial_evidence,
        CASE WHEN brand_count >= 3 THEN 100 WHEN brand_count = 2 THEN 50 ELSE 25 END AS multi_brand_score,
        CASE WHEN brand_count >= 4 THEN '4+ brand certifications (' WHEN brand_count = 3 THEN '3 brand certifications ('
             WHEN brand_count = 2 THEN '2 brand certifications (' ELSE 'Single brand (' END || brands || ')' AS multi_brand_evidence,
        CASE WHEN len(tr) >= 3 OR allp THEN 100 WHEN len(tr) = 2 THEN 75 ELSE 50 END AS trade_score,
        CASE WHEN len(tr) >= 3 OR allp THEN 'Multi-trade: ' || CASE WHEN len(tr) > 0 THEN array_to_string(tr, ', ') ELSE 'All Trades' END
             WHEN len(tr) = 2 THEN 'Dual-trade: ' || array_to_string(tr, ', ') WHEN len(tr) = 1 THEN {single}
             ELSE 'Generator installation (implies electrical)' END AS trade_evidence,
        CASE WHEN len(sv) >= 2 THEN 100 WHEN len(sv) = 1 THEN 75 WHEN st THEN 60 WHEN sol THEN 50 ELSE 25 END AS service_score,
        CASE WHEN len(sv) >= 2 THEN 'Strong O&M indicators: ' || array_to_string(sv[1:3], ', ') WHEN len(sv) = 1 THEN 'O&M indicator: ' || sv[1]
             WHEN st THEN 'Elite tier (likely offers maintenance)' WHEN sol THEN 'Service-oriented name' ELSE 'O&M capability unclear' END AS service_evidence
        FROM base), scored AS (SELECT *, CAST(resimercial_score * 35 + multi_brand_score * 25 + trade_score * 25 + service_score * 15 AS BIGINT)
        AS score_hundredths FROM dims), final AS (SELECT *, round_even(score_hundredths / 100.0::DOUBLE, 1) AS icp_score,
        {duck.tier('score_hundredths', 100)} AS icp_tier FROM scored)"""


G01_SQL = f"{DK}, o AS ({OVERLAP}), {name_score_sql('o', False)}"
FLAG_SQL = """f AS (SELECT coalesce('phone_' || phone_key, 'domain_' || domain_key) AS entity_key,
    bool_or(has_hvac = 'True') AS has_hvac FROM dk GROUP BY 1), oh AS (SELECT o.*, f.has_hvac FROM o JOIN f USING (entity_key))"""


def name_scored(t):
    return scoring.name_score(overlap(t), with_hvac=False)


@query("g01_name_score", f"WITH {G01_SQL} SELECT {', '.join(SCORED_COLUMNS)} FROM final")
def g01(t):
    return name_scored(t).select(*SCORED_COLUMNS)


@query(
    "g02_name_score_hvac",
    f"WITH {DK}, o AS ({OVERLAP}), {FLAG_SQL}, {name_score_sql('oh', True)} SELECT {', '.join(SCORED_COLUMNS)} FROM final",
)
def g02(t):
    rows = overlap(t, ("has_hvac",))
    return scoring.name_score(rows, with_hvac=True).select(*SCORED_COLUMNS)


def classed(t):
    """Registry rows with class flags, tenure, class score and tier."""
    rows = t.registry.select(
        "row_no", "state", "class_codes", "issue_text",
        clean("business_name").alias("business_name"),
        phone10("business_phone").alias("phone_key"),
    )
    codes = rows.withColumn("codes", class_codes("class_codes"))
    flagged = codes.withColumns(class_flags(F.col("codes"))).withColumns(class_pairs("class_codes"))
    days = F.datediff(F.lit(AS_OF).cast("date"), places.lenient_date("issue_text"))
    timed = flagged.withColumns({
        "license_count": F.size("codes").cast("long"),
        "tenure_days": days,
        "is_high_tenure": F.coalesce(days >= 3652.5, F.lit(False)),
    })
    return scoring.class_score(timed).withColumn("base_score", F.col("total_score"))


def _class_sql(marks: list[str]) -> str:
    return "len(list_filter(codes, lambda c: " + " OR ".join(f"contains(c, '{m}')" for m in marks) + ")) > 0"


CLASSED = f"""{RK}, cc AS (SELECT row_no, state, phone_key, {duck.clean('business_name')} AS business_name, class_codes,
    list_filter(list_transform(string_split(upper(class_codes), '|'), lambda x: trim(x)), lambda x: x <> '') AS codes,
    date_diff('day', try_cast(issue_text AS DATE), DATE '{AS_OF}') AS tenure_days FROM rk),
    cf AS (SELECT *, {', '.join(f'{_class_sql(m)} AS {n}' for n, m in fixed.CLASS_FLAGS.items())},
    list_contains(codes, 'B') AS is_gc, list_contains(codes, 'A') AS is_engineering_gc, len(codes) AS license_count,
    coalesce(tenure_days >= 3652.5, false) AS is_high_tenure,
    regexp_matches(class_codes, 'C-?10') AS c10, regexp_matches(class_codes, 'C-?20') AS c20, regexp_matches(class_codes, 'C-?46') AS c46 FROM cc),
    cs AS (SELECT *, c10 AND c20 AND c46 AS has_all_three, (c10 AND c20) OR (c10 AND c46) OR (c20 AND c46) AS is_multi_trade,
    CASE WHEN is_gc AND is_engineering_gc THEN 35 WHEN is_gc THEN 20 WHEN is_engineering_gc THEN 15 ELSE 0 END AS resimercial_score,
    0 AS multi_brand_score, 5 AS service_score,
    CASE WHEN has_solar THEN least(tp + 5, 25) ELSE tp END AS trade_score FROM (SELECT *,
        CASE CAST(has_electrical AS INT) + CAST(has_hvac AS INT) + CAST(has_plumbing AS INT) WHEN 0 THEN 0 WHEN 1 THEN 10
        WHEN 2 THEN 18 ELSE 25 END AS tp FROM cf)),
    ct AS (SELECT *, resimercial_score + multi_brand_score + trade_score + service_score AS total_score FROM cs),
    classed AS (SELECT *, total_score AS base_score, {duck.tier('total_score')} AS icp_tier FROM ct)"""
CLASS_OUT = ["row_no", "resimercial_score", "trade_score", "service_score", "total_score", "icp_tier"]


@query("g03_class_score", f"WITH {CLASSED} SELECT {', '.join(CLASS_OUT)} FROM classed")
def g03(t):
    return classed(t).select(*CLASS_OUT)


@query(
    "g04_rescore_with_brands",
    f"""WITH {DK}, {CLASSED}, b AS (SELECT phone_key, count(DISTINCT brand) AS n FROM dk WHERE phone_key IS NOT NULL GROUP BY 1),
        r AS (SELECT row_no, classed.phone_key, CASE WHEN n >= 4 THEN 25 WHEN n = 3 THEN 19 WHEN n = 2 THEN 12 ELSE 6 END AS multi_brand_score,
        resimercial_score + trade_score + service_score + CASE WHEN n >= 4 THEN 25 WHEN n = 3 THEN 19 WHEN n = 2 THEN 12 ELSE 6 END AS total_score
        FROM classed JOIN b USING (phone_key)) SELECT *, {duck.tier('total_score')} AS icp_tier FROM r""",
)
def g04(t):
    matched = enrich.phone_overlap(
        classed(t).withColumnRenamed("row_no", "pos"), keyed_dealers(t)
    )
    return scoring.rescore_with_brands(matched, "brand_count").select(
        F.col("pos").alias("row_no"), "phone_key", "multi_brand_score", "total_score", "icp_tier"
    )


def held_licences(t):
    return t.licenses.select(
        F.col("contractor_id").alias("entity_id"), "state", "license_category", "license_id"
    )


def licence_profile(t):
    """Capability flags, state count and SREC states per licensed entity."""
    held = held_licences(t)
    flags = capabilities.category_flags(held)
    states = held.groupBy("entity_id").agg(
        F.countDistinct("state").alias("state_count"),
        F.countDistinct(F.when(F.col("state").isin(fixed.SREC_STATES), F.col("state"))).alias("srec_states"),
        F.array_sort(
            F.collect_set(F.when(F.col("state").isin(fixed.SREC_STATES), F.col("state")))
        ).alias("srec_list"),
        F.array_sort(F.collect_set("license_category")).alias("category_list"),
    )
    return flags.join(states, "entity_id")


def _cat(flag: str) -> str:
    cats = [c for c, f in fixed.CATEGORY_FLAGS.items() if f == flag]
    return f"bool_or(license_category IN ({duck.quoted(cats)})) AS {flag}"


PROFILE = f"""profile AS (SELECT contractor_id AS entity_id, {', '.join(_cat(f) for f in sorted(set(fixed.CATEGORY_FLAGS.values())))},
    count(DISTINCT license_category) AS license_count, count(DISTINCT state) AS state_count,
    count(DISTINCT state) FILTER (state IN ({duck.quoted(fixed.SREC_STATES)})) AS srec_states,
    list_sort(list(DISTINCT state) FILTER (state IN ({duck.quoted(fixed.SREC_STATES)}))) AS srec_list,
    list_sort(list(DISTINCT license_category)) AS category_list FROM licenses GROUP BY 1)"""


@query(
    "g05_source_score",
    f"""WITH {MASTER_LIST}, {PROFILE}, s AS (SELECT entity_id, least(100, CAST(in_ranking AS INT) * 15 + CAST(in_solar_coop AS INT) * 10 +
        CAST(in_om_coop AS INT) * 10 + 5 + CAST(has_solar AS INT) * 10 + CAST(has_electrical AS INT) * 5 + CAST(has_hvac AS INT) * 5 +
        CAST(has_general_contractor AS INT) * 5 + CASE WHEN license_count >= 3 THEN 5 ELSE 0 END +
        CASE WHEN kw_installed > 1000000 THEN 10 WHEN kw_installed > 100000 THEN 5 ELSE 0 END +
        CASE WHEN list_count >= 5 THEN 10 WHEN list_count >= 3 THEN 5 ELSE 0 END + CASE WHEN srec_states > 0 THEN 5 ELSE 0 END +
        CASE WHEN state_count >= 3 THEN 5 ELSE 0 END) AS icp_score FROM ml JOIN profile USING (entity_id))
        SELECT *, {duck.tier('icp_score')} AS icp_tier FROM s""",
)
def g05(t):
    rows = master_rows(t).join(licence_profile(t), "entity_id")
    return scoring.source_score(rows).select("entity_id", "icp_score", "icp_tier")


def enhanced_rows(t):
    brands = t.certifications.groupBy(F.col("contractor_id").alias("entity_id")).agg(
        F.array_sort(F.collect_set("brand")).alias("brand_list")
    )
    members = master_rows(t).select(
        "entity_id", "in_solar_coop", "in_om_coop",
        F.when(F.col("in_ranking"), F.col("kw_installed")).alias("kw_installed"),
        F.when(F.col("in_ranking"), F.col("list_count")).alias("list_count"),
    )
    profile = licence_profile(t).select("entity_id", "srec_list", "category_list")
    return members.join(brands, "entity_id").join(profile, "entity_id")


def _any(values: list[str]) -> str:
    return f"list_has_any(brand_list, [{duck.quoted(values)}])"


ENHANCED = f"""{MASTER_LIST}, {PROFILE}, bl AS (SELECT contractor_id AS entity_id, list_sort(list(DISTINCT brand)) AS brand_list FROM certifications GROUP BY 1),
    en AS (SELECT *, {_any(scoring.HVAC_BRANDS)} AS hv, {_any(scoring.GENERATOR_BRANDS)} AS ge, {_any(scoring.SOLAR_BRANDS)} AS so,
    list_contains(category_list, 'ELECTRICAL') OR {_any(scoring.ELECTRICAL_BRANDS)} AS el, list_contains(category_list, 'PLUMBING') AS pl,
    len(brand_list) AS n FROM ml JOIN profile USING (entity_id) JOIN bl USING (entity_id)),
    en2 AS (SELECT *, CAST(hv AS INT) + CAST(ge AS INT) + CAST(so AS INT) AS kinds, list_contains(category_list, 'HVAC') OR hv AS ht,
    CAST(el AS INT) + CAST(list_contains(category_list, 'HVAC') OR hv AS INT) + CAST(pl AS INT) +
    CAST(list_contains(category_list, 'ROOFING') OR list_contains(category_list, 'SOLAR') OR so AS INT) AS tc,
    coalesce(len(srec_list), 0) > 0 AS sr FROM en),
    en3 AS (SELECT *, CASE WHEN hv THEN 25 ELSE 0 END + CASE WHEN kinds >= 2 THEN 10 ELSE 0 END AS resimercial_score,
    CASE WHEN n >= 3 THEN 25 WHEN n = 2 THEN 15 WHEN n = 1 THEN 5 ELSE 0 END AS multi_brand_score,
    CASE WHEN tc >= 3 THEN 25 WHEN tc = 2 THEN 15 WHEN tc = 1 THEN 5 ELSE 0 END AS trade_score,
    CASE WHEN in_om_coop THEN 15 WHEN hv THEN 10 WHEN ge THEN 5 ELSE 0 END AS service_score,
    CASE WHEN in_ranking THEN 10 ELSE 0 END + CASE WHEN in_solar_coop THEN 5 ELSE 0 END + CASE WHEN sr THEN 5 ELSE 0 END AS bonus_score,
    concat_ws('; ', CASE WHEN hv THEN 'HVAC brand (typically resimercial)' END,
      CASE WHEN kinds >= 2 THEN 'Multi-product (' || kinds || ' types)' END,
      CASE WHEN in_solar_coop THEN 'Solar cooperative member (values-driven)' END,
      CASE WHEN sr THEN 'SREC state (' || array_to_string(srec_list, ', ') || ')' END,
      CASE WHEN n >= 3 THEN 'Triple+ brand (' || n || ' brands)' WHEN n = 2 THEN 'Dual brand (' || array_to_string(brand_list, ', ') || ')'
           WHEN n = 1 THEN 'Single brand (' || brand_list[1] || ')' END,
      CASE WHEN in_ranking THEN 'Ranked (' || kw_installed || ' kW, ' || list_count || ' lists)' END,
      CASE WHEN tc >= 3 THEN 'Multi-trade (' || tc || ' trades)' WHEN tc = 2 THEN 'Dual-trade (2 trades)' WHEN tc = 1 THEN 'Single trade: ' ||
           concat_ws(', ', CASE WHEN el THEN 'Electrical' END, CASE WHEN ht THEN 'HVAC' END, CASE WHEN pl THEN 'Plumbing' END) END,
      CASE WHEN in_om_coop THEN 'O&M cooperative member (proven O&M capability)' WHEN hv THEN 'HVAC brand (service contracts typical)'
           WHEN ge THEN 'Generator brand (maintenance required)' END) AS evidence FROM en2),
    en4 AS (SELECT *, least(100, resimercial_score + multi_brand_score + trade_score + service_score + bonus_score) AS icp_score FROM en3)"""
ENHANCED_OUT = ["entity_id", "resimercial_score", "multi_brand_score", "trade_score", "service_score", "bonus_score", "icp_score", "evidence"]


@query("g06_enhanced_score", f"WITH {ENHANCED} SELECT {', '.join(ENHANCED_OUT)}, {duck.tier('icp_score')} AS icp_tier FROM en4")
def g06(t):
    return scoring.enhanced_score(enhanced_rows(t)).select(*ENHANCED_OUT, "icp_tier")


def four_part_rows(t):
    held = t.licenses.groupBy("contractor_id").agg(
        F.countDistinct("license_category").alias("category_count"),
        F.count_if(F.col("license_category") == "HVAC").alias("hvac_licences"),
        F.count_if(F.col("license_category") == "ELECTRICAL").alias("electrical_licences"),
        F.count_if(F.col("license_category").isin("SOLAR", "ENERGY")).alias("solar_licences"),
    )
    pairs = t.certifications.select("contractor_id", "brand").distinct()
    brands = pairs.groupBy("contractor_id").agg(
        F.count(F.lit(1)).alias("brand_total"),
        *[F.count_if(F.col("brand").isin(v)).alias(f"{k}_brands") for k, v in scoring.PART_BRANDS.items()],
    )
    kw = master_rows(t).select(F.col("entity_id").alias("contractor_id"), "kw_installed")
    base = t.contractors.select(F.col("id").alias("contractor_id"))
    counts = ["category_count", "hvac_licences", "electrical_licences", "solar_licences",
              "brand_total", *[f"{k}_brands" for k in scoring.PART_BRANDS]]
    return (
        base.join(held, "contractor_id", "left").join(brands, "contractor_id", "left")
        .join(kw, "contractor_id", "left").fillna(0, subset=counts)
    )


FOUR_PART = f"""{MASTER_LIST}, h AS (SELECT contractor_id, count(DISTINCT license_category) AS cc, count(*) FILTER (license_category = 'HVAC') AS hl,
    count(*) FILTER (license_category = 'ELECTRICAL') AS el, count(*) FILTER (license_category IN ('SOLAR', 'ENERGY')) AS sl FROM licenses GROUP BY 1),
    b AS (SELECT contractor_id, count(DISTINCT brand) AS bt, {', '.join(f"count(DISTINCT brand) FILTER (brand IN ({duck.quoted(v)})) AS {k}_b" for k, v in scoring.PART_BRANDS.items())}
    FROM certifications GROUP BY 1), q AS (SELECT ml.entity_id AS contractor_id, ml.kw_installed AS kw, coalesce(cc, 0) AS cc, coalesce(hl, 0) AS hl, coalesce(el, 0) AS el,
    coalesce(sl, 0) AS sl, coalesce(bt, 0) AS bt, coalesce(hvac_b, 0) AS hb, coalesce(generator_b, 0) AS gb, coalesce(solar_b, 0) AS sb, coalesce(battery_b, 0) AS bb
    FROM ml LEFT JOIN h ON h.contractor_id = ml.entity_id LEFT JOIN b ON b.contractor_id = ml.entity_id),
    q1 AS (SELECT *, CASE WHEN cc >= 4 THEN 100 WHEN cc >= 3 THEN 80 WHEN cc >= 2 THEN 60 WHEN cc >= 1 THEN 30 ELSE 0 END AS bs,
    CASE WHEN sl > 0 OR sb > 0 OR bb > 0 THEN 60 ELSE 0 END AS rs FROM q),
    q2 AS (SELECT contractor_id, CASE WHEN hl > 0 AND el > 0 THEN least(100, bs + 20) ELSE bs END AS trade_score,
    CASE WHEN bt >= 3 THEN 100 WHEN bt >= 2 THEN 70 WHEN bt >= 1 THEN 40 ELSE 0 END AS brand_score,
    CASE WHEN sb > 0 AND bb > 0 THEN 100 WHEN kw > 0 THEN greatest(rs, 80) ELSE rs END AS renewable_score,
    least(100, CASE WHEN hb > 0 THEN 40 ELSE 0 END + CASE WHEN gb > 0 THEN 40 ELSE 0 END + CASE WHEN hl > 0 THEN 20 ELSE 0 END) AS asset_score FROM q1),
    fp AS (SELECT *, CAST((trade_score * 35 + brand_score * 25 + renewable_score * 25 + asset_score * 15) // 100 AS BIGINT) AS icp_score FROM q2)"""
FOUR_OUT = ["contractor_id", "trade_score", "brand_score", "renewable_score", "asset_score", "icp_score"]


@query("g07_four_part_score", f"WITH {FOUR_PART} SELECT {', '.join(FOUR_OUT)}, {duck.tier('icp_score')} AS icp_tier FROM fp")
def g07(t):
    return scoring.four_part_score(four_part_rows(t)).select(*FOUR_OUT, "icp_tier")


def composite_rows(t):
    """Class-scored licences with the phones' multi-state and brand flags."""
    rows = classed(t)
    spread = rows.where("phone_key IS NOT NULL").groupBy("phone_key").agg(
        (F.countDistinct("state") >= 2).alias("is_multi_state")
    )
    branded = keyed_dealers(t).select("phone_key", F.lit(True).alias("has_brand")).where(
        "phone_key IS NOT NULL"
    ).distinct()
    marks = spread.join(branded, "phone_key", "left")
    return scoring.composite_score(lookup_join(rows, marks, "phone_key", "row_no", "left"))


COMPOSITE = f"""{DK}, {CLASSED}, sp AS (SELECT phone_key, count(DISTINCT state) >= 2 AS ms FROM classed WHERE phone_key IS NOT NULL GROUP BY 1),
    br AS (SELECT DISTINCT phone_key, true AS hb FROM dk WHERE phone_key IS NOT NULL),
    parts AS (SELECT row_no, base_score AS b, CASE WHEN is_multi_trade THEN 30 ELSE 0 END AS p1, CASE WHEN has_all_three THEN 20 ELSE 0 END AS p2,
    CASE WHEN is_high_tenure THEN 15 ELSE 0 END AS p3, CASE WHEN ms THEN 25 ELSE 0 END AS p4, CASE WHEN hb THEN 20 ELSE 0 END AS p5
    FROM classed LEFT JOIN sp USING (phone_key) LEFT JOIN br ON br.phone_key = classed.phone_key),
    composed AS (SELECT row_no, b + p1 + p2 + p3 + p4 + p5 AS composite_score, 'Base: ' || b || ' | Multi-trade: ' || p1 || ' | All three: ' || p2 ||
    ' | Tenure: ' || p3 || ' | Multi-state: ' || p4 || ' | Brand: ' || p5 AS score_breakdown FROM parts)"""


@query("g08_composite_score", f"WITH {COMPOSITE} SELECT * FROM composed")
def g08(t):
    return composite_rows(t).select("row_no", "composite_score", "score_breakdown")


@query(
    "g09_lead_score",
    f"""WITH l AS (SELECT ranking_id, CASE list_name WHEN 'ECONOMY' THEN 'RANK_COMMERCIAL' WHEN 'PROMO' THEN 'RANK_EPC' ELSE 'RANK_OTHER' END AS source,
        rank_position <= 100 AS is_top_100, headquarters_state AS state, contains(markets, 'C&I') AND contains(markets, 'R') AS rm,
        len(list_filter(['ELE', 'HVAC', 'SOL', 'CONT', 'PLUM'], lambda w: contains(upper(licence_text), w))) >= 2 AS mt,
        profile_url IS NOT NULL AS he, count(*) OVER (PARTITION BY {duck.company_key('company_name')}) AS sc FROM rankings)
        SELECT ranking_id, CAST(least(100, CASE WHEN he THEN 20 ELSE 0 END + CASE WHEN mt THEN 25 ELSE 0 END +
        CASE WHEN source = 'RANK_COMMERCIAL' AND is_top_100 THEN 20 ELSE 0 END + CASE WHEN source = 'RANK_EPC' THEN 15 ELSE 0 END +
        CASE WHEN rm THEN 15 ELSE 0 END + CASE WHEN state = 'FL' THEN 5 ELSE 0 END + CASE WHEN sc > 1 THEN (sc - 1) * 10 ELSE 0 END) AS BIGINT) AS score FROM l""",
)
def g09(t):
    from ..functions.names import company_key
    from ..sources.listings import partner_licences, serves_both_markets

    rows = t.rankings.withColumn("name_key", company_key("company_name"))
    counts = rows.groupBy("name_key").agg(F.count(F.lit(1)).alias("source_count"))
    leads = lookup_join(rows, counts, "name_key", "ranking_id").select(
        "ranking_id",
        F.when(F.col("list_name") == "ECONOMY", "RANK_COMMERCIAL")
        .when(F.col("list_name") == "PROMO", "RANK_EPC").otherwise("RANK_OTHER").alias("source"),
        (F.col("rank_position") <= 100).alias("is_top_100"),
        F.col("headquarters_state").alias("state"),
        serves_both_markets("markets").alias("is_resimercial"),
        partner_licences("licence_text")[1].alias("is_multi_trade"),
        F.col("profile_url").isNotNull().alias("has_email"), "source_count",
    )
    return scoring.lead_score(leads).select("ranking_id", F.col("score").cast("long").alias("score"))


AGENT = f"""bc AS (SELECT contractor_id, {', '.join(f"count(DISTINCT brand) FILTER (brand IN ({duck.quoted(v)})) AS {k}_brands" for k, v in fixed.BRAND_CATEGORIES.items())},
    count(DISTINCT brand) AS brand_total FROM certifications GROUP BY 1),
    bcc AS (SELECT *, {' + '.join(f'CASE WHEN {k}_brands > 0 THEN 1 ELSE 0 END' for k in fixed.BRAND_CATEGORIES)} AS brand_categories FROM bc),
    lf AS (SELECT contractor_id, {', '.join(f"bool_or(license_category = '{c}') AS has_{c.lower()}" for c in ['HVAC', 'ELECTRICAL', 'PLUMBING', 'SOLAR'])} FROM licenses GROUP BY 1),
    agent AS (SELECT c.id AS entity_id, c.primary_phone AS phone, c.primary_email AS email, CAST(least(100, CASE WHEN has_hvac THEN 10 ELSE 0 END + CASE WHEN has_electrical THEN 10 ELSE 0 END +
    CASE WHEN has_plumbing THEN 10 ELSE 0 END + CASE WHEN has_solar THEN 10 ELSE 0 END + least(coalesce(brand_categories, 0) * 10, 40) +
    CASE WHEN c.primary_phone IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN c.primary_email IS NOT NULL THEN 10 ELSE 0 END) AS INT) AS score
    FROM contractors c LEFT JOIN bcc ON bcc.contractor_id = c.id LEFT JOIN lf ON lf.contractor_id = c.id)"""


def agent_rows(t):
    entities = t.contractors.select(
        F.col("id").alias("entity_id"), F.col("primary_phone").alias("phone"), F.col("primary_email").alias("email")
    )
    held = held_licences(t)
    flagged = enrich.category_flags(entities, held, ["HVAC", "ELECTRICAL", "PLUMBING", "SOLAR"])
    kinds = marts.brand_category_counts(t.certifications).select(
        F.col("contractor_id").alias("entity_id"), "brand_categories"
    )
    return flagged.join(kinds, "entity_id", "left").fillna(0, subset=["brand_categories"]).withColumn(
        "score", scoring.capability_score().cast("int")
    )


@query("g10_capability_score", f"WITH {AGENT} SELECT entity_id, score FROM agent")
def g10(t):
    return agent_rows(t).select("entity_id", "score")


@query(
    "g11_contact_quality",
    """SELECT id, CASE WHEN primary_phone IS NOT NULL AND primary_email IS NOT NULL THEN 'GOLD'
       WHEN primary_phone IS NOT NULL OR primary_email IS NOT NULL THEN 'SILVER' ELSE 'BRONZE' END AS quality FROM contractors""",
)
def g11(t):
    return t.contractors.select(
        "id", scoring.contact_quality_tier("primary_phone", "primary_email").alias("quality")
    )


@query(
    "g12_brand_count_tier",
    f"""WITH {DK}, o AS ({OVERLAP}) SELECT CASE WHEN brand_count >= 3 THEN 'TRIPLE' WHEN brand_count = 2 THEN 'DUAL' ELSE 'SINGLE' END
        AS brand_tier, count(*) AS entities FROM o GROUP BY 1""",
)
def g12(t):
    tier = scoring.brand_count_tier(F.col("brand_count")).alias("brand_tier")
    return overlap(t).groupBy(tier).agg(F.count(F.lit(1)).alias("entities"))


@query(
    "g13_priority_score",
    f"""WITH {DK}, o AS ({OVERLAP}), sz AS (SELECT state, CASE WHEN count(*) > 40 THEN 'HIGH' ELSE 'MEDIUM' END AS sp FROM o GROUP BY 1),
        p AS (SELECT entity_key, CASE WHEN brand_count >= 3 THEN 40 WHEN brand_count = 2 THEN 25 WHEN brand_count = 1 THEN 10 ELSE 0 END +
        CASE sp WHEN 'HIGH' THEN 20 WHEN 'MEDIUM' THEN 10 ELSE 0 END + CASE WHEN length(name) >= 50 THEN 20 WHEN length(name) >= 10 THEN 15
        WHEN length(name) >= 5 THEN 10 ELSE 5 END + CASE WHEN length(brands) <= 10 THEN 10 WHEN length(brands) <= 30 THEN 7 ELSE 0 END +
        CASE WHEN contains(lower(name), 'commercial') THEN 10 WHEN contains(lower(name), 'home') THEN 7 ELSE 0 END AS priority_score
        FROM o JOIN sz USING (state)) SELECT *, CASE WHEN priority_score >= 80 THEN 'HIGH' WHEN priority_score >= 50 THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM p""",
)
def g13(t):
    """The lookups the score needs are inputs; here they come from sizes and lengths."""
    rows = overlap(t)
    sizes = rows.groupBy("state").agg(
        F.when(F.count(F.lit(1)) > 40, "HIGH").otherwise("MEDIUM").alias("state_priority")
    )
    lowered = F.lower("name")
    inputs = rows.join(sizes, "state").withColumns({
        "employees": F.length("name"), "zip_rank": F.length("brands"),
        "urgency": F.when(lowered.contains("commercial"), "CRITICAL").when(lowered.contains("home"), "HIGH"),
    })
    return scoring.priority_score(inputs).select("entity_key", "priority_score", "priority")


@query(
    "g14_contact_share",
    """SELECT source_type, count(*) AS entities, CAST((count(primary_email) + count(primary_phone)) * 100 // (2 * count(*)) AS BIGINT) AS quality_score
       FROM contractors GROUP BY source_type""",
)
def g14(t):
    rows = F.count(F.lit(1))
    return t.contractors.groupBy("source_type").agg(
        rows.alias("entities"),
        scoring.contact_share_score(F.count("primary_email"), F.count("primary_phone"), rows).alias("quality_score"),
    )


# --- capabilities ---------------------------------------------------------------------------------

BRAND_FLAG_NAMES = sorted({f for flags in fixed.BRAND_FLAGS.values() for f in flags})


@query(
    "c01_brand_flags",
    "SELECT dealer_id, brand, "
    + ", ".join(
        f"coalesce(brand IN ({duck.quoted([b for b, fl in fixed.BRAND_FLAGS.items() if f in fl])}), false) AS {f}"
        for f in BRAND_FLAG_NAMES
    )
    + " FROM dealers",
)
def c01(t):
    return capabilities.brand_flags(t.dealers.select("dealer_id", "brand"))


def _rule_sql(flag: str) -> str:
    fields = {"name": "name", "tier": "tier", "certs": "certifications", "name+certs": "name || ' ' || certifications"}
    tests = []
    for brand, field, words, flags in capabilities.BRAND_RULES:
        if flag not in flags:
            continue
        extra = "" if field == "always" else (
            f" AND tier IN ({duck.quoted(words)})" if field == "tier_is"
            else f" AND {duck.has_any(fields[field], words)}"
        )
        tests.append(f"(brand = '{brand}'{extra})")
    if flag == "is_commercial":
        tests += [f"(brand = '{b}' AND rating >= 4.5 AND review_count >= {n})" for b, n in capabilities.RATED_COMMERCIAL.items()]
    return " OR ".join(tests)


CAPS = f"""c0 AS (SELECT *, {', '.join(f'({_rule_sql(f)}) AS {f}' for f in capabilities.FLAGS if f != 'is_residential')}, ({_rule_sql('is_residential')}) AS res0
    FROM (SELECT dealer_id, name, tier, brand, certifications, rating, review_count, phone, website FROM dealers)),
    caps AS (SELECT *, res0 OR (brand IN ({duck.quoted(capabilities.RESIDENTIAL_UNLESS_COMMERCIAL)}) AND NOT is_commercial) AS is_residential FROM c0),
    c2 AS (SELECT *, name || ' ' || certifications || ' ' || tier AS txt FROM caps),
    c3 AS (SELECT *, {duck.has_any('txt', fixed.OPERATIONS_WORDS)} AS has_om_capability,
    (has_electrical AND has_hvac AND has_plumbing AND has_roofing) OR {duck.has_any('txt', fixed.FOUR_TRADE_WORDS)} AS is_mep_r,
    {duck.has_any('txt', fixed.FIRE_SECURITY_WORDS)} AS has_fire_security FROM c2),
    c4 AS (SELECT *, list_filter([CASE WHEN has_hvac THEN 'HVAC' END, CASE WHEN has_electrical THEN 'Electrical' END, CASE WHEN has_plumbing THEN 'Plumbing' END,
    CASE WHEN has_fire_security THEN 'Fire/Security' END, CASE WHEN has_solar OR has_inverters OR has_microinverters THEN 'Solar/Energy' END,
    CASE WHEN has_generator OR has_battery THEN 'Generator/Battery' END], lambda x: x IS NOT NULL) AS tr FROM c3)"""


def capable(t):
    rows = t.dealers.select(
        "dealer_id", "name", "tier", "brand", "certifications", "rating", "review_count", "phone", "website"
    )
    return capabilities.trade_count(capabilities.high_value_types(capabilities.directory_flags(rows)))


@query("c02_directory_flags", f"WITH {CAPS} SELECT dealer_id, {', '.join(capabilities.FLAGS)} FROM caps")
def c02(t):
    return capable(t).select("dealer_id", *capabilities.FLAGS)


@query(
    "c02b_flags_per_entity",
    f"""WITH {DK}, {CAPS} SELECT phone_key, {', '.join(f'bool_or(caps.{f}) AS {f}' for f in capabilities.FLAGS)}
        FROM caps JOIN dk USING (dealer_id) WHERE phone_key IS NOT NULL GROUP BY phone_key""",
)
def c02b(t):
    rows = capable(t).withColumn("phone_key", phone10("phone")).where("phone_key IS NOT NULL")
    return rows.groupBy("phone_key").agg(*[F.bool_or(f).alias(f) for f in capabilities.FLAGS])


# written out brand by brand, not derived from the operator's lists
SETS_SQL = """sets AS (SELECT dealer_id, has_o_m AS has_ops_maintenance,
    CASE brand WHEN 'Mitsubishi' THEN 'Mitsubishi Electric' WHEN 'Tigo' THEN 'Tigo Energy' ELSE brand END AS certified,
    CASE WHEN brand = 'SimpliPhi' AND contains(lower(certifications), 'generators') THEN 'Briggs & Stratton' END AS partner,
    CASE WHEN brand IN ('Cummins', 'Kohler') THEN brand
         WHEN brand = 'Briggs & Stratton' AND contains(lower(certifications), 'standby generators') THEN brand END AS generator,
    CASE WHEN brand IN ('Tesla', 'Sol-Ark', 'SimpliPhi') THEN brand
         WHEN brand = 'Generac' AND (tier IN ('Premier', 'Elite Plus', 'Elite') OR contains(lower(certifications), 'powerpro premier')) THEN brand
         WHEN brand = 'Briggs & Stratton' AND (contains(lower(certifications), 'battery storage') OR contains(lower(tier), 'elite iq')) THEN brand
         WHEN brand IN ('Enphase', 'SolarEdge') AND contains(lower(certifications), 'storage') THEN brand
         WHEN brand = 'Fronius' AND (contains(lower(certifications), 'battery storage') OR contains(lower(certifications), 'hybrid systems')) THEN brand END AS battery,
    CASE brand WHEN 'Tesla' THEN brand WHEN 'Enphase' THEN brand WHEN 'SolarEdge' THEN brand WHEN 'SMA' THEN brand WHEN 'Fronius' THEN brand
         WHEN 'Sol-Ark' THEN brand WHEN 'Tigo' THEN 'Tigo Energy' END AS inverter
    FROM (SELECT *, brand = 'Enphase' AND contains(lower(certifications), 'o&m') AS has_o_m FROM dealers))"""
SET_COLUMNS = ["oem_certifications", "generator_oems", "battery_oems", "inverter_oems"]


@query(
    "c02c_brand_sets",
    f"""WITH {SETS_SQL} SELECT dealer_id, CASE WHEN partner IS NULL THEN certified ELSE partner || ', ' || certified END AS oem_certifications,
        coalesce(generator, '') AS generator_oems, coalesce(battery, '') AS battery_oems, coalesce(inverter, '') AS inverter_oems,
        coalesce(has_ops_maintenance, false) AS has_ops_maintenance FROM sets""",
)
def c02c(t):
    return capabilities.brand_sets(capable(t)).select(
        "dealer_id", *[F.array_join(c, ", ").alias(c) for c in SET_COLUMNS], "has_ops_maintenance"
    )


@query(
    "c02d_brand_sets_per_entity",
    f"""WITH {DK}, {SETS_SQL}, long AS (SELECT dealer_id, unnest([certified, partner]) AS held FROM sets)
        SELECT phone_key, string_agg(DISTINCT held, ', ' ORDER BY held) AS oem_certifications,
        coalesce(string_agg(DISTINCT generator, ', ' ORDER BY generator), '') AS generator_oems,
        coalesce(string_agg(DISTINCT battery, ', ' ORDER BY battery), '') AS battery_oems,
        coalesce(string_agg(DISTINCT inverter, ', ' ORDER BY inverter), '') AS inverter_oems,
        bool_or(coalesce(has_ops_maintenance, false)) AS has_ops_maintenance
        FROM sets JOIN long USING (dealer_id) JOIN dk USING (dealer_id) WHERE phone_key IS NOT NULL GROUP BY phone_key""",
)
def c02d(t):
    rows = capabilities.brand_sets(capable(t)).withColumn("phone_key", phone10("phone"))
    return capabilities.brand_sets_per_entity(rows, "phone_key").select(
        "phone_key", *[F.array_join(c, ", ").alias(c) for c in SET_COLUMNS], "has_ops_maintenance"
    )


@query(
    "c03_trade_count",
    f"""WITH {CAPS} SELECT dealer_id, CAST(len(tr) AS INT) AS trade_count, len(tr) >= 2 AS is_multi_trade,
        CASE WHEN len(tr) >= 2 THEN array_to_string(tr, '+') ELSE '' END AS trade_combo FROM c4""",
)
def c03(t):
    return capable(t).select("dealer_id", "trade_count", "is_multi_trade", "trade_combo")


@query("c04_high_value_types", f"WITH {CAPS} SELECT dealer_id, has_om_capability, is_mep_r, has_fire_security FROM c3")
def c04(t):
    return capable(t).select("dealer_id", "has_om_capability", "is_mep_r", "has_fire_security")


@query(
    "c05_capability_count",
    f"WITH {CAPS} SELECT dealer_id, {' + '.join(f'CAST({f} AS INT)' for f in capabilities.FLAGS if f.startswith('has_'))} AS capabilities FROM caps",
)
def c05(t):
    return capable(t).select("dealer_id", capabilities.capability_count().alias("capabilities"))


@query(
    "c06_category_flags",
    f"SELECT contractor_id AS entity_id, {', '.join(_cat(f) for f in sorted(set(fixed.CATEGORY_FLAGS.values())))}, count(DISTINCT license_category) AS license_count FROM licenses GROUP BY 1",
)
def c06(t):
    return capabilities.category_flags(held_licences(t))


@query(
    "c07_class_pairs",
    f"WITH {CLASSED} SELECT row_no, c10 AND c20 AS has_c10_c20, c10 AND c46 AS has_c10_c46, c20 AND c46 AS has_c20_c46, has_all_three, is_multi_trade FROM classed",
)
def c07(t):
    return t.registry.select(
        "row_no", *[test.alias(name) for name, test in class_pairs("class_codes").items()]
    )
