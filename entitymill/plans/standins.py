"""Contact, licence, ranking and funnel tables derived from the given star schema.

The given tables hold no phones or company names. Every stand-in below is plain SQL that
Spark and DuckDB read alike, so that a query and its check start from the same rows. All of
them cover their base table row by row and grow with it; nothing is sampled. About three
consecutive keys stand for one business, with noise in spelling, phone, mail and web form.
"""

from __future__ import annotations

STATES = ["CA", "TX", "FL", "NY", "PA", "MA", "NJ", "OH", "AZ", "NV", "CO", "GA", "NC",
          "WA", "OR", "IL", "MI", "MD", "CT", "VA", "TN", "SC", "UT", "NM", "MO"]
SYLLABLE_A = ["Brad", "Hart", "Win", "Ash", "Mor", "Stan", "Green", "Red", "Thorn", "Lang",
              "Fair", "Wood", "Black", "Clay", "Nor", "Al"]
SYLLABLE_B = ["ford", "ley", "ton", "well", "field", "gate", "man", "son", "bury", "wick", "dale"]
LEAD_WORD = ["", "Tri-State ", "Pacific ", "Summit ", "Gulf Coastal ", "Lone Star ", "Liberty ",
             "Pioneer ", "Metro ", "Valley ", "Élan ", "Blue Sky ", "All Phase "]
TRADE = ["Electric", "Heating & Cooling", "Solar", "Plumbing", "Roofing", "Fire Protection",
         "Mechanical", "Home Services", "Commercial Maintenance"]
SUFFIX = ["", " LLC", ", Inc.", " Corp", " Company, LLC", " Co.", " Services Inc"]
CITIES = ["Springfield", "Austin", "Tampa", "Fresno", "Albany", "Dayton", "Tucson", "Boulder",
          "Macon", "Salem", "Joliet", "Flint"]
BRANDS = ["Generac", "Briggs & Stratton", "Cummins", "Kohler", "Tesla", "Enphase", "SolarEdge",
          "SMA", "Carrier", "Mitsubishi", "York", "Trane", "Rheem", "Fronius", "Sol-Ark",
          "SimpliPhi", "Schneider Electric", "Lennox", "Tigo"]
DEALER_TIERS = ["Premier", "Elite Plus", "Certified Installer", "Platinum Pro", "Standard",
                "Elite IQ", "Diamond Commercial", "Authorized Dealer"]
CATEGORIES = ["HVAC", "ELECTRICAL", "PLUMBING", "SOLAR", "ROOFING", "FIRE", "LOW_VOLTAGE",
              "GENERAL", "BUILDING", "REFRIGERATION", "UTILITY", "SPECIALTY"]
STAGES = ["RAW_LEAD", "ENRICHED", "CONTACTED", "RESPONDED", "DEMO_SET", "OPPORTUNITY",
          "CLOSED_WON", "CLOSED_LOST", "DISQUALIFIED"]


def pick(index: str, values: list[str]) -> str:
    return f"split_part('{'~'.join(values)}', '~', CAST(({index}) % {len(values)} AS INT) + 1)"


def part_of(k: str, size: int) -> str:
    return f"CAST(floor(({k}) / {size}) AS BIGINT)"


def phone_digits(k: str, e: str) -> str:
    own = (
        f"(lpad(CAST(201 + ({e} * 37) % 780 AS STRING), 3, '0') || "
        f"lpad(CAST(({e} * 7919) % 10000000 AS STRING), 7, '0'))"
    )
    other = f"('9' || lpad(CAST((({k}) * 104729) % 1000000000 AS STRING), 9, '0'))"
    return (
        f"(CASE WHEN ({k}) % 17 = 0 THEN '8005550100' WHEN ({k}) % 10 = 7 THEN {other} "
        f"ELSE {own} END)"
    )


def keyed(table: str, key: str) -> str:
    """The base rows with k (record key), e (the business it stands for) and what follows from e.

    sn surname, td trade, sx suffix, nm plain name, mb mailbox, dg phone digits (in parts d1-d3), dom domain, st state, cy city, zp zip.
    """
    serial = f"CASE WHEN e >= 20592 THEN ' ' || CAST({part_of('e', 20592)} AS STRING) ELSE '' END"
    return f"""(
        SELECT *, {pick(part_of('e', 176), LEAD_WORD)} || sn || ' ' || td || {serial} || sx AS nm,
               lower(sn) || CAST(e AS STRING) || '.com' AS dom,
               substring(dg, 1, 3) AS d1, substring(dg, 4, 3) AS d2, substring(dg, 7, 4) AS d3
        FROM (
            SELECT *, {pick('e', SYLLABLE_A)} || {pick(part_of('e', 16), SYLLABLE_B)} AS sn,
                   {phone_digits('k', 'e')} AS dg, {pick('e', TRADE)} AS td, {pick('k', SUFFIX)} AS sx,
                   {pick('k', ["info", "Sales", "j.smith", "office"])} AS mb,
                   CASE WHEN k % 11 = 0 THEN {pick('k', STATES)} ELSE {pick('e', STATES)} END AS st,
                   {pick(part_of('e', 2), CITIES)} AS cy,
                   lpad(CAST(10000 + (e * 31) % 8999 AS STRING), 5, '0') ||
                       CASE WHEN k % 4 = 1 THEN '-1234' ELSE '' END AS zp
            FROM (
                SELECT *, CAST(floor(k / 3) AS BIGINT) AS e
                FROM (SELECT *, {key} AS k FROM {{{table}}}) base
            ) entity
        ) parts
    ) keyed"""


NAME = (
    "(CASE CAST(k % 8 AS INT) WHEN 3 THEN upper(nm) WHEN 5 THEN '  ' || nm || '  ' "
    "WHEN 6 THEN sn || 's ' || td || sx ELSE nm END)"
)

PHONE_CLEAN = "(CASE WHEN k % 9 = 4 OR k % 13 = 5 THEN NULL ELSE dg END)"

PHONE = (
    "(CASE WHEN k % 9 = 4 THEN NULL WHEN k % 13 = 5 THEN '555-01' "
    "ELSE CASE CAST(k % 5 AS INT) WHEN 0 THEN '(' || d1 || ') ' || d2 || '-' || d3 "
    "WHEN 1 THEN '+1 ' || d1 || '-' || d2 || '-' || d3 "
    "WHEN 2 THEN d1 || '.' || d2 || '.' || d3 WHEN 3 THEN '1' || dg "
    "ELSE d1 || '-' || d2 || '-' || d3 || ' ext 12' END END)"
)

EMAIL = (
    "(CASE WHEN k % 8 = 3 THEN NULL WHEN k % 8 = 5 THEN '  ' "
    "WHEN k % 6 = 2 THEN lower(sn) || CAST(k AS STRING) || '@gmail.com' "
    "WHEN k % 5 = 1 THEN '  ' || mb || '@' || upper(dom) || ' ' "
    "ELSE mb || '@' || dom END)"
)

WEBSITE = (
    "(CASE CAST(k % 7 AS INT) WHEN 0 THEN 'https://www.' || dom || '/contact?x=1' "
    "WHEN 1 THEN 'http://' || dom || ':8080/a' WHEN 2 THEN 'shop.' || dom "
    "WHEN 3 THEN 'WWW.' || dom || '/' WHEN 4 THEN NULL WHEN 5 THEN 'not a domain' "
    "ELSE dom END)"
)


def variant(k: str, row: str, most: int) -> str:
    """0 .. m-1 with m between 1 and `most` fixed by the key, so that counts differ."""
    return f"(({row}) % (1 + ({k}) % {most}))"


def brand_of(row: str) -> str:
    return pick(f"k * 5 + {variant('k', row, 5)} * 4", BRANDS)


def category_of(row: str) -> str:
    return pick(f"k * 3 + {variant('k', row, 4)}", CATEGORIES)


def licence_state_of(row: str) -> str:
    return f"(CASE WHEN k % 3 = 0 AND ({row}) % 2 = 1 THEN {pick(f'k + ({row}) % 3', STATES)} ELSE st END)"


def class_list(k: str) -> str:
    return pick(k, ["C10", "B| C10| C20", "A| B", "A|B|C-10|C46", "C20|C36", "C-7", "B",
                    "C10|C20|C36", "", "HAZ|C46", "C-20| C46 |"])


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


C, O, P, S = "c_custkey", "o_orderkey", "p_partkey", "s_suppkey"
K = "o_custkey"

# Tables of long string expressions, written once per application instead of derived in each query.
HEAVY = {"dealers", "contractors", "licenses", "certifications", "contacts", "registry", "rankings", "members",
         "imports"}
TABLES: dict[str, str] = {
    # brand directory records, one per customer
    "dealers": f"""
        SELECT {C} AS dealer_id,
               'dir_' || CAST({C} % 4 AS STRING) AS source_file,
               {NAME} AS name, {PHONE} AS phone, {EMAIL} AS email,
               {WEBSITE} AS website,
               CAST(e AS STRING) || ' Main St' AS street, cy AS city,
               st AS state, zp AS zip,
               {pick(C, DEALER_TIERS)} AS tier, {brand_of(C)} AS brand,
               {pick(C, ['Storage,Commercial', 'O&M', '', 'Hybrid Battery', 'Award Winner',
                         'Security alarm', 'VRF, Maintenance'])} AS certifications,
               CAST(floor((c_acctbal + 1000) / 2200) AS INT) AS rating,
               CAST({C} % 37 AS INT) AS review_count,
               CAST(10000 + {C} % 290 AS STRING) AS scraped_from_zip,
               {pick(C, ['True', 'False', ''])} AS has_hvac,
               {pick(C, ['', 'True'])} AS has_generator
        FROM {keyed('customer', C)}""",
    # the master table with its children
    "contractors": f"""
        SELECT {C} AS id, {NAME} AS company_name, cy AS city,
               st AS state, zp AS zip, {PHONE_CLEAN} AS primary_phone,
               CASE WHEN {C} % 8 = 3 OR {C} % 8 = 5 THEN NULL
                    ELSE lower(trim({EMAIL})) END AS primary_email,
               CASE WHEN {C} % 7 = 4 THEN NULL ELSE dom END AS primary_domain,
               {WEBSITE} AS website_url,
               {pick(part_of(C, 4), ['state_license', 'oem_dealer', 'both'])} AS source_type,
               CASE WHEN {C} % 19 = 1 THEN 1 WHEN {C} % 23 = 2 THEN NULL ELSE 0 END AS is_deleted,
               CAST(floor(c_acctbal / 120) AS INT) AS lead_score
        FROM {keyed('customer', C)}""",
    "licenses": f"""
        SELECT {O} AS license_id, {K} AS contractor_id, {licence_state_of(O)} AS state,
               {pick(O, ['CAC', 'C-10', 'EC', 'CFC', 'C46'])} AS license_type,
               {category_of(O)} AS license_category,
               'L' || CAST({K} * 10 + {variant(K, O, 4)} AS STRING) AS license_number,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS issue_date,
               {pick(O, ['fl_2024.csv', 'ca_2024.csv', 'tx_2024.csv'])} AS source_file
        FROM {keyed('orders', K)}""",
    "certifications": f"""
        SELECT {O} AS cert_id, {K} AS contractor_id, {brand_of(O)} AS brand,
               {pick(O, DEALER_TIERS)} AS certification_tier,
               CAST(10000 + {O} % 290 AS STRING) AS scraped_from_zip,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS scraped_on
        FROM {keyed('orders', K)}""",
    "contacts": f"""
        SELECT {O} AS contact_id, {K} AS contractor_id,
               sn || ' ' || {pick(O, ['Pat', 'Sam', 'Lee'])} AS contact_name,
               CASE WHEN {O} % 5 = 2 THEN NULL
                    ELSE {pick(O, ['info', 'Sales', 'j.smith'])} || '@' || dom END AS email,
               CASE WHEN {O} % 4 = 1 THEN NULL ELSE CASE WHEN {O} % 2 = 0 THEN dg ELSE '7' || substring(dg, 2, 9) END END AS phone,
               CASE WHEN {O} % 2 = 0 THEN 80 ELSE 70 END AS confidence
        FROM {keyed('orders', K)}""",
    # registry extracts in their own headers, one row per order
    "registry": f"""
        SELECT {O} AS row_no, {K} AS holder,
               {pick(O, ['FL', 'CA', 'TX', 'NYC'])} AS registry_state,
               CASE CAST({O} % 4 AS INT)
                    WHEN 0 THEN {pick(part_of(O, 4), ['CAC', 'ER', 'CPC', 'ZZZ', 'EC', 'EL'])}
                    WHEN 1 THEN {pick(part_of(O, 4), ['C-10', 'C-7', 'C-20', 'B'])}
                    WHEN 2 THEN {pick(part_of(O, 4), ['Electrical Contractor', 'A/C Contractor',
                        'Journeyman Electrician', 'Elevator Contractor', 'Master Electrician'])}
                    ELSE {pick(part_of(O, 4), ['A', 'P', 'G', 'K', 'O', 'F'])} END AS type_code,
               {class_list(O)} AS class_codes,
               'N' || CAST({O} AS STRING) AS license_number,
               CASE WHEN {O} % 6 = 1 THEN '' ELSE {NAME} END AS business_name,
               CASE WHEN {O} % 12 = 1 THEN '' ELSE sn || ' Pat' END AS person_name,
               CASE WHEN {O} % 5 = 3 THEN '' ELSE {PHONE} END AS business_phone,
               '(' || d1 || ') ' || d2 || '-9' || substring(d3, 2, 3) AS person_phone, {EMAIL} AS email,
               CAST(e AS STRING) || ' Main St' AS address1,
               CASE WHEN {O} % 3 = 0 THEN 'Suite ' || CAST({O} % 9 AS STRING) ELSE '' END AS address2,
               cy AS city, st AS state, zp AS zip,
               CASE WHEN {O} % 9 = 0 THEN upper(cy)
                    WHEN {O} % 9 = 1 THEN upper(cy) || ', ' || st
                    WHEN {O} % 9 = 2 THEN ''
                    ELSE upper(cy) || ', ' || st || ' ' || zp
               END AS city_state_zip,
               CASE WHEN {O} % 10 = 4 THEN 'not known' WHEN {O} % 10 = 6 THEN NULL
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS issue_text,
               CASE CAST({O} % 3 AS INT) WHEN 0 THEN 'CLEAR' WHEN 1 THEN 'clear ' ELSE 'Expired' END
                    AS status
        FROM {keyed('orders', K)}""",
    # ranked lists and membership lists
    "rankings": f"""
        SELECT {P} AS ranking_id, {NAME} AS company_name,
               p_type AS list_name, CAST(1 + {P} % 400 AS INT) AS rank_position,
               CAST(floor(p_retailprice * p_size * 20) AS BIGINT) AS kw_installed,
               CASE WHEN {P} % 4 = 2 THEN NULL ELSE st END AS headquarters_state,
               CASE WHEN {P} % 3 = 0 THEN NULL ELSE 'https://' || dom END AS profile_url,
               CASE CAST({P} % 3 AS INT) WHEN 0 THEN 'kW Installed in 2024' WHEN 1 THEN '2024'
                    ELSE '' END || CAST(10 + p_size AS STRING) || ',' ||
               lpad(CAST({P} % 1000 AS STRING), 3, '0') || ' kW' AS kw_text,
               {pick(P, ['C&I, R', 'R', 'C&I', 'Utility', ''])} AS markets,
               {pick(P, ['ELE; HVAC', 'SOL', 'ele, plum, cont', '', 'HVAC'])} AS licence_text
        FROM {keyed('part', P)}""",
    "members": f"""
        SELECT {S} AS member_id, dom AS domain,
               {NAME} AS company_name,
               CASE WHEN s_nationkey % 2 = 0 THEN 'solar' ELSE 'om' END AS list_name
        FROM {keyed('supplier', 's_suppkey * 2')}""",
    # collectors, runs, inventory, imports
    "collectors": f"""
        SELECT 'collector_' || CAST({S} AS STRING) AS collector_name,
               {pick(S, ['oem', 'license', 'ranking'])} AS collector_type,
               {pick(part_of(S, 2), ['WORKING', 'BROKEN', 'UNTESTED'])} AS status,
               CASE WHEN {S} % 5 = 0 THEN 1 ELSE 0 END AS validated
        FROM {{supplier}}""",
    "collector_runs": """
        SELECT 'collector_' || CAST(l_suppkey AS STRING) AS collector_name,
               CASE l_returnflag WHEN 'A' THEN 'FAILED' WHEN 'R' THEN 'PARTIAL' ELSE 'SUCCESS' END
                    AS status,
               CAST(l_quantity AS BIGINT) AS record_count,
               CAST(l_shipdate AS DATE) AS run_date
        FROM {lineitem}""",
    "inventory": f"""
        SELECT 'source_' || CAST({P} AS STRING) AS source_name,
               {pick(P, ['oem', 'state_license', 'ranking', 'file'])} AS source_type,
               CAST(floor(p_retailprice) AS BIGINT) AS record_count,
               CAST(floor(p_retailprice * (p_size % 10) / 10) AS BIGINT) AS with_email_count,
               CAST(floor(p_retailprice * (p_size % 7) / 7) AS BIGINT) AS with_phone_count,
               CAST(p_size AS INT) AS age_days, p_brand AS folder
        FROM {{part}}""",
    "imports": f"""
        SELECT {O} AS import_id, 'file_' || CAST({O} % 50 AS STRING) || '.csv' AS file_name,
               md5('file_' || CAST({O} % 50 AS STRING) || CAST(o_custkey AS STRING)) AS file_hash,
               {pick(O, ['oem', 'state_license', 'ranking'])} AS source_type,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END
                    AS status,
               CAST({O} % 100 AS BIGINT) AS rows_read, CAST({O} % 60 AS BIGINT) AS rows_new,
               CAST({O} % 30 AS BIGINT) AS rows_merged,
               CAST(o_orderdate AS DATE) AS imported_on, st AS state
        FROM {keyed('orders', K)}""",
    # funnel and money
    "funnel_events": f"""
        SELECT event_id, user_id AS contractor_id, ts,
               CASE event_type WHEN 'view' THEN 'RAW_LEAD' WHEN 'click' THEN 'ENRICHED'
                    WHEN 'signup' THEN 'CONTACTED' WHEN 'purchase' THEN 'CLOSED_WON'
                    ELSE 'CLOSED_LOST' END AS stage_to,
               {cents('value')} AS cost_cents
        FROM {{events}}""",
    "costs": f"""
        SELECT event_id AS cost_id, CAST(ts AS DATE) AS cost_date,
               CASE event_type WHEN 'view' THEN 'infrastructure' WHEN 'click' THEN 'scraping'
                    WHEN 'signup' THEN 'enrichment' WHEN 'purchase' THEN 'outreach'
                    ELSE 'labor' END AS category,
               {cents('value')} AS amount_cents,
               CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id % 7 * 10 END AS billable_units
        FROM {{events}}""",
    "attribution": f"""
        SELECT {C} AS contractor_id, {pick(f'{C} * 7 + c_nationkey', STAGES)} AS stage,
               {pick(C, ['state_license', 'oem', 'ranking'])} AS acquisition_source,
               CAST(100 + {C} % 90 AS BIGINT) AS acquisition_cost_cents,
               CAST({C} % 45 AS BIGINT) AS enrichment_cost_cents,
               CAST({C} % 31 AS BIGINT) AS outreach_cost_cents,
               CASE WHEN {C} % 4 = 0 THEN NULL ELSE CAST({C} % 20 AS BIGINT) END AS days_to_contact,
               CASE WHEN {C} % 3 = 0 THEN NULL ELSE CAST({C} % 11 AS BIGINT) END AS days_to_response
        FROM {{customer}}""",
    "opportunities": f"""
        SELECT {O} AS opportunity_id, {K} AS contractor_id,
               CASE o_orderstatus WHEN 'F' THEN CASE WHEN {O} % 2 = 0 THEN 'WON' ELSE 'LOST' END
                    WHEN 'O' THEN 'DEMO' ELSE 'PROPOSAL' END AS stage,
               {cents('o_totalprice')} AS amount_cents
        FROM {{orders}}""",
}


def cte(name: str) -> str:
    """DuckDB text of a stand-in."""
    class Plain(dict):
        def __missing__(self, key: str) -> str:
            return key

    return f"{name} AS ({TABLES[name].format_map(Plain())})"
