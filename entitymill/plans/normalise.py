"""Scalar normalisers (N*) and predicates (F*) over the directory records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import domains, fixed_values as fixed, names, phones, places, text
from ..functions.licences import category_of
from ..functions.similarity import block_ratio, indel_ratio
from ..operators import filters
from . import duck
from .registry import query


def _phone(name: str, fn, sql: str) -> None:
    @query(name, f"SELECT dealer_id, {sql} AS result FROM dealers")
    def run(t, fn=fn):
        return t.dealers.select("dealer_id", fn("phone").alias("result"))


_phone("n01_phone10", phones.phone10, duck.phone10("phone"))
_phone(
    "n02_phone10_no_ext",
    phones.phone10_without_extension,
    duck.phone10(r"regexp_replace(phone, '(?i)\s*(ext|x)\s*[0-9]+', '', 'g')"),
)
_phone("n03_digits", phones.digits, duck.digits("phone"))
_phone("n04_last10", phones.last10, f"right({duck.digits('phone')}, 10)")
_phone(
    "n05_toll_free",
    lambda c: phones.is_toll_free(phones.phone10(c)),
    duck.toll_free(duck.phone10("phone")),
)
_phone(
    "n06_display",
    lambda c: phones.display(phones.local_phone10(c)),
    f"CASE WHEN NOT {duck.toll_free(duck.phone10('phone'))} THEN '(' || substr({duck.phone10('phone')}, 1, 3) || ') ' || "
    f"substr({duck.phone10('phone')}, 4, 3) || '-' || substr({duck.phone10('phone')}, 7, 4) END",
)
_phone("n07_e164", lambda c: phones.e164(phones.phone10(c)), f"'+1' || {duck.phone10('phone')}")


def _column(name: str, column: str, fn, sql: str) -> None:
    @query(name, f"SELECT dealer_id, {sql} AS result FROM dealers")
    def run(t, fn=fn, column=column):
        return t.dealers.select("dealer_id", fn(column).alias("result"))


_column("n08_email", "email", domains.email_key, duck.email_key("email"))
_column("n09_email_domain", "email", domains.email_domain, duck.email_domain("email"))
_column("n10_url_host", "website", domains.url_host, duck.url_host("website"))
_column("n11_root_domain", "website", domains.root_domain, duck.root_domain("website"))
_column("n12_loose_domain", "website", domains.loose_domain, duck.loose_domain("website"))
_column("n13_company_key", "name", names.company_key, duck.company_key("name"))
_column("n14_company_key_upper", "name", names.company_key_upper, duck.company_key_upper("name"))
_column(
    "n15_company_key_trade", "name", names.company_key_trade,
    duck.company_key("name", fixed.TRADE_SUFFIXES),
)
_column(
    "n16_company_key_anchored", "name", names.company_key_anchored,
    duck.company_key_anchored("name"),
)
_column(
    "n17_company_key_cut", "name", names.company_key_cut_anywhere, duck.company_key_cut("name")
)
_column(
    "n18_business_name", "name", names.is_business_name,
    duck.has_any("name", fixed.BUSINESS_NAME_WORDS),
)


@query(
    "n19_blank_guard",
    f"""SELECT dealer_id, coalesce({duck.company_key('name')} = {duck.company_key('certifications')}
        OR length({duck.company_key('certifications')}) > 0, false) AS comparable FROM dealers""",
)
def n19(t):
    left, right = names.company_key("name"), names.company_key("certifications")
    return t.dealers.select(
        "dealer_id", (left.isNotNull() & right.isNotNull()).alias("comparable")
    )


def _name_pairs(t):
    """Each directory record next to the earliest record of its domain."""
    keyed = t.dealers.select(
        "dealer_id",
        names.company_key("name").alias("name_key"),
        domains.root_domain("website").alias("domain"),
    )
    first = keyed.where("domain IS NOT NULL").groupBy("domain").agg(
        F.min_by("name_key", "dealer_id").alias("first_key")
    )
    return keyed.join(first, "domain")


@query(
    "n20_block_ratio",
    f"""WITH RECURSIVE k AS (SELECT dealer_id, {duck.company_key('name')} AS name_key, {duck.root_domain('website')} AS domain FROM dealers),
        f AS (SELECT domain, first(name_key ORDER BY dealer_id) AS first_key FROM k WHERE domain IS NOT NULL GROUP BY domain),
        {duck.distinct_pairs('SELECT name_key AS a, first_key AS b FROM k JOIN f USING (domain)')}, {duck.BLOCK_RATIOS}
        SELECT dealer_id, coalesce(ratio, 0) AS ratio
        FROM k JOIN f USING (domain) LEFT JOIN ratios ON a = name_key AND b = first_key""",
)
def n20(t):
    return _name_pairs(t).select(
        "dealer_id", block_ratio(F.col("name_key"), F.col("first_key")).alias("ratio")
    )


@query(
    "n21_indel_ratio",
    f"""WITH k AS (SELECT dealer_id, {duck.company_key('name')} AS name_key, {duck.root_domain('website')} AS domain FROM dealers),
        f AS (SELECT domain, first(name_key ORDER BY dealer_id) AS first_key FROM k WHERE domain IS NOT NULL GROUP BY domain)
        SELECT dealer_id, coalesce(CAST(200 AS DOUBLE) * {duck.LCS} / (length(name_key) + length(first_key)), 0) AS ratio
        FROM k JOIN f USING (domain)""",
)
def n21(t):
    return _name_pairs(t).select(
        "dealer_id", indel_ratio(F.col("name_key"), F.col("first_key")).alias("ratio")
    )


@query(
    "n22_fingerprint",
    """SELECT dealer_id, substr(md5('city=' || coalesce(city, '') || '|email=' || coalesce(email, '')
       || '|name=' || coalesce(name, '') || '|phone=' || coalesce(phone, '') || '|state=' ||
       coalesce(state, '')), 1, 16) AS result FROM dealers""",
)
def n22(t):
    return t.dealers.select(
        "dealer_id",
        text.fingerprint(["name", "phone", "email", "city", "state"]).alias("result"),
    )


@query(
    "n23_city_state_zip",
    r"""SELECT row_no,
        CASE WHEN x ~ '.+,? +[A-Z]{2} +[0-9]{5}(-[0-9]{4})?' THEN regexp_extract(x, '^(.+?),?\s+([A-Z]{2})\s+([0-9]{5}(?:-[0-9]{4})?)$', 1)
             WHEN x ~ '.+,? +[A-Z]{2}' THEN regexp_extract(x, '^(.+?),?\s+([A-Z]{2})$', 1)
             ELSE nullif(x, '') END AS city,
        CASE WHEN x ~ '.+,? +[A-Z]{2} +[0-9]{5}(-[0-9]{4})?' THEN regexp_extract(x, '\s([A-Z]{2})\s+[0-9-]+$', 1)
             WHEN x ~ '.+,? +[A-Z]{2}' THEN right(x, 2) END AS state,
        CASE WHEN x ~ '.+,? +[A-Z]{2} +[0-9]{5}(-[0-9]{4})?' THEN regexp_extract(x, '[0-9-]+$', 0) END AS zip
        FROM (SELECT row_no, trim(city_state_zip) AS x FROM registry)""",
)
def n23(t):
    parsed = places.city_state_zip("city_state_zip")
    return t.registry.select("row_no", parsed.alias("p")).select("row_no", "p.*")


@query(
    "n24_state_zip",
    """SELECT dealer_id, upper(left(nullif(state, ''), 2)) AS state2, nullif(left(zip, 5), '') AS zip5
       FROM dealers""",
)
def n24(t):
    return t.dealers.select(
        "dealer_id", places.state2("state").alias("state2"), places.zip5("zip").alias("zip5")
    )


@query(
    "n25_class_list",
    """SELECT row_no, array_to_string(list_filter(list_transform(string_split(class_codes, '|'),
       lambda x: trim(x)), lambda x: x <> ''), ';') AS codes FROM registry""",
)
def n25(t):
    return t.registry.select(
        "row_no", F.array_join(text.split_list("class_codes", "|"), ";").alias("codes")
    )


@query(
    "n26_licence_category",
    "SELECT row_no, CASE registry_state "
    + " ".join(
        f"WHEN '{s}' THEN {duck.mapped('type_code', m)}"
        for s, m in fixed.LICENCE_CATEGORIES.items()
    )
    + " END AS category FROM registry",
)
def n26(t):
    return t.registry.select(
        "row_no", category_of("registry_state", "type_code").alias("category")
    )


@query(
    "n27_full_address",
    """SELECT row_no, nullif(concat_ws(', ', nullif(address1, ''), nullif(address2, ''),
       nullif(city, ''), nullif(state, ''), nullif(zip, '')), '') AS address FROM registry""",
)
def n27(t):
    return t.registry.select(
        "row_no",
        places.full_address("address1", "address2", "city", "state", "zip").alias("address"),
    )


@query(
    "n28_tenure",
    """SELECT row_no, date_diff('day', try_cast(issue_text AS DATE), DATE '2005-06-30') / 365.25::DOUBLE
       AS years, coalesce(date_diff('day', try_cast(issue_text AS DATE), DATE '2005-06-30')
       >= 3652.5, false) AS is_long FROM registry""",
)
def n28(t):
    years = places.tenure_years(
        places.lenient_date("issue_text"), F.lit("2005-06-30").cast("date")
    )
    return t.registry.select(
        "row_no",
        years.alias("years"),
        F.coalesce(years >= 10, F.lit(False)).alias("is_long"),
    )


@query(
    "n29_keywords",
    f"""SELECT dealer_id, {duck.has_any('name', fixed.MAINTENANCE_WORDS)} AS present,
        array_to_string({duck.found('name', fixed.MAINTENANCE_WORDS)}, ',') AS words FROM dealers""",
)
def n29(t):
    return t.dealers.select(
        "dealer_id",
        text.has_any("name", fixed.MAINTENANCE_WORDS).alias("present"),
        F.array_join(text.words_found("name", fixed.MAINTENANCE_WORDS), ",").alias("words"),
    )


@query(
    "n30_guessed_mailbox",
    f"""SELECT dealer_id, 'info@' || {duck.loose_domain('website')} AS mailbox,
        '@' || {duck.loose_domain('website')} AS suffix FROM dealers""",
)
def n30(t):
    domain = domains.loose_domain("website")
    return t.dealers.select(
        "dealer_id",
        domains.guessed_mailbox(domain).alias("mailbox"),
        domains.mail_suffix(domain).alias("suffix"),
    )


# --- predicates ---------------------------------------------------------------


@query(
    "f01_contact_presence",
    """SELECT count(primary_phone) AS with_phone, count(primary_email) AS with_email,
       count(*) FILTER (primary_phone IS NOT NULL AND primary_email IS NOT NULL) AS with_both,
       count(*) FILTER (primary_phone IS NULL AND primary_email IS NULL) AS with_neither
       FROM contractors""",
)
def f01(t):
    return filters.contact_presence(t.contractors)


@query(
    "f02_states",
    f"""SELECT id, state, state IN ({duck.quoted(fixed.SREC_STATES)}) AS is_srec FROM contractors
        WHERE state IN ('CA', 'TX', 'PA', 'AZ')""",
)
def f02(t):
    kept = filters.in_states(t.contractors, ["CA", "TX", "PA", "AZ"])
    return kept.select("id", "state", filters.is_srec_state("state").alias("is_srec"))


@query(
    "f03_priority_states",
    """WITH priority AS (SELECT s.state, CASE s.n % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END
         AS priority FROM (SELECT state, count(*) AS n FROM contractors GROUP BY state HAVING count(*) % 4 <> 3) s)
       SELECT priority, count(*) AS entities FROM contractors JOIN priority USING (state) GROUP BY priority""",
)
def f03(t):
    sizes = t.contractors.groupBy("state").agg(F.count("*").alias("n")).where("n % 4 <> 3")
    table = sizes.select(
        "state",
        F.when(F.col("n") % 3 == 0, "HIGH")
        .when(F.col("n") % 3 == 1, "MEDIUM")
        .otherwise("LOW")
        .alias("priority"),
    )
    return filters.priority_distribution(t.contractors, table)


@query(
    "f04_live",
    "SELECT id, company_name FROM contractors WHERE coalesce(is_deleted, 0) = 0",
)
def f04(t):
    return filters.live(t.contractors).select("id", "company_name")


@query(
    "f05_search",
    """SELECT c.id, c.company_name, string_agg(DISTINCT l.license_category, ','
         ORDER BY l.license_category) AS categories
       FROM contractors c LEFT JOIN licenses l ON l.contractor_id = c.id
       WHERE contains(lower(c.company_name), 'solar') OR contains(lower(c.primary_email), 'solar')
          OR c.primary_phone = '2019999999'
       GROUP BY c.id, c.company_name ORDER BY c.id LIMIT 50""",
)
def f05(t):
    return filters.search(t.contractors, t.licenses, "Solar", phone="2019999999", limit=50)


@query(
    "f06_licence_types",
    "SELECT license_id, license_type FROM licenses WHERE license_type IN ('CAC', 'C46')",
)
def f06(t):
    return filters.of_types(t.licenses, ["CAC", "C46"]).select("license_id", "license_type")


@query(
    "f07_trade_from_name",
    """SELECT row_no, regexp_matches(business_name, '(?i)electric|electrical') AS has_electrical,
       regexp_matches(business_name, '(?i)hvac|heating|cooling|air cond') AS has_hvac,
       regexp_matches(business_name, '(?i)solar|photovoltaic') AS has_solar,
       regexp_matches(business_name, '(?i)plumb') AS has_plumbing FROM registry""",
)
def f07(t):
    return t.registry.select("row_no", *filters.trades_from_name("business_name"))


@query(
    "f08_access_tier",
    """SELECT state, access_tier, entities FROM (
         SELECT state, count(*) AS entities, CASE ascii(state) % 3 WHEN 0 THEN 'BULK' WHEN 1
         THEN 'API' ELSE 'SCRAPER' END AS access_tier FROM contractors GROUP BY state)
       WHERE access_tier = 'BULK'""",
)
def f08(t):
    sizes = t.contractors.groupBy("state").agg(F.count("*").alias("entities"))
    config = sizes.withColumn(
        "access_tier",
        F.when(F.ascii("state") % 3 == 0, "BULK")
        .when(F.ascii("state") % 3 == 1, "API")
        .otherwise("SCRAPER"),
    )
    return filters.of_access_tier(config, "BULK").select("state", "access_tier", "entities")
