"""Sources (SRC*) over extracts that Spark writes from the stand-ins and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..session import scratch_dir
from ..sources import files, listings, registries
from . import duck
from .registry import query

PLAIN = ["dealer_id", "company", "city", "state", "zip"]


def _plain(t):
    """Directory columns without blanks at the ends, so that a file round trip keeps them."""
    return t.dealers.select(
        F.col("dealer_id").cast("string"), F.trim("name").alias("company"), "city", "state", "zip"
    )


PLAIN_SQL = (
    "SELECT CAST(dealer_id AS VARCHAR) AS dealer_id, trim(name) AS company, city, state, zip FROM dealers"
)


@query("src01_header_csv", PLAIN_SQL)
def src01(t):
    path = scratch_dir(t.spark, "src01")
    _plain(t).write.option("header", True).option("escape", '"').csv(path)
    return files.read_header_csv(t.spark, path)


@query("src02_skip_long_rows", PLAIN_SQL)
def src02(t):
    """Every record once well-formed and once with surplus fields, which must not come back."""
    path = scratch_dir(t.spark, "src02")
    line = F.concat_ws(",", *[F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in PLAIN])
    lines = _plain(t).select(
        F.explode(F.array(line, F.concat(line, F.lit(",surplus,more")))).alias("value")
    )
    lines.write.text(path)
    return files.read_csv_skipping_long_rows(t.spark, path, PLAIN, header=False)


@query(
    "src03_positional_csv",
    "SELECT CAST(dealer_id AS VARCHAR) AS code, city AS town, zip AS postcode FROM dealers",
)
def src03(t):
    path = scratch_dir(t.spark, "src03")
    _plain(t).write.option("escape", '"').csv(path)
    return files.read_positional_csv(t.spark, path, {0: "code", 2: "town", 4: "postcode"})


@query(
    "src04_short_rows",
    """SELECT CAST(dealer_id AS VARCHAR) AS code, trim(name) AS company FROM dealers
       WHERE review_count >= 8""",
)
def src04(t):
    """Rows written with as many fields as the record has reviews (up to ten), plus two."""
    path = scratch_dir(t.spark, "src04")
    tail = F.repeat(F.lit(",x"), F.least(F.col("review_count"), F.lit(10)))
    t.dealers.select(
        F.concat(
            F.col("dealer_id"), F.lit(',"'), F.trim("name"), F.lit('"'), tail
        ).alias("value")
    ).write.text(path)
    return files.read_wide_rows(t.spark, path, {0: "code", 1: "company"}, fewest=10)


@query("src05_json_records", "SELECT dealer_id, city, state FROM dealers")
def src05(t):
    """Documents of at most 100 records: a bare list, or a list under one of the known keys."""
    path = scratch_dir(t.spark, "src05")
    groups = t.dealers.groupBy(
        "source_file", F.floor(F.col("dealer_id") / 100).cast("string").alias("part")
    ).agg(F.to_json(F.collect_list(F.struct("dealer_id", "city", "state"))).alias("body"))
    doc = F.when(F.col("source_file") == "dir_0", F.col("body"))
    for shape, key in [("dir_1", "dealers"), ("dir_2", "contractors"), ("dir_3", "data")]:
        wrapped = F.concat(F.lit('{"%s":' % key), "body", F.lit("}"))
        doc = doc.when(F.col("source_file") == shape, wrapped)
    groups.select("source_file", doc.alias("value")).write.partitionBy("source_file").text(path)
    record = T.StructType([
        T.StructField("dealer_id", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
    ])
    return files.read_json_records(t.spark, f"{path}/source_file=*", record, per_line=True)


@query("src06_newest_file", "SELECT '2' AS run")
def src06(t):
    """Three runs of the directory list, a file per task; the newest file is one of the last run."""
    path = scratch_dir(t.spark, "src06")
    rows = _plain(t)
    for run in range(3):
        rows.write.mode("append").option("header", True).csv(f"{path}/run={run}")
    return files.newest_file(t.spark, f"{path}/run=*/*.csv").select(
        F.regexp_extract("path", "run=([0-9]+)", 1).alias("run")
    )


STAMPED = "'leads_' || strftime(imported_on, '%Y%m%d')"


@query(
    "src07_file_stamp",
    f"""SELECT import_id, CAST(CAST(imported_on AS TIMESTAMP) AS VARCHAR) AS stamp,
        CASE CAST(import_id % 3 AS INT) WHEN 2 THEN strftime(imported_on, '%Y%m%d') || '_leads' ELSE 'leads' END AS base
        FROM imports""",
)
def src07(t):
    day = F.date_format("imported_on", "yyyyMMdd")
    name = (
        F.when(F.col("import_id") % 3 == 0, F.concat(F.lit("leads_"), day, F.lit("_000000.json")))
        .when(F.col("import_id") % 3 == 1, F.concat(F.lit("leads_"), day, F.lit(".json")))
        .otherwise(F.concat(day, F.lit("_leads.csv")))
    )
    named = t.imports.select("import_id", name.alias("file"))
    return named.select(
        "import_id",
        F.date_format(files.file_stamp("file"), "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        files.file_group("file").alias("base"),
    )


@query(
    "src08_state_of_file",
    """SELECT license_id, CASE WHEN source_file LIKE 'ca%' THEN 'CA' WHEN source_file LIKE 'fl%' THEN 'FL'
       WHEN source_file LIKE 'tx%' THEN 'TX' END AS file_state FROM licenses""",
)
def src08(t):
    return t.licenses.select(
        "license_id", files.state_of_file("source_file").alias("file_state")
    )


def _extract(t, state: str):
    return t.registry.where(F.col("registry_state") == state)


def _california(t):
    return _extract(t, "CA").select(
        F.col("license_number").alias("License Number"),
        F.col("business_name").alias("Business Name"), F.col("type_code").alias("License Type"),
        F.col("status").alias("License Status"), F.col("issue_text").alias("Issue Date"),
        F.lit("12/31/2024").alias("Expiration Date"), F.col("address1").alias("Business Address"),
        F.col("city").alias("City"), F.col("state").alias("State"), F.col("zip").alias("ZIP Code"),
        F.lit("Kern").alias("County"), F.col("business_phone").alias("Business Phone"),
        F.col("email").alias("Email"),
    )


def _florida(t):
    return _extract(t, "FL").select(
        F.col("license_number").alias("License Number"), F.col("business_name").alias("Name"),
        F.col("type_code").alias("License Type"), F.col("status").alias("Primary Status"),
        F.col("issue_text").alias("Original License Date"), F.lit("").alias("Expiration Date"),
        F.col("address1").alias("Address Line 1"), F.col("city").alias("City"),
        F.col("state").alias("State"), F.col("zip").alias("Zip Code"), F.lit("Dade").alias("County"),
        F.col("business_phone").alias("Phone"), F.col("email").alias("Email"),
    )


def _texas(t):
    return _extract(t, "TX").select(
        "row_no", F.col("type_code").alias("LICENSE TYPE"), F.col("license_number").alias("LICENSE NUMBER"),
        F.col("issue_text").alias("LICENSE EXPIRATION DATE"), F.lit("Travis").alias("COUNTY"),
        F.col("person_name").alias("NAME"), F.col("person_phone").alias("PHONE NUMBER"),
        F.col("business_name").alias("BUSINESS NAME"),
        F.col("address1").alias("BUSINESS ADDRESS-LINE1"),
        F.col("address2").alias("BUSINESS ADDRESS-LINE2"),
        F.col("city_state_zip").alias("BUSINESS CITY, STATE ZIP"),
        F.lit("").alias("BUSINESS COUNTY"), F.col("zip").alias("BUSINESS ZIP"),
        F.col("business_phone").alias("BUSINESS PHONE"),
    )


def _licensee_out(df):
    """Licensee columns with dates as text."""
    return df.select(
        *[F.col(c).cast("string").alias(c) for c in registries.LICENSEE]
    )


def _type_sql(state: str) -> str:
    return f"coalesce({duck.mapped('type_code', fixed.REGISTRY_TYPE_NAMES[state])}, type_code)"


ISSUE = "CAST(try_cast(trim(issue_text) AS DATE) AS VARCHAR)"


@query(
    "src09_california",
    f"""SELECT {duck.clean('business_name')} AS licensee_name, license_number, {_type_sql('CA')} AS license_type,
        {duck.clean('status')} AS license_status, city, state, zip, 'CA' AS source_state, 'BULK' AS source_tier,
        {duck.clean('business_name')} AS business_name, {ISSUE} AS issue_date,
        CAST(NULL AS VARCHAR) AS original_issue_date, '2024-12-31' AS expiration_date,
        {duck.clean('business_phone')} AS phone, {duck.clean('email')} AS email, address1 AS street,
        'Kern' AS county FROM registry WHERE registry_state = 'CA'""",
)
def src09(t):
    return _licensee_out(registries.california(_california(t)))


@query(
    "src10_florida",
    f"""SELECT {duck.clean('business_name')} AS licensee_name, license_number, {_type_sql('FL')} AS license_type,
        {duck.clean('status')} AS license_status, city, state, zip, 'FL' AS source_state, 'BULK' AS source_tier,
        {duck.clean('business_name')} AS business_name, CAST(NULL AS VARCHAR) AS issue_date,
        {ISSUE} AS original_issue_date, CAST(NULL AS VARCHAR) AS expiration_date,
        {duck.clean('business_phone')} AS phone, {duck.clean('email')} AS email, address1 AS street,
        'Dade' AS county FROM registry WHERE registry_state = 'FL'""",
)
def src10(t):
    return _licensee_out(registries.florida(_florida(t)))


FULL = r"^(.*?),\s*([A-Z]{2})\s+([0-9]{5}(?:-[0-9]{4})?)$"


@query(
    "src11_texas",
    f"""SELECT coalesce({duck.clean('business_name')}, {duck.clean('person_name')}) AS licensee_name,
        license_number, {_type_sql('TX')} AS license_type, 'Active' AS license_status,
        nullif(regexp_extract(city_state_zip, '{FULL}', 1), '') AS city,
        coalesce(nullif(regexp_extract(city_state_zip, '{FULL}', 2), ''), 'TX') AS state,
        coalesce(nullif(regexp_extract(city_state_zip, '{FULL}', 3), ''), zip) AS zip,
        'TX' AS source_state, 'BULK' AS source_tier,
        coalesce({duck.clean('business_name')}, {duck.clean('person_name')}) AS business_name,
        CAST(NULL AS VARCHAR) AS issue_date, CAST(NULL AS VARCHAR) AS original_issue_date,
        {ISSUE} AS expiration_date,
        coalesce({duck.clean('business_phone')}, {duck.clean('person_phone')}) AS phone,
        CAST(NULL AS VARCHAR) AS email, trim(address1 || ' ' || address2) AS street,
        'Travis' AS county FROM registry WHERE registry_state = 'TX'""",
)
def src11(t):
    return _licensee_out(registries.texas(_texas(t)))


def _load_florida(t):
    return registries.load_florida(
        _extract(t, "FL").select(
            "row_no",
            F.col("type_code").alias("license_type"), F.col("person_name").alias("name"),
            F.col("business_name").alias("company"), F.col("address1").alias("address"),
            "city", "state", "zip", "email",
        )
    )


def _load_california(t):
    return registries.load_california(
        _extract(t, "CA").select(
            "row_no", F.col("business_name").alias("BusinessName"),
            F.col("person_name").alias("FullBusinessName"),
            F.col("business_phone").alias("BusinessPhone"),
            F.col("address1").alias("MailingAddress"), F.col("city").alias("City"),
            F.col("state").alias("State"), F.col("zip").alias("ZIPCode"),
            F.col("class_codes").alias("Classifications(s)"),
            F.col("status").alias("PrimaryStatus"), F.col("license_number").alias("LicenseNo"),
        )
    )


def _load_new_york(t):
    return registries.load_new_york(
        _extract(t, "NYC").select(
            "row_no",
            F.col("type_code").alias("license_type_code"),
            F.col("person_name").alias("licensee_name"), "license_number",
            F.lit("").alias("business_1"), F.col("business_name").alias("business_2"),
        )
    )


def loaded_registries(t):
    """The four loaders stacked."""
    return registries.stack(
        _load_florida(t), _load_california(t), registries.load_texas(_texas(t)), _load_new_york(t)
    )


NONE = "CAST(NULL AS VARCHAR)"
LOAD_SQL = {
    "FL": f"""SELECT coalesce({duck.clean('business_name')}, {duck.clean('person_name')}) AS company_name,
        {duck.clean('person_name')} AS contact_name, address1 AS address, city, state, zip, {NONE} AS phone,
        {duck.clean('email')} AS email, type_code AS license_type,
        {duck.mapped('type_code', fixed.LICENCE_CATEGORIES['FL'])} AS license_category,
        {NONE} AS license_number, 'FL_License' AS source FROM registry WHERE registry_state = 'FL'
        AND {duck.mapped('type_code', fixed.LICENCE_CATEGORIES['FL'])} IS NOT NULL""",
    "CA": f"""SELECT * FROM (SELECT coalesce({duck.clean('business_name')}, {duck.clean('person_name')}) AS company_name,
        {NONE} AS contact_name, address1 AS address, city, state, zip, {duck.clean('business_phone')} AS phone,
        {NONE} AS email, code AS license_type,
        {duck.mapped('code', fixed.LICENCE_CATEGORIES['CA'])} AS license_category, license_number,
        'CA_CSLB' AS source FROM (SELECT *, trim(unnest(string_split(class_codes, '|'))) AS code FROM registry
        WHERE registry_state = 'CA' AND upper(trim(status)) = 'CLEAR')) WHERE license_category IS NOT NULL""",
    "TX": f"""SELECT * FROM (SELECT coalesce({duck.clean('business_name')}, {duck.clean('person_name')}) AS company_name,
        {NONE} AS contact_name, trim(address1 || ' ' || address2) AS address,
        CASE WHEN row_no % 9 IN (0) THEN city_state_zip WHEN row_no % 9 = 2 THEN NULL ELSE upper(city) END AS city,
        CASE WHEN row_no % 9 IN (0, 2) THEN 'TX' ELSE state END AS state, zip,
        coalesce({duck.clean('business_phone')}, {duck.clean('person_phone')}) AS phone, {NONE} AS email,
        type_code AS license_type, {duck.mapped('type_code', fixed.LICENCE_CATEGORIES['TX'])} AS license_category,
        license_number, 'TX_TDLR' AS source FROM registry WHERE registry_state = 'TX')
        WHERE license_category IS NOT NULL AND company_name IS NOT NULL""",
    "NYC": f"""SELECT * FROM (SELECT coalesce({duck.clean('business_name')}, {duck.clean('person_name')}) AS company_name,
        {duck.clean('person_name')} AS contact_name, {NONE} AS address, 'New York' AS city, 'NY' AS state,
        {NONE} AS zip, {NONE} AS phone, {NONE} AS email, 'NYC_' || type_code AS license_type,
        {duck.mapped('type_code', fixed.LICENCE_CATEGORIES['NYC'])} AS license_category, license_number,
        'NYC_DOB' AS source FROM registry WHERE registry_state = 'NYC')
        WHERE license_category IS NOT NULL AND company_name IS NOT NULL""",
}


@query("src12_load_florida", LOAD_SQL["FL"])
def src12(t):
    return _load_florida(t).select(*registries.RECORD)


@query("src13_load_california", LOAD_SQL["CA"])
def src13(t):
    return _load_california(t).select(*registries.RECORD)


@query("src14_load_texas", LOAD_SQL["TX"])
def src14(t):
    return registries.load_texas(_texas(t)).select(*registries.RECORD)


@query("src15_load_new_york", LOAD_SQL["NYC"])
def src15(t):
    return _load_new_york(t).select(*registries.RECORD)


@query(
    "src16_ranking_cells",
    """SELECT ranking_id, CAST(replace(regexp_extract(kw_text, '([0-9]{2},[0-9]{3}) kW$', 1), ',', '') AS BIGINT) AS kw
       FROM rankings""",
)
def src16(t):
    return t.rankings.select("ranking_id", listings.kw_of_cell("kw_text").alias("kw"))


RANK_STATE = "coalesce(headquarters_state, 'NA')"


@query(
    "src17_rank_lines",
    f"""SELECT rank_position AS rank, trim(replace(company_name, ',', '')) AS company_name, {RANK_STATE} AS state,
        CAST(kw_installed AS DOUBLE) AS kw_installed, 'RANKED' AS source, rank_position <= 100 AS is_top_100
        FROM rankings""",
)
def src17(t):
    line = F.concat_ws(
        ",",
        F.col("rank_position"),
        F.trim(F.replace("company_name", F.lit(","), F.lit(""))),
        F.coalesce("headquarters_state", F.lit("NA")),
        F.col("kw_installed"),
    )
    lines = t.rankings.select(line.alias("line"))
    return listings.rank_lines(lines, "line", "RANKED")


@query(
    "src18_partner_licences",
    """SELECT ranking_id, array_to_string(list_filter(['ELE', 'HVAC', 'SOL', 'CONT', 'PLUM'],
       lambda w: contains(upper(licence_text), w)), ',') AS licences,
       len(list_filter(['ELE', 'HVAC', 'SOL', 'CONT', 'PLUM'], lambda w: contains(upper(licence_text), w))) >= 2
       AS is_multi_trade FROM rankings""",
)
def src18(t):
    tokens, multi = listings.partner_licences("licence_text")
    return t.rankings.select(
        "ranking_id", F.array_join(tokens, ",").alias("licences"), multi.alias("is_multi_trade")
    )


@query(
    "src19_markets",
    "SELECT ranking_id, contains(markets, 'C&I') AND contains(markets, 'R') AS is_resimercial FROM rankings",
)
def src19(t):
    return t.rankings.select(
        "ranking_id", listings.serves_both_markets("markets").alias("is_resimercial")
    )


@query(
    "src20_stacked_registries",
    f"""WITH stacked AS ({' UNION ALL '.join(f'({s})' for s in LOAD_SQL.values())})
        SELECT source, company_name, state, license_category, license_number, {duck.phone10('phone')} AS phone_key
        FROM stacked""",
)
def src20(t):
    return loaded_registries(t).select(
        "source", "company_name", "state", "license_category", "license_number", "phone_key"
    )


@query(
    "src21_source_type",
    """SELECT import_id, CASE CAST(import_id % 4 AS INT) WHEN 0 THEN 'oem_dealer' WHEN 1 THEN 'license_contractor'
       WHEN 2 THEN 'mep_list' ELSE source_type END AS kind FROM imports""",
)
def src21(t):
    words = F.array(F.lit("Carrier_"), F.lit("state_license_"), F.lit("MEP_"), F.lit("other_"))
    named = t.imports.select(
        "import_id",
        "source_type",
        F.concat(F.get(words, (F.col("import_id") % 4).cast("int")), "file_name").alias("file"),
    )
    return named.select("import_id", files.source_type_of("file", "source_type").alias("kind"))


TEXT = r"""trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)\b.*?</(script|style)>', ' ', 'g'),
    '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"""


@query(
    "src22_page_records",
    rf"""WITH staged AS (SELECT page_id, url, html, {TEXT} AS txt FROM pages)
        SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '^www\.', '') AS host,
        {duck.clean("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS heading,
        CASE WHEN contains(txt, 'Gold Dealer') THEN 'Gold Dealer' WHEN contains(txt, 'Silver Dealer') THEN 'Silver Dealer'
             WHEN contains(txt, 'Bronze Dealer') THEN 'Bronze Dealer' WHEN contains(txt, 'Titan Certified')
             THEN 'Titan Certified' ELSE 'Certified Installer' END AS tier,
        try_cast(regexp_extract(txt, '([0-9.]+) *miles?', 1) AS DOUBLE) AS miles,
        {duck.clean("regexp_extract(txt, '([^,.!?<>]+), ([A-Z]{2}) ([0-9]{5})', 1)")} AS city,
        nullif(regexp_extract(txt, '([^,.!?<>]+), ([A-Z]{{2}}) ([0-9]{{5}})', 2), '') AS state,
        nullif(regexp_extract(txt, '([^,.!?<>]+), ([A-Z]{{2}}) ([0-9]{{5}})', 3), '') AS zip,
        len(regexp_extract_all(html, '<a\s')) AS links,
        nullif(regexp_extract(txt, '(\(?[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}})', 1), '') AS phone
        FROM staged""",
)
def src22(t):
    return listings.page_record(t.pages)


@query(
    "src23_run_progress",
    """SELECT collector_name, max(record_count) AS completed, max(record_count * 3) AS collected,
       max(record_count) * 100.0::DOUBLE / 137.0::DOUBLE AS percent FROM collector_runs GROUP BY collector_name""",
)
def src23(t):
    runs = t.collector_runs
    step = F.concat(F.lit("["), "record_count", F.lit("/137] Scraping ZIP 94102"))
    found = F.concat(F.lit("Found 3 dealers (Total: "), F.col("record_count") * 3, F.lit(")"))
    lines = runs.select("collector_name", F.explode(F.array(step, found)).alias("line"))
    return files.run_progress(lines, "collector_name", "line", 137)
