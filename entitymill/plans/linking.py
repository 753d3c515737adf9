"""Joins and matching (J*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import domains, fixed_values as fixed, names, text
from ..operators import enrich, inserts, linkage
from ..session import cut_lineage
from . import duck
from .registry import query
from .resolving import RANKED, batch, merged_rankings
from .shared import DK, MK, RK, keyed_dealers, keyed_registry, master, master_contacts


@query("j01_priority_match")
def j01(t):
    return linkage.match_records(cut_lineage(batch(t)), master(t), master_contacts(t))


@query("j02_match_without_email")
def j02(t):
    no_mail = cut_lineage(batch(t).withColumn("email", F.lit(None).cast("string")))
    return linkage.match_records(no_mail, master(t), master_contacts(t))


def licences(t):
    return keyed_registry(t).withColumnRenamed("row_no", "pos")


DEALER_LICENCE = f"""{DK}, {RK}, lp AS (SELECT phone_key, min(row_no) AS license_id FROM rk
    WHERE phone_key IS NOT NULL GROUP BY phone_key), ld AS (SELECT domain_key, min(row_no) AS license_id FROM rk
    WHERE domain_key IS NOT NULL GROUP BY domain_key), dl AS (SELECT d.dealer_id, coalesce(lp.license_id, ld.license_id)
    AS license_id, CASE WHEN lp.license_id IS NOT NULL THEN 'phone' ELSE 'domain' END AS match_method,
    CASE WHEN lp.license_id IS NOT NULL THEN 100 ELSE 90 END AS match_confidence
    FROM dk d LEFT JOIN lp USING (phone_key) LEFT JOIN ld ON ld.domain_key = d.domain_key
    WHERE coalesce(lp.license_id, ld.license_id) IS NOT NULL)"""


def _name_blocks(rows: str, id_column: str, name: str) -> str:
    """Rows of (id, block, name) of an SQL table, one for its city and one for its zip code."""
    key = duck.company_key_upper(name)
    return " UNION ".join(
        f"SELECT {id_column} AS id, '{kind}:' || {place} AS block, {key} AS name FROM {rows} "
        f"WHERE {place} IS NOT NULL AND {key} IS NOT NULL"
        for kind, place in (("city", "upper(city)"), ("zip", "trim(zip)")))


@query(
    "j03_dealer_licence_fuzzy",
    f"""WITH {DEALER_LICENCE}, rest AS (SELECT * FROM dk WHERE dealer_id NOT IN (SELECT dealer_id FROM dl)),
        asked AS ({_name_blocks('rest', 'dealer_id', 'name')}),
        held AS (SELECT block, name, min(id) AS license_id FROM ({_name_blocks('rk', 'row_no', 'business_name')}) GROUP BY ALL),
        pairs AS (SELECT DISTINCT asked.name AS name_key, held.name AS first_key FROM asked JOIN held USING (block)
            WHERE 200 * least(length(asked.name), length(held.name)) >= 85 * (length(asked.name) + length(held.name))),
        near AS (SELECT name_key, first_key, ratio FROM (SELECT *, CAST(200 AS DOUBLE) * {duck.LCS}
            / (length(name_key) + length(first_key)) AS ratio FROM pairs) WHERE ratio >= 85),
        ranked AS (SELECT asked.id AS dealer_id, license_id, ratio,
            row_number() OVER (PARTITION BY asked.id ORDER BY ratio DESC, license_id) AS place
            FROM asked JOIN near ON name_key = asked.name JOIN held ON held.block = asked.block AND held.name = first_key)
        SELECT dealer_id, license_id, match_method, CAST(match_confidence AS DOUBLE) AS match_confidence FROM dl
        UNION ALL SELECT dealer_id, license_id, 'fuzzy_name', ratio FROM ranked WHERE place = 1""",
)
def j03(t):
    """Phone, else domain, else the most similar name in the same city or zip code."""
    dealers, held = cut_lineage(keyed_dealers(t)), cut_lineage(licences(t))
    exact = cut_lineage(enrich.dealer_licences(dealers, held))
    rest = dealers.join(exact.select("dealer_id"), "dealer_id", "left_anti")

    def blocks(df, id_column, id_name, name):
        places = F.array(
            F.concat(F.lit("city:"), F.upper("city")), F.concat(F.lit("zip:"), F.trim("zip"))
        )
        return df.select(
            F.col(id_column).alias(id_name), F.explode(F.array_compact(places)).alias("block"),
            names.company_key_upper(name).alias("name"),
        )

    fuzzy = linkage.fuzzy_best(
        blocks(rest, "dealer_id", "record_id", "name"),
        blocks(held, "pos", "entity_id", "business_name"),
        linkage.FUZZY_THRESHOLD,
    ).select(
        F.col("record_id").alias("dealer_id"), F.col("entity_id").alias("license_id"),
        F.lit("fuzzy_name").alias("match_method"), F.col("ratio").alias("match_confidence"),
    )
    return exact.withColumn("match_confidence", F.col("match_confidence").cast("double")).unionByName(fuzzy)


@query("j04_dealer_licence_exact", f"WITH {DEALER_LICENCE} SELECT * FROM dl")
def j04(t):
    return enrich.dealer_licences(keyed_dealers(t), licences(t))


@query(
    "j05_licence_dealers",
    f"""WITH {DK}, {RK}, p AS (SELECT phone_key, count(*) AS dealers, string_agg(DISTINCT brand, ', ' ORDER BY brand)
        AS brands FROM dk WHERE phone_key IS NOT NULL GROUP BY phone_key), d AS (SELECT domain_key, count(*) AS dealers,
        string_agg(DISTINCT brand, ', ' ORDER BY brand) AS brands FROM dk WHERE domain_key IS NOT NULL GROUP BY domain_key)
        SELECT row_no AS pos, CASE WHEN p.dealers IS NOT NULL THEN 'phone' ELSE 'domain' END AS match_type,
        coalesce(p.dealers, d.dealers) AS dealers, coalesce(p.brands, d.brands) AS brands,
        CASE WHEN p.dealers IS NOT NULL THEN 100 ELSE 90 END AS confidence
        FROM rk LEFT JOIN p USING (phone_key) LEFT JOIN d ON d.domain_key = rk.domain_key
        WHERE coalesce(p.dealers, d.dealers) IS NOT NULL""",
)
def j05(t):
    return enrich.licence_dealers(licences(t), keyed_dealers(t))


@query(
    "j06_unmatched_licences",
    f"WITH {DEALER_LICENCE} SELECT row_no FROM rk WHERE row_no NOT IN (SELECT license_id FROM dl)",
)
def j06(t):
    held = keyed_registry(t).select("row_no")
    used = enrich.dealer_licences(keyed_dealers(t), licences(t)).select(
        F.col("license_id").alias("row_no")
    )
    return held.join(used, "row_no", "left_anti")


@query(
    "j07_enriched_dealers",
    f"""WITH {DEALER_LICENCE} SELECT d.dealer_id, d.name, dl.match_method, rk.license_number, rk.type_code, rk.registry_state
        FROM dk d LEFT JOIN dl USING (dealer_id) LEFT JOIN rk ON rk.row_no = dl.license_id""",
)
def j07(t):
    dealers, held = keyed_dealers(t), licences(t)
    found = enrich.dealer_licences(dealers, held).join(
        held.select(F.col("pos").alias("license_id"), "license_number", "type_code", "registry_state"),
        "license_id",
    )
    return dealers.select("dealer_id", "name").join(
        found.select("dealer_id", "match_method", "license_number", "type_code", "registry_state"),
        "dealer_id", "left",
    )


@query(
    "j08_phone_overlap",
    f"""WITH {DK}, {RK}, b AS (SELECT phone_key, string_agg(DISTINCT brand, ', ' ORDER BY brand) AS brands,
        count(DISTINCT brand) AS brand_count FROM dk WHERE phone_key IS NOT NULL GROUP BY phone_key)
        SELECT row_no AS pos, phone_key, brands, brand_count FROM rk JOIN b USING (phone_key)""",
)
def j08(t):
    rows = licences(t).select("pos", "phone_key")
    return enrich.phone_overlap(rows, keyed_dealers(t)).select(
        "pos", "phone_key", "brands", "brand_count"
    )


BRAND_IMPORT = f"""{DK}, {MK}, x AS (SELECT dk.*, {duck.company_key('name')} AS name_key FROM dk),
    bp AS (SELECT primary_phone AS k, min(id) AS id FROM mk GROUP BY 1), be AS (SELECT primary_email AS k, min(id) AS id
    FROM mk GROUP BY 1), bd AS (SELECT primary_domain AS k, min(id) AS id FROM mk GROUP BY 1),
    bn AS (SELECT name_key AS k, state AS s, min(id) AS id FROM mk GROUP BY 1, 2)"""


def brand_import(t):
    """Directory records against the master by phone, domain, name in the state."""
    records = keyed_dealers(t).select(
        "dealer_id", "phone_key", "domain_key",
        F.concat(names.company_key("name"), F.lit("|"), F.col("state")).alias("name_state"),
    )
    entities = master(t).select(
        "entity_id", F.col("entity_id").alias("pos"), "phone", "domain",
        F.concat("name_key", F.lit("|"), "state").alias("name_state"),
    )
    index = linkage.key_index([
        (entities, "phone", "phone", "phone", 1),
        (entities, "domain", "domain", "domain", 2),
        (entities, "name_state", "name", "name", 3),
    ])
    signals = {"phone": "phone_key", "domain": "domain_key", "name": "name_state"}
    return linkage.match_by_keys(records, "dealer_id", signals, index)


@query(
    "j09_brand_import",
    f"""WITH {BRAND_IMPORT} SELECT dealer_id, coalesce(bp.id, bd.id, bn.id) AS entity_id,
        CASE WHEN bp.id IS NOT NULL THEN 'phone' WHEN bd.id IS NOT NULL THEN 'domain' WHEN bn.id IS NOT NULL
        THEN 'name' ELSE 'new' END AS match_type FROM x LEFT JOIN bp ON bp.k = x.phone_key
        LEFT JOIN bd ON bd.k = x.domain_key LEFT JOIN bn ON bn.k = x.name_key AND bn.s = x.state""",
)
def j09(t):
    hits = brand_import(t).select("dealer_id", "entity_id", "match_type")
    return t.dealers.select("dealer_id").join(hits, "dealer_id", "left").fillna(
        "new", subset=["match_type"]
    )


@query(
    "j10_import_by_mail",
    f"""WITH {BRAND_IMPORT} SELECT dealer_id, coalesce(bp.id, be.id, bd.id) AS entity_id,
        CASE WHEN bp.id IS NOT NULL THEN 'phone' WHEN be.id IS NOT NULL THEN 'email' ELSE 'domain' END AS match_type
        FROM x LEFT JOIN bp ON bp.k = x.phone_key LEFT JOIN be ON be.k = x.email_key
        LEFT JOIN bd ON bd.k = {duck.email_domain('x.email')} WHERE coalesce(bp.id, be.id, bd.id) IS NOT NULL""",
)
def j10(t):
    records = keyed_dealers(t, "email").withColumn("mail_domain", domains.email_domain("email"))
    entities = master(t).withColumn("pos", F.col("entity_id"))
    index = linkage.key_index([
        (entities, "phone", "phone", "phone", 1),
        (entities, "email", "email", "email", 2),
        (entities, "domain", "domain", "domain", 3),
    ])
    signals = {"phone": "phone_key", "email": "email_key", "domain": "mail_domain"}
    return linkage.match_by_keys(records, "dealer_id", signals, index).select(
        "dealer_id", "entity_id", "match_type"
    )


@query(
    "j11_source_type",
    f"""WITH {BRAND_IMPORT}, hit AS (SELECT dealer_id, coalesce(bp.id, bd.id, bn.id) AS id FROM x
        LEFT JOIN bp ON bp.k = x.phone_key LEFT JOIN bd ON bd.k = x.domain_key
        LEFT JOIN bn ON bn.k = x.name_key AND bn.s = x.state)
        SELECT 'entity' AS kind, id AS row_id, CASE WHEN source_type = 'state_license' AND id IN (SELECT id FROM hit WHERE id IS NOT NULL)
        THEN 'both' ELSE source_type END AS source_type FROM contractors UNION ALL
        SELECT 'dealer', dealer_id, 'oem_dealer' FROM hit WHERE id IS NULL""",
)
def j11(t):
    matched = cut_lineage(brand_import(t))
    entities = t.contractors.select("id", "source_type")
    kept = linkage.with_source_type(entities, matched).select(
        F.lit("entity").alias("kind"), F.col("id").alias("row_id"), "source_type"
    )
    added = t.dealers.select("dealer_id").join(matched, "dealer_id", "left_anti").select(
        F.lit("dealer").alias("kind"), F.col("dealer_id").alias("row_id"),
        F.lit("oem_dealer").alias("source_type"),
    )
    return kept.unionByName(added)


def named_rankings(t):
    return t.rankings.withColumn("name_key", names.company_key("company_name"))


@query(
    "j12_ranking_links",
    f"""WITH {MK}, r AS (SELECT ranking_id, headquarters_state AS hs, {duck.company_key('company_name')} AS name_key
        FROM rankings) SELECT r.ranking_id, min(mk.id) AS entity_id FROM r LEFT JOIN mk ON mk.name_key = r.name_key
        AND (mk.state = r.hs OR r.hs IS NULL) GROUP BY r.ranking_id""",
)
def j12(t):
    return enrich.rank_links(named_rankings(t), master(t))


def _in_state(df, id_column, id_name, state):
    return df.select(
        F.col(id_column).alias(id_name), F.col(state).alias("block"),
        names.company_key("name_key").alias("name"),
    )


RANKING_LINKS = f"""WITH RECURSIVE {MK}, r AS (SELECT ranking_id, company_name, headquarters_state AS hs,
        {duck.company_key('company_name')} AS name_key FROM rankings),
    exact AS (SELECT r.ranking_id, min(mk.id) AS entity_id FROM r LEFT JOIN mk ON mk.name_key = r.name_key
        AND (mk.state = r.hs OR r.hs IS NULL) GROUP BY r.ranking_id),
    rest AS (SELECT ranking_id, hs AS block, {duck.company_key('name_key')} AS a FROM r JOIN exact USING (ranking_id)
        WHERE entity_id IS NULL),
    known AS (SELECT state AS block, {duck.company_key('name_key')} AS b, min(id) AS known_id FROM mk GROUP BY ALL),
    {duck.distinct_pairs('SELECT a, b FROM rest JOIN known USING (block)')}, {duck.BLOCK_RATIOS},
    fuzzy AS (SELECT ranking_id, min(known_id) AS fuzzy_id FROM rest JOIN known USING (block) JOIN ratios USING (a, b)
        WHERE ratio >= {linkage.FUZZY_THRESHOLD} GROUP BY ranking_id),
    links AS (SELECT ranking_id, coalesce(entity_id, fuzzy_id) AS entity_id, CASE WHEN entity_id IS NOT NULL THEN 'exact'
        WHEN fuzzy_id IS NOT NULL THEN 'fuzzy' ELSE 'new' END AS match_type FROM exact LEFT JOIN fuzzy USING (ranking_id)),
    fresh AS (SELECT name_key, hs, min(ranking_id) AS first_record_id, min_by(company_name, ranking_id) AS company_name,
        count(*) AS records FROM r JOIN links USING (ranking_id) WHERE match_type = 'new' AND name_key IS NOT NULL GROUP BY ALL),
    inserted AS (SELECT (SELECT max(id) FROM contractors) + row_number() OVER (ORDER BY first_record_id) AS new_id, * FROM fresh)"""


def ranking_links(t):
    """Exact name and state, then similar name in the state; what is left becomes a new entity."""
    ranks = named_rankings(t)  # without a state a ranking matches nothing and is new
    entities = master(t)
    exact = cut_lineage(enrich.rank_links(ranks, entities))
    rest = ranks.join(exact.where("entity_id IS NULL").select("ranking_id"), "ranking_id")
    fuzzy = linkage.fuzzy_first(
        _in_state(rest, "ranking_id", "record_id", "headquarters_state"),
        _in_state(entities, "entity_id", "entity_id", "state"),
        "block", linkage.FUZZY_THRESHOLD,
    )
    found = fuzzy.select(
        F.col("record_id").alias("ranking_id"), F.col("entity_id").alias("fuzzy_id")
    )
    return exact.join(found, "ranking_id", "left").select(
        "ranking_id",
        F.coalesce("entity_id", "fuzzy_id").alias("entity_id"),
        F.when(F.col("entity_id").isNotNull(), "exact")
        .when(F.col("fuzzy_id").isNotNull(), "fuzzy")
        .otherwise("new")
        .alias("match_type"),
    )


@query("j13_ranking_links_fuzzy", RANKING_LINKS + " SELECT * FROM links")
def j13(t):
    return ranking_links(t)


def ranking_entities(t):
    """All links, the entities to insert, and the rankings that go to them."""
    links = cut_lineage(ranking_links(t))
    unmatched = named_rankings(t).join(links.where("match_type = 'new'").select("ranking_id"), "ranking_id").select(
        F.col("ranking_id").alias("record_id"), "company_name", "name_key", F.col("headquarters_state").alias("state"))
    return links, *inserts.new_entities(unmatched, master(t))


@query(
    "j13b_new_entities",
    RANKING_LINKS + """ SELECT new_id AS entity_id, company_name, name_key, hs AS state, first_record_id, records,
        'ranking' AS source FROM inserted""",
)
def j13b(t):
    """The entities that the rankings add: one per name and state, ids behind the highest."""
    _, inserted, _ = ranking_entities(t)
    return inserted.withColumn("source", F.lit("ranking"))


@query(
    "j13c_ranking_entities",
    RANKING_LINKS + """ SELECT ranking_id, coalesce(entity_id, new_id) AS entity_id, match_type FROM links
        JOIN r USING (ranking_id) LEFT JOIN inserted n ON match_type = 'new' AND n.name_key = r.name_key
        AND n.hs IS NOT DISTINCT FROM r.hs""",
)
def j13c(t):
    """Every ranking with its entity, found or new."""
    links, _, placed = ranking_entities(t)
    own = placed.select(F.col("record_id").alias("ranking_id"), F.col("entity_id").alias("new_id"))
    return links.join(own, "ranking_id", "left").select(
        "ranking_id", F.coalesce("entity_id", "new_id").alias("entity_id"), "match_type")


MAIL_FILL_THRESHOLD = 0.90


def licensed_entities(t):
    """Master rows in each state where they hold a licence, and the owner of every name there."""
    entities = master(t).where("name_key IS NOT NULL")
    held = t.licenses.where("state IS NOT NULL").select(
        F.col("contractor_id").alias("entity_id"), F.col("state").alias("block")).distinct()
    licensed = cut_lineage(entities.join(held, "entity_id"))
    owners = licensed.groupBy("block", F.col("name_key").alias("name")).agg(
        F.min("entity_id").alias("entity_id"))
    return licensed, owners


def matched_donors(donors, owners, *carry):
    """Donors (record_id, block, name) by equal name (80), else by a similar one (75)."""
    exact = donors.join(owners, ["block", "name"]).withColumn("confidence", F.lit(80))
    rest = donors.join(exact.select("record_id"), "record_id", "left_anti")
    known = owners.select("entity_id", "block", "name")
    fuzzy = linkage.fuzzy_first(
        rest.select("record_id", "block", "name"), known,
        "block", MAIL_FILL_THRESHOLD,
    ).join(rest.select("record_id", *carry), "record_id").withColumn("confidence", F.lit(75))
    columns = ["record_id", "entity_id", *carry, "confidence"]
    return exact.select(*columns).unionByName(fuzzy.select(*columns))


def offers_sql(donors):
    """SQL of matched_donors: offers (record_id, entity_id, confidence) of donors (record_id, a, block, ...)."""
    long_enough = f"2.0 * least(length(a), length(b)) >= {MAIL_FILL_THRESHOLD} * (length(a) + length(b))"
    pairs = duck.distinct_pairs(f"SELECT a, b FROM rest JOIN owners USING (block) WHERE {long_enough}")
    return f"""WITH RECURSIVE {MK}, licensed AS (SELECT DISTINCT mk.id AS entity_id, primary_email AS held_email, name_key, l.state AS block
        FROM mk JOIN licenses l ON l.contractor_id = mk.id WHERE name_key IS NOT NULL AND l.state IS NOT NULL),
    owners AS (SELECT block, name_key AS b, min(entity_id) AS entity_id FROM licensed GROUP BY ALL),
    donors AS ({donors}),
    exact AS (SELECT record_id, entity_id FROM donors JOIN owners ON owners.block = donors.block AND b = a),
    rest AS (SELECT * FROM donors WHERE record_id NOT IN (SELECT record_id FROM exact)), {pairs}, {duck.BLOCK_RATIOS},
    offers AS (SELECT record_id, entity_id, 80 AS confidence FROM exact UNION ALL
        SELECT record_id, min(entity_id), 75 FROM rest JOIN owners USING (block) JOIN ratios USING (a, b)
        WHERE ratio >= {MAIL_FILL_THRESHOLD} GROUP BY record_id)"""


@query(
    "j14_email_fill",
    offers_sql(f"""SELECT * FROM (SELECT dealer_id AS record_id, {duck.email_key('email')} AS mail,
        {duck.company_key('name')} AS a, state AS block FROM dealers) WHERE mail IS NOT NULL AND a IS NOT NULL AND block IS NOT NULL""")
    + """, best AS (SELECT entity_id, min_by(mail, record_id) AS mail, min_by(confidence, record_id) AS confidence
        FROM offers JOIN donors USING (record_id) GROUP BY entity_id)
        SELECT entity_id, coalesce(held_email, mail) AS email, held_email IS NULL AS was_filled, confidence
        FROM (SELECT DISTINCT entity_id, held_email FROM licensed) JOIN best USING (entity_id)""",
)
def j14(t):
    """E-mails for licensed entities by name, exact (80) then similar (75); present ones stay."""
    licensed, owners = licensed_entities(t)
    donors = cut_lineage(
        t.dealers.where("state IS NOT NULL").select(
            F.col("dealer_id").alias("record_id"), domains.email_key("email").alias("mail"),
            names.company_key("name").alias("name"), F.col("state").alias("block"),
        ).where("mail IS NOT NULL AND name IS NOT NULL")
    )
    best = matched_donors(donors, owners, "mail").groupBy("entity_id").agg(
        F.min_by(F.struct("mail", "confidence"), "record_id").alias("o")
    )
    return licensed.drop("block").distinct().join(best, "entity_id").select(
        "entity_id", F.coalesce("email", "o.mail").alias("email"),
        F.col("email").isNull().alias("was_filled"), "o.confidence",
    )


@query(
    "j14b_contact_rows",
    offers_sql(f"""SELECT * FROM (SELECT row_no AS record_id, {duck.email_key('email')} AS email, {duck.clean('person_name')} AS contact_name,
        {duck.company_key('business_name')} AS a, state AS block FROM registry)
        WHERE a IS NOT NULL AND contact_name IS NOT NULL AND block IS NOT NULL""")
    + f""", people AS (SELECT entity_id, contact_name, email, confidence, record_id FROM offers JOIN donors USING (record_id)),
        held AS (SELECT contractor_id AS entity_id, contact_name, {duck.email_key('email')} AS email FROM contacts),
        by_mail AS (SELECT * FROM people WHERE email IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY entity_id, email ORDER BY record_id) = 1),
        by_name AS (SELECT * FROM people WHERE email IS NULL
            QUALIFY row_number() OVER (PARTITION BY entity_id, contact_name ORDER BY record_id) = 1)
        SELECT *, 'registry' AS source FROM by_mail ANTI JOIN held USING (entity_id, email) UNION ALL
        SELECT *, 'registry' FROM by_name ANTI JOIN held USING (entity_id, contact_name)""",
)
def j14b(t):
    """The people of registry rows whose company has a licensed entity, as new contacts of it."""
    _, owners = licensed_entities(t)
    donors = cut_lineage(
        t.registry.where("state IS NOT NULL").select(
            F.col("row_no").alias("record_id"), domains.email_key("email").alias("email"),
            text.clean("person_name").alias("contact_name"), names.company_key("business_name").alias("name"),
            F.col("state").alias("block"),
        ).where("name IS NOT NULL AND contact_name IS NOT NULL")
    )
    matched = matched_donors(donors, owners, "email", "contact_name")
    return inserts.new_contacts(matched, master_contacts(t)).withColumn("source", F.lit("registry"))


@query(
    "j15_contact_fill",
    f"""WITH spread AS (SELECT contractor_id FROM licenses GROUP BY 1 HAVING count(DISTINCT state) >= 2),
        p AS (SELECT contractor_id, min_by(phone, contact_id) AS phone FROM contacts WHERE phone IS NOT NULL GROUP BY 1),
        e AS (SELECT contractor_id, min_by({duck.email_key('email')}, contact_id) AS email FROM contacts WHERE email IS NOT NULL GROUP BY 1)
        SELECT c.id AS entity_id, CASE WHEN s.contractor_id IS NULL THEN c.primary_phone ELSE coalesce(c.primary_phone, p.phone) END AS phone,
        CASE WHEN s.contractor_id IS NULL THEN c.primary_email ELSE coalesce(c.primary_email, e.email) END AS email
        FROM contractors c LEFT JOIN spread s ON s.contractor_id = c.id LEFT JOIN p ON p.contractor_id = c.id
        LEFT JOIN e ON e.contractor_id = c.id""",
)
def j15(t):
    held = t.licenses.select(F.col("contractor_id").alias("entity_id"), "state")
    entities = master(t).select("entity_id", "phone", "email")
    return enrich.fill_from_contacts(entities, held, master_contacts(t))


def trade_ranked(t):
    return merged_rankings(t, names.company_key_trade)


TRADE = duck.company_key("company_name", fixed.TRADE_SUFFIXES)
COOP = """coop AS (SELECT domain, first(company_name ORDER BY CASE list_name WHEN 'solar' THEN 0 ELSE 1 END, member_id)
    AS company_name, bool_or(list_name = 'solar') AS in_solar_coop, bool_or(list_name = 'om') AS in_om_coop
    FROM members GROUP BY domain)"""
TRADE_RANKED = RANKED.replace(duck.company_key("company_name"), TRADE)
MASTER_LIST = f"""{COOP}, {TRADE_RANKED}, c AS (SELECT *, {TRADE} AS name_key FROM contractors),
    ml AS (SELECT c.id AS entity_id, c.company_name, c.name_key, c.primary_domain AS domain, c.state,
    true AS has_state_license, r.name_key IS NOT NULL AS in_ranking, coalesce(in_solar_coop, false) AS in_solar_coop,
    coalesce(in_om_coop, false) AS in_om_coop, 1 + CAST(r.name_key IS NOT NULL AS INT) + CAST(coop.domain IS NOT NULL AS INT)
    AS source_count, coalesce(r.kw_installed, 0) AS kw_installed, coalesce(r.list_count, 0) AS list_count
    FROM c LEFT JOIN ranked r ON r.name_key = c.name_key LEFT JOIN coop ON coop.domain = c.primary_domain)"""


def master_rows(t):
    entities = t.contractors.select(
        F.col("id").alias("entity_id"), "company_name", F.col("primary_domain").alias("domain"),
        "state", names.company_key_trade("company_name").alias("name_key"),
    )
    return enrich.master_list(entities, trade_ranked(t), enrich.membership(t.members))


@query("j16_master_list", f"WITH {MASTER_LIST} SELECT * FROM ml")
def j16(t):
    return master_rows(t)


@query(
    "j17_outside_master",
    f"""WITH {MASTER_LIST}, co AS (SELECT coop.*, {TRADE} AS name_key FROM coop WHERE domain NOT IN
        (SELECT domain FROM ml WHERE domain IS NOT NULL))
        SELECT co.company_name, co.name_key, co.domain, CAST(NULL AS VARCHAR) AS state, r.name_key IS NOT NULL AS in_ranking,
        in_solar_coop, in_om_coop, 1 + CAST(r.name_key IS NOT NULL AS INT) AS source_count,
        coalesce(r.kw_installed, 0) AS kw_installed, coalesce(r.list_count, 0) AS list_count
        FROM co LEFT JOIN ranked r USING (name_key) UNION ALL
        SELECT name_key, name_key, NULL, headquarters_state, true, false, false, 1, kw_installed, list_count FROM ranked
        WHERE name_key IS NOT NULL AND name_key NOT IN (SELECT name_key FROM ml WHERE name_key IS NOT NULL)
        AND name_key NOT IN (SELECT name_key FROM co WHERE name_key IS NOT NULL)""",
)
def j17(t):
    return enrich.outside_master(
        master_rows(t), trade_ranked(t), enrich.membership(t.members),
        names.company_key_trade("company_name"),
    )


@query(
    "j18_membership",
    f"""WITH {COOP} SELECT *, CAST(in_solar_coop AS INT) + CAST(in_om_coop AS INT) AS cooperative_count FROM coop""",
)
def j18(t):
    return enrich.membership(t.members)


@query(
    "j19_several_lists",
    f"""WITH a AS (SELECT {duck.company_key('name')} AS name_key, 'directory' AS source, {duck.email_key('email')} AS email,
        NULL AS licence FROM dealers UNION ALL SELECT {duck.company_key('company_name')}, 'ranking', NULL, NULL FROM rankings
        UNION ALL SELECT {duck.company_key('business_name')}, 'registry', {duck.email_key('email')}, type_code FROM registry)
        SELECT name_key, count(*) AS source_count, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources,
        count(email) AS emails, count(DISTINCT licence) AS licences, count(email) > 0 AS has_email,
        count(DISTINCT licence) >= 2 AS is_multi_trade FROM a WHERE name_key IS NOT NULL GROUP BY name_key
        HAVING count(*) > 1""",
)
def j19(t):
    return enrich.in_several_lists(lead_lists(t))


def lead_lists(t):
    none = F.lit(None).cast("string")
    return [
        t.dealers.select(
            names.company_key("name").alias("name_key"), F.lit("directory").alias("source"),
            domains.email_key("email").alias("email"), none.alias("licence"),
        ),
        t.rankings.select(
            names.company_key("company_name").alias("name_key"), F.lit("ranking").alias("source"),
            none.alias("email"), none.alias("licence"),
        ),
        t.registry.select(
            names.company_key("business_name").alias("name_key"), F.lit("registry").alias("source"),
            domains.email_key("email").alias("email"), F.col("type_code").alias("licence"),
        ),
    ]


@query(
    "j20_nested_children",
    f"""WITH l AS (SELECT contractor_id, string_agg(item, ';' ORDER BY item) AS s FROM (SELECT DISTINCT contractor_id,
        concat_ws(':', state, license_type, license_number) AS item FROM licenses) GROUP BY 1),
        b AS (SELECT contractor_id, string_agg(DISTINCT brand, ';' ORDER BY brand) AS s FROM certifications GROUP BY 1),
        k AS (SELECT contractor_id, string_agg(DISTINCT {duck.email_key('email')}, ';' ORDER BY {duck.email_key('email')}) AS s FROM contacts
        WHERE email IS NOT NULL GROUP BY 1)
        SELECT id AS entity_id, company_name, 0 AS part, coalesce(l.s, '') AS licences, coalesce(b.s, '') AS brands,
        coalesce(k.s, '') AS contacts FROM contractors c LEFT JOIN l ON l.contractor_id = c.id
        LEFT JOIN b ON b.contractor_id = c.id LEFT JOIN k ON k.contractor_id = c.id""",
)
def j20(t):
    entities = t.contractors.select(F.col("id").alias("entity_id"), "company_name")
    owner = F.col("contractor_id").alias("entity_id")
    return enrich.nested_children(entities, {
        "licences": t.licenses.select(
            owner, F.concat_ws(":", "state", "license_type", "license_number").alias("item")
        ),
        "brands": t.certifications.select(owner, F.col("brand").alias("item")),
        "contacts": t.contacts.select(owner, domains.email_key("email").alias("item")).where(
            "item IS NOT NULL"
        ),
    })


FLAGGED = ["HVAC", "ELECTRICAL", "PLUMBING", "SOLAR", "ROOFING"]


@query(
    "j21_category_flags",
    "SELECT id AS entity_id, "
    + ", ".join(
        f"EXISTS (SELECT 1 FROM licenses l WHERE l.contractor_id = c.id AND l.license_category = '{c}') AS has_{c.lower()}"
        for c in FLAGGED
    )
    + " FROM contractors c",
)
def j21(t):
    held = t.licenses.select(F.col("contractor_id").alias("entity_id"), "license_category")
    return enrich.category_flags(
        t.contractors.select(F.col("id").alias("entity_id")), held, FLAGGED
    )


def sync_status(t):
    """Sync state per entity: synced once contacted, stale once a demo is set, none before."""
    state = (
        F.when(F.col("stage") == "RAW_LEAD", "pending")
        .when(F.col("stage").isin("CONTACTED", "RESPONDED"), "synced")
        .when(F.col("stage").isin("DEMO_SET", "OPPORTUNITY"), "needs_update")
    )
    return t.attribution.select(
        F.col("contractor_id").alias("entity_id"), state.alias("sync_status")
    ).where("sync_status IS NOT NULL")


SYNC = """sync AS (SELECT contractor_id AS entity_id, CASE WHEN stage = 'RAW_LEAD' THEN 'pending'
    WHEN stage IN ('CONTACTED', 'RESPONDED') THEN 'synced' ELSE 'needs_update' END AS sync_status FROM attribution
    WHERE stage IN ('RAW_LEAD', 'CONTACTED', 'RESPONDED', 'DEMO_SET', 'OPPORTUNITY'))"""


@query(
    "j22_pending_sync",
    f"""WITH {SYNC} SELECT c.id AS entity_id, c.lead_score, coalesce(s.sync_status, 'pending') AS sync_status
        FROM contractors c LEFT JOIN sync s ON s.entity_id = c.id WHERE s.sync_status IS NULL OR s.sync_status = 'pending'""",
)
def j22(t):
    entities = t.contractors.select(F.col("id").alias("entity_id"), "lead_score")
    return enrich.pending_sync(entities, sync_status(t), "lead_score")


@query(
    "j23_needs_update",
    f"""WITH {SYNC} SELECT c.id AS entity_id, c.lead_score, s.sync_status FROM contractors c JOIN sync s
        ON s.entity_id = c.id WHERE s.sync_status = 'needs_update'""",
)
def j23(t):
    entities = t.contractors.select(F.col("id").alias("entity_id"), "lead_score")
    return enrich.needs_update(entities, sync_status(t), "lead_score")
