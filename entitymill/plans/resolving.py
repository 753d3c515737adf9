"""Deduplication and entity resolution (D*), windows (W*) and set operations (U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names, phones, text
from ..functions.domains import email_domain, email_key
from ..operators import cluster, growing, keyed, leaders, numbering, pairs, upsert as upserting
from ..operators.linkage import FUZZY_THRESHOLD
from ..session import cut_lineage
from . import duck
from .loading import loaded_registries
from .registry import query
from .shared import DK, keyed_dealers, master, master_contacts

FIRST = "QUALIFY row_number() OVER (PARTITION BY {} ORDER BY dealer_id) = 1"


@query(
    "d01_first_per_phone",
    f"WITH {DK} SELECT dealer_id, name, phone_key FROM dk WHERE phone_key IS NOT NULL {FIRST.format('phone_key')}",
)
def d01(t):
    rows = keyed_dealers(t).select("dealer_id", "name", "phone_key")
    return keyed.first_per_key(rows, ["phone_key"], "dealer_id")


@query(
    "d02_phone_else_name",
    f"""WITH {DK}, kept AS (SELECT * FROM dk WHERE phone_key IS NOT NULL {FIRST.format('phone_key')}),
        loose AS (SELECT * FROM dk WHERE phone_key IS NULL {FIRST.format('plain_name')})
        SELECT dealer_id, plain_name FROM kept UNION ALL
        SELECT l.dealer_id, l.plain_name FROM loose l WHERE NOT EXISTS (SELECT 1 FROM kept k
        WHERE k.plain_name = l.plain_name AND k.dealer_id < l.dealer_id)""",
)
def d02(t):
    rows = keyed_dealers(t).select("dealer_id", "phone_key", "plain_name")
    kept = keyed.first_per_phone_else_name(rows, "phone_key", "plain_name", "dealer_id")
    return kept.select("dealer_id", "plain_name")


@query(
    "d03_mark_duplicates",
    f"""WITH {DK} SELECT dealer_id, phone_key IS NOT NULL AND row_number() OVER (PARTITION BY phone_key
        ORDER BY dealer_id) > 1 AS is_duplicate FROM dk""",
)
def d03(t):
    rows = keyed_dealers(t).select("dealer_id", "phone_key")
    return keyed.mark_later(rows, "phone_key", "dealer_id").select("dealer_id", "is_duplicate")


PHASES = f"""{DK}, p AS (SELECT * FROM dk QUALIFY phone_key IS NULL OR row_number() OVER
    (PARTITION BY phone_key ORDER BY dealer_id) = 1), d AS (SELECT * FROM p QUALIFY domain_key IS NULL OR
    row_number() OVER (PARTITION BY domain_key ORDER BY dealer_id) = 1)"""


@query("d04_phone_then_domain", f"WITH {PHASES} SELECT dealer_id, name FROM d")
def d04(t):
    rows = keyed_dealers(t).select("dealer_id", "name", "phone_key", "domain_key")
    return keyed.phone_then_domain(rows, "phone_key", "domain_key", "dealer_id").select(
        "dealer_id", "name"
    )


@query(
    "d04b_phase_counts",
    f"""WITH {PHASES} SELECT 'raw' AS phase, count(*) AS rows FROM dk UNION ALL
        SELECT 'phone', count(*) FROM p UNION ALL SELECT 'domain', count(*) FROM d""",
)
def d04b(t):
    rows = keyed_dealers(t).select("dealer_id", "phone_key", "domain_key")
    return keyed.phase_counts(rows, "phone_key", "domain_key", "dealer_id")


def fuzzy_name_edges(rows, ratio, floor):
    """Directed (key, other_key) between the distinct names of a state."""
    blocked = rows.select(F.col("state").alias("block"), F.col("fuzzy_name").alias("name"))
    return (
        pairs.candidate_pairs(blocked, blocked, FUZZY_THRESHOLD)
        .where("new_name <> known_name")
        .where(ratio >= floor)
        .select(
            F.concat_ws("|", F.lit("name:"), "block", "new_name").alias("key"),
            F.concat_ws("|", F.lit("name:"), "block", "known_name").alias("other_key"),
        )
    )


def name_members(rows):
    return rows.where("state IS NOT NULL AND fuzzy_name IS NOT NULL").select(
        "pos", F.concat_ws("|", F.lit("name:"), "state", "fuzzy_name").alias("key")
    )


def edge_keys(similar):
    """Edges (key, other_key) of pairs (block, name, other)."""
    return similar.select(
        *[F.concat_ws("|", F.lit("name:"), "block", c).alias(key) for c, key in (("name", "key"), ("other", "other_key"))])


def leaders_by_name(rows):
    """Phase three: of the rows (pos, state, fuzzy_name), those no earlier kept name resembles."""
    return leaders.banded_leaders(rows, name_members(rows), edge_keys, FUZZY_THRESHOLD, "indel")


# The rows of a state are walked in order; a row is dropped when not all that come before it and
# resemble it have been dropped.
LEADERS = f"""{PHASES}, named AS (SELECT dealer_id, upper(state) AS st, lower({duck.clean('name')}) AS nm FROM d),
    n AS (SELECT * FROM named WHERE st IS NOT NULL AND nm IS NOT NULL),
    u AS (SELECT DISTINCT st, nm FROM n),
    pairs AS (SELECT a.st, a.nm AS name_key, b.nm AS first_key FROM u a JOIN u b ON a.st = b.st AND a.nm < b.nm
        WHERE 200 * least(length(a.nm), length(b.nm)) >= 85 * (length(a.nm) + length(b.nm))),
    near AS (SELECT * FROM pairs WHERE CAST(200 AS DOUBLE) * {duck.LCS} / (length(name_key) + length(first_key)) >= 85),
    alike AS (SELECT st, nm, nm AS other FROM u UNION ALL SELECT st, name_key, first_key FROM near
        UNION ALL SELECT st, first_key, name_key FROM near),
    nodes AS (SELECT l.st, l.dealer_id AS later, list(e.dealer_id) AS before,
            row_number() OVER (PARTITION BY l.st ORDER BY l.dealer_id) AS place
        FROM n l JOIN alike ON alike.st = l.st AND alike.nm = l.nm
            JOIN n e ON e.st = l.st AND e.nm = other AND e.dealer_id < l.dealer_id GROUP BY l.st, l.dealer_id),
    walk AS (SELECT DISTINCT st, CAST(0 AS BIGINT) AS place, CAST([] AS BIGINT[]) AS dropped FROM nodes
        UNION ALL SELECT walk.st, nodes.place, CASE WHEN list_has_all(walk.dropped, nodes.before) THEN walk.dropped
            ELSE list_append(walk.dropped, nodes.later) END
        FROM walk JOIN nodes ON nodes.st = walk.st AND nodes.place = walk.place + 1),
    gone AS (SELECT unnest(dropped) AS dealer_id FROM (SELECT arg_max(dropped, place) AS dropped FROM walk GROUP BY st))"""


@query(
    "d05_fuzzy_leaders",
    f"WITH RECURSIVE {LEADERS} SELECT dealer_id, name, state FROM d WHERE dealer_id NOT IN (SELECT dealer_id FROM gone)",
)
def d05(t):
    rows = keyed_dealers(t).select(
        "dealer_id", "name", "phone_key", "domain_key", "state",
        F.lower(text.clean("name")).alias("fuzzy_name"),
    )
    survivors = cut_lineage(
        keyed.phone_then_domain(rows, "phone_key", "domain_key", "dealer_id").withColumnRenamed(
            "dealer_id", "pos"
        )
    )
    kept = leaders_by_name(survivors.select("pos", F.upper("state").alias("state"), "fuzzy_name"))
    return survivors.join(kept.where("kept"), "pos").select(
        F.col("pos").alias("dealer_id"), "name", "state"
    )


def multi_signal_members(rows):
    """Long keys of (pos, phone_key, domain_key, state, fuzzy_name)."""
    keyed_rows = F.array_compact(
        F.array(F.concat(F.lit("phone:"), "phone_key"), F.concat(F.lit("domain:"), "domain_key"))
    )
    exact = rows.select("pos", F.explode(keyed_rows).alias("key"))
    return exact.unionAll(name_members(rows))


REASON_RANKS = {"phone": 1, "domain": 2, "name": 3}


def multi_signal_leaders(rows):
    members = cut_lineage(multi_signal_members(rows))
    decided = cut_lineage(leaders.banded_leaders(rows, members, edge_keys, FUZZY_THRESHOLD, "block"))
    first = leaders.first_edges(rows, decided, FUZZY_THRESHOLD, "block")
    edges = edge_keys(first.where("name <> other"))
    reasons = cluster.drop_reasons(decided, members, cut_lineage(edges), REASON_RANKS)
    return decided.join(reasons, "pos", "left")


# A ratio of matching blocks never exceeds the one of the longest common subsequence, which sorts
# out most pairs. Then all rows are walked in order, as in LEADERS.
SIGNALS = f"""{DK}, k AS (SELECT dealer_id, phone_key, domain_key, state AS st, {duck.company_key_anchored('name')} AS nm FROM dk),
    u AS (SELECT DISTINCT st, nm FROM k WHERE st IS NOT NULL AND nm IS NOT NULL),
    met AS (SELECT DISTINCT x.nm AS name_key, y.nm AS first_key FROM u x JOIN u y ON x.st = y.st AND x.nm <> y.nm
        WHERE 200 * least(length(x.nm), length(y.nm)) >= 85 * (length(x.nm) + length(y.nm))),
    {duck.distinct_pairs(f"SELECT name_key AS a, first_key AS b FROM met WHERE 200 * {duck.LCS} >= 85 * (length(name_key) + length(first_key))")},
    {duck.BLOCK_RATIOS}, alike AS (SELECT a AS nm, b AS other FROM ratios WHERE ratio >= 0.85 UNION ALL SELECT DISTINCT nm, nm FROM u),
    hits AS (
        SELECT l.dealer_id AS later, e.dealer_id AS earlier, 1 AS rank, 'phone' AS reason FROM k l JOIN k e
            ON e.phone_key = l.phone_key AND e.dealer_id < l.dealer_id
        UNION ALL SELECT l.dealer_id, e.dealer_id, 2, 'domain' FROM k l JOIN k e
            ON e.domain_key = l.domain_key AND e.dealer_id < l.dealer_id
        UNION ALL SELECT l.dealer_id, e.dealer_id, 3, 'name' FROM k l JOIN alike ON alike.nm = l.nm
            JOIN k e ON e.st = l.st AND e.nm = other AND e.dealer_id < l.dealer_id),
    nodes AS (SELECT later, list(DISTINCT earlier) AS before, row_number() OVER (ORDER BY later) AS place FROM hits GROUP BY later),
    walk AS (SELECT CAST(0 AS BIGINT) AS place, CAST([] AS BIGINT[]) AS dropped
        UNION ALL SELECT nodes.place, CASE WHEN list_has_all(dropped, before) THEN dropped ELSE list_append(dropped, later) END
        FROM walk JOIN nodes ON nodes.place = walk.place + 1),
    gone AS (SELECT unnest(dropped) AS dealer_id FROM (SELECT arg_max(dropped, place) AS dropped FROM walk)),
    why AS (SELECT later AS dealer_id, min({{'rank': rank, 'reason': reason, 'at': earlier}}) AS best FROM hits
        WHERE later IN (SELECT dealer_id FROM gone) AND earlier NOT IN (SELECT dealer_id FROM gone) GROUP BY later)"""


@query(
    "d06_multi_signal_leaders",
    f"""WITH RECURSIVE {SIGNALS} SELECT dealer_id, best IS NULL AS kept, best.reason AS reason, best.at AS kept_pos
        FROM k LEFT JOIN why USING (dealer_id)""",
)
def d06(t):
    rows = cut_lineage(
        keyed_dealers(t).select(
            F.col("dealer_id").alias("pos"), "phone_key", "domain_key", "state",
            names.company_key_anchored("name").alias("fuzzy_name"),
        )
    )
    return multi_signal_leaders(rows).select(
        F.col("pos").alias("dealer_id"), "kept", "reason", "kept_pos"
    )


def batch(t):
    """The loaded registry rows as an upsert batch, numbered by row and class position."""
    position = F.coalesce(F.col("class_no"), F.lit(0))
    return loaded_registries(t).select(
        (F.col("row_no") * (1 << 31) + position).alias("record_id"),
        "company_name", "contact_name", "city", "state", "zip",
        "license_type", "license_category", "license_number",
        phones.phone10("phone").alias("phone"), F.lower(text.clean("email")).alias("email"),
        email_domain("email").alias("domain"), names.company_key("company_name").alias("name_key"),
    )


def run_upsert(t, records=None):
    licences = t.licenses.select(
        F.col("contractor_id").alias("entity_id"), "state", "license_type", "license_number"
    )
    return upserting.upsert(batch(t) if records is None else records, master(t), master_contacts(t), licences)


@query("d07_upsert")
def d07(t):
    done = run_upsert(t)
    return done.assignments.groupBy("match_type").agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("entity_id").alias("entities"),
        F.count_if("is_new").alias("inserted"),
    )


def exact_members(t):
    rows = keyed_dealers(t).select(
        F.col("dealer_id").alias("id"), "phone_key", "email_key", "state",
        names.company_key("name").alias("name_key"),
    )
    keys = F.array_compact(
        F.array(
            F.concat(F.lit("phone:"), "phone_key"),
            F.concat(F.lit("email:"), "email_key"),
            F.concat(F.lit("name:"), "name_key", F.lit("|"), "state"),
        )
    )
    return rows, rows.select("id", F.explode(keys).alias("key"))


COMPONENTS = f"""WITH RECURSIVE {DK}, nk AS (SELECT *, {duck.company_key('name')} AS name_key FROM dk),
    m AS (SELECT dealer_id AS id, 'p' || phone_key AS key FROM nk WHERE phone_key IS NOT NULL
          UNION SELECT dealer_id, 'e' || email_key FROM nk WHERE email_key IS NOT NULL
          UNION SELECT dealer_id, 'n' || name_key || '|' || state FROM nk WHERE name_key IS NOT NULL),
    hub AS (SELECT key, min(id) AS h FROM m GROUP BY key),
    star AS (SELECT DISTINCT m.id AS u, hub.h AS v FROM m JOIN hub USING (key) WHERE m.id <> hub.h),
    links AS (SELECT u, v FROM star UNION SELECT v, u FROM star),
    reach AS (SELECT dealer_id AS start, dealer_id AS node FROM nk
              UNION SELECT r.start, l.v FROM reach r JOIN links l ON l.u = r.node),
    comp AS (SELECT start AS dealer_id, min(node) AS component FROM reach GROUP BY start)"""


@query(
    "d08_components",
    COMPONENTS + """ SELECT component, count(*) AS records, count(DISTINCT brand) AS brands,
        string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS sources,
        min_by(name, dealer_id) AS first_name FROM comp JOIN nk USING (dealer_id) GROUP BY component""",
)
def d08(t):
    rows, members = exact_members(t)
    members = cut_lineage(members)
    found = cluster.connected_components(rows, cluster.key_links(members))
    extra = t.dealers.select(F.col("dealer_id").alias("id"), "brand", "source_file", "name")
    return found.join(extra, "id").groupBy("component").agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("brand").alias("brands"),
        text.join_sorted(F.collect_set("source_file"), ",").alias("sources"),
        F.min_by("name", "id").alias("first_name"),
    )


# Sources in the order in which they are merged; an id is the source and its own key.
SOURCE_STRIDE = 1 << 40
SETS = {"phones": "phone", "emails": "email", "contact_names": "contact_name", "sources": "source",
        "license_types": "license_types", "categories": "categories"}
# A number under which more different names stand is a switchboard or a toll-free line.
NAMES_OF_A_NUMBER = 10


def listed_rows(t):
    """Directory, registry and ranking rows in one form, with the keys that they merge by."""
    empty = F.lit(None).cast("string")

    def part(source, df, key, name, state, phone, email, contact, source_name, licences, categories, kw):
        return df.select(
            (F.lit(source * SOURCE_STRIDE) + F.col(key)).cast("long").alias("id"),
            text.clean(name).alias("company_name"), F.coalesce(F.upper(state), F.lit("")).alias("state"),
            phones.phone10(phone).alias("phone"), email_key(email).alias("email"), email_domain(email).alias("domain"),
            text.clean(contact).alias("contact_name"), source_name.alias("source"),
            licences.alias("license_types"), categories.alias("categories"), kw.cast("long").alias("kw"))

    none = F.array().cast("array<string>")
    dealers = part(0, t.dealers, "dealer_id", "name", "state", "phone", "email", empty, F.col("source_file"),
                   none, text.split_list("certifications", ","), F.lit(None))
    registry = part(1, t.registry, "row_no", "business_name", "state", "business_phone", "email", "person_name",
                    F.col("registry_state"), F.array("type_code"), none, F.lit(None))
    ranked = part(2, t.rankings, "ranking_id", "company_name", "headquarters_state", empty, empty, empty,
                  F.col("list_name"), text.split_list("licence_text", ";"), text.split_list("markets", ","), F.col("kw_installed"))
    return dealers.unionByName(registry).unionByName(ranked).withColumn(
        "name", names.company_key_cut_anywhere("company_name"))


def keys_of(rows, **columns):
    """(id, key) of every present key; a key carries its signal as prefix."""
    listed = F.array_compact(F.array(*[F.concat(F.lit(f"{signal}:"), c) for signal, c in columns.items()]))
    return rows.select("id", F.explode(listed).alias("key"))


def grown(t, most_names=None):
    """Rows of all lists and their components; numbers under more than `most_names` names are weak, if given."""
    rows = cut_lineage(listed_rows(t))
    strong = keys_of(rows, email=F.col("email"), name=F.concat("name", F.lit("|"), "state"))
    numbers = keys_of(rows, phone=F.col("phone"))
    weak = keys_of(rows, domain=F.col("domain")).withColumn("first_only", F.lit(True))
    if most_names is not None:
        numbers, shared = growing.split_shared(numbers, rows, most_names)
        weak = weak.unionByName(shared.withColumn("first_only", F.lit(False)))
    return rows, growing.growing_components(rows, strong.unionByName(numbers), weak)


def merged(t, most_names=None):
    return growing.merge_rows(*grown(t, most_names), SETS, ["company_name", "state"], "kw")


@query("d08b_growing_index")
def d08b(t):
    """Mail domains merge by a similar name as well; what merged rows bring along counts on."""
    return merged(t).entities


@query("d08c_shared_numbers")
def d08c(t):
    """As d08b, but a number of many different names needs a similar name."""
    return merged(t, NAMES_OF_A_NUMBER).entities


@query("d08d_merged_values")
def d08d(t):
    """The sets of d08c's entities."""
    return merged(t, NAMES_OF_A_NUMBER).values


OVERLAP = """SELECT entity_key, min_by(name, dealer_id) AS name, min_by(city, dealer_id) AS city,
    min_by(state, dealer_id) AS state, min_by(tier, dealer_id) AS tier, count(DISTINCT brand) AS brand_count,
    string_agg(DISTINCT brand, ', ' ORDER BY brand) AS brands
    FROM (SELECT *, coalesce('phone_' || phone_key, 'domain_' || domain_key) AS entity_key FROM dk)
    WHERE entity_key IS NOT NULL GROUP BY entity_key"""


def overlap(t, flags=()):
    rows = keyed_dealers(t, "has_hvac", "has_generator")
    base = ["name", "city", "state", "tier"]
    if flags:
        rows = rows.withColumns({f: F.col(f) == "True" for f in flags})
    brands = text.split_list("brand", ",") if flags else F.array("brand")
    return keyed.brand_overlap(
        rows, "phone_key", "domain_key", brands, "dealer_id", base, list(flags)
    )


@query("d09_brand_overlap", f"WITH {DK} {OVERLAP}")
def d09(t):
    return overlap(t)


@query(
    "d10_brand_overlap_flags",
    f"""WITH {DK}, o AS ({OVERLAP}), f AS (SELECT coalesce('phone_' || phone_key, 'domain_' || domain_key)
        AS entity_key, bool_or(has_hvac = 'True') AS has_hvac, bool_or(has_generator = 'True') AS has_generator
        FROM dk GROUP BY 1) SELECT o.*, f.has_hvac, f.has_generator FROM o JOIN f USING (entity_key)""",
)
def d10(t):
    return overlap(t, ("has_hvac", "has_generator"))


SOURCES = f"""{DK}, lic AS (SELECT {duck.phone10('business_phone')} AS phone, {duck.clean('business_name')} AS name,
    city, state, registry_state || '_License' AS registry, row_no AS pos FROM registry),
    both_sides AS (SELECT phone_key AS phone, name, city, state, brand, NULL AS registry, 0 AS side, dealer_id AS pos FROM dk
         UNION ALL SELECT phone, name, city, state, NULL, registry, 1, pos FROM lic),
    grouped AS (SELECT phone, first(name ORDER BY side, pos) AS name, first(city ORDER BY side, pos) AS city,
        first(state ORDER BY side, pos) AS state, count(DISTINCT brand) AS num_brands,
        count(DISTINCT registry) AS num_licences, count(DISTINCT brand) + count(DISTINCT registry) AS num_overlaps,
        coalesce(string_agg(DISTINCT brand, ', ' ORDER BY brand), '') AS brand_sources,
        coalesce(string_agg(DISTINCT registry, ', ' ORDER BY registry), '') AS licence_sources,
        string_agg(DISTINCT coalesce(brand, registry), ', ' ORDER BY coalesce(brand, registry)) AS overlap_sources
        FROM both_sides WHERE phone IS NOT NULL GROUP BY phone)"""


def phone_sources(t):
    dealers = keyed_dealers(t).select(
        F.col("phone_key").alias("phone"), "name", "city", "state",
        F.col("brand").alias("source"), F.col("dealer_id").alias("pos"),
    )
    licences = t.registry.select(
        phones.phone10("business_phone").alias("phone"), text.clean("business_name").alias("name"),
        "city", "state", F.concat("registry_state", F.lit("_License")).alias("source"),
        F.col("row_no").alias("pos"),
    )
    return keyed.source_overlap(dealers, licences)


@query("d11_source_overlap", f"WITH {SOURCES} SELECT * FROM grouped")
def d11(t):
    return phone_sources(t)


RANKED = f"""ranked AS (SELECT {duck.company_key('company_name')} AS name_key, max(kw_installed) AS kw_installed,
    first(profile_url ORDER BY ranking_id) FILTER (profile_url IS NOT NULL) AS profile_url,
    first(headquarters_state ORDER BY ranking_id) FILTER (headquarters_state IS NOT NULL) AS headquarters_state,
    count(DISTINCT list_name) AS list_count, string_agg(DISTINCT list_name, ', ' ORDER BY list_name) AS lists
    FROM rankings GROUP BY 1)"""


def merged_rankings(t, key=names.company_key):
    rows = t.rankings.withColumn("name_key", key("company_name"))
    return keyed.best_of_lists(
        rows, "name_key", "ranking_id", ["kw_installed"], ["profile_url", "headquarters_state"],
        "list_name",
    )


@query("d12_best_of_lists", f"WITH {RANKED} SELECT * FROM ranked")
def d12(t):
    return merged_rankings(t)


PHONE_EDGES = f"""{DK}, hub AS (SELECT phone_key, min(dealer_id) AS entity_id FROM dk WHERE phone_key IS NOT NULL
    GROUP BY phone_key), e AS (SELECT dk.*, hub.entity_id FROM dk JOIN hub USING (phone_key)
    WHERE dk.dealer_id <> hub.entity_id)"""


@query(
    "d13_match_log",
    f"""WITH {PHONE_EDGES} SELECT entity_id, substr(md5('city=' || city || '|dealer_id=' || dealer_id || '|name=' || name ||
        '|state=' || state), 1, 16) AS record_hash, 'phone' AS match_type, phone_key AS match_value,
        1.0::DOUBLE AS confidence, 'directory' AS source_file FROM e""",
)
def d13(t):
    rows = keyed_dealers(t).where("phone_key IS NOT NULL")
    hubs = rows.groupBy("phone_key").agg(F.min("dealer_id").alias("entity_id"))
    from ..operators.skew import lookup_join

    edges = lookup_join(rows, hubs, "phone_key", "dealer_id").where("dealer_id <> entity_id").select(
        "*", F.lit("phone").alias("match_type"), F.col("phone_key").alias("match_value")
    )
    return keyed.match_log(
        edges, text.fingerprint(["dealer_id", "name", "city", "state"]), "directory"
    )


def _report_sql(by: str) -> str:
    return f"""WITH {DK}, m AS (SELECT {by}, phone_key IS NOT NULL AND row_number() OVER (PARTITION BY phone_key
        ORDER BY dealer_id) > 1 AS later FROM dk) SELECT {by}, count(*) AS raw, count(*) FILTER (NOT later)
        AS unique_rows, count(*) FILTER (later) AS removed, {duck.percent('count(*) FILTER (later)', 'count(*)')}
        AS removed_pct FROM m GROUP BY {by}"""


@query("d14_report_by_state", _report_sql("state"))
def d14(t):
    return keyed.dedup_report(keyed_dealers(t), "phone_key", "dealer_id", "state")


@query("d14b_report_by_tier", _report_sql("tier"))
def d14b(t):
    return keyed.dedup_report(keyed_dealers(t), "phone_key", "dealer_id", "tier")


@query(
    "d14c_most_repeated",
    f"""WITH {DK} SELECT phone_key, count(*) AS rows, min_by(name, dealer_id) AS first_name FROM dk
        WHERE phone_key IS NOT NULL GROUP BY phone_key HAVING count(*) > 1 ORDER BY rows DESC, phone_key LIMIT 20""",
)
def d14c(t):
    return keyed.most_repeated(keyed_dealers(t), "phone_key", "dealer_id", "name")


@query(
    "d15_dedup_stats",
    COMPONENTS + f""", g AS (SELECT component, count(*) AS n, count(DISTINCT source_file) AS sources,
        count(email_key) AS emails, count(phone_key) AS phones FROM comp JOIN nk USING (dealer_id) GROUP BY component)
        SELECT CAST(sum(n) AS BIGINT) AS total_input, count(*) AS unique_records,
        CAST(sum(n) AS BIGINT) - count(*) AS duplicates_removed,
        {duck.percent('CAST(sum(n) AS BIGINT) - count(*)', 'CAST(sum(n) AS BIGINT)')} AS dedup_rate,
        count(*) FILTER (sources > 1) AS multi_source, count(*) FILTER (emails > 0) AS with_email,
        count(*) FILTER (phones > 0) AS with_phone FROM g""",
)
def d15(t):
    from ..functions.scores import percent

    rows, members = exact_members(t)
    found = cluster.connected_components(rows, cluster.key_links(cut_lineage(members)))
    extra = keyed_dealers(t, "source_file").select(
        F.col("dealer_id").alias("id"), "source_file", "email_key", "phone_key"
    )
    groups = found.join(extra, "id").groupBy("component").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("source_file").alias("sources"),
        F.count("email_key").alias("emails"),
        F.count("phone_key").alias("phones"),
    )
    total, unique = F.sum("n"), F.count(F.lit(1))
    return groups.agg(
        total.alias("total_input"),
        unique.alias("unique_records"),
        (total - unique).alias("duplicates_removed"),
        percent(total - unique, total).alias("dedup_rate"),
        F.count_if(F.col("sources") > 1).alias("multi_source"),
        F.count_if(F.col("emails") > 0).alias("with_email"),
        F.count_if(F.col("phones") > 0).alias("with_phone"),
    )


@query(
    "d16_new_children",
    """WITH cand AS (SELECT DISTINCT ON (contractor_id, brand) cert_id, contractor_id, brand FROM certifications
         ORDER BY contractor_id, brand, cert_id),
       have AS (SELECT contractor_id, license_category FROM licenses)
       SELECT cert_id, contractor_id, brand FROM cand c WHERE NOT EXISTS (SELECT 1 FROM certifications x
         WHERE x.contractor_id = c.contractor_id AND x.brand = c.brand AND x.certification_tier = 'Premier')""",
)
def d16(t):
    certs = t.certifications.select("cert_id", "contractor_id", "brand", "certification_tier")
    existing = certs.where("certification_tier = 'Premier'")
    return keyed.new_children(
        certs.drop("certification_tier"), existing, ["contractor_id", "brand"], "cert_id"
    )


# --- windows, top-k, sorts --------------------------------------------------------------


@query(
    "w01_first_per_domain",
    f"WITH {DK} SELECT dealer_id, domain_key FROM dk WHERE domain_key IS NOT NULL {FIRST.format('domain_key')}",
)
def w01(t):
    rows = keyed_dealers(t).select("dealer_id", "domain_key")
    return keyed.first_per_key(rows, ["domain_key"], "dealer_id")


@query(
    "w02_best_per_state",
    """SELECT state, id, company_name, lead_score FROM contractors
       QUALIFY row_number() OVER (PARTITION BY state ORDER BY lead_score DESC, id) = 1""",
)
def w02(t):
    best = F.max_by(
        F.struct("id", "company_name", "lead_score"), F.struct("lead_score", -F.col("id"))
    )
    return t.contractors.groupBy("state").agg(best.alias("b")).select("state", "b.*")


@query(
    "w03_top_prospects",
    "SELECT id, company_name, lead_score FROM contractors ORDER BY lead_score DESC, id LIMIT 200",
)
def w03(t):
    rows = t.contractors.select("id", "company_name", "lead_score")
    return numbering.top_n(rows, 200, F.desc("lead_score"), F.asc("id"))


@query(
    "w04_top_rated",
    """SELECT dealer_id, rating, review_count FROM dealers WHERE review_count >= 5
       ORDER BY rating DESC, dealer_id LIMIT 10""",
)
def w04(t):
    rows = t.dealers.where("review_count >= 5").select("dealer_id", "rating", "review_count")
    return numbering.top_n(rows, 10, F.desc("rating"), F.asc("dealer_id"))


@query(
    "w05_sort_nulls_last",
    """SELECT id, primary_phone, lead_score FROM contractors
       ORDER BY lead_score DESC NULLS LAST, primary_phone ASC NULLS LAST, id""",
)
def w05(t):
    return t.contractors.select("id", "primary_phone", "lead_score").orderBy(
        F.desc_nulls_last("lead_score"), F.asc_nulls_last("primary_phone"), "id"
    )


@query(
    "w06_stage_order",
    """SELECT stage, CASE stage WHEN 'RAW_LEAD' THEN 1 WHEN 'ENRICHED' THEN 2 WHEN 'CONTACTED' THEN 3
       WHEN 'RESPONDED' THEN 4 WHEN 'DEMO_SET' THEN 5 WHEN 'OPPORTUNITY' THEN 6 WHEN 'CLOSED_WON' THEN 7
       WHEN 'CLOSED_LOST' THEN 8 ELSE 9 END AS position, count(*) AS leads FROM attribution GROUP BY 1, 2
       ORDER BY 2""",
)
def w06(t):
    from ..operators.funnel import stage_position

    return (
        t.attribution.groupBy("stage")
        .agg(F.count(F.lit(1)).alias("leads"))
        .withColumn("position", stage_position("stage"))
        .orderBy("position")
    )


@query(
    "w07_row_number",
    "SELECT dealer_id, name, row_number() OVER (ORDER BY dealer_id) AS row_number FROM dealers",
)
def w07(t):
    return numbering.number_rows(t.dealers.select("dealer_id", "name"), "dealer_id")


@query(
    "w08_quality_rank",
    """SELECT id, CASE WHEN primary_phone IS NOT NULL AND primary_email IS NOT NULL THEN 3
       WHEN primary_phone IS NOT NULL THEN 2 WHEN primary_email IS NOT NULL THEN 1 ELSE 0 END AS quality_rank,
       lead_score FROM contractors ORDER BY 2 DESC, 3 DESC, 1""",
)
def w08(t):
    from ..operators.scoring import contact_quality_rank

    return t.contractors.select(
        "id", contact_quality_rank("primary_phone", "primary_email").alias("quality_rank"), "lead_score"
    ).orderBy(F.desc("quality_rank"), F.desc("lead_score"), "id")


@query(
    "w09_quota_per_state",
    """WITH q AS (SELECT state, CASE WHEN count(*) > 60 THEN 10 ELSE 6 END AS quota FROM contractors GROUP BY state)
       SELECT c.state, c.id, row_number() OVER (PARTITION BY c.state ORDER BY c.id) AS rank_in_group
       FROM contractors c JOIN q USING (state) QUALIFY rank_in_group <= quota""",
)
def w09(t):
    sizes = t.contractors.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    quotas = sizes.select("state", F.when(F.col("n") > 60, 10).otherwise(6).alias("quota"))
    picked = numbering.quota_per_group(t.contractors.select("state", "id"), quotas, "state", "id", 10)
    return picked.select("state", "id", F.col("rank_in_group").cast("long").alias("rank_in_group"))


# --- set operations -------------------------------------------------------------------------


@query(
    "u01_stack_sources",
    """SELECT 'dealer' AS kind, name, city, state, brand, NULL::BIGINT AS kw_installed FROM dealers UNION ALL
       SELECT 'ranking', company_name, NULL, headquarters_state, NULL, kw_installed FROM rankings""",
)
def u01(t):
    left = t.dealers.select(F.lit("dealer").alias("kind"), "name", "city", "state", "brand")
    right = t.rankings.select(
        F.lit("ranking").alias("kind"), F.col("company_name").alias("name"),
        F.col("headquarters_state").alias("state"), "kw_installed",
    )
    return left.unionByName(right, allowMissingColumns=True)


@query(
    "u02_common_names",
    f"""SELECT {duck.company_key('name')} AS name_key FROM dealers INTERSECT
        SELECT {duck.company_key('company_name')} FROM rankings""",
)
def u02(t):
    return t.dealers.select(names.company_key("name").alias("name_key")).intersect(
        t.rankings.select(names.company_key("company_name").alias("name_key"))
    )


@query(
    "u03_common_phones",
    f"""SELECT {duck.phone10('phone')} AS phone FROM dealers WHERE {duck.phone10('phone')} IS NOT NULL INTERSECT
        SELECT {duck.phone10('business_phone')} FROM registry""",
)
def u03(t):
    left = t.dealers.select(phones.phone10("phone").alias("phone")).where("phone IS NOT NULL")
    return left.intersect(t.registry.select(phones.phone10("business_phone").alias("phone")))


@query(
    "u04_remaining_work",
    """SELECT DISTINCT scraped_from_zip AS zip FROM certifications EXCEPT
       SELECT scraped_from_zip FROM dealers WHERE brand = 'Tesla'""",
)
def u04(t):
    done = t.dealers.where("brand = 'Tesla'").select(F.col("scraped_from_zip").alias("zip"))
    todo = t.certifications.select(F.col("scraped_from_zip").alias("zip")).distinct()
    return todo.join(done, "zip", "left_anti")


@query(
    "u05_gold_and_best_silver",
    f"""WITH s AS (SELECT id, lead_score, {duck.tier('lead_score')} AS icp_tier FROM contractors)
        SELECT * FROM s WHERE icp_tier = 'GOLD' UNION ALL
        SELECT * FROM (SELECT * FROM s WHERE icp_tier = 'SILVER' ORDER BY lead_score DESC, id LIMIT 150)""",
)
def u05(t):
    from ..functions.scores import tier_of

    scored = t.contractors.select("id", "lead_score", tier_of(F.col("lead_score")).alias("icp_tier"))
    silver = numbering.top_n(
        scored.where("icp_tier = 'SILVER'"), 150, F.desc("lead_score"), F.asc("id")
    )
    return scored.where("icp_tier = 'GOLD'").unionByName(silver)
