"""Priority match, upsert and enrichment on small cases."""

import pytest
from pyspark.sql import functions as F

from entitymill.functions import domains, names, phones
from entitymill.operators import enrich, linkage, marts
from entitymill.operators.upsert import upsert

RECORD = "record_id LONG, company_name STRING, contact_name STRING, email STRING, phone STRING, state STRING, city STRING, zip STRING, license_type STRING, license_category STRING, license_number STRING"
ENTITY = "entity_id LONG, company_name STRING, phone STRING, email STRING, domain STRING, state STRING"


def prepared(df):
    return df.withColumns({
        "phone": phones.phone10("phone"), "domain": domains.email_domain("email"),
        "email": domains.email_key("email"), "name_key": names.company_key("company_name"),
    })


def record(spark, rows):
    return prepared(spark.createDataFrame(rows, RECORD))


def entities(spark, rows=()):
    return spark.createDataFrame(list(rows), ENTITY).withColumn("name_key", names.company_key("company_name"))


def contacts(spark, rows=()):
    return spark.createDataFrame(list(rows), "contact_id LONG, entity_id LONG, phone STRING, email STRING")


KNOWN = [
    (1, "Sunny Solar LLC", "3055551000", "info@sunny.com", "sunny.com", "FL"),
    (2, "Bright Heating", None, None, "bright.com", "FL"),
    (3, "Gulf Plumbing Partners", None, "boss@gmail.com", None, "FL"),
]

CASES = [
    ("phone", "Other Name", None, "(305) 555-1000", "TX", (1, "phone")),
    ("contact phone", "Other Name", None, "305-555-7777", "TX", (2, "phone")),
    ("phone before email", "x", "boss@gmail.com", "305-555-1000", "FL", (1, "phone")),
    ("email", "Other", "BOSS@gmail.com ", None, "TX", (3, "email")),
    ("contact email", "Other", "two@mail.org", None, "TX", (2, "email")),
    ("domain with similar name", "Bright Heating & Air", "joe@bright.com", None, "TX", (2, "domain")),
    ("domain with other name", "Zzyzx", "joe@bright.com", None, "TX", None),
    ("webmail is no domain", "Zzyzx", "other@gmail.com", None, "FL", None),
    ("similar name in the state", "Gulf Plumbing Partner", None, None, "FL", (3, "fuzzy_name")),
    ("similar name in another state", "Gulf Plumbing Partner", None, None, "GA", None),
    ("other first letters", "The Gulf Plumbing Partners", None, None, "FL", (3, "fuzzy_name")),
]


def test_priority_match(spark):
    rows = [(i, c[1], None, c[2], c[3], c[4], None, None, None, None, None) for i, c in enumerate(CASES)]
    known_contacts = [(10, 2, "3055557777", None), (11, 2, None, "two@mail.org")]
    got = linkage.match_records(record(spark, rows), entities(spark, KNOWN), contacts(spark, known_contacts))
    found = {r.record_id: (r.entity_id, r.match_type) for r in got.collect()}
    for i, case in enumerate(CASES):
        assert found.get(i) == case[5], case[0]
    finer = F.concat("state", F.lit("|"), F.left("name_key", F.lit(3)))
    got = linkage.match_records(record(spark, rows), entities(spark, KNOWN), contacts(spark, known_contacts), finer)
    assert len(CASES) - 1 not in {r.record_id for r in got.collect()}


def test_upsert_end_to_end(spark):
    """Three records share a phone, one is another company: 2 new, 2 merged, 3 categories."""
    rows = [
        (1, "ABC Contractors LLC", "Ann", "ann@abc.com", "305-555-1000", "FL", "Miami", "33101", "CAC", "HVAC", "1"),
        (2, "ABC Contractors LLC", "Ann", "ann@abc.com", "(305) 555-1000", "FL", "Miami", "33101", "CPC", "PLUMBING", "2"),
        (3, "ABC Contractors Inc", "Bob", "bob@abc.com", "1-305-555-1000", "FL", "Miami", "33101", "CFC", "FIRE", "3"),
        (4, "XYZ Roofing", "Cy", "cy@xyz.com", "407-555-2000", "FL", "Orlando", "32801", "CCC", "ROOFING", "4"),
    ]
    none = spark.createDataFrame([], "entity_id LONG, state STRING, license_type STRING, license_number STRING")
    done = upsert(record(spark, rows), entities(spark), contacts(spark), none)
    kinds = {r.record_id: (r.entity_id, r.is_new) for r in done.assignments.collect()}
    assert [kinds[i][1] for i in (1, 2, 3, 4)] == [True, False, False, True]
    assert kinds[1][0] == kinds[2][0] == kinds[3][0] != kinds[4][0]
    assert done.entities.count() == 2
    counts = done.licences.groupBy("entity_id").agg(F.countDistinct("license_category").alias("n"))
    assert sorted(r.n for r in counts.collect()) == [1, 3]
    mails = {(r.email, r.confidence) for r in done.contacts.collect()}
    assert mails == {("ann@abc.com", 80), ("bob@abc.com", 70), ("cy@xyz.com", 80)}

    # loading the same batch again adds nothing
    known = entities(spark).unionByName(done.entities.select(
        "entity_id", "company_name", "phone", "email", "domain", "state", "name_key"
    ))
    held = contacts(spark).unionByName(done.contacts.select(
        F.col("record_id").alias("contact_id"), "entity_id", "phone", "email"
    ))
    licences = done.licences.select("entity_id", "state", "license_type", "license_number")
    again = upsert(record(spark, rows), known, held, licences)
    assert again.entities.count() == 0 and again.licences.count() == 0 and again.contacts.count() == 0


def test_nameless_records_stay_apart(spark):
    rows = [
        (1, None, "Ann", "ann@gmail.com", None, "FL", None, None, "CAC", "HVAC", "1"),
        (2, None, "Bob", "bob@gmail.com", None, "FL", None, None, "CAC", "HVAC", "2"),
        (3, "Acme", "Cy", None, None, None, None, None, None, None, None),
        (4, "Acme", "Di", None, None, None, None, None, None, None, None),
    ]
    none = spark.createDataFrame([], "entity_id LONG, state STRING, license_type STRING, license_number STRING")
    done = upsert(record(spark, rows), entities(spark), contacts(spark), none)
    assert done.assignments.select("entity_id").distinct().count() == 4


def test_exact_match_takes_row_zero(spark):
    dealers = spark.createDataFrame([(5, "2145550100", None), (6, None, "a.com"), (7, None, None)], "dealer_id LONG, phone_key STRING, domain_key STRING")
    held = spark.createDataFrame([(0, "2145550100", "a.com"), (1, "2145550100", None)], "pos LONG, phone_key STRING, domain_key STRING")
    got = {r.dealer_id: (r.license_id, r.match_method, r.match_confidence) for r in enrich.dealer_licences(dealers, held).collect()}
    assert got == {5: (0, "phone", 100), 6: (0, "domain", 90)}


def test_best_name_in_city_or_zip(spark):
    dealers = spark.createDataFrame([(1, "c:A", "SMITH HEATING"), (1, "z:1", "SMITH HEATING"), (2, "c:B", "SMITH HEATING")], "record_id LONG, block STRING, name STRING")
    held = spark.createDataFrame([(9, "c:A", "SMITH HEATINGS"), (8, "z:1", "SMITH HEATING"), (7, "z:1", "SMITH HEATING")], "entity_id LONG, block STRING, name STRING")
    got = [tuple(r) for r in linkage.fuzzy_best(dealers, held, 0.85).collect()]
    assert got == [(1, 7, 100.0)]


def test_nested_children_are_cut_into_parts(spark):
    owners = spark.createDataFrame([(1, "a"), (2, "b")], "entity_id LONG, company_name STRING")
    items = spark.range(50).select(F.lit(1).cast("long").alias("entity_id"), F.col("id").cast("string").alias("item"))
    rows = enrich.nested_children(owners, {"items": items}, chunk=10).collect()
    assert sorted(int(x) for r in rows if r["items"] for x in r["items"].split(";")) == list(range(50))
    assert sum(r.entity_id == 1 for r in rows) > 1
    assert [(r.part, r["items"]) for r in rows if r.entity_id == 2] == [(0, "")]


def test_rank_links_need_the_state_only_if_known(spark):
    ranks = spark.createDataFrame([(1, "acme", "TX"), (2, "acme", None), (3, "acme", "CA")], "ranking_id LONG, name_key STRING, headquarters_state STRING")
    known = spark.createDataFrame([(4, "acme", "FL"), (5, "acme", "TX")], "entity_id LONG, name_key STRING, state STRING")
    assert {r.ranking_id: r.entity_id for r in enrich.rank_links(ranks, known).collect()} == {1: 5, 2: 4, 3: None}


def test_pairs_refuse_low_thresholds(spark):
    df = spark.createDataFrame([("b", "x")], "block STRING, name STRING")
    with pytest.raises(ValueError):
        linkage.candidate_pairs(df, df, 0.5)


def test_source_type_turns_to_both_once(spark):
    rows = spark.createDataFrame([(1, "state_license"), (2, "oem_dealer"), (3, "state_license")], "id LONG, source_type STRING")
    hits = spark.createDataFrame([(1,), (1,), (2,)], "entity_id LONG")
    got = {r.id: r.source_type for r in linkage.with_source_type(rows, hits).collect()}
    assert got == {1: "both", 2: "oem_dealer", 3: "state_license"}
    change = {r.source_type: r.change for r in marts.before_after(rows, linkage.with_source_type(rows, hits)).collect()}
    assert change == {"state_license": -1, "both": 1, "oem_dealer": 0}
