"""Golden values per brand: flags and product sets of one directory row."""

import pytest
from pyspark.sql import functions as F

from entitymill.operators import capabilities, marts

ROW = "i INT, brand STRING, name STRING, tier STRING, certifications STRING, rating DOUBLE, review_count INT"
SHORT = {"generator_oems": "g", "battery_oems": "b", "inverter_oems": "i"}
# brand, tier, certifications; certified brands; product sets (g, b, i) by letter; maintenance
CASES = [
    ("Generac", "Elite", "", ["Generac"], {"b": ["Generac"]}, False),
    ("Generac", "Standard", "", ["Generac"], {}, False),
    ("Generac", "Standard", "PowerPro Premier", ["Generac"], {"b": ["Generac"]}, False),
    ("Briggs & Stratton", "Standard", "Standby Generators", ["Briggs & Stratton"], {"g": ["Briggs & Stratton"]}, False),
    ("Briggs & Stratton", "Elite IQ", "", ["Briggs & Stratton"], {"b": ["Briggs & Stratton"]}, False),
    ("Cummins", "Standard", "", ["Cummins"], {"g": ["Cummins"]}, False),
    ("Kohler", "Gold", "", ["Kohler"], {"g": ["Kohler"]}, False),
    ("Tesla", "Standard", "", ["Tesla"], {"b": ["Tesla"], "i": ["Tesla"]}, False),
    ("Enphase", "Gold", "Storage,O&M", ["Enphase"], {"b": ["Enphase"], "i": ["Enphase"]}, True),
    ("Enphase", "Gold", "", ["Enphase"], {"i": ["Enphase"]}, False),
    ("SolarEdge", "Gold", "O&M", ["SolarEdge"], {"i": ["SolarEdge"]}, False),
    ("SMA", "Standard", "Hybrid Battery", ["SMA"], {"i": ["SMA"]}, False),
    ("Fronius", "Standard", "Battery Storage", ["Fronius"], {"b": ["Fronius"], "i": ["Fronius"]}, False),
    ("Sol-Ark", "Standard", "", ["Sol-Ark"], {"b": ["Sol-Ark"], "i": ["Sol-Ark"]}, False),
    ("SimpliPhi", "Standard", "Generators", ["Briggs & Stratton", "SimpliPhi"], {"b": ["SimpliPhi"]}, False),
    ("SimpliPhi", "Standard", "", ["SimpliPhi"], {"b": ["SimpliPhi"]}, False),
    ("Mitsubishi", "Diamond", "", ["Mitsubishi Electric"], {}, False),
    ("Tigo", "Standard", "Battery", ["Tigo Energy"], {"i": ["Tigo Energy"]}, False),
    ("Sungrow", "Standard", "Hybrid", ["Sungrow"], {"b": ["Sungrow"], "i": ["Sungrow"]}, False),
    ("Sungrow", "Standard", "", ["Sungrow"], {"i": ["Sungrow"]}, False),
    ("GoodWe", "Gold", "", ["GoodWe"], {"b": ["GoodWe"], "i": ["GoodWe"]}, False),
    ("Growatt", "Standard", "off-grid", ["Growatt"], {"b": ["Growatt"], "i": ["Growatt"]}, False),
    ("Carrier", "Standard", "", ["Carrier"], {}, False),
    ("Honeywell Home", "Standard", "", ["Honeywell Home"], {}, False),
    ("Johnson Controls", "Standard", "", ["Johnson Controls"], {}, False),
    ("Sensi", "Standard", "", ["Sensi"], {}, False),
    ("Schneider Electric", "Standard", "Battery", ["Schneider Electric"], {}, False),
    ("Unlisted", "Standard", "Storage", [], {}, False),
    (None, None, None, [], {}, False),
]
# brand, name, tier, certifications, rating, reviews: the flags that must be set, and no others
FLAG_CASES = [
    ("Honeywell Home", "Ace Heating", "", "Humidifier", 0.0, 0,
     {"has_hvac", "has_electrical", "has_plumbing", "is_commercial"}),
    ("Honeywell Home", "Ace", "", "", 0.0, 0, {"has_hvac", "has_electrical", "is_residential"}),
    ("Johnson Controls", "Home Air", "", "", 0.0, 0, {"has_hvac", "has_electrical", "is_commercial", "is_residential"}),
    ("Sensi", "Ace", "", "Water", 0.0, 0, {"has_hvac", "has_electrical", "has_plumbing", "is_residential"}),
    ("Sungrow", "Ace", "", "Commercial,Energy Storage", 0.0, 0,
     {"has_inverters", "has_solar", "has_electrical", "has_battery", "is_commercial"}),
    ("GoodWe", "Ace", "Gold", "", 0.0, 0,
     {"has_inverters", "has_solar", "has_electrical", "has_battery", "is_residential", "is_commercial"}),
    ("Growatt", "Ace", "", "MAX Series", 0.0, 0, {"has_inverters", "has_solar", "has_electrical", "is_commercial"}),
    ("Growatt", "Ace", "", "", 0.0, 0, {"has_inverters", "has_solar", "has_electrical", "is_residential"}),
    ("Generac", "Ace", "Elite", "", 0.0, 0,
     {"has_generator", "has_electrical", "has_battery", "is_residential", "is_commercial"}),
    ("Cummins", "Ace", "Standard", "", 0.0, 0, {"has_generator", "has_electrical"}),
    ("Trane", "Ace Roofing", "", "", 5.0, 60, {"has_hvac", "has_roofing", "is_commercial"}),
    (None, None, None, None, None, None, set()),
]


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [(i, c[0], "Ace", c[1], c[2], 0.0, 0) for i, c in enumerate(CASES)]
    return capabilities.directory_flags(spark.createDataFrame(rows, ROW))


def test_product_sets_of_every_brand(flagged):
    for r in capabilities.brand_sets(flagged).orderBy("i").collect():
        _, _, _, certified, sets, maintenance = CASES[r.i]
        assert (r.oem_certifications, r.microinverter_oems, r.has_ops_maintenance) == (certified, [], maintenance), CASES[r.i]
        assert {k: r[c] for c, k in SHORT.items() if r[c]} == sets, CASES[r.i]


def test_sets_of_an_entity_are_the_union(flagged):
    rows = capabilities.brand_sets(flagged.where("i IN (2, 3, 8, 14)")).withColumn("entity", F.lit("x"))
    none = rows.withColumn("entity", F.lit(None).cast("string"))
    got = capabilities.brand_sets_per_entity(rows.unionAll(rows).unionAll(none), "entity").collect()
    assert len(got) == 1 and got[0].has_ops_maintenance
    assert got[0].oem_certifications == ["Briggs & Stratton", "Enphase", "Generac", "SimpliPhi"]
    assert got[0].battery_oems == ["Enphase", "Generac", "SimpliPhi"]
    assert got[0].generator_oems == ["Briggs & Stratton"] and got[0].inverter_oems == ["Enphase"]


def test_flags_of_a_brand(spark):
    rows = [(i, *c[:2], *c[2:6]) for i, c in enumerate(FLAG_CASES)]
    for r in capabilities.directory_flags(spark.createDataFrame(rows, ROW)).collect():
        assert {f for f in capabilities.FLAGS if r[f]} == FLAG_CASES[r.i][6], FLAG_CASES[r.i]


def test_multi_licence_holders_list_all_they_hold(spark):
    columns = "company_name STRING, contact_name STRING, address STRING, city STRING, state STRING, zip STRING, email STRING, license_type STRING, license_category STRING"
    rows = [("Ace", n, a, "Tampa", "FL", "1", m, k, k.title()) for n, a, m, k in [
        ("D", "9 Oak", "a@x.y", "CAC"), ("C", "2 Elm", "A@x.y", "CFC"), ("B", "2 Elm", None, "CAC"), ("A", "3 Fir", "b@x.y", "CAC"),
        (None, None, None, "CFC")]]
    rows += [("One", "E", "1 Ash", "Miami", "FL", "2", None, "CAC", "Cac"), (None, "F", None, None, None, None, None, "CFC", "Cfc")]
    got = marts.multi_licence_by(spark.createDataFrame(rows, columns), F.col("company_name")).collect()
    assert len(got) == 1
    assert got[0].asDict() == {
        "key": "Ace", "category_count": 2, "categories": "Cac, Cfc", "types": "CAC, CFC", "emails": "A@X.Y, B@X.Y",
        "companies": "Ace", "address": "2 Elm, Tampa, FL, 1", "first_names": "A; B; C"}
