"""Golden values of the scalar normalisers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from entitymill.functions import domains, licences, names, phones, places, scores, text
from entitymill.functions.similarity import block_ratio, indel_ratio


def apply(spark, fn, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r.r for r in rows.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


GOLDEN = [
    (phones.phone10, {
        "+1 555-123-4567": "5551234567", "(555) 123-4567": "5551234567", "123": None,
        "abcdefghij": None, "1-555-123-4567": "5551234567", None: None, "25551234567": None,
    }),
    (phones.phone10_without_extension, {
        "323-555-1234 ext 123": "3235551234", "323-555-1234x456": "3235551234",
        "+1-323-555-1234": "3235551234", "invalid": None,
    }),
    (phones.last10, {"+1 (555) 123-4567": "5551234567", "555-01": "55501", "": None}),
    (phones.digits, {"(555) 12": "55512", "none": None}),
    (lambda c: phones.is_toll_free(phones.phone10(c)), {"800-555-0100": True, "214-555-0100": False, None: False}),
    (lambda c: phones.display(phones.local_phone10(c)), {"2145550100": "(214) 555-0100", "8885550100": None}),
    (lambda c: phones.e164(phones.phone10(c)), {"2145550100": "+12145550100", "5": None}),
    (domains.email_key, {"  test@test.com  ": "test@test.com", "John@Example.COM": "john@example.com", " ": None}),
    (domains.email_domain, {
        "john@company.com": "company.com", "john@gmail.com": None, "nobody": None,
        " a@B.org\t": "b.org", None: None,
    }),
    (domains.url_host, {
        "https://www.example.com/path": "example.com", "shop.example.com": "shop.example.com",
        "not a domain": None, "EXAMPLE.com?x=1": "example.com", "": None,
    }),
    (domains.root_domain, {
        "https://www.example.com": "example.com", "http://sub.example.com:80/x": "example.com",
        "localhost": "localhost", "": None,
    }),
    (domains.loose_domain, {"http://www.Example.com:80/p": "example.com", "": None}),
    (names.company_key, {
        "ABC Solar LLC": "abc solar", "XYZ Inc.": "xyz", "Test Company, LLC": "test",
        "  ABC  DEF  ": "abc def", "Café Élan Co.": "café élan", "LLC": "llc", "": None, "\tA\n": "a",
    }),
    (names.company_key_upper, {"Smith's, Inc.": "SMITH'S,", "Foo DBA Bar LLC": "FOO BAR", "A.B. Corp": "A.B."}),
    (names.company_key_trade, {"Sun Solar LLC": "sun", "Sun Solar": "sun", "Best HVAC Services": "best hvac"}),
    (names.company_key_anchored, {"TRI-STATE POWER & PUMP LLC": "tri-state power & pump", "A Co Inc": "a"}),
    (names.company_key_cut_anywhere, {"Gulf Coastal LLC": "gulfastal"}),
    (names.is_business_name, {"Pat Smith": False, "Smith Electric": True, None: False}),
    (places.state2, {"florida": "FL", "": None}),
    (places.zip5, {"12345-6789": "12345"}),
    (lambda c: places.city_state_zip(c)["zip"], {"HOUSTON, TX 77002": "77002", "HOUSTON, TX": None}),
    (lambda c: places.city_state_zip(c)["city"], {"HOUSTON, TX 77002": "HOUSTON", "HOUSTON": "HOUSTON", "": None}),
    (places.lenient_date, {
        "2020-02-29": dt.date(2020, 2, 29), "12/31/2024": dt.date(2024, 12, 31), "not a date": None,
    }),
    (lambda c: licences.category_of(F.lit("CA"), c), {"C-10": "ELECTRICAL", "B": None}),
    (lambda c: F.array_join(text.split_list(c, "|"), ";"), {"A| B| C10": "A;B;C10", "": ""}),
]


@pytest.mark.parametrize("case", range(len(GOLDEN)))
def test_golden(spark, case):
    fn, table = GOLDEN[case]
    assert apply(spark, fn, list(table)) == list(table.values())


def test_ratios(spark):
    pairs = spark.createDataFrame(
        [("abc solar", "abc solar"), ("abcd", "bcde"), ("", "x"), (None, "x"), ("tide", "diet")], "a STRING, b STRING"
    )
    got = pairs.select(
        block_ratio(F.col("a"), F.col("b")).alias("m"), indel_ratio(F.col("a"), F.col("b")).alias("i")
    ).collect()
    assert [r.m for r in got] == [1.0, 0.75, 0.0, 0.0, 0.25]
    assert [r.i for r in got] == [100.0, 75.0, 0.0, 0.0, 50.0]


def test_same_company_has_ratio_one(spark):
    row = spark.createDataFrame([("ABC Solar LLC", "ABC Solar Inc")], "a STRING, b STRING")
    key = lambda c: names.company_key(c)
    assert row.select(block_ratio(key("a"), key("b")).alias("r")).first().r == 1.0


def test_rounding_and_tiers(spark):
    rows = spark.createDataFrame([(1, 3, 80), (2, 3, 60), (5, 1000, 40), (0, 0, 39)], "a LONG, b LONG, s INT")
    got = rows.select(scores.percent(F.col("a"), F.col("b")).alias("p"), scores.tier_of(F.col("s")).alias("t")).collect()
    assert [r.p for r in got] == [33.3, 66.7, 0.5, None]
    assert [r.t for r in got] == ["PLATINUM", "GOLD", "SILVER", "BRONZE"]
