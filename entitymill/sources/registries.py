"""Registry extracts conformed to one licensee schema, and the bulk loaders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.licences import class_codes, type_name
from ..functions.places import city_state_zip, lenient_date
from ..functions.text import clean, first_filled, lookup
from ..functions.phones import phone10

LICENSEE = [
    "licensee_name", "license_number", "license_type", "license_status", "city", "state",
    "zip", "source_state", "source_tier", "business_name", "issue_date",
    "original_issue_date", "expiration_date", "phone", "email", "street", "county",
]


def _licensee(df: DataFrame, source_state: str, values: dict[str, Column]) -> DataFrame:
    values = {
        "source_state": F.lit(source_state),
        "source_tier": F.lit("BULK"),
        **values,
    }
    dates = {"issue_date", "original_issue_date", "expiration_date"}
    return df.select(
        *[
            values.get(c, F.lit(None)).cast("date" if c in dates else "string").alias(c)
            for c in LICENSEE
        ]
    )


def california(df: DataFrame) -> DataFrame:
    return _licensee(df, "CA", {
        "licensee_name": clean("Business Name"), "business_name": clean("Business Name"),
        "license_number": clean("License Number"),
        "license_type": type_name("CA", "License Type"),
        "license_status": clean("License Status"), "city": clean("City"),
        "state": F.coalesce(clean("State"), F.lit("CA")), "zip": clean("ZIP Code"),
        "issue_date": lenient_date("Issue Date"),
        "expiration_date": lenient_date("Expiration Date"),
        "phone": clean("Business Phone"), "email": clean("Email"),
        "street": clean("Business Address"), "county": clean("County"),
    })


def florida(df: DataFrame) -> DataFrame:
    return _licensee(df, "FL", {
        "licensee_name": clean("Name"), "business_name": clean("Name"),
        "license_number": clean("License Number"),
        "license_type": type_name("FL", "License Type"),
        "license_status": clean("Primary Status"), "city": clean("City"),
        "state": F.coalesce(clean("State"), F.lit("FL")), "zip": clean("Zip Code"),
        "original_issue_date": lenient_date("Original License Date"),
        "expiration_date": lenient_date("Expiration Date"),
        "phone": clean("Phone"), "email": clean("Email"),
        "street": clean("Address Line 1"), "county": clean("County"),
    })


def texas(df: DataFrame) -> DataFrame:
    """The business name, phone and county win over the personal ones; the file lists live ones only."""
    pattern = r"^(.*?),\s*([A-Z]{2})\s+([0-9]{5}(?:-[0-9]{4})?)$"
    place = F.col("BUSINESS CITY, STATE ZIP")

    def part(i: int) -> Column:
        return clean(F.regexp_extract(place, pattern, i))

    name = first_filled("BUSINESS NAME", "NAME")
    return _licensee(df, "TX", {
        "licensee_name": name, "business_name": name,
        "license_number": clean("LICENSE NUMBER"),
        "license_type": type_name("TX", "LICENSE TYPE"), "license_status": F.lit("Active"),
        "city": part(1), "state": F.coalesce(part(2), F.lit("TX")),
        "zip": F.coalesce(part(3), clean("BUSINESS ZIP")),
        "expiration_date": lenient_date("LICENSE EXPIRATION DATE"),
        "phone": first_filled("BUSINESS PHONE", "PHONE NUMBER"),
        "street": clean(
            F.concat_ws(" ", clean("BUSINESS ADDRESS-LINE1"), clean("BUSINESS ADDRESS-LINE2"))
        ),
        "county": first_filled("BUSINESS COUNTY", "COUNTY"),
    })


PARSERS = {"CA": california, "FL": florida, "TX": texas}

# --- bulk loaders: rows in scope for the master table ------------------------------------

RECORD = [
    "company_name", "contact_name", "address", "city", "state", "zip", "phone", "email",
    "license_type", "license_category", "license_number", "source",
]


def _record(df: DataFrame, source: str, values: dict[str, Column]) -> DataFrame:
    """The record columns, with row_no (and class_no after an explode) where the extract has them."""
    values = {**values, "source": F.lit(source)}
    place = [c for c in ("row_no", "class_no") if c in df.columns]
    return df.select(
        *[values.get(c, F.lit(None)).cast("string").alias(c) for c in RECORD], *place
    )


def load_florida(df: DataFrame) -> DataFrame:
    code = F.upper(clean("license_type"))
    table = fixed.LICENCE_CATEGORIES["FL"]
    return _record(df, "FL_License", {
        "company_name": first_filled("company", "name"), "contact_name": clean("name"),
        "address": clean("address"), "city": clean("city"),
        "state": F.coalesce(F.upper(clean("state")), F.lit("FL")), "zip": clean("zip"),
        "email": clean("email"), "license_type": code, "license_category": lookup(code, table),
    }).where("license_category IS NOT NULL")


def load_california(df: DataFrame) -> DataFrame:
    """Clear licences only, one row per classification in scope."""
    table = fixed.LICENCE_CATEGORIES["CA"]
    live = df.where(F.upper(clean("PrimaryStatus")) == "CLEAR")
    each = live.select("*", F.posexplode(class_codes("Classifications(s)")).alias("class_no", "class_code"))
    return _record(each, "CA_CSLB", {
        "company_name": first_filled("BusinessName", "FullBusinessName"),
        "address": clean("MailingAddress"), "city": clean("City"),
        "state": F.coalesce(F.upper(clean("State")), F.lit("CA")), "zip": clean("ZIPCode"),
        "phone": clean("BusinessPhone"), "license_type": F.col("class_code"),
        "license_category": lookup("class_code", table), "license_number": clean("LicenseNo"),
    }).where("license_category IS NOT NULL")


def load_texas(df: DataFrame) -> DataFrame:
    code = clean("LICENSE TYPE")
    place = city_state_zip("BUSINESS CITY, STATE ZIP")
    return _record(df, "TX_TDLR", {
        "company_name": first_filled("BUSINESS NAME", "NAME"),
        "address": clean(
            F.concat_ws(" ", clean("BUSINESS ADDRESS-LINE1"), clean("BUSINESS ADDRESS-LINE2"))
        ),
        "city": place["city"], "state": F.coalesce(place["state"], F.lit("TX")),
        "zip": F.coalesce(place["zip"], clean("BUSINESS ZIP")),
        "phone": first_filled("BUSINESS PHONE", "PHONE NUMBER"), "license_type": code,
        "license_category": lookup(code, fixed.LICENCE_CATEGORIES["TX"]),
        "license_number": clean("LICENSE NUMBER"),
    }).where("license_category IS NOT NULL AND company_name IS NOT NULL")


def load_new_york(df: DataFrame) -> DataFrame:
    """General contractors and auditors are not in the map and so drop out."""
    code = F.upper(clean("license_type_code"))
    return _record(df, "NYC_DOB", {
        "company_name": first_filled("business_1", "business_2", "licensee_name"),
        "contact_name": clean("licensee_name"), "city": F.lit("New York"), "state": F.lit("NY"),
        "license_type": F.concat(F.lit("NYC_"), code),
        "license_category": lookup(code, fixed.LICENCE_CATEGORIES["NYC"]),
        "license_number": clean("license_number"),
    }).where("license_category IS NOT NULL AND company_name IS NOT NULL")


LOADERS = {
    "FL": load_florida, "CA": load_california, "TX": load_texas, "NYC": load_new_york,
}


def stack(*parts: DataFrame) -> DataFrame:
    """Loaded registries as one frame with the phone key and the source label."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.withColumn("phone_key", phone10("phone"))
