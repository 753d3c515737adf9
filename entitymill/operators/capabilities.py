"""Capability flags from brands, directory text and licence classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.text import count_true, has_any

FLAGS = [
    "has_generator", "has_solar", "has_battery", "has_microinverters", "has_inverters",
    "has_electrical", "has_hvac", "has_roofing", "has_plumbing", "is_commercial",
    "is_residential",
]

# What a brand's directory entry says about its dealer. Each line reads
# brand, field the words are looked for in ("always": no condition), words, flags set.
COMPANY_WORDS = ["commercial", "industrial", "mechanical", "contractor", "inc", "corp", "llc"]
CLIMATE_WORDS = [*COMPANY_WORDS, "heating", "cooling", "hvac"]
BRAND_RULES = [
    ("Generac", "always", [], ["has_generator", "has_electrical", "is_residential", "is_commercial"]),
    ("Generac", "tier_is", ["Premier", "Elite Plus", "Elite"], ["has_battery"]),
    ("Generac", "certs", ["powerpro premier"], ["has_hvac", "has_battery"]),
    ("Briggs & Stratton", "always", [], ["has_electrical"]),
    ("Briggs & Stratton", "certs", ["standby generators"], ["has_generator"]),
    ("Briggs & Stratton", "certs", ["battery storage"], ["has_battery"]),
    ("Briggs & Stratton", "tier", ["platinum"], ["is_residential"]),
    ("Briggs & Stratton", "tier", ["elite iq"], ["is_residential", "has_battery"]),
    ("Cummins", "always", [], ["has_generator", "has_electrical"]),
    ("Cummins", "tier_is", ["Premier", "Elite", "Premier Dealer", "Elite Dealer"],
     ["is_residential", "is_commercial"]),
    ("Kohler", "always", [], ["has_generator", "has_electrical", "is_residential"]),
    ("Tesla", "always", [], ["has_battery", "has_solar", "has_electrical", "has_roofing",
                             "is_residential", "is_commercial"]),
    ("Enphase", "always", [], ["has_microinverters", "has_solar", "has_electrical",
                               "is_residential"]),
    ("Enphase", "certs", ["storage"], ["has_battery"]),
    ("Enphase", "certs", ["commercial"], ["is_commercial"]),
    ("SolarEdge", "always", [], ["has_solar", "has_inverters", "has_electrical", "has_roofing",
                                 "is_residential"]),
    ("SolarEdge", "certs", ["storage"], ["has_battery"]),
    ("SolarEdge", "certs", ["commercial"], ["is_commercial"]),
    ("SMA", "always", [], ["has_solar", "has_inverters", "has_electrical", "is_commercial",
                           "is_residential"]),
    ("SMA", "certs", ["battery", "hybrid"], ["has_battery"]),
    ("Fronius", "always", [], ["has_solar", "has_inverters", "has_electrical", "has_roofing",
                               "is_residential"]),
    ("Fronius", "certs", ["battery storage", "hybrid systems"], ["has_battery"]),
    ("Fronius", "certs", ["commercial"], ["is_commercial"]),
    ("Sol-Ark", "always", [], ["has_solar", "has_inverters", "has_battery", "has_electrical",
                               "has_roofing", "has_generator", "is_residential"]),
    ("Sol-Ark", "certs", ["commercial"], ["is_commercial"]),
    ("SimpliPhi", "always", [], ["has_battery", "has_electrical", "is_residential"]),
    ("SimpliPhi", "certs", ["solar"], ["has_solar", "has_inverters", "has_roofing"]),
    ("SimpliPhi", "certs", ["generators"], ["has_generator"]),
    ("SimpliPhi", "certs", ["commercial"], ["is_commercial"]),
    ("Carrier", "always", [], ["has_hvac", "is_residential"]),
    ("Carrier", "name", COMPANY_WORDS, ["is_commercial"]),
    ("Carrier", "name", ["electric"], ["has_electrical"]),
    ("Carrier", "tier", ["award"], ["is_commercial"]),
    ("Carrier", "certs", ["award winner"], ["is_commercial"]),
    ("York", "always", [], ["has_hvac", "is_residential"]),
    ("York", "name", COMPANY_WORDS, ["is_commercial"]),
    ("York", "certs", ["commercial contractor", "certified comfort expert", "24/7"],
     ["is_commercial"]),
    ("Trane", "always", [], ["has_hvac"]),
    ("Trane", "name+certs", ["electric", "wiring", "panel"], ["has_electrical"]),
    ("Trane", "name+certs", ["plumb", "pipe", "water heater"], ["has_plumbing"]),
    ("Trane", "name+certs", ["solar", "energy", "renewable", "photovoltaic"], ["has_solar"]),
    ("Trane", "name+certs", ["roof"], ["has_roofing"]),
    ("Trane", "name", ["commercial", "industrial", "mechanical", "inc", "corp", "llc"],
     ["is_commercial"]),
    ("Trane", "name+certs", ["residential", "home", "house"], ["is_residential"]),
    ("Lennox", "always", [], ["has_hvac", "has_electrical", "is_residential", "is_commercial"]),
    ("Mitsubishi", "always", [], ["has_hvac", "has_electrical", "is_commercial"]),
    ("Mitsubishi", "name", ["cooling", "heating", "air", "comfort"], ["is_residential"]),
    ("Rheem", "always", [], ["has_hvac", "is_residential"]),
    ("Rheem", "name", COMPANY_WORDS, ["is_commercial"]),
    ("Rheem", "name", ["plumbing", "plumber"], ["has_plumbing"]),
    ("Rheem", "name", ["electric"], ["has_electrical"]),
    ("Honeywell Home", "always", [], ["has_hvac", "has_electrical"]),
    ("Honeywell Home", "name", CLIMATE_WORDS, ["is_commercial"]),
    ("Honeywell Home", "name", ["residential", "home", "house"], ["is_residential"]),
    ("Honeywell Home", "certs", ["humidifier", "air quality", "water"], ["has_plumbing"]),
    ("Johnson Controls", "always", [], ["has_hvac", "has_electrical", "is_commercial"]),
    ("Johnson Controls", "name", ["residential", "home"], ["is_residential"]),
    ("Sensi", "always", [], ["has_hvac", "has_electrical"]),
    ("Sensi", "name", CLIMATE_WORDS, ["is_commercial"]),
    ("Sensi", "name", ["residential", "home", "house"], ["is_residential"]),
    ("Sensi", "certs", ["plumbing", "water", "pipe"], ["has_plumbing"]),
    ("Schneider Electric", "always", [], ["has_solar", "has_inverters"]),
    ("Schneider Electric", "name", [*COMPANY_WORDS, "energy", "systems", "solutions"],
     ["is_commercial"]),
    ("Schneider Electric", "name", ["residential", "home"], ["is_residential"]),
    ("Schneider Electric", "name", ["electric", "solar", "energy"], ["has_electrical"]),
    ("Schneider Electric", "name", ["battery", "storage"], ["has_battery"]),
    ("Schneider Electric", "certs", ["battery", "storage"], ["has_battery"]),
    ("Schneider Electric", "certs", ["ev charging", "charger"], ["has_electrical"]),
    ("Schneider Electric", "certs", ["commercial", "industrial"], ["is_commercial"]),
    ("Sungrow", "always", [], ["has_inverters", "has_solar", "has_electrical"]),
    ("Sungrow", "certs", ["hybrid", "battery", "energy storage"], ["has_battery"]),
    ("Sungrow", "certs", ["commercial"], ["is_commercial"]),
    ("Sungrow", "certs", ["residential"], ["is_residential"]),
    ("GoodWe", "always", [], ["has_inverters", "has_solar", "has_electrical", "has_battery",
                              "is_residential"]),
    ("GoodWe", "tier_is", ["Gold"], ["is_commercial"]),
    ("GoodWe", "certs", ["gold"], ["is_commercial"]),
    ("Growatt", "always", [], ["has_inverters", "has_solar", "has_electrical"]),
    ("Growatt", "certs", ["hybrid", "battery", "ark", "sph", "off-grid"], ["has_battery"]),
    ("Growatt", "certs", ["commercial", "max series"], ["is_commercial"]),
    ("Growatt", "certs", ["residential", "min series", "mic series"], ["is_residential"]),
    ("Tigo", "always", [], ["has_solar", "has_inverters", "has_electrical"]),
    ("Tigo", "certs", ["ei residential", "battery"], ["has_battery"]),
]
RATED_COMMERCIAL = {"Trane": 50, "Rheem": 100}
RATED_FLOOR = 4.5
RESIDENTIAL_UNLESS_COMMERCIAL = ["Honeywell Home", "Sensi", "Trane", "Growatt"]

# The brands that enter a dealer's product sets, and their names there.
GENERATOR_SET = ["Briggs & Stratton", "Cummins", "Kohler"]
BATTERY_SET = ["Generac", "Briggs & Stratton", "Tesla", "Enphase", "SolarEdge", "Fronius", "Sol-Ark",
               "SimpliPhi", "Sungrow", "GoodWe", "Growatt"]
INVERTER_SET = ["Tesla", "Enphase", "SolarEdge", "SMA", "Fronius", "Sol-Ark", "Sungrow", "GoodWe",
                "Growatt", "Tigo"]
SET_NAMES = {"Mitsubishi": "Mitsubishi Electric", "Tigo": "Tigo Energy"}
BRAND_SETS = ["oem_certifications", "generator_oems", "battery_oems", "microinverter_oems", "inverter_oems"]


def brand_flags(df: DataFrame, brand: str = "brand") -> DataFrame:
    """Flags that follow from the brand alone."""
    names = sorted({flag for flags in fixed.BRAND_FLAGS.values() for flag in flags})
    return df.withColumns({
        flag: F.coalesce(
            F.col(brand).isin([b for b, flags in fixed.BRAND_FLAGS.items() if flag in flags]),
            F.lit(False),
        )
        for flag in names
    })


def directory_flags(df: DataFrame) -> DataFrame:
    """Flags by brand rule over brand, name, tier, certifications, rating and review_count."""
    both = F.concat_ws(" ", "name", "certifications")

    def test(brand: str, field: str, words: list[str]) -> Column:
        mine = F.col("brand") == brand
        if field == "always":
            return mine
        if field == "tier_is":
            return mine & F.col("tier").isin(words)
        text = {"name": F.col("name"), "tier": F.col("tier"), "certs": F.col("certifications"),
                "name+certs": both}[field]
        return mine & has_any(text, words)

    def flag(name: str) -> Column:
        tests = [test(b, f, w) for b, f, w, flags in BRAND_RULES if name in flags]
        if name == "is_commercial":
            tests += [
                (F.col("brand") == b) & (F.col("rating") >= RATED_FLOOR) & (F.col("review_count") >= n)
                for b, n in RATED_COMMERCIAL.items()
            ]
        return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))

    flagged = df.withColumns({name: flag(name) for name in FLAGS})
    default = F.col("brand").isin(RESIDENTIAL_UNLESS_COMMERCIAL) & ~F.col("is_commercial")
    return flagged.withColumn("is_residential", F.col("is_residential") | default)


def brand_sets(df: DataFrame) -> DataFrame:
    """Certified brands and brands per product of one directory row with its flags, as sorted arrays.

    No directory fills microinverter_oems. An Enphase row also says whether it runs maintenance.
    """
    brand = F.col("brand")
    own = F.coalesce(*[F.when(brand == b, F.lit(n)) for b, n in SET_NAMES.items()], brand)
    known = brand.isin(sorted({b for b, *_ in BRAND_RULES}))
    partner = F.when((brand == "SimpliPhi") & F.col("has_generator"), "Briggs & Stratton")

    def held(*names: Column) -> Column:
        return F.array_sort(F.array_compact(F.array(*names)))

    return df.withColumns({
        "oem_certifications": held(F.when(known, own), partner),
        "generator_oems": held(F.when(brand.isin(GENERATOR_SET) & F.col("has_generator"), own)),
        "battery_oems": held(F.when(brand.isin(BATTERY_SET) & F.col("has_battery"), own)),
        "microinverter_oems": F.array().cast("array<string>"),
        "inverter_oems": held(F.when(brand.isin(INVERTER_SET), own)),
        "has_ops_maintenance": F.coalesce((brand == "Enphase") & has_any(F.col("certifications"), ["o&m"]),
                                          F.lit(False)),
    })


def brand_sets_per_entity(rows: DataFrame, key: str) -> DataFrame:
    """The sets of all rows of a key in one; a brand is in each at most once, so they stay short."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in BRAND_SETS],
        F.bool_or("has_ops_maintenance").alias("has_ops_maintenance"),
    )


def high_value_types(df: DataFrame) -> DataFrame:
    """O&M, four-trade and fire/security flags from name, certifications and tier."""
    text = F.concat_ws(" ", "name", "certifications", "tier")
    four = F.col("has_electrical") & F.col("has_hvac") & F.col("has_plumbing") & F.col("has_roofing")
    return df.withColumns({
        "has_om_capability": has_any(text, fixed.OPERATIONS_WORDS),
        "is_mep_r": four | has_any(text, fixed.FOUR_TRADE_WORDS),
        "has_fire_security": has_any(text, fixed.FIRE_SECURITY_WORDS),
    })


def trade_count(df: DataFrame) -> DataFrame:
    """Number of trades, the two-trade flag and the combination text."""
    trades = F.array_compact(
        F.array(
            F.when(F.col("has_hvac"), "HVAC"),
            F.when(F.col("has_electrical"), "Electrical"),
            F.when(F.col("has_plumbing"), "Plumbing"),
            F.when(F.col("has_fire_security"), "Fire/Security"),
            F.when(
                F.col("has_solar") | F.col("has_inverters") | F.col("has_microinverters"), "Solar/Energy"
            ),
            F.when(F.col("has_generator") | F.col("has_battery"), "Generator/Battery"),
        )
    )
    n = F.size("_trades")
    return df.withColumn("_trades", trades).withColumns({
        "trade_count": n,
        "is_multi_trade": n >= 2,
        "trade_combo": F.when(n >= 2, F.array_join("_trades", "+")).otherwise(""),
    }).drop("_trades")


def capability_count() -> Column:
    return count_true(*[F.col(f) for f in FLAGS if f.startswith("has_")])


def category_flags(licences: DataFrame) -> DataFrame:
    """Flags per entity from its licence categories, adjacent categories folded in."""
    names = sorted(set(fixed.CATEGORY_FLAGS.values()))
    return licences.groupBy("entity_id").agg(
        *[
            F.bool_or(
                F.col("license_category").isin(
                    [c for c, flag in fixed.CATEGORY_FLAGS.items() if flag == name]
                )
            ).alias(name)
            for name in names
        ],
        F.countDistinct("license_category").alias("license_count"),
    )
