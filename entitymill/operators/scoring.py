"""Fit scores. Weighted scores are integers in hundredths, so that tiers never hang on a float."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.scores import tier_of
from ..functions.text import count_true, has_any, words_found

# Points and weights.
NAME_WEIGHTS = {"resimercial": 35, "multi_brand": 25, "trade": 25, "service": 15}
FOUR_PART_WEIGHTS = {"trade": 35, "brand": 25, "renewable": 25, "asset": 15}
HVAC_BRANDS = ["Carrier", "Mitsubishi", "York", "Trane"]
GENERATOR_BRANDS = ["Generac", "Briggs & Stratton", "Cummins", "Kohler"]
SOLAR_BRANDS = ["Tesla", "Enphase", "SMA", "SolarEdge"]
ELECTRICAL_BRANDS = ["Enphase", "Tesla", "SMA"]
PART_BRANDS = {
    "hvac": ["Carrier", "Mitsubishi", "Rheem", "Trane", "York"],
    "generator": ["Generac", "Briggs & Stratton", "Cummins"],
    "solar": ["Enphase", "SMA"],
    "battery": ["Tesla"],
}


def points(*steps: tuple[Column, int], otherwise: int = 0) -> Column:
    """Points of the first test that holds; an unknown test counts as not met."""
    result = None
    for test, value in steps:
        result = F.when(test, value) if result is None else result.when(test, value)
    return result.otherwise(otherwise)


def bonus(test: Column, value: int) -> Column:
    return F.when(test, value).otherwise(0)


def total(*parts: Column) -> Column:
    return reduce(lambda a, b: a + b, parts)


def texts(*steps: tuple[Column, Column | str], otherwise: Column | str) -> Column:
    result = None
    for test, value in steps:
        result = F.when(test, value) if result is None else result.when(test, value)
    return result.otherwise(otherwise)


# --- name and brand score -----------------------------------------------------------------


def name_score(df: DataFrame, with_hvac: bool) -> DataFrame:
    """Four dimensions of 0..100 with evidence, the weighted score and the tier.

    Reads name, tier, brands (text), brand_count and, if with_hvac, the boolean has_hvac.
    """
    name, tier = F.lower("name"), F.lower("tier")
    hvac = F.col("has_hvac") if with_hvac else F.lit(False)
    commercial = has_any("name", fixed.COMMERCIAL_WORDS)
    residential = has_any("name", fixed.RESIDENTIAL_WORDS)
    market_tier = has_any("tier", fixed.MARKET_TIER_WORDS)
    service_tier = has_any("tier", fixed.SERVICE_TIER_WORDS)
    backup = has_any("brands", fixed.GENERATOR_WORDS) | hvac
    kind = "generator/HVAC dealer" if with_hvac else "generator dealer"

    market = [
        (commercial & residential, 100, "Explicit commercial + residential in name"),
        (commercial, 70, "Commercial indicator in name"),
        (residential, 60, "Residential indicator in name"),
        (market_tier & backup, 75, f"Elite {kind} (likely serves both markets)"),
        (backup, 50, f"{kind[0].upper()}{kind[1:]} (mixed market)"),
    ]
    brand_count = F.col("brand_count")
    held = F.concat(F.lit("("), F.coalesce("brands", F.lit("")), F.lit(")"))
    found = {
        trade: has_any("name", words) | (hvac if trade == "Mechanical" else F.lit(False))
        for trade, words in fixed.TRADE_WORDS.items()
    }
    trades = F.array_compact(F.array(*[F.when(test, trade) for trade, test in found.items()]))
    count = F.size("_trades")
    listed = F.array_join("_trades", ", ")
    whole = has_any("name", fixed.ALL_TRADE_PHRASES)
    service = F.size("_service")
    single = F.concat(F.lit("Single trade: "), listed)
    if with_hvac:
        single = F.when(hvac, "HVAC contractor (Mechanical)").otherwise(single)

    scored = df.withColumn("_trades", trades).withColumn(
        "_service", words_found("name", fixed.MAINTENANCE_WORDS)
    )
    scored = scored.withColumns({
        "resimercial_score": points(*[(t, p) for t, p, _ in market], otherwise=40),
        "resimercial_evidence": texts(
            *[(t, e) for t, _, e in market], otherwise="Market scope unclear"
        ),
        "multi_brand_score": points((brand_count >= 3, 100), (brand_count == 2, 50), otherwise=25),
        "multi_brand_evidence": texts(
            (brand_count >= 4, F.concat(F.lit("4+ brand certifications "), held)),
            (brand_count == 3, F.concat(F.lit("3 brand certifications "), held)),
            (brand_count == 2, F.concat(F.lit("2 brand certifications "), held)),
            otherwise=F.concat(F.lit("Single brand "), held),
        ),
        "trade_score": points(((count >= 3) | whole, 100), (count == 2, 75), otherwise=50),
        "trade_evidence": texts(
            (
                (count >= 3) | whole,
                F.concat(F.lit("Multi-trade: "), F.when(count > 0, listed).otherwise("All Trades")),
            ),
            (count == 2, F.concat(F.lit("Dual-trade: "), listed)),
            (count == 1, single),
            otherwise="Generator installation (implies electrical)",
        ),
        "service_score": points(
            (service >= 2, 100), (service == 1, 75), (service_tier, 60),
            (name.contains("solutions"), 50), otherwise=25,
        ),
        "service_evidence": texts(
            (
                service >= 2,
                F.concat(
                    F.lit("Strong O&M indicators: "), F.array_join(F.slice("_service", 1, 3), ", ")
                ),
            ),
            (service == 1, F.concat(F.lit("O&M indicator: "), F.get("_service", F.lit(0)))),
            (service_tier, "Elite tier (likely offers maintenance)"),
            (name.contains("solutions"), "Service-oriented name"),
            otherwise="O&M capability unclear",
        ),
    }).drop("_trades", "_service")
    hundredths = total(*[F.col(f"{d}_score") * w for d, w in NAME_WEIGHTS.items()])
    return scored.withColumn("score_hundredths", hundredths.cast("long")).withColumns({
        "icp_score": F.bround(F.col("score_hundredths").cast("decimal(12,2)") / 100, 1).cast("double"),
        "icp_tier": tier_of(F.col("score_hundredths"), scale=100),
    })


# --- licence classes -------------------------------------------------------------------------


def class_score(df: DataFrame) -> DataFrame:
    """Score from the class flags has_electrical .. is_engineering_gc."""
    both = F.col("is_gc") & F.col("is_engineering_gc")
    trades = count_true(F.col("has_electrical"), F.col("has_hvac"), F.col("has_plumbing"))
    trade_points = points((trades == 0, 0), (trades == 1, 10), (trades == 2, 18), otherwise=25)
    return df.withColumns({
        "resimercial_score": points(
            (both, 35), (F.col("is_gc"), 20), (F.col("is_engineering_gc"), 15)
        ),
        "multi_brand_score": F.lit(0),
        "trade_score": F.when(F.col("has_solar"), F.least(trade_points + 5, F.lit(25))).otherwise(
            trade_points
        ),
        "service_score": F.lit(5),
    }).transform(_sum_and_tier)


def _sum_and_tier(df: DataFrame) -> DataFrame:
    parts = ["resimercial_score", "multi_brand_score", "trade_score", "service_score"]
    return df.withColumn("total_score", total(*[F.col(p) for p in parts])).withColumn(
        "icp_tier", tier_of(F.col("total_score"))
    )


def rescore_with_brands(df: DataFrame, brand_count: str) -> DataFrame:
    """New brand points after a match to directories, new total and tier."""
    n = F.coalesce(F.col(brand_count), F.lit(1))
    brand_points = points((n >= 4, 25), (n == 3, 19), (n == 2, 12), otherwise=6)
    return df.withColumn("multi_brand_score", brand_points).transform(_sum_and_tier)


# --- additive scores ---------------------------------------------------------------------------


def source_score(df: DataFrame) -> DataFrame:
    """Sources, capabilities, volume and location, capped at 100."""
    kw, lists = F.col("kw_installed"), F.col("list_count")
    score = total(
        bonus(F.col("in_ranking"), 15), bonus(F.col("in_solar_coop"), 10),
        bonus(F.col("in_om_coop"), 10), bonus(F.col("has_state_license"), 5),
        bonus(F.col("has_solar"), 10), bonus(F.col("has_electrical"), 5),
        bonus(F.col("has_hvac"), 5), bonus(F.col("has_general_contractor"), 5),
        bonus(F.col("license_count") >= 3, 5),
        points((kw > 1_000_000, 10), (kw > 100_000, 5)),
        points((lists >= 5, 10), (lists >= 3, 5)),
        bonus(F.col("srec_states") > 0, 5), bonus(F.col("state_count") >= 3, 5),
    )
    return df.withColumn("icp_score", F.least(score, F.lit(100))).withColumn(
        "icp_tier", tier_of(F.col("icp_score"))
    )


def enhanced_score(df: DataFrame) -> DataFrame:
    """Dimensions with bonus and evidence. Reads brand_list, category_list, srec_list (sorted
    arrays), in_solar_coop, in_om_coop, kw_installed and list_count (NULL when not ranked)."""
    brands, cats = F.col("brand_list"), F.col("category_list")

    def any_of(values: list[str]) -> Column:
        return F.arrays_overlap(brands, F.array(*[F.lit(v) for v in values]))

    staged = df.withColumns({
        "_hvac": any_of(HVAC_BRANDS), "_generator": any_of(GENERATOR_BRANDS),
        "_solar": any_of(SOLAR_BRANDS), "_n": F.size(brands),
    })
    kinds = count_true(F.col("_hvac"), F.col("_generator"), F.col("_solar"))
    electrical = F.array_contains(cats, "ELECTRICAL") | any_of(ELECTRICAL_BRANDS)
    hvac = F.array_contains(cats, "HVAC") | F.col("_hvac")
    plumbing = F.array_contains(cats, "PLUMBING")
    cover = F.array_contains(cats, "ROOFING") | F.array_contains(cats, "SOLAR") | F.col("_solar")
    trades = count_true(electrical, hvac, plumbing, cover)
    ranked = F.col("kw_installed").isNotNull()
    srec = F.size("srec_list") > 0
    n = F.col("_n")
    single = F.array_join(
        F.array_compact(
            F.array(
                F.when(electrical, "Electrical"), F.when(hvac, "HVAC"), F.when(plumbing, "Plumbing")
            )
        ),
        ", ",
    )
    evidence = F.array_compact(
        F.array(
            F.when(F.col("_hvac"), "HVAC brand (typically resimercial)"),
            F.when(kinds >= 2, F.format_string("Multi-product (%d types)", kinds)),
            F.when(F.col("in_solar_coop"), "Solar cooperative member (values-driven)"),
            F.when(srec, F.concat(F.lit("SREC state ("), F.array_join("srec_list", ", "), F.lit(")"))),
            F.when(n >= 3, F.format_string("Triple+ brand (%d brands)", n))
            .when(n == 2, F.concat(F.lit("Dual brand ("), F.array_join(brands, ", "), F.lit(")")))
            .when(n == 1, F.concat(F.lit("Single brand ("), F.get(brands, F.lit(0)), F.lit(")"))),
            F.when(ranked, F.format_string("Ranked (%d kW, %d lists)", "kw_installed", "list_count")),
            F.when(trades >= 3, F.format_string("Multi-trade (%d trades)", trades))
            .when(trades == 2, "Dual-trade (2 trades)")
            .when(trades == 1, F.concat(F.lit("Single trade: "), single)),
            F.when(F.col("in_om_coop"), "O&M cooperative member (proven O&M capability)")
            .when(F.col("_hvac"), "HVAC brand (service contracts typical)")
            .when(F.col("_generator"), "Generator brand (maintenance required)"),
        )
    )
    scored = staged.withColumns({
        "resimercial_score": total(bonus(F.col("_hvac"), 25), bonus(kinds >= 2, 10)),
        "multi_brand_score": points((n >= 3, 25), (n == 2, 15), (n == 1, 5)),
        "trade_score": points((trades >= 3, 25), (trades == 2, 15), (trades == 1, 5)),
        "service_score": points(
            (F.col("in_om_coop"), 15), (F.col("_hvac"), 10), (F.col("_generator"), 5)
        ),
        "bonus_score": total(
            bonus(ranked, 10), bonus(F.col("in_solar_coop"), 5), bonus(srec, 5)
        ),
        "evidence": F.array_join(evidence, "; "),
    })
    parts = ["resimercial_score", "multi_brand_score", "trade_score", "service_score", "bonus_score"]
    return (
        scored.withColumn("icp_score", F.least(total(*[F.col(p) for p in parts]), F.lit(100)))
        .withColumn("icp_tier", tier_of(F.col("icp_score")))
        .drop("_hvac", "_generator", "_solar", "_n")
    )


def four_part_score(df: DataFrame) -> DataFrame:
    """Weighted 35/25/25/15, truncated. Reads category_count, the <trade>_licences counts, the
    <kind>_brands counts, brand_total and kw_installed."""
    licences = F.col("category_count")
    base = points((licences >= 4, 100), (licences >= 3, 80), (licences >= 2, 60), (licences >= 1, 30))
    combo = (F.col("hvac_licences") > 0) & (F.col("electrical_licences") > 0)
    solar, battery = F.col("solar_brands") > 0, F.col("battery_brands") > 0
    start = bonus((F.col("solar_licences") > 0) | solar | battery, 60)
    scored = df.withColumns({
        "trade_score": F.when(combo, F.least(base + 20, F.lit(100))).otherwise(base),
        "brand_score": points(
            (F.col("brand_total") >= 3, 100), (F.col("brand_total") >= 2, 70),
            (F.col("brand_total") >= 1, 40),
        ),
        "renewable_score": F.when(solar & battery, 100)
        .when(F.coalesce("kw_installed", F.lit(0)) > 0, F.greatest(start, F.lit(80)))
        .otherwise(start),
        "asset_score": F.least(
            total(
                bonus(F.col("hvac_brands") > 0, 40), bonus(F.col("generator_brands") > 0, 40),
                bonus(F.col("hvac_licences") > 0, 20),
            ),
            F.lit(100),
        ),
    })
    hundredths = total(*[F.col(f"{d}_score") * w for d, w in FOUR_PART_WEIGHTS.items()])
    return scored.withColumn("icp_score", F.call_function("div", hundredths, F.lit(100))).withColumn(
        "icp_tier", tier_of(F.col("icp_score"))
    )


def composite_score(df: DataFrame) -> DataFrame:
    """Base score plus bonuses, with the breakdown as text. Flags must be set (not NULL)."""
    flags = {
        "Multi-trade": ("is_multi_trade", 30), "All three": ("has_all_three", 20),
        "Tenure": ("is_high_tenure", 15), "Multi-state": ("is_multi_state", 25),
        "Brand": ("has_brand", 20),
    }
    gained = {label: bonus(F.coalesce(F.col(c), F.lit(False)), p) for label, (c, p) in flags.items()}
    pattern = "Base: %d" + "".join(f" | {label}: %d" for label in flags)
    return df.withColumns({
        "composite_score": total(F.coalesce("base_score", F.lit(0)), *gained.values()),
        "score_breakdown": F.format_string(pattern, "base_score", *gained.values()),
    })


def lead_score(df: DataFrame) -> DataFrame:
    """List lead score: e-mail, trades, list, market, state and further sources, capped."""
    source = F.col("source")
    score = total(
        bonus(F.col("has_email"), 20), bonus(F.col("is_multi_trade"), 25),
        bonus((source == "RANK_COMMERCIAL") & F.col("is_top_100"), 20),
        bonus(source == "RANK_EPC", 15), bonus(F.col("is_resimercial"), 15),
        bonus(F.col("state") == "FL", 5),
        F.when(F.col("source_count") > 1, (F.col("source_count") - 1) * 10).otherwise(0),
    )
    return df.withColumn("score", F.least(score, F.lit(100)))


def capability_score() -> Column:
    """Licence flags, brand categories and contact data, capped at 100."""
    flags = ["has_hvac", "has_electrical", "has_plumbing", "has_solar"]
    score = total(
        *[bonus(F.col(f), 10) for f in flags],
        F.least(F.col("brand_categories") * 10, F.lit(40)),
        bonus(F.col("phone").isNotNull(), 10), bonus(F.col("email").isNotNull(), 10),
    )
    return F.least(score, F.lit(100))


def contact_quality_rank(phone: str, email: str) -> Column:
    p, e = F.col(phone).isNotNull(), F.col(email).isNotNull()
    return points((p & e, 3), (p, 2), (e, 1))


def contact_quality_tier(phone: str, email: str) -> Column:
    p, e = F.col(phone).isNotNull(), F.col(email).isNotNull()
    return texts((p & e, "GOLD"), (p | e, "SILVER"), otherwise="BRONZE")


def brand_count_tier(count: Column) -> Column:
    return texts((count >= 3, "TRIPLE"), (count == 2, "DUAL"), otherwise="SINGLE")


def priority_score(df: DataFrame) -> DataFrame:
    """Five parts 40/20/20/10/10 with bands. State priority, zip rank and urgency are inputs."""
    brands, staff, rank = F.col("brand_count"), F.col("employees"), F.col("zip_rank")
    score = total(
        points((brands >= 3, 40), (brands == 2, 25), (brands == 1, 10)),
        points((F.col("state_priority") == "HIGH", 20), (F.col("state_priority") == "MEDIUM", 10)),
        points((staff >= 50, 20), (staff >= 10, 15), (staff >= 5, 10), otherwise=5),
        points((rank <= 10, 10), (rank <= 30, 7)),
        points((F.col("urgency") == "CRITICAL", 10), (F.col("urgency") == "HIGH", 7)),
    )
    return df.withColumn("priority_score", score).withColumn(
        "priority",
        texts(
            (F.col("priority_score") >= 80, "HIGH"), (F.col("priority_score") >= 50, "MEDIUM"),
            otherwise="LOW",
        ),
    )


def contact_share_score(email_count: Column, phone_count: Column, rows: Column) -> Column:
    """(e-mail % + phone %) / 2, truncated; 0 for no rows."""
    whole = F.nullif(rows.cast("long") * 2, F.lit(0).cast("long"))
    part = (email_count.cast("long") + phone_count.cast("long")) * 100
    return F.coalesce(F.call_function("div", part, whole), F.lit(0).cast("long"))
