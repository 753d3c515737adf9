"""Ranked lists, partner lists, outreach lists and saved pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import PARTNER_LICENCE_TOKENS
from ..functions.text import as_col, clean, strip, words_found

# Header words that the page glues to its kW cells, and tier badges.
KW_HEADERS = [
    "C&I kW Installed in 2024", "Residential kW Installed in 2024",
    "Storage kW Installed in 2024", "Utility kW Installed in 2024",
    "Community kW Installed in 2024", "kW Installed in 2024", "kW Installed",
    "Total kW Installed in 2024", "Total kW",
]
RANK_LINE = "rank INT, company_name STRING, state STRING, kw_installed DOUBLE"
PAGE_TIERS = ["Gold Dealer", "Silver Dealer", "Bronze Dealer", "Titan Certified"]
TOP_RANK = 100


def without_header(c, headers: list[str]) -> Column:
    """Cell text behind the first header it starts with."""
    text = strip(c)
    result = text
    for header in reversed(headers):
        result = F.when(
            text.startswith(header), strip(F.substring(text, len(header) + 1, 1_000_000))
        ).otherwise(result)
    return result


def kw_of_cell(c) -> Column:
    """kW number of a cell: header off, everything through a 202x year off, commas out."""
    tail = F.regexp_replace(without_header(c, KW_HEADERS), r".*202[0-9]", "")
    number = F.regexp_extract(tail, r"([0-9,]+(?:\.[0-9]+)?)", 1)
    return F.coalesce(
        F.floor(F.replace(number, F.lit(","), F.lit("")).try_cast("double")).cast("long"),
        F.lit(0).cast("long"),
    )


def rank_lines(lines: DataFrame, column: str, source: str) -> DataFrame:
    """"rank,company,state,kW" text lines to rows; lines that do not parse are dropped."""
    parsed = lines.select(F.from_csv(column, RANK_LINE).alias("r")).where("r.rank IS NOT NULL")
    return parsed.select(
        "r.*", F.lit(source).alias("source"), (F.col("r.rank") <= TOP_RANK).alias("is_top_100")
    )


def partner_licences(c) -> tuple[Column, Column]:
    """Licence tokens in a partner cell, and whether two or more trades are among them."""
    tokens = F.filter(
        F.array(*[F.lit(t) for t in PARTNER_LICENCE_TOKENS]),
        lambda t: F.contains(F.upper(as_col(c)), t),
    )
    return tokens, F.size(tokens) >= 2


def serves_both_markets(markets) -> Column:
    return as_col(markets).contains("C&I") & as_col(markets).contains("R")


def page_record(pages: DataFrame) -> DataFrame:
    """Dealer fields of a saved page, read from its whole text."""
    body = F.regexp_replace("html", r"(?s)<(script|style)\b.*?</(script|style)>", " ")
    text = F.trim(F.regexp_replace(F.regexp_replace(body, r"<[^>]*+>", " "), r"\s+", " "))
    host = F.regexp_replace(F.parse_url("url", F.lit("HOST")), r"^www\.", "")
    # tried only where a run of such characters starts, and searched once; the parts come from what it found
    address = r"(?<![^,.!?<>])([^,.!?<>]++), ([A-Z]{2}) ([0-9]{5})"
    staged = pages.select("page_id", host.alias("host"), "html", text.alias("text"))
    staged = staged.select("*", F.regexp_extract("text", address, 0).alias("address"))
    badges = words_found_exact("text", PAGE_TIERS)
    return staged.select(
        "page_id",
        "host",
        clean(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1)).alias("heading"),
        F.coalesce(F.get(badges, F.lit(0)), F.lit("Certified Installer")).alias("tier"),
        F.regexp_extract("text", r"([0-9.]+) *miles?", 1).try_cast("double").alias("miles"),
        clean(F.regexp_extract("address", address, 1)).alias("city"),
        F.nullif(F.regexp_extract("address", address, 2), F.lit("")).alias("state"),
        F.nullif(F.regexp_extract("address", address, 3), F.lit("")).alias("zip"),
        F.regexp_count("html", F.lit(r"<a\s")).cast("long").alias("links"),
        F.nullif(
            F.regexp_extract("text", r"(\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})", 1), F.lit("")
        ).alias("phone"),
    )


def words_found_exact(c, words: list[str]) -> Column:
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(as_col(c), w))
