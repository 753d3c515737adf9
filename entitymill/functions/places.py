"""Addresses, states and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, as_col, blank_to_null, clean, strip

CITY_STATE_ZIP = r"^(.+?),?\s+([A-Z]{2})\s+([0-9]{5}(?:-[0-9]{4})?)$"
CITY_STATE = r"^(.+?),?\s+([A-Z]{2})$"


def city_state_zip(c: ColumnLike) -> Column:
    """struct(city, state, zip) of "CITY, ST 12345-6789"; falls back to the whole as city."""
    text = clean(c)
    has_zip = text.rlike(CITY_STATE_ZIP)
    has_state = text.rlike(CITY_STATE)

    def part(full: int, short: int | None, rest: Column) -> Column:
        short_col = F.regexp_extract(text, CITY_STATE, short) if short else F.lit(None)
        return blank_to_null(
            F.when(has_zip, F.regexp_extract(text, CITY_STATE_ZIP, full))
            .when(has_state, short_col)
            .otherwise(rest)
        )

    missing = F.lit(None).cast("string")
    return F.struct(
        part(1, 1, text).alias("city"),
        part(2, 2, missing).alias("state"),
        part(3, None, missing).alias("zip"),
    )


def state2(c: ColumnLike) -> Column:
    return blank_to_null(F.left(F.upper(as_col(c)), F.lit(2)))


def zip5(c: ColumnLike) -> Column:
    return blank_to_null(F.left(as_col(c), F.lit(5)))


def full_address(*parts: ColumnLike) -> Column:
    return blank_to_null(F.concat_ws(", ", *[clean(p) for p in parts]))


def lenient_date(c: ColumnLike) -> Column:
    """ISO or US month/day/year date; NULL when it is neither."""
    text = strip(c)
    return F.coalesce(
        F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "M/d/yyyy")
    )


def tenure_years(since: ColumnLike, as_of: Column) -> Column:
    return F.datediff(as_of, as_col(since)) / F.lit(365.25)
