"""Phone keys and display forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import TOLL_FREE_PREFIXES
from .text import ColumnLike, as_col, blank_to_null


def digits(c: ColumnLike) -> Column:
    """Digits of any length, NULL when there are none."""
    return blank_to_null(F.regexp_replace(as_col(c), "[^0-9]", ""))


def phone10(c: ColumnLike) -> Column:
    """Ten-digit key; a leading country 1 is cut, any other length is no key."""
    return blank_to_null(F.regexp_extract(digits(c), r"\A1?([0-9]{10})\z", 1))


def phone10_without_extension(c: ColumnLike) -> Column:
    return phone10(F.regexp_replace(as_col(c), r"(?i)\s*(ext|x)\s*[0-9]+", ""))


def last10(c: ColumnLike) -> Column:
    return F.right(digits(c), F.lit(10))


def is_toll_free(key: ColumnLike) -> Column:
    return F.coalesce(F.substring(as_col(key), 1, 3).isin(TOLL_FREE_PREFIXES), F.lit(False))


def local_phone10(c: ColumnLike) -> Column:
    """phone10 without toll-free numbers, which are call centres rather than dealers."""
    key = phone10(c)
    return F.when(~is_toll_free(key), key)


def display(key: ColumnLike) -> Column:
    return F.regexp_replace(as_col(key), r"^(\d{3})(\d{3})(\d{4})$", "($1) $2-$3")


def e164(key: ColumnLike) -> Column:
    return F.concat(F.lit("+1"), as_col(key))
