"""Small text helpers shared by every normaliser; a missing value is always NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnLike) -> Column:
    """Cut white space of every kind at both ends (plain trim() only cuts blanks)."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def squeeze(c: ColumnLike) -> Column:
    return strip(F.regexp_replace(as_col(c), r"\s+", " "))


def blank_to_null(c: ColumnLike) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def clean(c: ColumnLike) -> Column:
    """Stripped text, NULL when nothing is left."""
    return blank_to_null(strip(c))


def first_filled(*cols: ColumnLike) -> Column:
    return F.coalesce(*[clean(c) for c in cols])


def drop_punctuation(c: ColumnLike) -> Column:
    return F.regexp_replace(as_col(c), r"[^\p{L}\p{N}_\s]", "")


def words_found(c: ColumnLike, words: list[str]) -> Column:
    """The listed words that occur in the lower-cased text, in list order."""
    text = F.lower(as_col(c))
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def has_any(c: ColumnLike, words: list[str]) -> Column:
    """True when one of the words occurs; false (not NULL) for missing text."""
    text = F.lower(as_col(c))
    tests = [text.contains(w) for w in words]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def split_list(c: ColumnLike, separator: str = ",") -> Column:
    """Delimited cell to an array of stripped, non-empty items."""
    parts = F.split(as_col(c), "\\" + separator if separator in "|.+*?" else separator)
    return F.filter(F.transform(parts, strip), lambda item: F.length(item) > 0)


def join_sorted(array: Column, separator: str = ", ") -> Column:
    return F.array_join(F.array_sort(array), separator)


def fingerprint(columns: list[str], width: int = 16) -> Column:
    """Stable record id: md5 over name=value items in column-name order."""
    items = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("")))
        for name in sorted(columns)
    ]
    return F.substring(F.md5(F.concat_ws("|", *items)), 1, width)


def lookup(c: ColumnLike, table: dict[str, str]) -> Column:
    """Code to value through a literal map; NULL for unknown codes."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), as_col(c))


def count_true(*flags: Column) -> Column:
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags])
