"""Company-name keys.

Each key differs in which endings it takes off. All of them return NULL when nothing is
left, so that an empty name never equals another empty name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import ColumnLike, as_col, blank_to_null, drop_punctuation, has_any, squeeze, strip


def cut_endings(c: Column, endings: list[str]) -> Column:
    """One pass over the ordered endings; each is taken off at most once."""
    return F.aggregate(
        F.array(*[F.lit(e) for e in endings]),
        c,
        lambda name, ending: F.when(
            F.endswith(name, ending), F.left(name, F.length(name) - F.length(ending))
        ).otherwise(name),
    )


def company_key(c: ColumnLike, endings: list[str] = fixed.LEGAL_SUFFIXES) -> Column:
    """The default key: lower case, endings off, punctuation out, blanks squeezed."""
    return blank_to_null(squeeze(drop_punctuation(cut_endings(strip(F.lower(as_col(c))), endings))))


def company_key_trade(c: ColumnLike) -> Column:
    """Also takes trade words off, to match rankings that leave them out."""
    return company_key(c, fixed.TRADE_SUFFIXES)


def company_key_short(c: ColumnLike) -> Column:
    return company_key(c, fixed.SHORT_SUFFIXES)


def company_key_upper(c: ColumnLike) -> Column:
    """Upper-case key; punctuation inside the name stays."""
    name = reduce(
        lambda acc, pattern: F.regexp_replace(acc, pattern, ""),
        fixed.UPPER_SUFFIX_PATTERNS,
        F.upper(strip(c)),
    )
    return blank_to_null(squeeze(name))


def company_key_anchored(c: ColumnLike) -> Column:
    """Lower-case key for directory lists; punctuation stays."""
    name = reduce(
        lambda acc, pattern: F.regexp_replace(acc, pattern, ""),
        fixed.ANCHORED_SUFFIX_PATTERNS,
        strip(F.lower(as_col(c))),
    )
    return blank_to_null(squeeze(name))


def company_key_cut_anywhere(c: ColumnLike, pieces: list[str] = fixed.CUT_ANYWHERE) -> Column:
    """Cuts the pieces wherever they occur, even inside a word ("gulf coastal" loses " co")."""
    name = reduce(
        lambda acc, piece: F.replace(acc, F.lit(piece), F.lit("")),
        pieces,
        strip(F.lower(as_col(c))),
    )
    return blank_to_null(squeeze(drop_punctuation(name)))


def is_business_name(c: ColumnLike) -> Column:
    return has_any(c, fixed.BUSINESS_NAME_WORDS)
