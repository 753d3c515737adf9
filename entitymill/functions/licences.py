"""Licence codes: categories, registry type names and class flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import ColumnLike, as_col, lookup, split_list


def category_of(registry: ColumnLike, code: ColumnLike) -> Column:
    """Licence category of a registry's type code; NULL when out of scope."""
    result = None
    for state, table in fixed.LICENCE_CATEGORIES.items():
        test, value = as_col(registry) == state, lookup(code, table)
        result = F.when(test, value) if result is None else result.when(test, value)
    return result


def type_name(registry: str, code: ColumnLike) -> Column:
    """Registry code to the common type name; unknown codes stay as they are."""
    return F.coalesce(lookup(code, fixed.REGISTRY_TYPE_NAMES[registry]), as_col(code))


def class_codes(c: ColumnLike) -> Column:
    return split_list(F.upper(as_col(c)), "|")


def class_flags(codes: Column) -> dict[str, Column]:
    """Trade flags of a class-code array, plus the two general-contractor classes."""
    def any_code(marks: list[str]) -> Column:
        return F.exists(
            codes, lambda code: F.arrays_overlap(
                F.filter(F.array(*[F.lit(m) for m in marks]), lambda m: F.contains(code, m)),
                F.array(*[F.lit(m) for m in marks]),
            )
        )

    flags = {name: any_code(marks) for name, marks in fixed.CLASS_FLAGS.items()}
    flags["is_gc"] = F.array_contains(codes, "B")
    flags["is_engineering_gc"] = F.array_contains(codes, "A")
    return flags


def class_pairs(c: ColumnLike) -> dict[str, Column]:
    """Which of the electrical, cooling and solar classes stand together in the raw text."""
    c10 = as_col(c).rlike("(?i)C-?10")
    c20 = as_col(c).rlike("(?i)C-?20")
    c46 = as_col(c).rlike("(?i)C-?46")
    return {
        "has_c10_c20": c10 & c20,
        "has_c10_c46": c10 & c46,
        "has_c20_c46": c20 & c46,
        "has_all_three": c10 & c20 & c46,
        "is_multi_trade": (c10 & c20) | (c10 & c46) | (c20 & c46),
    }
