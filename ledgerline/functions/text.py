"""Text predicates and cleaners as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(col: str | Column) -> Column:
    """NULL or blank."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.trim(c), F.lit(""))


def matches(col: str | Column, pattern: str) -> Column:
    """Anchored format test; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(pattern)


def map_category(col: str | Column, mapping: dict[str, str]) -> Column:
    """Explicit, auditable mapping on the upper-cased trimmed value; unmapped values pass through."""
    c = F.col(col) if isinstance(col, str) else col
    key = F.upper(F.trim(c))
    if not mapping:
        return key
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, key), key)


def first_letter_code(col: str | Column, allowed: tuple[str, ...], unknown: str) -> Column:
    """First letter of the trimmed value if allowed, else the explicit unknown code."""
    c = F.col(col) if isinstance(col, str) else col
    letter = F.upper(F.left(F.trim(c), F.lit(1)))
    return F.when(letter.isin(*allowed), letter).otherwise(F.lit(unknown))


def preview(col: str | Column, width: int = 110) -> Column:
    """Whitespace runs collapsed to one blank, cut to a display width."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(F.regexp_replace(c, r"\s+", " "), 1, width)
