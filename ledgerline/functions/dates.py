"""Date parsing and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of the storage formats met in feeds: ISO (YYYY-MM-DD), US (MM/DD/YYYY), text (DD-Mon-YYYY).
ISO, US, TEXT = r"^\d{4}-\d{1,2}-\d{1,2}\z", r"^\d{1,2}/\d{1,2}/\d{4}\z", r"^\d{1,2}-[A-Za-z]{3}-\d{4}\z"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"

# Labels and full-width shapes of the storage census.  Parsing accepts one-digit parts too, the census doesn't.
CENSUS_SHAPES: tuple[tuple[str, str], ...] = (
    ("ISO (YYYY-MM-DD)", r"^\d{4}-\d{2}-\d{2}$"),
    ("US (MM/DD/YYYY)", r"^\d{2}/\d{2}/\d{4}$"),
    ("Text (DD-Mon-YYYY)", r"^\d{2}-[A-Za-z]{3}-\d{4}$"),
)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col: str | Column) -> Column:
    """First format that fits wins; anything else, an impossible day included, is NULL.

    The parts are put into ISO order and cast: a pattern parser takes several times as long.
    """
    c = _c(col)
    name = F.upper(F.substring(c, F.instr(c, "-") + 1, F.lit(3)))
    place = F.call_function("locate", name, F.lit(MONTHS.upper()))
    month = F.when(place % 3 == 1, F.floor(place / 3) + 1).cast("string")
    ordered = (
        F.when(c.rlike(ISO), c)
        .when(c.rlike(US), F.concat(F.substring_index(c, "/", -1), F.lit("-"), F.translate(F.substring_index(c, "/", 2), "/", "-")))
        .when(c.rlike(TEXT), F.concat(F.substring_index(c, "-", -1), F.lit("-"), month, F.lit("-"), F.substring_index(c, "-", 1)))
    )
    return ordered.try_cast("date")


def date_text(day: str | Column, style: str) -> Column:
    """A day (from year 0 on) as ``ISO``, ``US`` or ``TEXT`` writes it with full width, from the parts of its ISO text.

    A formatter with a pattern takes several times as long.
    """
    iso = _c(day).cast("date").cast("string")
    if style == "ISO":
        return iso
    year, last = F.substring_index(iso, "-", 1), F.substring_index(iso, "-", -1)
    if style == "US":
        return F.concat(F.translate(F.right(iso, F.lit(5)), "-", "/"), F.lit("/"), year)
    return F.concat(last, F.lit("-"), F.substring(F.lit(MONTHS), F.month(_c(day)) * 3 - 2, F.lit(3)), F.lit("-"), year)


def month_start(col: str | Column) -> Column:
    """``YYYY-MM`` text to the first day of that month."""
    return F.to_date(F.concat(_c(col), F.lit("-01")), "yyyy-MM-dd")


def month_index(col: str | Column) -> Column:
    """Months since year 0, so a difference counts month boundaries crossed."""
    c = _c(col)
    return F.year(c) * 12 + F.month(c)


def months_between_starts(later: str | Column, earlier: str | Column) -> Column:
    return month_index(later) - month_index(earlier)


def decade(col: str | Column) -> Column:
    return (F.floor(F.year(_c(col)) / 10) * 10).cast("int")


def epoch_30d(col: str | Column) -> Column:
    """Time since 1970 in units of 30 days (a date is counted in whole days, so no time zone enters)."""
    return F.date_diff(_c(col), F.lit("1970-01-01").cast("date")) / F.lit(30.0)


def month_of(col: str | Column) -> Column:
    return F.trunc(_c(col), "month")
