"""Scalar column functions (section 2.11): all built-in, JVM-side expressions.

Every function takes and returns a ``Column`` so it stays inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.fixed_values import (MISREAD_EURO, MONTHS, SALE_CLASS_NEEDLE, SALE_CLASS_NEW,
                                 SALE_CLASS_OTHER, SALES_MONEY_CHARS)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Text that looks like a number.  ``try_cast`` on text that is not a number
# pays for a thrown and caught exception per row (tens of microseconds), so
# casts are guarded by these patterns and ``try_cast`` only sees likely hits.
# (possessive quantifiers: no backtracking over long digit runs)
INTEGER_TEXT = r"^\s*+[+-]?+[0-9]++\s*+$"
NUMBER_TEXT = r"^\s*+[+-]?+(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+\s*+$"
SPECIAL_NUMBERS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan")


def to_double(col: Column | str) -> Column:
    """Text to DOUBLE, null when it is not a number (decimal, exponent, inf, nan)."""
    c = _c(col)
    looks = c.rlike(NUMBER_TEXT) | F.lower(F.trim(c)).isin(*SPECIAL_NUMBERS)
    return F.when(looks, c.try_cast("double"))


def to_bigint(col: Column | str) -> Column:
    """Text to BIGINT, null unless it is a whole number in range."""
    c = _c(col)
    return F.when(c.rlike(INTEGER_TEXT), c.try_cast("bigint"))


def literal_map(mapping: dict) -> Column:
    """A constant map usable as ``literal_map(m)[col]``; unknown keys give null."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def lookup(col: Column | str, mapping: dict) -> Column:
    """Key lookup in a literal map (statistic -> column, month -> number)."""
    return literal_map(mapping)[_c(col)]


def parse_money(col: Column | str, strip_chars: str = SALES_MONEY_CHARS) -> Column:
    """``"€1,234.50"`` -> 1234.5; text that is not a number -> null."""
    return to_double(F.regexp_replace(_c(col).cast("string"), strip_chars, ""))


def parse_price(col: Column | str) -> Column:
    """A register price to DOUBLE: its currency mark in any of its spellings and
    misreadings removed; text that is no number stays null, never its digits."""
    return parse_money(F.replace(_c(col).cast("string"), F.lit(MISREAD_EURO), F.lit("")), SALES_MONEY_CHARS)


def first_year(col: Column | str) -> Column:
    """First 4-digit run as INT: ``2024M01``, ``2005 January`` -> year; else null."""
    return F.nullif(F.regexp_extract(_c(col).cast("string"), r"(\d{4})", 1), F.lit("")).cast("int")


def month_of_period(col: Column | str) -> Column:
    """Month number from a ``yyyy MonthName`` period; anything else -> null."""
    name = F.trim(F.regexp_extract(_c(col), r"^\d{4}\s+(.+)$", 1))
    return lookup(name, MONTHS).cast("int")


_SPACED_DATE = r"^(\d{1,2})\s+(\d{1,2})\s+(\d{4})$"


def normalise_date_text(col: Column | str) -> Column:
    """``d M yyyy`` (spaces) -> ``d/M/yyyy``; other text passes through trimmed."""
    return F.regexp_replace(F.trim(_c(col)), _SPACED_DATE, "$1/$2/$3")


def parse_date(col: Column | str) -> Column:
    """Sales-register date text to DATE, null when invalid.

    Accepts ``dd/MM/yyyy``, one-digit day or month, and the space-separated
    ``d M yyyy`` form; impossible dates (31/02) are null, never an error.
    """
    return F.try_to_date(normalise_date_text(col), "d/M/yyyy")


def first_nonblank(*cols: Column | str) -> Column:
    """First argument that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def chart_time(year: Column | str) -> Column:
    """Integer year -> the DATE of 1 January, for time-axis charts."""
    return F.make_date(_c(year), F.lit(1), F.lit(1))


def classify(col: Column | str, needle: str = SALE_CLASS_NEEDLE,
             yes: str = SALE_CLASS_NEW, no: str = SALE_CLASS_OTHER) -> Column:
    """``yes`` when the lower-cased text contains ``needle``, else ``no``.

    Null text falls in ``no``; ``needle`` matches inside words too
    ("Newtown" is New), as in the source mart.
    """
    return F.when(F.lower(_c(col)).contains(needle.lower()), F.lit(yes)).otherwise(F.lit(no))


def keep_blank_or_no(col: Column | str) -> Column:
    """Predicate: value is ``NO`` in any case, blank, or null (three-valued OR)."""
    c = _c(col)
    return F.upper(c).isin("NO", "") | c.isNull()


def contains_ci(col: Column | str, text: str) -> Column:
    """Case-insensitive substring test against a bound literal."""
    return F.lower(_c(col)).contains(F.lower(F.lit(text)))
