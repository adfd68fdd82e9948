"""Tolerant readers for text dates and numbers. Bad input gives null, never an error.

All take text already stripped. A pattern check comes before each cast because a plain cast also
takes bare years, time parts, type suffixes and words such as ``inf``. Dates are read in two
steps, so that a caller can put them in successive projections and do each once per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DMY = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
_YMD = r"^(?!0000)\d{4}-\d{1,2}-(\d{1,2}| [1-9])$"
_DIGITS = r"\d+(_\d+)*"
_NUMBER = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"


def _without(text: Column, sign: str, other: str = "") -> Column:
    """``sign`` replaced wherever it stands; ``translate`` would look up every character."""
    return F.replace(text, F.lit(sign), F.lit(other))


def year_first(text: Column) -> Column:
    """Dashes for slashes, and day-month-year turned to year-month-day."""
    return F.regexp_replace(_without(text, "/", "-"), _DMY, "$3-$2-$1")


def date_of(iso: Column) -> Column:
    """Date from year-month-day; one-digit parts allowed, the day may be padded with a space."""
    return F.when(iso.rlike(_YMD), _without(iso, " ").try_cast("date"))


def parse_date(text: Column) -> Column:
    """Year-month-day or day-month-year, split by ``-`` or ``/``."""
    return date_of(year_first(text))


def parse_double(text: Column) -> Column:
    """Plain or scientific notation; single underscores between digits are allowed."""
    return F.when(text.rlike(_NUMBER), _without(text, "_").try_cast("double"))


def fits(value: Column, sql_type: str) -> Column:
    """Whether a decimal of ``sql_type`` can hold the value; false for infinity."""
    precision, scale = (int(n) for n in sql_type[len("decimal("):-1].split(","))
    return F.abs(value) < 10 ** (precision - scale) - 0.5 * 10.0 ** -scale


def float_text(value: Column) -> Column:
    """A double as the error log prints it: shortest digits, plain from 1e-4 to below 1e16."""
    digits = F.regexp_replace(value.cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.regexp_replace(digits, r"\.$", ".0")
    text = F.regexp_replace(F.regexp_replace(value.cast("string"), r"\.0E", "E"), "Infinity", "inf")
    signed = F.regexp_replace(F.regexp_replace(text, r"E(\d)", "e+$1"), "E-", "e-")
    scientific = F.regexp_replace(signed, r"(e.)(\d)$", "$10$2")
    return (F.when(value == 0, "0.0").when(F.abs(value).between(1e-4, 9999999999999998.0), plain)
            .otherwise(scientific))


def truncated(value: Column) -> Column:
    """Integer part, so ``12.0`` is 12 and ``-12.9`` is -12; null beyond 64 bits."""
    return value.try_cast("long")
