"""Text helpers: whitespace, blanks and catalogue lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character that counts as whitespace at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_CLOSED = r"\A[!-~](.*[!-~])?\z"


def strip(col: Column) -> Column:
    """Drop whitespace of any kind from both ends (``trim`` alone drops spaces only).

    Text with a printable ASCII sign at either end has none there, which takes less to see than to trim.
    """
    return F.when(col.rlike(_CLOSED), col).otherwise(F.btrim(col, F.lit(WHITESPACE)))


def is_blank(stripped: Column) -> Column:
    """True for null or empty; text must be stripped first, so whitespace counts as empty."""
    return stripped.isNull() | (stripped == "")


def catalog_value(text: Column, catalog: dict[str, str]) -> Column:
    """Canonical label of stripped text, or null when the catalogue does not know it."""
    pairs = [F.lit(x) for kv in catalog.items() for x in kv]
    return F.create_map(*pairs)[F.lower(text)]
