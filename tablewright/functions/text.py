"""Scalar expressions, all built in so that they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a Unicode strip removes, including the four separator
# control characters.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(value: Column) -> Column:
    """Remove Unicode whitespace at both ends; a plain ``trim`` only knows U+0020."""
    return F.btrim(value, F.lit(WHITESPACE))


def lower_strip(value: Column) -> Column:
    return F.lower(strip_whitespace(value))


def strip_underscores(value: Column) -> Column:
    return F.ltrim(value, F.lit("_"))


def drop_prefix(value: Column, prefix: str) -> Column:
    """Remove ``prefix`` once from the front, if it is there."""
    return F.when(
        value.startswith(prefix), F.substring(value, len(prefix) + 1, 2**31 - 1)
    ).otherwise(value)


def comma_join(values: Column) -> Column:
    return F.array_join(values, ",")


def is_filled(value: Column) -> Column:
    """Neither null nor the empty string."""
    return value.isNotNull() & (value != "")


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole, null for an empty whole."""
    return F.try_divide(100.0 * part, whole)
