"""Strict and lenient casts from raw text.

The session may run in ANSI mode, so every cast of raw text is a ``try_cast`` behind a pattern:
Spark's own cast accepts more spellings (``1d``, ``+5``) than these rules do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.text import strip

# fixed values: accepted spellings; \z and not $, which also matches before a line end
LONG_PATTERN = r"^-?[0-9]+\z"
DOUBLE_PATTERN = r"^-?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE]-?[0-9]+)?\z"
LENIENT_DOUBLE_PATTERN = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
SPECIAL_DOUBLE_PATTERN = r"^[+-]?(?:inf|infinity|nan)\z"
ISO_DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
SLASH_DATE_PATTERN = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"


def strict_long(col: Column) -> Column:
    """Digits with an optional minus; anything else is null."""
    text = strip(col)
    return F.when(text.rlike(LONG_PATTERN), text.try_cast("bigint"))


def strict_double(col: Column) -> Column:
    """Plain decimal or exponent notation without any plus sign; anything else is null."""
    text = strip(col)
    return F.when(text.rlike(DOUBLE_PATTERN), text.try_cast("double"))


def strict_date(col: Column) -> Column:
    """``yyyy-MM-dd`` or ``M/D/yyyy``; other spellings and impossible dates are null."""
    text = strip(col)
    return F.when(text.rlike(ISO_DATE_PATTERN), F.try_to_date(text, "yyyy-MM-dd")).when(
        text.rlike(SLASH_DATE_PATTERN), F.try_to_date(text, "M/d/yyyy")
    )


def lenient_double(col: Column) -> Column:
    """Any ordinary float spelling, signed, with infinities and NaN; anything else is null."""
    text = strip(col)
    lowered = F.lower(text)
    return (
        F.when(col == "", F.lit(None))  # most cells of a wide export are empty, most others plain
        .when(col.rlike(LENIENT_DOUBLE_PATTERN), col.try_cast("double"))
        .when((text != col) & text.rlike(LENIENT_DOUBLE_PATTERN), text.try_cast("double"))
        .when(
            lowered.rlike(SPECIAL_DOUBLE_PATTERN),
            F.when(lowered.endswith("nan"), F.lit(float("nan"))).otherwise(lowered.try_cast("double")),
        )
    )


def lenient_long(col: Column) -> Column:
    """Same spellings as :func:`strict_long`; bad cells are dropped rather than reported."""
    return strict_long(col)


def null_if_empty(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))
