"""Text clean-up as Column functions (Column in, Column out, no Python on the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the code points that count as white space at the ends of a cell
WHITESPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# fixed values: digits that are not decimal digits (superscripts, circled digits, ...), as hex ranges
OTHER_DIGITS = (
    "B2-B3 B9 1369-1371 19DA 2070 2074-2079 2080-2089 2460-2468 2474-247C 2488-2490 24EA "
    "24F5-24FD 24FF 2776-277E 2780-2788 278A-2792 10A40-10A43 10E60-10E68 11052-1105A 1F100-1F10A"
)


def _regex_ranges(ranges: str) -> str:
    ends = (item.split("-") for item in ranges.split())
    return "".join("-".join(rf"\x{{{end}}}" for end in pair) for pair in ends)


# a run of anything but digits; ASCII is tested on its own, since the full class is slow, and nothing
# is given back, so long texts need no stack
NOT_DIGITS = (
    r"(?:[\x00-\x2F\x3A-\x7F]++"
    rf"|[^\x00-\x7F\p{{Nd}}{_regex_ranges(OTHER_DIGITS)}]++)++"
)
BOM = "\ufeff"


def strip(col: Column) -> Column:
    """Drop white space, including the ASCII separators U+001C-U+001F, from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def normalize_identifier(col: Column) -> Column:
    """Turn a raw header or table name into a lower-case ``[a-z0-9_]`` identifier.

    Every run of other characters becomes one underscore, none is left at the ends, an empty
    result becomes ``col`` and a leading digit gets the prefix ``c_``.
    """
    joined = F.regexp_replace(
        F.replace(F.lower(strip(col)), F.lit(BOM), F.lit("")), "[^a-z0-9]+", "_"
    )
    body = F.btrim(joined, F.lit("_"))
    return (
        F.when(body == "", F.lit("col"))
        .when(body.rlike("^[0-9]"), F.concat(F.lit("c_"), body))
        .otherwise(body)
    )


def normalize_layout_name(col: Column) -> Column:
    """Normalise the name of an access path: lower case, dashes become underscores."""
    return F.translate(F.lower(strip(col)), "-", "_")


def digits_key(col: Column) -> Column:
    """Keep only the digits of a code, with leading zeros; the result stays text."""
    return F.regexp_replace(col, NOT_DIGITS, "")


def digits_struct(col: Column) -> Column:
    """The stripped code, its digits-only form and how many digits that has."""
    key = digits_key(col)
    return F.struct(
        strip(col).alias("raw"), key.alias("normalized"), F.length(key).alias("digits")
    )


def drop_nul(col: Column) -> Column:
    return F.translate(col, "\x00", "")


# fixed values: control characters of delimited text exports and their escapes, backslash first
TEXT_ESCAPES = (
    ("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\b", "\\b"), ("\f", "\\f"),
    ("\v", "\\v"),
)


def escape_text(col: Column, null_marker: str | None = None) -> Column:
    """Escape a text cell for a tab-delimited bulk load; NUL is dropped.

    With ``null_marker`` a null cell becomes that marker.
    """
    out = drop_nul(col)
    for char, escaped in TEXT_ESCAPES:
        out = F.replace(out, F.lit(char), F.lit(escaped))
    return out if null_marker is None else F.coalesce(out, F.lit(null_marker))
