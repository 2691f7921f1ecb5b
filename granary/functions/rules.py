"""Naming rules: which type a column has, which columns are the key, what a nutrient is called.

Types and keys follow from names alone, never from the data.  Each rule exists once as a Column
expression; the driver-side forms for a single header evaluate the same constants.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary import catalog
from granary.functions.text import BOM, WHITESPACE

_TYPES = {"date": T.DateType(), "double": T.DoubleType(), "bigint": T.LongType(),
          "string": T.StringType()}


def identifier(raw: str) -> str:
    """Driver-side twin of ``normalize_identifier`` for header cells and option values."""
    words = re.findall("[a-z0-9]+", raw.strip(WHITESPACE).lower().replace(BOM, ""))
    name = "_".join(words) or "col"
    return f"c_{name}" if name[0].isdigit() else name


def choose_names(names: Iterable[str], only: Sequence[str] = (), skip: Sequence[str] = ()) -> list[str]:
    """The names that a user's lists leave: names on ``only`` in its order (without one: all, sorted), less
    those on ``skip``.  Spelling is compared as identifiers; nothing left is an error."""
    by_plain = {identifier(n): n for n in sorted(names)}
    asked = dict.fromkeys(map(identifier, only)) or by_plain
    left = asked.keys() - set(map(identifier, skip))
    chosen = [by_plain[plain] for plain in asked if plain in by_plain and plain in left]
    if not chosen:
        raise ValueError("no table or layout is selected")
    return chosen


def unique_identifiers(names: Sequence[str]) -> list[str]:
    """Normalise a header row; the n-th repeat of a name gets the suffix ``_n``.

    A literal header such as ``a_2`` that collides with a numbered repeat of ``a`` is an error.
    """
    repeats: dict[str, Iterator[int]] = defaultdict(lambda: count(1))
    numbered = ((base, next(repeats[base])) for base in map(identifier, names))
    names = [base if n == 1 else f"{base}_{n}" for base, n in numbered]
    if len(set(names)) < len(names):
        raise ValueError(f"headers that share a name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return names


def column_type(table: Column, column: Column) -> Column:
    """The Spark type name of a column, as an expression over an inventory of columns."""
    forced = column.isin(*catalog.TEXT_COLUMNS)
    food_text = F.lit(False)
    for owner, name in catalog.TEXT_TABLE_COLUMNS:
        food_text = food_text | ((table == owner) & (column == name))
    return (
        F.when(food_text, "string")
        .when(column.isin(*catalog.DATE_COLUMNS) | column.endswith("_date"), "date")
        .when(forced, "string")
        .when(column.isin(*catalog.DOUBLE_COLUMNS), "double")
        .when(
            column.isin(*catalog.LONG_COLUMNS, *catalog.ID_COLUMNS) | column.endswith("_id"),
            "bigint",
        )
        .otherwise("string")
    )


def column_type_name(table: str, column: str) -> str:
    """Driver-side twin of :func:`column_type` for one column of one header."""
    if (table, column) in catalog.TEXT_TABLE_COLUMNS:
        return "string"
    if column.endswith("_date"):
        return "date"
    for names, kind in (
        (catalog.DATE_COLUMNS, "date"),
        (catalog.TEXT_COLUMNS, "string"),
        (catalog.DOUBLE_COLUMNS, "double"),
        (catalog.LONG_COLUMNS + catalog.ID_COLUMNS, "bigint"),
    ):
        if column in names:
            return kind
    return "bigint" if column.endswith("_id") else "string"


def infer_schema(table: str, names: Sequence[str]) -> T.StructType:
    """The typed schema of a table with these (already normalised) column names."""
    return T.StructType([T.StructField(n, _TYPES[column_type_name(table, n)]) for n in names])


def primary_key(table: str, names: Sequence[str]) -> list[str]:
    """Key columns of a table, empty when it has none."""
    names = list(names)
    if "id" in names:
        return ["id"]
    if "fdc_id" in names and (table in catalog.ONE_ROW_PER_FOOD or names == ["fdc_id"]):
        return ["fdc_id"]
    columns, must_exist = catalog.TABLE_KEYS.get(table, ((), False))
    return list(columns) if not must_exist or set(columns) <= set(names) else []


def primary_key_names(table: Column, names: Column) -> Column:
    """:func:`primary_key` over an inventory: comma-joined key columns, ``''`` for none."""
    has = lambda name: F.array_contains(names, name)
    out = F.when(has("id"), "id").when(
        has("fdc_id") & (table.isin(*catalog.ONE_ROW_PER_FOOD) | (F.size(names) == 1)), "fdc_id"
    )
    for owner, (columns, must_exist) in catalog.TABLE_KEYS.items():
        applies = table == owner
        if must_exist:
            for name in columns:
                applies = applies & has(name)
        out = out.when(applies, ",".join(columns))
    return out.otherwise("")


def nutrient_key(field: Column) -> Column:
    """Long key of any nutrient header: suffix dropped, dashes to underscores, lower case."""
    bare = F.regexp_replace(field, f"{catalog.NUTRIENT_SUFFIX}$", "")
    return F.lower(F.translate(bare, "-", "_"))


def nutrient_unit(field: Column) -> Column:
    """Unit known from the header alone, else the empty string."""
    out = F.when(F.lit(False), "")
    for name, unit in catalog.HEADER_UNITS.items():
        out = out.when(field == name, unit)
    return out.otherwise("")
