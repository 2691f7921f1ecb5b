"""All-text rows to typed rows, with a report of every cell that does not fit.

A row is checked in this order: its width, then for each column a NUL character, then the type.
Empty cells are null for every type; typed cells are stripped first, text cells are kept as is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.casts import null_if_empty, strict_date, strict_double, strict_long
from granary.functions.text import strip
from granary.sources.delimited import CORRUPT

STRICT_CASTS = {
    T.LongType(): strict_long,
    T.DoubleType(): strict_double,
    T.DateType(): strict_date,
}
WIDTH, NUL = "width", "nul"
POLICIES = ("fail", "quarantine", "report")


_TYPED = "_typed_"


def _raw(field: T.StructField) -> Column:
    return F.col(f"`{field.name}`")


def _typed(field: T.StructField) -> Column:
    return F.col(f"`{_TYPED}{field.name}`")


def _shown(field: T.StructField) -> Column:
    return strip(_raw(field)) if field.dataType in STRICT_CASTS else _raw(field)


def typed_value(field: T.StructField) -> Column:
    """The cell under its target type; null when empty or when it does not fit."""
    cast = STRICT_CASTS.get(field.dataType, null_if_empty)
    return cast(_raw(field))


def with_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the typed form of each cell, so that every check below refers to one evaluation."""
    return df.select("*", *[typed_value(f).alias(_TYPED + f.name) for f in schema])


def reason(field: T.StructField) -> Column:
    """Why a cell does not fit, null when it does; needs :func:`with_typed`."""
    raw = _raw(field)
    out = F.when(raw.isNull() | (raw == ""), F.lit(None)).when(raw.contains("\x00"), NUL)
    if field.dataType in STRICT_CASTS:
        out = out.when(_typed(field).isNull(), f"invalid {field.dataType.simpleString()}")
    return out


def _wrong_width(df: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)


def violations(df: DataFrame, schema: T.StructType, order: Sequence[str] = ()) -> DataFrame:
    """One row per bad cell: ``order`` columns, ``position``, ``column``, ``reason``, ``value``.

    A record of the wrong width gives one row at position 0 with its raw text and nothing else.
    """
    wrong_width = _wrong_width(df)
    cells = [F.lit(0), F.lit(CORRUPT), F.when(wrong_width, WIDTH),
             F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")]
    for position, field in enumerate(schema, 1):
        why = F.when(~wrong_width, reason(field))
        cells += [F.lit(position), F.lit(field.name), why, F.when(why.isNotNull(), _shown(field))]
    entries = F.stack(F.lit(len(schema) + 1), *cells).alias("position", "column", "reason", "value")
    return with_typed(df, schema).select(*order, entries).where(F.col("reason").isNotNull())


def first_violation(df: DataFrame, schema: T.StructType, order: Sequence[str]) -> DataFrame:
    """The violation that a sequential reader would meet first (one row or none)."""
    return violations(df, schema, order).orderBy(*order, "position").limit(1)


def conform(
    df: DataFrame, schema: T.StructType, *, on_error: str = "fail", keep: Sequence[str] = ()
) -> DataFrame:
    """Typed rows under ``schema``, with the columns in ``keep`` carried along.

    ``fail``: the job stops at a bad cell.  ``quarantine``: rows with a bad cell are left out (see
    :func:`violations` for them).  ``report``: all rows stay, cells that do not fit
    their type are null.
    """
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {', '.join(POLICIES)}")
    rows = with_typed(df, schema)
    if on_error == "quarantine":
        bad = reduce(or_, [reason(f).isNotNull() for f in schema], _wrong_width(df))
        rows = rows.where(~bad)
    elif on_error == "fail" and CORRUPT in df.columns:
        message = F.concat(F.lit("record of the wrong width: "), F.col(CORRUPT))
        stop = F.when(_wrong_width(df), F.raise_error(message).cast("boolean"))
        rows = rows.where(stop.otherwise(True))

    def column(field: T.StructField) -> Column:
        value = _typed(field)
        if on_error == "fail":
            why = reason(field)
            message = F.concat(F.lit(f"column {field.name}: "), why, F.lit(": "), _shown(field))
            stop = F.raise_error(message).cast(field.dataType)
            value = F.when(why.isNull(), value).otherwise(stop)
        return value.alias(field.name)

    return rows.select(*[column(f) for f in schema], *keep)


def record_width(record: Column, sep: str = ",") -> Column:
    """How many cells a raw record has, quoted parts aside."""
    bare = F.regexp_replace(record, r'"[^"]*+(?:""[^"]*+)*+"', "")
    return F.length(bare) - F.length(F.translate(bare, sep, "")) + 1
