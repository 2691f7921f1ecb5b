"""Wide product rows to typed wide columns and to long nutrient rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary import catalog
from granary.catalog import NutrientField
from granary.functions.casts import lenient_double, lenient_long
from granary.functions.text import digits_key, drop_nul, strip

MODES = ("minimal", "all")
LONG_PREFIX, CLEAN_PREFIX, RAW_KJ = "_v_", "_c_", "_raw_kj"


def fields_for(
    mode: str, header: Sequence[str] = (), include_salt: bool = False
) -> list[NutrientField]:
    """Nutrient fields to emit: the minimal dimension, or every header with the suffix."""
    if mode not in MODES:
        raise ValueError(f"nutrients must be one of {', '.join(MODES)}")
    if mode == "minimal":
        return list(catalog.nutrient_fields(include_salt))
    wide = {f.source_field: f.wide_column for f in catalog.NUTRIENT_FIELDS}
    return [
        NutrientField(
            name,
            name.removesuffix(catalog.NUTRIENT_SUFFIX).replace("-", "_").lower(),
            catalog.HEADER_UNITS.get(name, ""),
            wide.get(name, ""),
        )
        for name in dict.fromkeys(header)
        if name.endswith(catalog.NUTRIENT_SUFFIX)
    ]


def _cell(name: str, present: Sequence[str]) -> Column:
    return F.col(f"`{name}`") if name in present else F.lit("")


def prefer(primary: Column, fallback: Column) -> Column:
    """The valid primary value, else the valid fallback."""
    return F.coalesce(primary, fallback)


def clean_values(df: DataFrame, fields: Sequence[NutrientField]) -> dict[str, Column]:
    """Every chosen raw cell as a number, null when empty or invalid."""
    return {f.source_field: lenient_double(_cell(f.source_field, df.columns)) for f in fields}


def wide_values(values: Mapping[str, Column]) -> dict[str, Column]:
    """Every wide nutrient column from clean values, null where no chosen field feeds it.

    Two fields feed the kJ column; the dedicated one is preferred whatever the header order.
    """
    out: dict[str, Column] = {}
    for column in catalog.WIDE_NUTRIENT_COLUMNS:
        feeding = [
            values[f.source_field]
            for f in catalog.NUTRIENT_FIELDS
            if f.wide_column == column and f.source_field in values
        ]
        out[column] = reduce(prefer, feeding) if feeding else F.lit(None).cast("double")
    return out


def long_values(values: Mapping[str, Column], mode: str, raw_kj: Column) -> dict[str, Column]:
    """The value each field contributes as a long row, null for none.

    In minimal mode the general energy field gives way to any text in the kJ field, valid or not.
    """
    out = dict(values)
    if mode == "minimal" and catalog.ENERGY_FIELD in out:
        out[catalog.ENERGY_FIELD] = F.when(raw_kj == "", out[catalog.ENERGY_FIELD])
    return out


def emitted_rows(values: Sequence[Column]) -> Column:
    """How many long rows the values give."""
    return reduce(add, [v.isNotNull().cast("int") for v in values], F.lit(0))


def unpivot_values(
    df: DataFrame, keys: Sequence[str], fields: Sequence[NutrientField], columns: Sequence[str]
) -> DataFrame:
    """Long rows from typed value columns, nulls dropped; key, unit and field are literals."""
    cells = [
        part
        for f, c in zip(fields, columns, strict=True)
        for part in (F.lit(f.nutrient_key), F.col(f"`{c}`"), F.lit(f.unit), F.lit(f.source_field))
    ]
    long = F.stack(F.lit(len(fields)), *cells).alias(
        "nutrient_key", "value", "unit", "source_field"
    )
    return df.select(*keys, long).where(F.col("value").isNotNull())


def unpivot_fields(
    df: DataFrame, key: str, mode: str = "minimal", include_salt: bool = False
) -> DataFrame:
    """Raw wide text to ``(key, nutrient_key, value, unit, source_field)``."""
    fields = fields_for(mode, df.columns, include_salt)
    raw_kj = _cell(catalog.ENERGY_KJ_FIELD, df.columns)
    values = long_values(clean_values(df, fields), mode, raw_kj)
    names = [LONG_PREFIX + f.source_field for f in fields]
    typed = df.select(
        key, *[values[f.source_field].alias(n) for f, n in zip(fields, names, strict=True)]
    )
    return unpivot_values(typed, [key], fields, names)


def product_rows(
    df: DataFrame, mode: str = "minimal", include_salt: bool = False, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[NutrientField], list[str]]:
    """Typed product rows with the value columns of their long rows and the emitted count.

    Returns the frame, the emitted fields and the names of their value columns.  Text is stripped
    and stays ``''`` when empty; numbers are null when empty or invalid.
    """
    fields = fields_for(mode, df.columns, include_salt)
    names = [LONG_PREFIX + f.source_field for f in fields]
    clean = {f.source_field: CLEAN_PREFIX + f.source_field for f in fields}
    code = strip(_cell(catalog.PRODUCT_KEY_FIELD, df.columns))
    raw_kj = _cell(catalog.ENERGY_KJ_FIELD, df.columns)
    # each cell is cleaned once; what is built from it below only refers to the result
    once = df.select(
        digits_key(code).alias("code_norm"),
        code.alias("code_raw"),
        *[strip(_cell(c, df.columns)).alias(c) for c in catalog.PRODUCT_TEXT_FIELDS],
        lenient_long(_cell(catalog.PRODUCT_TIME_FIELD, df.columns)).alias(catalog.PRODUCT_TIME_FIELD),
        *[v.alias(clean[f]) for f, v in clean_values(df, fields).items()],
        raw_kj.alias(RAW_KJ),
        *keep,
    )
    values = {f: F.col(f"`{c}`") for f, c in clean.items()}
    wide, long = wide_values(values), long_values(values, mode, F.col(RAW_KJ))
    typed = once.select(
        "code_norm", "code_raw", *catalog.PRODUCT_TEXT_FIELDS, catalog.PRODUCT_TIME_FIELD,
        *[v.alias(c) for c, v in wide.items()],
        *[long[f.source_field].alias(n) for f, n in zip(fields, names, strict=True)],
        emitted_rows(list(long.values())).alias("emitted"),
        *keep,
    )
    return typed, fields, names


def product_table(rows: DataFrame) -> DataFrame:
    """The eighteen product columns in their fixed order, text freed from NUL."""
    text = ("code_raw", *catalog.PRODUCT_TEXT_FIELDS)
    return rows.select(
        *[drop_nul(F.col(c)).alias(c) if c in text else F.col(c) for c in catalog.PRODUCT_SCHEMA.names]
    )


def nutrient_table(
    rows: DataFrame, fields: Sequence[NutrientField], names: Sequence[str]
) -> DataFrame:
    """The long rows of the same product rows, in the fixed column order."""
    return unpivot_values(rows, ["code_norm"], fields, names)
