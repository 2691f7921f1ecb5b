"""Wide and long nutrient rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary import catalog
from granary.functions import digits_key, lenient_double
from granary.operators.reshape import (
    clean_values,
    fields_for,
    prefer,
    product_rows,
    unpivot_fields,
    wide_values,
)
from granary.registry.base import (
    EXPORT,
    EXPORT_SQL,
    as_text,
    decimal_text,
    derive,
    product_export,
    query,
    select_sql,
    sql_digits,
    sql_double,
    sql_long,
    sql_strip,
    table,
)


def sql_value(field: str, mode: str) -> str:
    """The value of a field's long row."""
    value = sql_double(f'"{field}"')
    if mode == "minimal" and field == catalog.ENERGY_FIELD:
        return f"CASE WHEN \"{catalog.ENERGY_KJ_FIELD}\" = '' THEN {value} END"
    return value


def sql_long_rows(source: str, key: str, mode: str = "minimal", salt: bool = False) -> str:
    """Union of one select per field."""
    fields = fields_for(mode, list(EXPORT), salt)
    return " UNION ALL ".join(
        f"SELECT {key}, '{f.nutrient_key}' AS nutrient_key, {sql_value(f.source_field, mode)} AS value, "
        f"'{f.unit}' AS unit, '{f.source_field}' AS source_field FROM {source} "
        f"WHERE {sql_value(f.source_field, mode)} IS NOT NULL"
        for f in fields
    )


def sql_wide(salt: bool = False) -> str:
    """Select items of the wide nutrient columns."""
    chosen = {f.source_field for f in catalog.nutrient_fields(salt)}
    items = []
    for column in catalog.WIDE_NUTRIENT_COLUMNS:
        feeding = [
            sql_double(f'"{f.source_field}"') for f in catalog.NUTRIENT_FIELDS
            if f.wide_column == column and f.source_field in chosen
        ]
        items.append(f"coalesce({', '.join(feeding)}) AS {column}" if feeding else f"CAST(NULL AS DOUBLE) AS {column}")
    return ", ".join(items)


def sql_products(salt: bool = False) -> str:
    """Select items of the identity columns and wide columns of the export."""
    texts = ", ".join(f"{sql_strip(c)} AS {c}" for c in catalog.PRODUCT_TEXT_FIELDS)
    return (
        f"{sql_digits('code')} AS code_norm, {sql_strip('code')} AS code_raw, {texts}, "
        f"{sql_long('last_modified_t')} AS last_modified_t, {sql_wide(salt)}"
    )


@query("unpivot_minimal", f"WITH e AS ({EXPORT_SQL}) {sql_long_rows('e', 'event_id')}")
def _unpivot_minimal(spark, sf_dir):
    return unpivot_fields(product_export(spark, sf_dir), "event_id")


@query("unpivot_minimal_salt", f"WITH e AS ({EXPORT_SQL}) {sql_long_rows('e', 'event_id', salt=True)}")
def _unpivot_minimal_salt(spark, sf_dir):
    return unpivot_fields(product_export(spark, sf_dir), "event_id", include_salt=True)


@query("unpivot_all", f"WITH e AS ({EXPORT_SQL}) {sql_long_rows('e', 'event_id', 'all')}")
def _unpivot_all(spark, sf_dir):
    return unpivot_fields(product_export(spark, sf_dir), "event_id", "all")


_PRICES = {
    "line": f"{as_text('l_orderkey')} || '-' || {as_text('l_linenumber')} || '-' || {as_text('l_partkey')}",
    "Extended-Price_100g": decimal_text("l_extendedprice"),
    "Discount_100g": f"CASE WHEN l_discount > 0.05 THEN '' ELSE {decimal_text('l_discount')} END",
    "energy_100g": f"CASE l_returnflag WHEN 'A' THEN 'none' ELSE {decimal_text('l_quantity')} END",
}


@query("unpivot_headers", f"""
    WITH p AS ({select_sql(_PRICES, "lineitem")})
    SELECT line, 'extended_price' AS nutrient_key, CAST("Extended-Price_100g" AS DOUBLE) AS value, '' AS unit,
           'Extended-Price_100g' AS source_field FROM p
    UNION ALL SELECT line, 'discount', CAST("Discount_100g" AS DOUBLE), '', 'Discount_100g' FROM p
        WHERE "Discount_100g" <> ''
    UNION ALL SELECT line, 'energy', CAST(energy_100g AS DOUBLE), 'kJ', 'energy_100g' FROM p
        WHERE energy_100g <> 'none'
""")
def _unpivot_headers(spark, sf_dir):
    prices = derive(table(spark, sf_dir, "lineitem"), _PRICES)
    return unpivot_fields(prices, "line", "all")


@query("wide_product", f"WITH e AS ({EXPORT_SQL}) SELECT event_id, {sql_products()} FROM e")
def _wide_product(spark, sf_dir):
    rows, _, _ = product_rows(product_export(spark, sf_dir), keep=["event_id"])
    return rows.select("event_id", *catalog.PRODUCT_SCHEMA.names)


@query("wide_product_salt", f"WITH e AS ({EXPORT_SQL}) SELECT event_id, {sql_digits('code')} AS code_norm, {sql_wide(True)} FROM e")
def _wide_product_salt(spark, sf_dir):
    export = product_export(spark, sf_dir)
    wide = wide_values(clean_values(export, fields_for("minimal", include_salt=True)))
    return export.select(
        "event_id", digits_key(F.col("code")).alias("code_norm"), *[v.alias(c) for c, v in wide.items()]
    )


@query("energy_fallback", f"""
    WITH e AS ({EXPORT_SQL})
    SELECT event_id, "energy-kj_100g" AS kj, energy_100g AS energy,
           coalesce({sql_double('"energy-kj_100g"')}, {sql_double('energy_100g')}) AS energy_kj_100g FROM e
""")
def _energy_fallback(spark, sf_dir):
    kj, energy = F.col("`energy-kj_100g`"), F.col("energy_100g")
    return product_export(spark, sf_dir).select(
        "event_id", kj.alias("kj"), energy.alias("energy"),
        prefer(lenient_double(kj), lenient_double(energy)).alias("energy_kj_100g"),
    )


_ENERGY_ROWS = """
    SELECT source_field, count(*) AS rows FROM ({rows}) l
    WHERE source_field IN ('energy-kj_100g', 'energy_100g') GROUP BY source_field
"""


@query("energy_suppression", f"WITH e AS ({EXPORT_SQL}) " + _ENERGY_ROWS.format(rows=sql_long_rows("e", "event_id")))
def _energy_suppression(spark, sf_dir):
    long = unpivot_fields(product_export(spark, sf_dir), "event_id")
    return (
        long.where(F.col("source_field").isin("energy-kj_100g", "energy_100g"))
        .groupBy("source_field").agg(F.count("*").alias("rows"))
    )
