"""Registration and shared inputs of the queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL with the same result."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in (names or TABLES)}


def fresh_database(spark: SparkSession, label: str) -> str:
    """A new database below the scratch folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{scratch_path(spark, label)}'")
    return name


def select_sql(columns: Mapping[str, str], source: str) -> str:
    """The SQL text that derives ``columns`` from a table."""
    items = ", ".join(f'{expression} AS "{name}"' for name, expression in columns.items())
    return f"SELECT {items} FROM {source}"


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The same columns in Spark."""
    return df.select(*[F.expr(expression).alias(name) for name, expression in columns.items()])


def as_text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def decimal_text(expression: str) -> str:
    return as_text(f"CAST({expression} AS DECIMAL(18,2))")


# --- SQL forms of the cell rules, for the checks ----------------------------------------------


def sql_strip(expression: str) -> str:
    return f"trim({expression}, ' ' || chr(9) || chr(10) || chr(13))"


def sql_double(expression: str) -> str:
    """Lenient float."""
    cell = sql_strip(expression)
    pattern = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return f"CASE WHEN regexp_matches({cell}, '{pattern}') THEN TRY_CAST({cell} AS DOUBLE) END"


def sql_long(expression: str) -> str:
    cell = sql_strip(expression)
    return f"CASE WHEN regexp_matches({cell}, '^-?[0-9]+$') THEN TRY_CAST({cell} AS BIGINT) END"


def sql_digits(expression: str) -> str:
    return f"regexp_replace({expression}, '[^\\p{{Nd}}]', '', 'g')"


def sql_identifier(expression: str) -> str:
    body = (
        f"trim(regexp_replace(lower(trim({expression})), '[^a-z0-9]+', '_', 'g'), '_')"
    )
    return (
        f"CASE WHEN {body} = '' THEN 'col' WHEN regexp_matches({body}, '^[0-9]') "
        f"THEN 'c_' || {body} ELSE {body} END"
    )


# --- a product export derived from the events table -------------------------------------------

_AMOUNT = decimal_text("value")
EXPORT = {
    "event_id": "event_id",
    "code": "CASE event_id % 11 WHEN 0 THEN '' WHEN 1 THEN ' abc ' ELSE "
            f"' 00' || {as_text('user_id')} || '-' || {as_text('event_id % 3')} || ' ' END",
    "product_name": "CASE event_id % 5 WHEN 0 THEN '' ELSE ' ' || event_type || ' ' END",
    "brands": "CASE event_id % 7 WHEN 0 THEN '  ' ELSE props END",
    "categories": "CASE WHEN value > 10 THEN event_type ELSE '' END",
    "quantity": f"{_AMOUNT} || ' g'",
    "serving_size": "CASE event_id % 2 WHEN 0 THEN '' ELSE '100 g' END",
    "last_modified_t": "CASE event_id % 13 WHEN 0 THEN '' WHEN 1 THEN '-5' WHEN 2 THEN 'n/a' "
                       f"ELSE {as_text('1704067200 + event_id % 50')} END",
    "energy-kcal_100g": _AMOUNT,
    "energy-kj_100g": "CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'abc' "
                      f"WHEN 2 THEN ' ' || {_AMOUNT} || ' ' ELSE '1e+2' END",
    "energy_100g": "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '+5' ELSE '.5' END",
    "fat_100g": f"CASE event_id % 6 WHEN 0 THEN '1d' WHEN 1 THEN '5.' ELSE {_AMOUNT} END",
    "saturated-fat_100g": "''",
    "carbohydrates_100g": f"CASE event_id % 9 WHEN 0 THEN 'x' ELSE {as_text('user_id')} END",
    "sugars_100g": "CASE event_id % 8 WHEN 0 THEN '1_000' ELSE '-1.25E-2' END",
    "fiber_100g": "CASE event_id % 2 WHEN 0 THEN '0' ELSE '' END",
    "proteins_100g": as_text("user_id % 50"),
    "sodium_100g": "CASE WHEN event_type = 'error' THEN '0.1' ELSE '' END",
    "salt_100g": "'2'",
    "Vitamin-C_100g": "CASE event_id % 10 WHEN 0 THEN '60' ELSE '' END",
}
EXPORT_SQL = select_sql(EXPORT, "events")
EXPORT_ORDER = ("event_id",)
EXPORT_BLOCK = "event_id DIV 1000000"


def product_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "events"), EXPORT)
