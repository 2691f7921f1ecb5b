"""Scalar functions and naming rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import (
    column_type,
    digits_struct,
    escape_text,
    lenient_double,
    lenient_long,
    normalize_identifier,
    normalize_layout_name,
    null_if_empty,
    nutrient_key,
    nutrient_unit,
    strict_date,
    strict_double,
    strict_long,
    strip,
    text_or_empty,
)
from granary.functions.rules import primary_key_names
from granary.functions.text import drop_nul
from granary.operators.dedupe import numbered_repeats, unique_identifier_rows
from granary.registry.base import (
    as_text,
    decimal_text,
    derive,
    query,
    select_sql,
    sql_digits,
    sql_double,
    sql_identifier,
    sql_long,
    sql_strip,
    table,
)
from granary.sources.delimited import detect_delimiter

_HEADERS_SQL = """
    SELECT DISTINCT raw FROM (
        SELECT p_type AS raw FROM part UNION ALL SELECT p_name FROM part
        UNION ALL SELECT p_brand FROM part UNION ALL SELECT c_name FROM customer
        UNION ALL SELECT o_orderpriority FROM orders UNION ALL SELECT url FROM pages
        UNION ALL SELECT '  ' || c_mktsegment || '. ' FROM customer
        UNION ALL SELECT '#' FROM region) t
"""


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name, column: table(spark, sf_dir, name).select(F.expr(column).alias("raw"))
    parts = [
        t("part", "p_type"), t("part", "p_name"), t("part", "p_brand"), t("customer", "c_name"),
        t("orders", "o_orderpriority"), t("pages", "url"),
        t("customer", "'  ' || c_mktsegment || '. '"), t("region", "'#'"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


@query("identifier_normalize", f"SELECT raw, {sql_identifier('raw')} AS ident FROM ({_HEADERS_SQL}) h")
def _identifier_normalize(spark, sf_dir):
    return _headers(spark, sf_dir).select("raw", normalize_identifier(F.col("raw")).alias("ident"))


@query("identifier_unique", f"""
    SELECT p_partkey AS pos, p_brand AS owner,
           CASE WHEN n = 1 THEN base ELSE base || '_' || CAST(n AS VARCHAR) END AS ident
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, base ORDER BY p_partkey) AS n
          FROM (SELECT p_partkey, p_brand, {sql_identifier("p_name || '.' || p_type")} AS base FROM part) a) b
""")
def _identifier_unique(spark, sf_dir):
    base = normalize_identifier(F.expr("p_name || '.' || p_type")).alias("ident")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pos"), F.col("p_brand").alias("owner"), base
    )
    return unique_identifier_rows(part, "ident", "pos", ["owner"]).select("pos", "owner", "ident")


@query("numbered_repeats", """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events
""")
def _numbered_repeats(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return numbered_repeats(events, ["event_type"], "event_id").withColumn("n", F.col("n").cast("bigint"))


@query("layout_name_normalize", """
    SELECT raw, replace(lower(trim(raw)), '-', '_') AS name, count(*) AS uses
    FROM (SELECT ' ' || o_orderpriority || '-IDX ' AS raw FROM orders) o GROUP BY 1, 2
""")
def _layout_name_normalize(spark, sf_dir):
    raw = F.expr("' ' || o_orderpriority || '-IDX '")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(raw.alias("raw"), normalize_layout_name(raw).alias("name"))
        .agg(F.count("*").alias("uses"))
    )


# an inventory of columns: real column names of the rules, and words with every kind of suffix
_NAMES = (
    "id", "fdc_id", "foodid", "food_category_id", "publication_date", "last_updated", "gtin_upc",
    "ndb_number", "upc_code", "amount", "median", "nutrient_nbr", "rank", "data_points", "seq_num",
    "wweia_category_code", "food_group_id", "description", "min_value",
)
_OWNERS = ("food", "branded_food", "food_nutrient", "microbe")
_SUFFIXES = ("", "_id", "_date", "_code", "_number", "_nbr")


def _pick(values: tuple[str, ...], index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


_INVENTORY = {
    "owner": _pick(_OWNERS, "l_orderkey % 4"),
    "name": f"CASE WHEN l_linenumber = 1 THEN lower(l_returnflag) || {_pick(_SUFFIXES, 'l_suppkey % 6')} "
            f"ELSE {_pick(_NAMES, 'l_partkey % 19')} END",
}
_INVENTORY_SQL = select_sql(_INVENTORY, "lineitem")


@query("column_type_rules", f"""
    SELECT owner, name, count(*) AS uses,
      CASE WHEN owner = 'food' AND name = 'food_category_id' THEN 'string'
           WHEN name IN ('publication_date', 'last_updated') OR name LIKE '%\\_date' ESCAPE '\\' THEN 'date'
           WHEN name IN ('gtin_upc', 'ndb_number', 'upc_code') THEN 'string'
           WHEN name IN ('amount', 'median', 'nutrient_nbr', 'rank') THEN 'double'
           WHEN name IN ('data_points', 'seq_num', 'wweia_category_code', 'food_group_id', 'id', 'foodid')
                OR name LIKE '%\\_id' ESCAPE '\\' THEN 'bigint'
           ELSE 'string' END AS column_type
    FROM ({_INVENTORY_SQL}) i GROUP BY owner, name
""")
def _column_type_rules(spark, sf_dir):
    inventory = derive(table(spark, sf_dir, "lineitem"), _INVENTORY)
    return (
        inventory.groupBy("owner", "name").agg(F.count("*").alias("uses"))
        .withColumn("column_type", column_type(F.col("owner"), F.col("name")))
    )


_KEYED = {
    "number": "l_orderkey",
    "owner": _pick(
        ("food", "branded_food", "lab_method_code", "acquisition_samples", "market_acquisition",
         "food_calorie_conversion_factor", "sub_sample_result", "lab_method_nutrient",
         "survey_fndds_food", "food_protein_conversion_factor", "sample_food"),
        "l_orderkey % 11"),
    "name": _pick(
        ("fdc_id", "acquisition_number", "food_nutrient_conversion_factor_id", "code", "value", "fdc_id",
         "id", "fdc_id", "description"), "l_partkey % 9"),
}


@query("primary_key_rules", f"""
    SELECT number, owner, CASE
        WHEN has_id THEN 'id'
        WHEN has_fdc AND (owner IN ('branded_food', 'survey_fndds_food') OR names = 1) THEN 'fdc_id'
        WHEN owner = 'acquisition_samples' THEN 'fdc_id_of_sample_food,fdc_id_of_acquisition_food'
        WHEN owner = 'lab_method_code' THEN 'lab_method_id,code'
        WHEN owner = 'lab_method_nutrient' THEN 'lab_method_id,nutrient_id'
        WHEN owner = 'sub_sample_result' THEN 'food_nutrient_id,lab_method_id'
        WHEN owner = 'market_acquisition' AND has_fdc AND has_number THEN 'fdc_id,acquisition_number'
        WHEN owner IN ('food_calorie_conversion_factor', 'food_protein_conversion_factor') AND has_factor
            THEN 'food_nutrient_conversion_factor_id'
        ELSE '' END AS key
    FROM (SELECT number, owner, count(DISTINCT name) AS names, bool_or(name = 'id') AS has_id,
                 bool_or(name = 'fdc_id') AS has_fdc, bool_or(name = 'acquisition_number') AS has_number,
                 bool_or(name = 'food_nutrient_conversion_factor_id') AS has_factor
          FROM ({select_sql(_KEYED, "lineitem")}) i GROUP BY number, owner) g
""")
def _primary_key_rules(spark, sf_dir):
    inventory = derive(table(spark, sf_dir, "lineitem"), _KEYED)
    return (
        inventory.groupBy("number", "owner").agg(F.collect_set("name").alias("names"))
        .select("number", "owner", primary_key_names(F.col("owner"), F.col("names")).alias("key"))
    )


_CODES_SQL = """
    SELECT 'customer' AS source, c_custkey AS id, ' ' || c_name || ' ' AS raw FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'documents', doc_id, text FROM documents
    UNION ALL SELECT 'pages', page_id, url FROM pages
"""


@query("digits_key", f"""
    SELECT source, id, {sql_strip('raw')} AS code_raw, {sql_digits('raw')} AS code_norm,
           CAST(length({sql_digits('raw')}) AS BIGINT) AS digits
    FROM ({_CODES_SQL}) c
""")
def _digits_key(spark, sf_dir):
    part = lambda source, key, raw: table(spark, sf_dir, source).select(
        F.lit(source).alias("source"), F.col(key).alias("id"), F.expr(raw).alias("raw"))
    codes = (
        part("customer", "c_custkey", "' ' || c_name || ' '")
        .unionByName(part("supplier", "s_suppkey", "s_name"))
        .unionByName(part("documents", "doc_id", "text"))
        .unionByName(part("pages", "page_id", "url"))
    )
    return codes.select("source", "id", digits_struct(F.col("raw")).alias("k")).select(
        "source", "id", F.col("k.raw").alias("code_raw"), F.col("k.normalized").alias("code_norm"),
        F.col("k.digits").cast("bigint").alias("digits"),
    )


_NUMBERS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "raw": "CASE (l_partkey + l_linenumber) % 14 WHEN 0 THEN '+5' WHEN 1 THEN '1e+5' WHEN 2 THEN '5.' "
           "WHEN 3 THEN '.5' WHEN 4 THEN '1d' WHEN 5 THEN '1_000' WHEN 6 THEN '   ' WHEN 7 THEN '' "
           f"WHEN 8 THEN ' -' || {as_text('l_partkey')} || ' ' WHEN 9 THEN '1E-3' WHEN 10 THEN '--1' "
           f"WHEN 11 THEN {as_text('l_orderkey')} ELSE {decimal_text('l_extendedprice')} END",
}
_STRICT = r"^-?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE]-?[0-9]+)?$"


@query("strict_cast", f"""
    SELECT l_orderkey, l_linenumber, raw, {sql_long('raw')} AS as_long,
           CASE WHEN regexp_matches({sql_strip('raw')}, '{_STRICT}')
                THEN TRY_CAST({sql_strip('raw')} AS DOUBLE) END AS as_double
    FROM ({select_sql(_NUMBERS, "lineitem")}) n
""")
def _strict_cast(spark, sf_dir):
    raw = F.col("raw")
    return derive(table(spark, sf_dir, "lineitem"), _NUMBERS).select(
        "l_orderkey", "l_linenumber", "raw", strict_long(raw).alias("as_long"),
        strict_double(raw).alias("as_double"),
    )


@query("lenient_cast", f"""
    SELECT l_orderkey, l_linenumber, raw, {sql_long('raw')} AS as_long, {sql_double('raw')} AS as_double
    FROM ({select_sql(_NUMBERS, "lineitem")}) n
""")
def _lenient_cast(spark, sf_dir):
    raw = F.col("raw")
    return derive(table(spark, sf_dir, "lineitem"), _NUMBERS).select(
        "l_orderkey", "l_linenumber", "raw", lenient_long(raw).alias("as_long"),
        lenient_double(raw).alias("as_double"),
    )


_Y, _M, _D = (as_text(f"{part}(o_orderdate)") for part in ("year", "month", "day"))
DATES = {
    "o_orderkey": "o_orderkey",
    "raw": f"CASE o_orderkey % 7 WHEN 0 THEN {_M} || '/' || {_D} || '/' || {_Y} WHEN 1 THEN 'Jan 2' "
           f"WHEN 2 THEN '2020-02-30' WHEN 3 THEN ' ' || {_Y} || '-0' || substr({_D}, 1, 1) || '-01 ' "
           f"WHEN 4 THEN '13/1/' || {_Y} WHEN 5 THEN '' ELSE {_Y} || '-' || lpad({_M}, 2, '0') || '-' "
           f"|| lpad({_D}, 2, '0') END",
}


def sql_date(raw: str) -> str:
    cell = f"trim({raw})"
    return (
        f"CASE WHEN regexp_matches({cell}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
        f"THEN CAST(TRY_CAST({cell} AS DATE) AS VARCHAR) "
        f"WHEN regexp_matches({cell}, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$') "
        f"THEN CAST(CAST(try_strptime({cell}, '%m/%d/%Y') AS DATE) AS VARCHAR) END"
    )


@query("date_normalize", f"""
    SELECT o_orderkey, raw, {sql_date('raw')} AS iso FROM ({select_sql(DATES, "orders")}) d
""")
def _date_normalize(spark, sf_dir):
    return derive(table(spark, sf_dir, "orders"), DATES).select(
        "o_orderkey", "raw", strict_date(F.col("raw")).cast("string").alias("iso")
    )


_CELLS = {
    "c_custkey": "c_custkey",
    "raw": f"CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN chr(9) || c_name || chr(10) "
           f"WHEN 3 THEN NULL ELSE ' ' || {decimal_text('c_acctbal')} END",
}


@query("empty_cells", f"""
    SELECT c_custkey, nullif(raw, '') AS as_null, coalesce(raw, '') AS as_text,
           {sql_strip('raw')} AS stripped, coalesce(replace(raw, 'Customer', ''), '') AS without
    FROM ({select_sql(_CELLS, "customer")}) c
""")
def _empty_cells(spark, sf_dir):
    raw = F.col("raw")
    with_nul = F.replace(raw, F.lit("Customer"), F.lit("\x00"))
    return derive(table(spark, sf_dir, "customer"), _CELLS).select(
        "c_custkey", null_if_empty(raw).alias("as_null"), text_or_empty(raw).alias("as_text"),
        strip(raw).alias("stripped"), text_or_empty(drop_nul(with_nul)).alias("without"),
    )


_ESCAPED = "text"
for _char, _name in ((92, "\\"), (9, "t"), (10, "n"), (13, "r"), (8, "b"), (12, "f"), (11, "v")):
    _ESCAPED = f"replace({_ESCAPED}, chr({_char}), '\\{_name}')"


@query("text_escape", f"SELECT doc_id, {_ESCAPED} AS cell FROM documents")
def _text_escape(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", escape_text(F.col("text")).alias("cell"))


_FIELDS = {
    "field": "CASE l_partkey % 5 WHEN 0 THEN 'energy-kj_100g' WHEN 1 THEN 'energy_100g' "
             "WHEN 2 THEN 'energy-kcal_100g' ELSE l_returnflag || '-' || l_linestatus || "
             f"{as_text('l_suppkey')} || '_100g' END",
}


@query("nutrient_names", f"""
    SELECT field, count(*) AS uses, lower(replace(regexp_replace(field, '_100g$', ''), '-', '_')) AS nutrient_key,
           CASE WHEN field IN ('energy-kj_100g', 'energy_100g') THEN 'kJ'
                WHEN field = 'energy-kcal_100g' THEN 'kcal' ELSE '' END AS unit
    FROM ({select_sql(_FIELDS, "lineitem")}) f GROUP BY field
""")
def _nutrient_names(spark, sf_dir):
    fields = derive(table(spark, sf_dir, "lineitem"), _FIELDS).groupBy("field").agg(F.count("*").alias("uses"))
    return fields.select(
        "field", "uses", nutrient_key(F.col("field")).alias("nutrient_key"),
        nutrient_unit(F.col("field")).alias("unit"),
    )


_LINES_SQL = """
    SELECT 'documents' AS source, doc_id AS id, text FROM documents
    UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations
    UNION ALL SELECT 'pages', page_id, replace(html, '<', chr(9)) FROM pages
"""


@query("delimiter_detect", f"""
    SELECT source, id, CASE WHEN length(replace(text, chr(9), '')) > length(replace(text, ',', ''))
                            THEN 'comma' ELSE 'tab' END AS delimiter
    FROM ({_LINES_SQL}) t
""")
def _delimiter_detect(spark, sf_dir):
    part = lambda source, key, text: table(spark, sf_dir, source).select(
        F.lit(source).alias("source"), F.expr(key).alias("id"), F.expr(text).alias("text"))
    lines = (
        part("documents", "doc_id", "text")
        .unionByName(part("conversations", "conv_id * 1000 + turn", "text"))
        .unionByName(part("pages", "page_id", "replace(html, '<', chr(9))"))
    )
    name = F.when(detect_delimiter(F.col("text")) == ",", "comma").otherwise("tab")
    return lines.select("source", "id", name.alias("delimiter"))
