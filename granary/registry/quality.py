"""Checks of keys, references, counts and coverage."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from granary.catalog import Edge
from granary.functions import normalize_identifier
from granary.operators.dedupe import with_key
from granary.operators.quality import (
    GateError,
    anomaly_counts,
    check_not_null,
    check_unique,
    coverage_by_table,
    dictionary_coverage,
    identity_status,
    import_stats,
    missing_references,
    reconcile_counts,
    repeated_keys,
    row_counts,
    tables_not_mentioned,
    throughput,
    top_missing,
    without_null,
)
from granary.operators.reshape import product_rows, unpivot_fields
from granary.registry.base import (
    EXPORT_SQL,
    TABLES,
    as_text,
    derive,
    fresh_database,
    product_export,
    query,
    select_sql,
    sql_double,
    table,
    tables,
)
from granary.registry.duplicates import _TYPED
from granary.registry.reshape import sql_long_rows
from granary.sinks.tables import create_table, read_table, write_table
from granary.sources.bundle import select_table_rows

# child keys with injected nulls and dangling values
_LINES = {
    "l_orderkey": "CASE WHEN l_linenumber = 7 THEN l_orderkey + 100000000 ELSE l_orderkey END",
    "l_partkey": "CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_partkey END",
    "l_suppkey": "l_suppkey",
    "part_text": f"CASE WHEN l_suppkey % 8 = 0 THEN 'Oils Edible' ELSE {as_text('l_partkey')} END",
}
_ORDERS = {"o_orderkey": "o_orderkey", "o_custkey": "CASE WHEN o_orderkey % 4 = 0 THEN 0 - o_custkey ELSE o_custkey END"}
_EDGES = (
    Edge("lines", "l_orderkey", "orders", "o_orderkey"),
    Edge("lines", "l_partkey", "part", "p_partkey"),
    Edge("lines", "l_suppkey", "supplier", "s_suppkey"),
    Edge("lines", "part_text", "part", "p_partkey"),
    Edge("orders", "o_custkey", "customer", "c_custkey"),
    Edge("customer", "c_nationkey", "nation", "n_nationkey"),
    Edge("supplier", "s_nationkey", "nation", "n_nationkey"),
    Edge("nation", "n_regionkey", "region", "r_regionkey"),
    Edge("labels", "doc_id", "documents", "doc_id"),
)
_RELATIONS = (
    f"WITH lines AS ({select_sql(_LINES, 'lineitem')}), changed AS ({select_sql(_ORDERS, 'orders')}) "
)


def _sql_missing(edge: Edge, ignore_null: bool) -> str:
    child = "changed" if edge.child == "orders" else edge.child
    key = f"TRY_CAST(c.{edge.child_key} AS BIGINT)" if edge.child_key == "part_text" else f"c.{edge.child_key}"
    extra = f" AND c.{edge.child_key} IS NOT NULL" if ignore_null else ""
    distinct = f"coalesce(CAST({key} AS VARCHAR), 'null')"
    return (
        f"SELECT '{edge.name}' AS edge, count(*) AS missing_rows, count(DISTINCT {distinct}) AS missing_keys "
        f"FROM {child} c LEFT JOIN {edge.parent} p ON p.{edge.parent_key} = {key} "
        f"WHERE p.{edge.parent_key} IS NULL{extra}"
    )


def _related(spark, sf_dir):
    t = tables(spark, sf_dir, "orders", "part", "supplier", "customer", "nation", "region", "labels", "documents")
    return {
        **t,
        "lines": derive(table(spark, sf_dir, "lineitem"), _LINES),
        "orders": derive(t["orders"], _ORDERS),
    }


@query("missing_refs", _RELATIONS + " UNION ALL ".join(_sql_missing(e, False) for e in _EDGES))
def _missing_refs(spark, sf_dir):
    return missing_references(_related(spark, sf_dir), _EDGES)


@query("missing_refs_nonnull", _RELATIONS + " UNION ALL ".join(_sql_missing(e, True) for e in _EDGES))
def _missing_refs_nonnull(spark, sf_dir):
    return missing_references(_related(spark, sf_dir), _EDGES, ignore_null=True)


_KEYS = (
    ("customer", ("c_custkey",)), ("supplier", ("s_suppkey",)), ("part", ("p_partkey",)),
    ("orders", ("o_orderkey",)), ("lineitem", ("l_orderkey", "l_linenumber")), ("events", ("event_id",)),
    ("events", ("user_id",)), ("documents", ("doc_id",)), ("labels", ("doc_id",)), ("pages", ("page_id",)),
    ("pages", ("url",)), ("conversations", ("conv_id", "turn")), ("benchmark", ("item_id",)),
    ("embeddings", ("vec_id",)), ("nation", ("n_nationkey",)), ("region", ("r_regionkey",)),
)


@query("key_uniqueness", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{','.join(k)}' AS key, count(*) AS repeated_keys, "
    f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows "
    f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1) g"
    for t, k in _KEYS))
def _key_uniqueness(spark, sf_dir):
    return check_unique([(t, table(spark, sf_dir, t), k) for t, k in _KEYS])


@query("repeated_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def _repeated_keys(spark, sf_dir):
    return repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_NULLABLE = {
    "lineitem": {
        "l_orderkey": "l_orderkey", "l_partkey": "nullif(l_partkey, 7)",
        "l_suppkey": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END",
    },
    "orders": {"o_orderkey": "o_orderkey", "o_custkey": "nullif(o_custkey, 3)"},
    "events": {"event_id": "event_id", "user_id": "CASE WHEN event_type = 'error' THEN NULL ELSE user_id END"},
}


@query("null_keys", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) FILTER (({e}) IS NULL) AS null_rows FROM {t}"
    for t, columns in _NULLABLE.items() for c, e in columns.items()))
def _null_keys(spark, sf_dir):
    return check_not_null({
        t: (derive(table(spark, sf_dir, t), columns), list(columns)) for t, columns in _NULLABLE.items()
    })


_PORTIONS = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
    "fdc_id": "CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_partkey END",
    "unit_id": "CASE WHEN l_partkey % 20 = 0 OR l_suppkey % 30 = 0 THEN NULL ELSE l_suppkey END",
}


@query("anomaly_counts", f"""
    SELECT count(*) AS rows, count(*) FILTER (fdc_id IS NULL) AS null_fdc_id,
           count(*) FILTER (unit_id IS NULL) AS null_unit_id,
           count(*) FILTER (fdc_id IS NULL AND unit_id IS NULL) AS null_all
    FROM ({select_sql(_PORTIONS, "lineitem")}) p
""")
def _anomaly_counts(spark, sf_dir):
    return anomaly_counts(derive(table(spark, sf_dir, "lineitem"), _PORTIONS), ["fdc_id", "unit_id"])


@query("anomaly_filter", f"""
    SELECT l_orderkey, l_linenumber, fdc_id, unit_id FROM ({select_sql(_PORTIONS, "lineitem")}) p WHERE fdc_id IS NOT NULL
""")
def _anomaly_filter(spark, sf_dir):
    return without_null(derive(table(spark, sf_dir, "lineitem"), _PORTIONS), "fdc_id")


@query("empty_code_filter", f"SELECT event_id, code_norm, code_raw FROM ({_TYPED}) t WHERE code_norm <> ''")
def _empty_code_filter(spark, sf_dir):
    rows, _, _ = product_rows(product_export(spark, sf_dir), keep=["event_id"])
    return with_key(rows).select("event_id", "code_norm", "code_raw")


_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in TABLES)


@query("row_counts", _COUNTS_SQL)
def _row_counts(spark, sf_dir):
    return row_counts(tables(spark, sf_dir))


_RECONCILED = {
    # table: rows that its count file gives, and what its load comes to
    "customer": ("n", "n", "already loaded"), "orders": ("n", "0", "not loaded"), "labels": ("n", "2 * n", "too many rows"),
    "pages": ("n - 1", "n", "already loaded"), "supplier": (None, "n", "no expectation"),
}


@query("reconcile_counts", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", CAST({loaded} AS BIGINT) AS loaded_rows, CAST({expected or 'NULL'} AS BIGINT) AS expected_rows,
        CASE WHEN {loaded} > {expected or 'NULL'} THEN n END AS recounted_rows,
        coalesce({loaded} > {expected or 'NULL'}, false) AS expected_rows_mismatch, '{status}' AS status FROM (SELECT count(*) AS n FROM {t}) c"""
    for t, (expected, loaded, status) in _RECONCILED.items()
) + """
    UNION ALL SELECT 'documents', count(*) FILTER (doc_id % 3 = 0), count(*), NULL, false, 'partly loaded' FROM documents
    UNION ALL SELECT 'absent', 0, 5, NULL, false, 'not loaded'
""")
def _reconcile_counts(spark, sf_dir):
    """Whole tables are loaded: one as it should be, one refused by a check, one twice, one of which a delivery is missing."""
    t = tables(spark, sf_dir, *_RECONCILED, "documents")
    db = fresh_database(spark, "reconcile_counts")

    def refuse(rows):
        raise GateError("refused")

    for name, df in t.items():
        create_table(spark, db, name, df.schema)
        with contextlib.suppress(GateError):
            rows = df.where("doc_id % 3 = 0") if name == "documents" else df
            write_table(rows, db, name, check=refuse if name == "orders" else None)
    write_table(t["labels"], db, "labels")
    source = row_counts(t).withColumnRenamed("rows", "source_rows")
    less = F.col("source_rows") - F.when(F.col("table") == "pages", 1).otherwise(0)
    expected = source.where("table <> 'supplier'").select("table", less.alias("expected_rows")).unionByName(
        spark.createDataFrame([("absent", 5)], "table string, expected_rows long")
    )
    return reconcile_counts(row_counts({n: read_table(spark, db, n) for n in t}), expected, source)


_MINIMAL_ROWS = sql_long_rows("e", "event_id")


@query("import_stats", f"""
    WITH e AS ({EXPORT_SQL}), t AS ({_TYPED})
    SELECT count(*) AS products, count(*) FILTER (code_raw = '') AS missing_code_raw,
           round(100.0 * count(*) FILTER (code_raw = '') / count(*), 4) AS missing_code_raw_pct,
           count(*) FILTER (code_norm = '') AS empty_code_norm,
           round(100.0 * count(*) FILTER (code_norm = '') / count(*), 4) AS empty_code_norm_pct,
           (SELECT count(*) FROM ({_MINIMAL_ROWS}) l) AS nutrient_rows FROM t
""")
def _import_stats(spark, sf_dir):
    export = product_export(spark, sf_dir)
    rows, _, _ = product_rows(export)
    return import_stats(rows, unpivot_fields(export, "event_id"))


_MEASURED = ("energy_kcal_100g", "energy_kj_100g", "fat_100g", "saturated_fat_100g", "carbohydrates_100g",
             "sugars_100g", "fiber_100g", "protein_100g", "sodium_100g", "salt_100g")


_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS missing FROM t" for c in _MEASURED if c != "salt_100g"
) + f"""
    UNION ALL SELECT 'salt_100g', count(*) FILTER (({sql_double('salt_100g')}) IS NULL) FROM ({EXPORT_SQL}) x"""


@query("top_missing", f"""
    WITH t AS ({_TYPED}) SELECT field, missing FROM ({_MISSING_SQL}) m ORDER BY missing DESC, field LIMIT 5
""")
def _top_missing(spark, sf_dir):
    rows, _, _ = product_rows(product_export(spark, sf_dir), include_salt=True)
    return top_missing(rows, _MEASURED, 5)


# the dictionary is the text of the two tables whose size does not depend on the scale
_TOKENS = {
    "table": f"'NATION_' || {as_text('o_orderkey % 40')}",
    "header": f"CASE o_custkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'MERIC' WHEN 2 THEN ' EUROPE ' "
              f"ELSE 'N_' || {as_text('o_custkey % 60')} END",
}
_DICTIONARY_SQL = """
    SELECT string_agg(word, ' ' ORDER BY word) AS text
    FROM (SELECT n_name AS word FROM nation UNION ALL SELECT r_name FROM region) w
"""


def _dictionary(spark, sf_dir):
    words = table(spark, sf_dir, "nation").select(F.col("n_name").alias("word")).unionByName(
        table(spark, sf_dir, "region").select(F.col("r_name").alias("word"))
    )
    return words.agg(F.array_join(F.array_sort(F.collect_list("word")), " ").alias("text"))  # names of 30 places


def _inventory(spark, sf_dir):
    return derive(table(spark, sf_dir, "orders"), _TOKENS).groupBy("table", "header").agg(F.count("*").alias("uses"))


_COVERAGE_SQL = f"""
    SELECT i."table", i.header, i.uses,
           regexp_matches(d.text, '\\b' || i."table" || '\\b') AS table_found,
           contains(d.text, trim(i.header)) AS header_found
    FROM (SELECT "table", header, count(*) AS uses FROM ({select_sql(_TOKENS, "orders")}) o GROUP BY 1, 2) i,
         ({_DICTIONARY_SQL}) d WHERE trim(i.header) <> ''
"""


@query("dictionary_coverage", _COVERAGE_SQL)
def _dictionary_coverage(spark, sf_dir):
    return dictionary_coverage(_inventory(spark, sf_dir), _dictionary(spark, sf_dir))


@query("dictionary_gaps", f"""
    SELECT "table", bool_or(table_found) AS table_found, count(*) FILTER (NOT header_found) AS missing_headers
    FROM ({_COVERAGE_SQL}) c GROUP BY "table"
""")
def _dictionary_gaps(spark, sf_dir):
    return coverage_by_table(dictionary_coverage(_inventory(spark, sf_dir), _dictionary(spark, sf_dir)))


@query("dictionary_tables", f"""
    SELECT DISTINCT o."table" FROM ({select_sql(_TOKENS, "orders")}) o, ({_DICTIONARY_SQL}) d
    WHERE NOT contains(d.text, o."table")
""")
def _dictionary_tables(spark, sf_dir):
    inventory = derive(table(spark, sf_dir, "orders"), _TOKENS)
    return tables_not_mentioned(inventory, _dictionary(spark, sf_dir))


@query("identity_gate", """
    SELECT d.doc_id, sha256(d.text) AS file_sha256, octet_length(encode(d.text)) AS file_bytes,
           CASE WHEN l.doc_id IS NULL THEN 'no manifest'
                WHEN l.doc_id % 5 = 0 THEN 'manifest without file_sha256'
                WHEN l.doc_id % 5 = 1 THEN 'sha-256 mismatch'
                WHEN l.doc_id % 5 = 2 THEN 'manifest without file_bytes'
                WHEN l.doc_id % 5 = 3 THEN 'size mismatch' ELSE 'ok' END AS status
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def _identity_gate(spark, sf_dir):
    """Documents stand for files, the labelled ones have a manifest with a typical fault."""
    documents = table(spark, sf_dir, "documents")
    files = documents.select(
        "doc_id", F.sha2("text", 256).alias("file_sha256"),
        F.octet_length("text").cast("bigint").alias("file_bytes"),
    )
    fault = F.col("doc_id") % 5
    manifests = table(spark, sf_dir, "labels").select("doc_id").join(files, "doc_id").select(
        "doc_id",
        F.when(fault == 0, "").when(fault == 1, "0").otherwise(F.col("file_sha256")).alias("file_sha256"),
        F.when(fault == 2, F.lit(None)).when(fault == 3, -1).otherwise(F.col("file_bytes")).alias("file_bytes"),
    )
    return identity_status(files, manifests, ["doc_id"])


_SOURCES = """
    SELECT source AS "table", CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, count(*) AS expected_rows,
           source <> 'web' AS selected FROM documents GROUP BY source
"""


@query("throughput", f"""
    WITH i AS ({_SOURCES}),
    t AS (SELECT CAST(coalesce(sum(bytes) FILTER (selected), 0) AS BIGINT) AS selected_bytes,
                 CAST(coalesce(sum(expected_rows) FILTER (selected), 0) AS BIGINT) AS selected_rows,
                 CAST(sum(bytes) AS BIGINT) AS bundle_bytes, CAST(sum(expected_rows) AS BIGINT) AS bundle_rows FROM i)
    SELECT *, selected_bytes / 4.0::DOUBLE AS bytes_per_s, selected_rows / 4.0::DOUBLE AS rows_per_s,
           bundle_bytes / (selected_bytes / 4.0::DOUBLE) AS full_seconds_by_bytes,
           bundle_rows / (selected_rows / 4.0::DOUBLE) AS full_seconds_by_rows FROM t
""")
def _throughput(spark, sf_dir):
    """Document sources stand for the tables of a bundle that took four seconds."""
    inventory = (
        table(spark, sf_dir, "documents").groupBy(F.col("source").alias("table"))
        .agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("expected_rows"))
        .withColumn("selected", F.col("table") != "web")
    )
    return throughput(inventory, 4.0)


@query("table_selection", """
    SELECT p_brand AS "table", count(*) AS parts,
           CAST(CASE p_brand WHEN 'Brand#9' THEN 0 WHEN 'Brand#3' THEN 1 ELSE 2 END AS INTEGER) AS requested_position
    FROM part WHERE p_brand IN ('Brand#9', 'Brand#3', 'Brand#12') GROUP BY p_brand
""")
def _table_selection(spark, sf_dir):
    brands = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("table")).agg(F.count("*").alias("parts"))
    chosen = select_table_rows(brands, ["Brand 9", "brand#3", "Brand#9", "brand.12", "brand_5"], ["BRAND-5"])
    return chosen.orderBy("requested_position", normalize_identifier(F.col("table")))
