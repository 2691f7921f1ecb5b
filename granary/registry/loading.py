"""Strict loading: conform, violation reports, tables, provenance, events."""

from __future__ import annotations

import contextlib

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from granary import catalog
from granary.functions.rules import infer_schema
from granary.operators.conform import conform, violations
from granary.operators.quality import row_counts
from granary.operators.reshape import nutrient_table, product_table
from granary.registry.base import (
    EXPORT_SQL,
    as_text,
    decimal_text,
    derive,
    fresh_database,
    query,
    select_sql,
    sql_long,
    sql_strip,
    table,
    tables,
)
from granary.registry.duplicates import _BEST, _COLUMNS, _resolved
from granary.registry.reshape import sql_long_rows
from granary.registry.text import DATES, sql_date
from granary.session import scratch_path, stage
from granary.sinks.events import event_rows, field, log_events, read_events
from granary.sinks.publication import create_published, publish
from granary.sinks.tables import (
    create_database,
    create_table,
    drop_database,
    provenance_rows,
    read_table,
    snapshot_schema,
    table_ddl,
    truncate_table,
    write_table,
)
from granary.sources.tables import list_tables

# raw orders with every kind of bad cell
_RAW = {
    "o_orderkey": "o_orderkey",
    "id": f"CASE o_orderkey % 10 WHEN 0 THEN '+' || {as_text('o_orderkey')} WHEN 1 THEN ' ' ELSE "
          f"' ' || {as_text('o_orderkey')} END",
    "amount": f"CASE o_custkey % 12 WHEN 0 THEN '1e+5' WHEN 1 THEN 'inf' WHEN 2 THEN '' ELSE {decimal_text('o_totalprice')} END",
    "publication_date": DATES["raw"],
    "description": f"CASE o_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'a' || chr(0) ELSE o_orderpriority || '  ' END",
}
_SCHEMA = infer_schema("raw_order", [c for c in _RAW if c != "o_orderkey"])
_RAW_SQL = select_sql({**_RAW, "description": _RAW["description"].replace("chr(0)", "'<nul>'")}, "orders")
_STRICT = r"^-?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE]-?[0-9]+)?$"


def _sql_bad(position: int, column: str, reason: str, bad: str, value: str) -> str:
    return (
        f"SELECT o_orderkey, {position} AS position, '{column}' AS \"column\", '{reason}' AS reason, "
        f"{value} AS value FROM raw WHERE {column} <> '' AND ({bad})"
    )


_BAD_ID = f"{sql_long('id')} IS NULL"
_BAD_AMOUNT = f"NOT regexp_matches({sql_strip('amount')}, '{_STRICT}')"
_BAD_DATE = f"{sql_date('publication_date')} IS NULL"
_BAD_TEXT = "description = 'a<nul>'"
_VIOLATIONS = " UNION ALL ".join([
    _sql_bad(1, "id", "invalid bigint", _BAD_ID, "trim(id)"),
    _sql_bad(2, "amount", "invalid double", _BAD_AMOUNT, "trim(amount)"),
    _sql_bad(3, "publication_date", "invalid date", _BAD_DATE, "trim(publication_date)"),
    _sql_bad(4, "description", "nul", _BAD_TEXT, "description"),
])
_TYPED_ORDER = f"""
    o_orderkey, {sql_long('id')} AS id,
    CASE WHEN {_BAD_AMOUNT} THEN NULL ELSE TRY_CAST(nullif({sql_strip('amount')}, '') AS DOUBLE) END AS amount,
    {sql_date('publication_date')} AS publication_date, nullif(description, '') AS description
"""


def _raw_orders(spark, sf_dir):
    return derive(table(spark, sf_dir, "orders"), _RAW)


def _shown(df):
    """Dates as text and NUL made visible, as in the check."""
    return df.withColumns({
        "publication_date": F.col("publication_date").cast("string"),
        "description": F.replace("description", F.lit("\x00"), F.lit("<nul>")),
    })


@query("violations_report", f"WITH raw AS ({_RAW_SQL}) {_VIOLATIONS}")
def _violations_report(spark, sf_dir):
    bad = violations(_raw_orders(spark, sf_dir), _SCHEMA, ["o_orderkey"])
    return bad.withColumn("value", F.replace("value", F.lit("\x00"), F.lit("<nul>")))


@query("first_violations", f"""
    WITH raw AS ({_RAW_SQL}) SELECT o_orderkey, min(position) AS position FROM ({_VIOLATIONS}) v GROUP BY o_orderkey
""")
def _first_violations(spark, sf_dir):
    bad = violations(_raw_orders(spark, sf_dir), _SCHEMA, ["o_orderkey"])
    return bad.groupBy("o_orderkey").agg(F.min("position").alias("position"))


@query("conform_report", f"WITH raw AS ({_RAW_SQL}) SELECT {_TYPED_ORDER} FROM raw")
def _conform_report(spark, sf_dir):
    return _shown(conform(_raw_orders(spark, sf_dir), _SCHEMA, on_error="report", keep=["o_orderkey"]))


@query("conform_quarantine", f"""
    WITH raw AS ({_RAW_SQL}) SELECT {_TYPED_ORDER} FROM raw
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_VIOLATIONS}) v)
""")
def _conform_quarantine(spark, sf_dir):
    return _shown(conform(_raw_orders(spark, sf_dir), _SCHEMA, on_error="quarantine", keep=["o_orderkey"]))


_GOOD = {"id": as_text("o_orderkey"), "amount": decimal_text("o_totalprice"),
         "publication_date": "substr(" + as_text("o_orderdate") + ", 1, 10)", "description": "o_orderpriority"}


@query("conform_strict", """
    SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS publication_date, o_orderpriority AS description FROM orders
""")
def _conform_strict(spark, sf_dir):
    return _shown(conform(derive(table(spark, sf_dir, "orders"), _GOOD), _SCHEMA, on_error="fail"))


# --- tables in a database ---------------------------------------------------------------------


_WINNERS_RAW = f"SELECT b.code_norm, x.* FROM ({_BEST}) b JOIN ({EXPORT_SQL}) x ON x.event_id = b.event_id"


@query("table_load", f"""
    SELECT 'product_raw' AS "table", (SELECT count(*) FROM ({_BEST}) b) AS rows
    UNION ALL SELECT 'nutrient_100g', (SELECT count(*) FROM (
        WITH w AS ({_WINNERS_RAW}) {sql_long_rows('w', 'code_norm')}) n)
    UNION ALL SELECT 'appended', 2 * (SELECT count(*) FROM orders)
    UNION ALL SELECT 'replaced', (SELECT count(*) FROM orders)
    UNION ALL SELECT 'truncated', 0
""")
def _table_load(spark, sf_dir):
    """Create, append, replace and truncate, then count what each table holds."""
    db = fresh_database(spark, "table_load")
    winners, fields, names = _resolved(spark, sf_dir)
    create_table(spark, db, "product_raw", catalog.PRODUCT_SCHEMA)
    write_table(product_table(winners), db, "product_raw")
    write_table(nutrient_table(winners, fields, names), db, "nutrient_100g", partition_by=("nutrient_key",))
    orders = conform(derive(table(spark, sf_dir, "orders"), _GOOD), _SCHEMA)
    for name in ("appended", "replaced", "truncated"):
        create_table(spark, db, name, _SCHEMA)
        write_table(orders, db, name)
    write_table(orders, db, "appended")
    write_table(orders, db, "replaced", mode="overwrite")
    truncate_table(spark, db, "truncated")
    found = [r["table"] for r in list_tables(spark, db).collect()]
    return row_counts({t: read_table(spark, db, t) for t in found})


@query("product_table_read", f"SELECT {_COLUMNS} FROM ({_BEST}) b")
def _product_table_read(spark, sf_dir):
    """Written product rows read back from the table."""
    db = fresh_database(spark, "product_table")
    winners, _, _ = _resolved(spark, sf_dir)
    create_table(spark, db, "product_raw", catalog.PRODUCT_SCHEMA)
    write_table(product_table(winners), db, "product_raw")
    return read_table(spark, db, "product_raw")


_SNAPSHOT = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


@query("schema_snapshot", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST({i} AS INTEGER) AS position, '{c.split()[0]}' AS \"column\", '{c.split()[1]}' AS type, true AS has_ddl, "
    f"(SELECT count(*) FROM {t}) AS rows"
    for t, columns in _SNAPSHOT.items() for i, c in enumerate(columns.split(", "), 1)))
def _schema_snapshot(spark, sf_dir):
    """Load three tables into a database, snapshot it and count what each table holds."""
    db = fresh_database(spark, "schema_snapshot")
    for name, df in tables(spark, sf_dir, *_SNAPSHOT).items():
        write_table(df, db, name)
    counts = row_counts({n: read_table(spark, db, n) for n in _SNAPSHOT})
    ddl = table_ddl(spark, db).select("table", F.col("ddl").startswith("CREATE TABLE").alias("has_ddl"))
    columns = snapshot_schema(spark, db).drop("nullable")
    return columns.join(counts, "table").join(ddl, "table")


@query("database_drop", """
    SELECT s."table", s.rows AS rows_before, CASE s."table" WHEN 'orders' THEN o.rows ELSE 0 END AS rows_after
    FROM (SELECT 'customer' AS "table", count(*) AS rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders) s,
         (SELECT count(*) AS rows FROM orders) o
""")
def _database_drop(spark, sf_dir):
    """Two tables are loaded, their database is dropped with everything in it, and one of them is loaded again."""
    t = tables(spark, sf_dir, "customer", "orders")
    db = fresh_database(spark, "database_drop")
    for name, df in t.items():
        write_table(df, db, name)
    before = stage(row_counts({n: read_table(spark, db, n) for n in t}), "rows-before").withColumnRenamed("rows", "rows_before")
    drop_database(spark, db)
    create_database(spark, db, scratch_path(spark, "database_drop"))
    write_table(t["orders"], db, "orders")
    found = [r["table"] for r in list_tables(spark, db).collect()]
    after = row_counts({n: read_table(spark, db, n) for n in found}).withColumnRenamed("rows", "rows_after")
    return before.join(after, "table", "left").select("table", "rows_before", F.coalesce("rows_after", F.lit(0)).alias("rows_after"))


@query("published_load", """
    SELECT step, "table", CASE WHEN step = 3 THEN n WHEN "table" = 'customer' THEN odd ELSE odd_orders END AS rows
    FROM (SELECT unnest([1, 2, 3]) AS step) s, (
        SELECT 'customer' AS "table", count(*) AS n, count(*) FILTER (c_custkey % 2 = 1) AS odd, 0 AS odd_orders FROM customer
        UNION ALL SELECT 'orders', count(*), 0, count(*) FILTER (o_custkey % 2 = 1) FROM orders) t
""")
def _published_load(spark, sf_dir):
    """Rows of two tables after a load, after one that died between them, and after one that replaced the first."""
    t = tables(spark, sf_dir, "customer", "orders")
    db = fresh_database(spark, "published_load")
    create_published(spark, db, {n: df.schema for n, df in t.items()})
    counts = lambda step: stage(
        row_counts({n: read_table(spark, db, n) for n in t}), "published").withColumn("step", F.lit(step))
    publish(spark, db, {"customer": t["customer"].where("c_custkey % 2 = 1"), "orders": t["orders"].where("o_custkey % 2 = 1")})
    found = [counts(1)]
    broken = t["orders"].withColumn("o_orderstatus", F.raise_error(F.lit("the load dies here")).cast("string"))
    with contextlib.suppress(PySparkException):
        publish(spark, db, {"customer": t["customer"], "orders": broken})
    found.append(counts(2))
    publish(spark, db, t, replace=True)
    return found[0].unionByName(found[1]).unionByName(counts(3))


@query("provenance", f"""
    SELECT '{catalog.PRODUCT_EXPORT_URL}' AS source_url, source || '/' || CAST(doc_id AS VARCHAR) AS file_path,
           sha256(text) AS file_sha256, octet_length(encode(text)) AS file_bytes, 'tab' AS delimiter,
           'minimal' AS nutrients_mode, true AS stamped FROM documents
""")
def _provenance(spark, sf_dir):
    """One provenance row per document, documents standing for imported files."""
    runs = table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("file_path"),
        F.sha2("text", 256).alias("file_sha256"),
        F.octet_length("text").cast("bigint").alias("file_bytes"),
        F.lit("tab").alias("delimiter"),
        F.lit("minimal").alias("nutrients_mode"),
    )
    db = fresh_database(spark, "provenance")
    create_table(spark, db, "import_metadata", catalog.PROVENANCE_SCHEMA)
    write_table(provenance_rows(runs), db, "import_metadata")
    stamped = (F.length("id") == 36) & (F.col("imported_at") <= F.current_timestamp())
    return read_table(spark, db, "import_metadata").select(
        *catalog.PROVENANCE_SCHEMA.names[2:], stamped.alias("stamped")
    )


@query("run_events", """
    SELECT 'table_done' AS event, user_id, event_type, count(*) AS rows, true AS stamped FROM events
    GROUP BY user_id, event_type
""")
def _run_events(spark, sf_dir):
    """Log one event per user and type, read the log back."""
    done = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("rows"))
    path = scratch_path(spark, "events")
    names = ("user_id", "event_type", "rows")
    log_events(event_rows(done, "table_done", {n: F.col(n) for n in names}), path)
    return read_events(spark, path).select(
        "event", field("user_id").cast("bigint").alias("user_id"), field("event_type").alias("event_type"),
        field("rows").cast("bigint").alias("rows"),
        F.col("ts").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$").alias("stamped"),
    )


@query("run_events_text", "SELECT DISTINCT '] done user=' || CAST(user_id AS VARCHAR) || ' n=1' AS line FROM events")
def _run_events_text(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    path = scratch_path(spark, "events-text")
    fields = {"user": F.col("user_id"), "none": F.lit(None), "n": F.lit(1)}
    log_events(event_rows(users, "done", fields), path, "text")
    return spark.read.text(path).select(F.substring_index("value", "+00:00", -1).alias("line"))
