"""Check the tables of a loaded database: keys, filled columns, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary import catalog
from granary.functions.rules import primary_key
from granary.operators.quality import available_edges, table_checks
from granary.plans.products import NUTRIENTS, PRODUCTS
from granary.sinks.events import RunLog
from granary.sinks.tables import read_table
from granary.sources.tables import list_tables

PRODUCT_KEYS = {PRODUCTS: ("code_norm",), NUTRIENTS: ("code_norm", "source_field")}


def verify_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """``(check, subject, problems)``: repeated keys, null keys and child rows without a parent, for every
    table with a key and every known reference whose two tables are there."""
    keys = {
        name: list(PRODUCT_KEYS.get(name) or primary_key(name, df.columns) or ()) for name, df in tables.items()
    }
    keyed = {name: key for name, key in keys.items() if key}
    edges = available_edges(tables, catalog.ALL_EDGES)
    if not keyed and not edges:
        raise ValueError("no table has a key or a reference to check")
    return table_checks(tables, keyed, edges)


def verify_database(
    spark: SparkSession, database: str, *, log_path: str | None = None, log_format: str = "text"
) -> DataFrame:
    """:func:`verify_tables` over all tables of a database; what has problems comes first."""
    names = [r["table"] for r in list_tables(spark, database).collect()]
    found = verify_tables({n: read_table(spark, database, n) for n in names})
    rows = found.orderBy(F.col("problems").desc(), "check", "subject").collect()  # one per check
    log = RunLog(spark, log_path, log_format)
    for row in rows:
        log.event("verify_problem" if row["problems"] else "verify_ok", **row.asDict())
    return spark.createDataFrame(rows, found.schema)
