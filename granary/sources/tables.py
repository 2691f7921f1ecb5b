"""Tables of a database in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOT_BASE_TABLES = ("VIEW", "TEMPORARY")
#: The list of published loads (see :mod:`granary.sinks.publication`).
LOADS = "published_loads"


def rows_table(table: str) -> str:
    """Where the rows of a published table are."""
    return f"{table}_rows"


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of ``database``, in order, as column ``table``: base tables, and published ones by the
    name that readers use."""
    found = [t for t in spark.catalog.listTables(database) if not t.isTemporary]
    views = {t.name for t in found if t.tableType in NOT_BASE_TABLES}
    base = {t.name for t in found} - views
    published = {v for v in views if rows_table(v) in base} if LOADS in base else set()
    hidden = {LOADS, *map(rows_table, published)} if LOADS in base else set()
    rows = [(name,) for name in base - hidden | published]
    return spark.createDataFrame(rows, "table string").orderBy(F.col("table"))
