"""Tables that change together: a load of several tables shows all of its rows or none.

The rows of a published table carry the load that wrote them, as a partition.  One small table lists the loads that
are published, and readers see, through a view under the table's name, the rows of those alone.  A load writes
the rows of all its tables first; then one write to the list publishes it, or puts it in the place of all before
it.  Rows of a load that died on its way are never seen, and :func:`unpublished_loads` names them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sinks.tables import create_table, read_table, write_table
from granary.sources.tables import LOADS, rows_table

LOAD = "load_id"


def create_published(spark: SparkSession, database: str, tables: Mapping[str, T.StructType]) -> None:
    """Empty published tables where there are none."""
    create_table(spark, database, LOADS, T.StructType([T.StructField(LOAD, T.StringType())]))
    for table, schema in tables.items():
        rows = f"`{database}`.`{rows_table(table)}`"
        if not spark.catalog.tableExists(rows):
            held = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
            spark.createDataFrame([], held).write.format("parquet").partitionBy(LOAD).saveAsTable(rows)
        columns = ", ".join(f"r.`{c}`" for c in schema.names)
        spark.sql(
            f"CREATE OR REPLACE VIEW `{database}`.`{table}` AS "
            f"SELECT {columns} FROM {rows} r LEFT SEMI JOIN `{database}`.`{LOADS}` l ON r.{LOAD} = l.{LOAD}"
        )


def publish(spark: SparkSession, database: str, tables: Mapping[str, DataFrame], *, replace: bool = False) -> str:
    """Add the rows of one load to several tables at once, matching columns by name; returns the load's id.

    ``replace``: the load takes the place of all earlier ones, in all published tables of the database.
    """
    load = uuid.uuid4().hex
    for table, rows in tables.items():
        columns = read_table(spark, database, table).columns
        held = rows.select(*[F.col(f"`{c}`") for c in columns], F.lit(load).alias(LOAD))
        held.write.insertInto(f"`{database}`.`{rows_table(table)}`")
    one = spark.createDataFrame([(load,)], f"{LOAD} string")
    write_table(one, database, LOADS, mode="overwrite" if replace else "append")
    for table in tables:
        spark.catalog.refreshTable(f"`{database}`.`{table}`")
    return load


def unpublished_loads(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Loads that have rows in a table and are not published: they died, or were replaced."""
    held = read_table(spark, database, rows_table(table)).select(LOAD).distinct()
    return held.join(read_table(spark, database, LOADS), LOAD, "left_anti")
