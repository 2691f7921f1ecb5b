"""Databases and tables: create, drop, truncate, append, replace, describe."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary import catalog
from granary.operators.quality import GateError
from granary.session import stage
from granary.sources.tables import list_tables

MODES = ("append", "overwrite")
HOT_BUCKETS = 4.0  # how many average buckets one value may fill


def _name(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def drop_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def create_table(spark: SparkSession, database: str, table: str, schema: T.StructType) -> None:
    """An empty table unless there is one; key columns are checked by jobs, not by the store."""
    if not spark.catalog.tableExists(_name(database, table)):
        empty = spark.createDataFrame([], schema)
        empty.write.format("parquet").saveAsTable(_name(database, table))


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(_name(database, table))


def _database_location(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def write_table(
    df: DataFrame, database: str, table: str, *, mode: str = "append",
    partition_by: tuple[str, ...] = (), check: Callable[[DataFrame], None] | None = None,
    keys: Sequence[str] = (),
) -> None:
    """Append rows, or replace the table's contents, matching columns by name.

    A replacement is written to a new folder first and the table is pointed to it when the job has
    committed, so a failed load leaves the old rows in place.  ``check`` sees the new rows, already
    written, and raises to refuse them; rows whose ``keys`` an appended table holds already are refused
    by a semi join, so an append never groups the old rows again.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    spark = df.sparkSession
    name = _name(database, table)
    exists = spark.catalog.tableExists(name)
    if mode == "append" and exists:
        old = spark.table(name)
        rows = df.select(*[F.col(f"`{c}`") for c in old.columns])
        if check is not None:
            rows = stage(rows, table)
            check(rows)
            if keys:
                _refuse_known(rows, old, keys, table)
        rows.write.insertInto(name)
        return
    path = f"{_database_location(spark, database)}/{table}-{uuid.uuid4().hex}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    if check is not None:
        check(spark.read.schema(df.schema).parquet(path))
    if exists and not partition_by and spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")  # one statement: there always is a table
        spark.catalog.refreshTable(name)
        return
    if exists:
        spark.sql(f"DROP TABLE {name}")  # other columns than before
    spark.catalog.createTable(name, path, "parquet")
    if partition_by:
        spark.catalog.recoverPartitions(name)


def _refuse_known(rows: DataFrame, old: DataFrame, keys: Sequence[str], table: str) -> None:
    known = rows.join(old.select(*keys), list(keys), "left_semi").first()
    if known:
        raise GateError(f"{table}: key {', '.join(keys)} is there already: {[known[k] for k in keys]}")


def write_bucketed(
    df: DataFrame, database: str, table: str, column: str, buckets: int, hot_buckets: float = HOT_BUCKETS
) -> None:
    """A new table bucketed and sorted by a join column.

    Two tables with equal buckets join on the column without a shuffle, but a bucket is read by one
    task.  So the hottest value is measured first, and a value that would fill more than ``hot_buckets``
    average buckets is refused: such a table is better written plainly, as adaptive execution splits its
    joins.  Infinity allows any value.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    size = counts.agg(F.max("n").alias("hottest"), F.sum("n").alias("rows")).first()
    if (size["hottest"] or 0) * buckets > hot_buckets * (size["rows"] or 0):
        raise ValueError(f"{table}: one value of {column} fills {size['hottest']} of {size['rows']} rows")
    path = f"{_database_location(df.sparkSession, database)}/{table}-{uuid.uuid4().hex}"
    (
        df.repartition(buckets, column)
        .write.format("parquet")
        .bucketBy(buckets, column)
        .sortBy(column)
        .option("path", path)
        .saveAsTable(_name(database, table))
    )


def truncate_table(spark: SparkSession, database: str, table: str) -> None:
    """Replace the contents by nothing."""
    empty = spark.createDataFrame([], read_table(spark, database, table).schema)
    write_table(empty, database, table, mode="overwrite")


def append_provenance(
    spark: SparkSession, database: str, *, file_path: str, file_sha256: str, file_bytes: int,
    delimiter: str, nutrients_mode: str, table: str = "import_metadata",
) -> None:
    """Record one finished run; written after the data."""
    run = spark.createDataFrame(
        [(file_path, file_sha256, file_bytes, delimiter, nutrients_mode)],
        "file_path string, file_sha256 string, file_bytes long, delimiter string, "
        "nutrients_mode string",
    )
    write_table(provenance_rows(run), database, table)


def provenance_rows(runs: DataFrame) -> DataFrame:
    """Provenance rows for run descriptions, with a new id and the time of the write."""
    return runs.select(
        F.uuid().alias("id"),
        F.current_timestamp().alias("imported_at"),
        F.lit(catalog.PRODUCT_EXPORT_URL).alias("source_url"),
        *[c for c in catalog.PROVENANCE_SCHEMA.names[3:]],
    )


def snapshot_schema(spark: SparkSession, database: str) -> DataFrame:
    """``(table, position, column, type, nullable)`` of every base table, in order."""
    rows = [
        (t["table"], i, f.name, f.dataType.simpleString(), f.nullable)
        for t in list_tables(spark, database).collect()
        for i, f in enumerate(read_table(spark, database, t["table"]).schema, 1)
    ]
    return spark.createDataFrame(
        rows, "table string, position int, column string, type string, nullable boolean"
    ).orderBy("table", "position")


def table_ddl(spark: SparkSession, database: str) -> DataFrame:
    """``(table, ddl)``: the create statement of every base table, in order."""
    names = [t["table"] for t in list_tables(spark, database).collect()]
    if not names:
        return spark.createDataFrame([], "table string, ddl string")
    statements = [
        spark.sql(f"SHOW CREATE TABLE {_name(database, n)}").select(
            F.lit(n).alias("table"), F.col("createtab_stmt").alias("ddl")
        )
        for n in names
    ]
    return reduce(DataFrame.unionByName, statements).orderBy("table")
