"""A directory of CSV files read as one set of tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary import catalog
from granary.functions.rules import choose_names, identifier, infer_schema, primary_key, unique_identifiers
from granary.functions.text import normalize_identifier
from granary.sources.delimited import COMMA, read_delimited, read_header
from granary.sources.files import bare, list_files

CSV_SUFFIX = ".csv"


@dataclass(frozen=True)
class TableSource:
    """Metadata of one bundle file: its table name, header, typed schema and key."""

    table: str
    path: str
    headers: tuple[str, ...]
    schema: T.StructType
    key: tuple[str, ...]


def _last_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def bundle_listing(spark: SparkSession, csv_dir: str) -> DataFrame:
    """Path and size of the CSV files of a bundle; a table may be a folder ``table.csv`` of files."""
    try:
        files = list_files(spark, f"{csv_dir.rstrip('/')}/*{CSV_SUFFIX}", "*" + CSV_SUFFIX)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long")
    folder = F.regexp_extract("path", r"^(.*\.csv)/[^/]*$", 1)
    inside = (folder != "") & (_last_name(folder) != csv_dir.rstrip("/").rsplit("/", 1)[-1])
    named = files.withColumn("path", F.when(inside, folder).otherwise(F.col("path")))
    # Listings write one path in two ways.
    return named.groupBy(bare(F.col("path")).alias("_bare")).agg(
        F.min("path").alias("path"), F.sum("length").alias("length")).drop("_bare")


def requested_order(only: Iterable[str]) -> dict[str, int]:
    """Normalised table names in the order of their first mention."""
    return {name: i for i, name in enumerate(dict.fromkeys(map(identifier, only)))}


def select_tables(
    names: Iterable[str], only: Sequence[str] = (), skip: Sequence[str] = ()
) -> list[str]:
    """Apply the allow list, then the deny list; the allow list also gives the order."""
    return choose_names(names, only, skip)


def select_table_rows(
    inventory: DataFrame, only: Sequence[str] = (), skip: Sequence[str] = (), column: str = "table"
) -> DataFrame:
    """:func:`select_tables` over an inventory frame; adds ``requested_position``."""
    order = requested_order(only)
    name = normalize_identifier(F.col(column))
    position = F.coalesce(
        *[F.when(name == n, i) for n, i in order.items()], F.lit(len(order))
    )
    kept = inventory.withColumn("requested_position", position)
    if order:
        kept = kept.where(name.isin(*order))
    if skip:
        kept = kept.where(~name.isin(*map(identifier, skip)))
    return kept


def bundle_sources(
    spark: SparkSession, csv_dir: str, only: Sequence[str] = (), skip: Sequence[str] = ()
) -> list[TableSource]:
    """The selected tables of a bundle in load order."""
    files = bundle_listing(spark, csv_dir).select("path", _last_name(F.col("path")).alias("name"))
    paths = {
        identifier(r["name"].removesuffix(CSV_SUFFIX)): r["path"]
        for r in files.where(F.col("name") != catalog.RECORD_COUNT_FILE).orderBy("path").collect()  # one row per table
    }
    if not paths:
        raise ValueError(f"no CSV file in {csv_dir}")
    sources = []
    for table in select_tables(paths, only, skip):
        headers = read_header(spark, paths[table])
        columns = unique_identifiers(headers)
        sources.append(
            TableSource(
                table,
                paths[table],
                tuple(headers),
                infer_schema(table, columns),
                tuple(primary_key(table, columns)),
            )
        )
    return sources


def read_source(
    spark: SparkSession,
    source: TableSource,
    with_order: bool = True,
) -> DataFrame:
    """Strict all-text scan of one bundle table."""
    return read_delimited(
        spark,
        source.path,
        sep=COMMA,
        strict=True,
        names=source.schema.names,
        with_order=with_order,
    )


def load_bundle(
    spark: SparkSession, csv_dir: str, *, only: Sequence[str] = (), skip: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """One lazy all-text frame per selected table."""
    return {s.table: read_source(spark, s) for s in bundle_sources(spark, csv_dir, only, skip)}


def read_expected_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(table, expected_rows)`` from a record-count file; other entries are dropped."""
    name = F.col(catalog.RECORD_COUNT_TABLE)
    own = identifier(catalog.RECORD_COUNT_FILE.removesuffix(CSV_SUFFIX))
    return (
        read_delimited(spark, path, sep=COMMA)
        .where(name.endswith(CSV_SUFFIX))
        .select(
            normalize_identifier(F.replace(name, F.lit(CSV_SUFFIX), F.lit(""))).alias("table"),
            F.col(catalog.RECORD_COUNT_ROWS).cast("bigint").alias("expected_rows"),
        )
        .where(F.col("table") != own)
    )


def bundle_inventory(
    files: DataFrame, expected: DataFrame, only: Sequence[str] = (), skip: Sequence[str] = ()
) -> DataFrame:
    """``(table, bytes, expected_rows, selected)`` per bundle file."""
    tables = (
        files.withColumn("name", _last_name(F.rtrim("path", F.lit("/"))))
        .where(F.col("name").endswith(CSV_SUFFIX) & (F.col("name") != catalog.RECORD_COUNT_FILE))
        .select(
            normalize_identifier(F.regexp_replace("name", r"\.csv$", "")).alias("table"),
            F.col("length").alias("bytes"),
        )
    )
    chosen = select_table_rows(tables, only, skip).select("table", F.lit(True).alias("selected"))
    return (
        tables.join(expected, "table", "left")
        .join(chosen, "table", "left")
        .select(
            "table",
            "bytes",
            F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
            F.coalesce("selected", F.lit(False)).alias("selected"),
        )
    )
