"""File listings."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def bare(path: Column) -> Column:
    """A path without the slashes by which listings differ (``file:/x``, ``file:///x``)."""
    return F.regexp_replace(path, r"^(\w+:)/*", "$1/")


def list_files(spark: SparkSession, path: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Path and size of the files at ``path``, empty ones included; contents are not read.

    The file source gives no row for an empty file, so what only the listing knows has size 0.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")
    names = spark.createDataFrame([(n,) for n in file_names(spark, path, glob)], "path string")
    empty = names.join(listing.select(bare(F.col("path")).alias("_known")), bare(F.col("path")) == F.col("_known"), "left_anti")
    return listing.unionByName(empty.select("path", F.lit(0).cast("bigint").alias("length")))


def file_names(spark: SparkSession, path: str | Sequence[str], glob: str = "*") -> list[str]:
    """Sorted paths of the files at ``path``, empty files included."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return sorted(map(unquote, listing.inputFiles()))
