"""Manifest and code-list files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary import catalog


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Write one manifest row as a JSON document with sorted fields, nulls included."""
    fields = sorted(set(manifest.columns) & set(catalog.MANIFEST_SCHEMA.names))
    (
        manifest.select(*fields)
        .coalesce(1)
        .write.mode("overwrite")
        .option("ignoreNullFields", False)
        .json(path)
    )


def write_code_list(codes: DataFrame, path: str) -> None:
    """Write column ``code`` one per line; the part files in order are in byte order."""
    codes.select(F.col("code").alias("value")).orderBy("value").write.mode("overwrite").text(path)
