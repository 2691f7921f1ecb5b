"""Layouts for lookups: a copy of a table sorted by one column, or clustered by several.

The rows are range-partitioned and sorted by the column, so each file covers a narrow range and a
filter on the column skips nearly all files and row groups by their min/max statistics.  A value
that fills many rows stays spread: ties are salted over the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.catalog import ACCESS_PATHS, AccessPath
from granary.functions.rules import choose_names

ROWS_PER_FILE = 5_000_000
ROW_GROUP_BYTES = 8 * 1024 * 1024
SALT = "_salt"


def select_access_paths(
    only: Sequence[str] = (), skip: Sequence[str] = (), paths: Sequence[AccessPath] = ACCESS_PATHS
) -> list[AccessPath]:
    """Access paths by name, in catalog order; nothing left is an error."""
    chosen = set(choose_names((p.name for p in paths), only, skip))
    return [p for p in paths if p.name in chosen]


def write_layout(df: DataFrame, column: str, path: str, partitions: int | None = None) -> None:
    """Write ``df`` to ``path`` ordered for lookups by ``column``."""
    salted = df.withColumn(SALT, F.monotonically_increasing_id())
    if partitions:
        spread = salted.repartitionByRange(partitions, column, SALT)
    else:
        spread = salted.repartitionByRange(column, SALT)
    (
        spread.sortWithinPartitions(column)
        .drop(SALT)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(path)
    )


#: Bits of a column's place in a clustered layout: it is cut at 2^CLUSTER_BITS - 1 quantiles.
CLUSTER_BITS = 6


def _place(value: Column, cuts: Sequence) -> Column:
    """How many of the cuts lie below a value; none for null."""
    below = F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts))]), lambda cut: cut < value)
    return F.when(value.isNull(), 0).otherwise(F.size(below)).cast("bigint")


def write_clustered(df: DataFrame, columns: Sequence[str], path: str, partitions: int | None = None) -> None:
    """Write ``df`` to ``path`` along a space-filling curve, so that one copy serves lookups by each of ``columns``.

    Every column (of numbers or dates) is cut at its quantiles; the bits of the places are interleaved, and rows
    are range-partitioned and sorted by the result.  A file then covers a narrow range of each column.  The
    quantiles, ``2 ** CLUSTER_BITS - 1`` values per column, are all that reaches the driver.  Nulls come first.
    """
    shares = [k / (1 << CLUSTER_BITS) for k in range(1, 1 << CLUSTER_BITS)]
    cuts = df.agg(*[F.percentile_approx(c, shares).alias(c) for c in columns]).first()
    curve = F.lit(0).cast("bigint")
    for i, column in enumerate(columns):
        place = _place(F.col(column), cuts[column] or ())
        for bit in range(CLUSTER_BITS):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("bigint"))
            curve = curve + F.shiftleft(one, bit * len(columns) + i)
    placed = df.withColumns({"_curve": curve, SALT: F.monotonically_increasing_id()})
    spread = placed.repartitionByRange(partitions, "_curve", SALT) if partitions else placed.repartitionByRange("_curve", SALT)
    (
        spread.sortWithinPartitions("_curve", *columns)
        .drop("_curve", SALT)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(path)
    )
