"""Duplicate profiles and resolution.

Every operator survives a key that holds a large part of all rows: counts combine before the
shuffle, and "best row per key" is a ranked window whose group limit keeps at most one row per key
and map task before rows are exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary import catalog

_RANK, _LISTED = "_rank", "_listed"
#: Ranges that a piece is cut into at a time; three times cover 2^33 positions.
_RANGES = 1 << 11
SCORE_FIELDS = (*catalog.PRODUCT_TEXT_FIELDS, catalog.PRODUCT_TIME_FIELD)


def with_key(df: DataFrame, key: str = "code_norm") -> DataFrame:
    """Rows whose normalised key is not empty."""
    return df.where(F.col(key) != "")


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("code")).agg(F.count("*").alias("n"))


def profile_duplicates(df: DataFrame, key: str) -> DataFrame:
    """One row: totals of non-empty keys, of repeated keys and of skipped empty ones."""
    n, filled = F.col("n"), F.col("code") != ""
    total = lambda c: F.coalesce(F.sum(F.when(filled, c)), F.lit(0)).cast("bigint")
    return (
        key_counts(df, key)
        .agg(
            total(n).alias("code_total"),
            F.count_if(filled).alias("code_unique"),
            F.count_if(filled & (n > 1)).alias("duplicate_values"),
            total(n - 1).alias("duplicate_occurrences"),
            F.coalesce(F.sum(F.when(~filled, n)), F.lit(0)).cast("bigint").alias("skipped_no_code"),
        )
        .withColumn("duplicates_found", F.col("duplicate_values") > 0)
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-empty keys that occur at least twice, each once, as column ``code`` (unordered)."""
    return key_counts(with_key(df, key), key).where(F.col("n") > 1).select("code")


def duplicate_sample(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The first ``n`` repeated keys in byte order."""
    return duplicate_keys(df, key).orderBy("code").limit(n)


def _first_of(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first in source order."""
    return _first_of(df, key, [F.col(c).asc() for c in order])


def keep_best(
    df: DataFrame, key: str | Sequence[str], score: Sequence[Column], order: Sequence[str]
) -> DataFrame:
    """The row of each key with the highest score; the earliest row wins a tie."""
    return _first_of(df, key, [s.desc() for s in score] + [F.col(c).asc() for c in order])


def completeness_score(
    emitted: Column, fields: Sequence[str] = SCORE_FIELDS, time_field: str = catalog.PRODUCT_TIME_FIELD
) -> list[Column]:
    """(last modified or -1, emitted nutrient rows, filled product fields).

    A text field counts as filled unless it is empty, a null of any type does not.
    """
    filled = reduce(add, [F.coalesce((F.col(c).cast("string") != "").cast("int"), F.lit(0)) for c in fields])
    return [
        F.coalesce(F.col(time_field), F.lit(-1).cast("bigint")), emitted, filled,
    ]


def with_listed(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Add whether the key is on the list, by one join with the distinct list.

    Adaptive execution splits the rows of a key that fills a large part of the table.
    """
    listed = codes.select(F.col("code").alias("_code")).distinct().withColumn(_LISTED, F.lit(True))
    joined = df.join(listed, F.col(key) == F.col("_code"), "left").drop("_code")
    return joined.withColumn(_LISTED, F.coalesce(_LISTED, F.lit(False)))


def split_by_list(df: DataFrame, codes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not in the list, and rows whose key is."""
    marked = with_listed(df, codes, key)
    return tuple(marked.where(F.col(_LISTED) == side).drop(_LISTED) for side in (False, True))


def resolve_listed(
    df: DataFrame, codes: DataFrame, key: str, score: Sequence[Column], order: Sequence[str]
) -> DataFrame:
    """Resolve only keys on the list by score; all other rows pass through unchanged.

    With a complete list this equals :func:`keep_best`, which needs one shuffle less.
    ``resolved`` tells the two kinds apart.
    """
    passed, listed = split_by_list(df, codes, key)
    return passed.withColumn("resolved", F.lit(False)).unionByName(
        keep_best(listed, key, score, order).withColumn("resolved", F.lit(True))
    )


def row_cap(
    df: DataFrame, counted: DataFrame, order: Sequence[str], n: int, block: Sequence[Column]
) -> DataFrame:
    """Rows of ``df`` up to and including the ``n``-th row of ``counted``, in source order.

    ``counted`` holds the rows that count toward the cap; 0 means no cap.

    ``block`` cuts the source order into pieces of bounded size, for example file and block; in a piece
    the last column of ``order`` is a unique whole number and the others are constant.  Positions of a piece lie
    less than 2^33 apart.

    The piece with the n-th row is found from one count per piece, the row by counts of ranges of
    positions that get narrower until one position is left.  No row is sorted or ranked, and
    nothing runs before the result is used: the cut-off is a subquery of the plan.
    """
    if n <= 0:
        return df
    *outer, position = order
    names = [f"_b{i}" for i in range(len(block))]
    pieced = counted.select(*[b.alias(x) for x, b in zip(names, block, strict=True)], *order)
    pieces = pieced.groupBy(*names).agg(
        F.count("*").alias("_n"), *[F.min(c).alias(f"_o_{c}") for c in outer],
        F.min(position).alias("_low"), (F.max(position) - F.min(position) + 1).alias("_width"),
    )
    found = _reached(pieces, names, F.lit(n)).withColumn(
        "_width", F.when(F.col("_width") > 1 << 33, F.raise_error(F.lit("positions of a piece are too far apart")).cast("bigint")).otherwise(F.col("_width"))
    )
    for _ in range(3):
        found = found.withColumn("_step", F.ceil(F.col("_width") / _RANGES).cast("bigint"))
        inside = pieced.join(found.drop("_n"), names).where(F.expr(f"`{position}` >= _low AND `{position}` < _low + _width"))
        ranges = inside.groupBy(
            *names, *[f"_o_{c}" for c in outer], "_left", F.col("_step").alias("_width"),
            F.expr(f"_low + (`{position}` - _low) DIV _step * _step").alias("_low"),
        ).agg(F.count("*").alias("_n"))
        found = _reached(ranges, ["_low"], F.col("_left"))
    last = found.select(F.struct(*[F.col(f"_o_{c}").alias(c) for c in outer], F.col("_low").alias(position)).alias("last"))
    # One row at most, so a subquery; none if the cap is not reached.
    last = last.agg(F.first("last").alias("last")).scalar()
    return df.where(last.isNull() | (F.struct(*order) <= last))


def _reached(counts: DataFrame, order: Sequence[str], k: Column) -> DataFrame:
    """Of counts in order, the one with the ``k``-th row; ``_left`` is that row's number in it."""
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.withColumn("_upto", F.sum("_n").over(running)).withColumn("_left", k - F.col("_upto") + F.col("_n"))
    return upto.where("_left BETWEEN 1 AND _n").drop("_upto")


def numbered_repeats(
    df: DataFrame, key: Sequence[str], position: str, *, piece_rows: int = 1 << 20, name: str = "n"
) -> DataFrame:
    """Add how often the key has occurred up to and including this row, in ``position`` order.

    ``position`` is a unique whole number.  Positions are cut into pieces; a window numbers each key
    inside a piece and the counts of earlier pieces are added, so a key that holds a large part of
    all rows never meets in one task.
    """
    keys = list(key)
    piece = F.floor(F.col(position) / piece_rows)
    pieced = df.withColumn("_piece", piece)
    inside = F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(position))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pieced.groupBy(*keys, "_piece")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    offsets = offsets.withColumnsRenamed({c: f"_of_{c}" for c in [*keys, "_piece"]})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*keys, "_piece"]]  # null is a key too
    return (
        pieced.withColumn("_inside", inside)
        .join(offsets, same)
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_piece", "_inside", "_before", *[f"_of_{c}" for c in [*keys, "_piece"]])
    )


def unique_identifier_rows(
    df: DataFrame, identifier: str, position: str, scope: Sequence[str] = ()
) -> DataFrame:
    """Suffix the n-th repeat of an identifier (n > 1) with ``_n``, per ``scope``."""
    numbered = numbered_repeats(df, [*scope, identifier], position, name="_repeat")
    text = F.when(F.col("_repeat") == 1, F.col(identifier)).otherwise(
        F.concat_ws("_", F.col(identifier), F.col("_repeat").cast("string"))
    )
    return numbered.withColumn(identifier, text).drop("_repeat")
