"""Delimited text with a header row, read strictly or leniently.

Spark never names the columns: the header is read once on the driver (metadata only) and the scan
gets an explicit all-text schema by position.

Scale.  One distributed pass over the lines proves whether every line is a plain record of its own; then
Spark's CSV source reads the files in splits.  Where a cell holds a line break, text follows a closing quote, or a
line is blank, the records are read in the same splits by :mod:`granary.sources.records`, which gives each record its
place.  A gzip file is unpacked once, by one task.  The same pass finds invalid UTF-8 and headers that differ.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.text import BOM
from granary.session import stage
from granary.sources.files import file_names
from granary.sources.records import line_patterns, read_lines, read_records, summarize, with_starts

TAB, COMMA = "\t", ","
MAX_CELL_CHARS = 2_000_000  # fixed value: default size limit of a cell
SPARE_COLUMNS = 20_480  # room for records that are longer than the header
CORRUPT = "_corrupt"
SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW = "_src_file", "_src_block", "_src_row"
SOURCE_ORDER = (SOURCE_FILE, SOURCE_BLOCK, SOURCE_ROW)


class InputError(ValueError):
    """The input cannot be read as asked."""


def detect_delimiter(header_line: Column) -> Column:
    """Comma when a header line holds more commas than tabs, else tab."""
    return F.when(
        F.length(header_line) - F.length(F.translate(header_line, COMMA, ""))
        > F.length(header_line) - F.length(F.translate(header_line, TAB, "")),
        COMMA,
    ).otherwise(TAB)


def choose_delimiter(header_line: str, requested: str = TAB) -> tuple[str, str]:
    """The delimiter to use and the detected one; only a requested tab is overridden."""
    detected = COMMA if header_line.count(COMMA) > header_line.count(TAB) else TAB
    return (detected if requested == TAB else requested), detected


def read_header_line(spark: SparkSession, path: str | Sequence[str]) -> str:
    """First line of the first file, without byte-order marks."""
    files = file_names(spark, path)
    if not files:
        raise InputError(f"no input file at {path}")
    first = spark.read.text(files[0]).first()
    if first is None:
        raise InputError(f"the file is empty: {files[0]}")
    return first["value"].lstrip(BOM)


def read_header(spark: SparkSession, path: str | Sequence[str], sep: str = COMMA) -> list[str]:
    """The header cells; an empty file is an error."""
    return _cells(read_header_line(spark, path), sep)


def _cells(line: str, sep: str) -> list[str]:
    return next(csv.reader([line], delimiter=sep), [])


def profile_lines(
    spark: SparkSession, path: str | Sequence[str], sep: str, header_line: str
) -> DataFrame:
    """One row per file: line counts that decide how the file can be read.

    ``lines``, ``blank_lines``, ``open_lines`` (not a complete record on their own),
    ``invalid_lines`` (not UTF-8) and whether the first line is ``header_line``.
    """
    line = F.col("value")
    first_block = F.col("block") == 0
    same = (F.ltrim(line, F.lit(BOM)) == header_line).cast("int")
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
            "value",
        )
        .groupBy("file_path")
        .agg(
            F.count("*").alias("lines"),
            F.count_if(line == "").alias("blank_lines"),
            F.count_if(~line.rlike(line_patterns(sep)[0])).alias("open_lines"),
            F.count_if(~F.is_valid_utf8(line)).alias("invalid_lines"),
            # numbers only, so that the aggregate hashes and never sorts the lines
            F.min_by(same, F.when(first_block, F.col("row"))).alias("same_header"),
        )
    )


def cannot_split(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Whether all files are gzip, which one task each reads in any case."""
    return all(name.endswith(".gz") for name in file_names(spark, path))


def _positional(width: int) -> list[str]:
    return [f"_p{i}" for i in range(width)]


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    sep: str = TAB,
    strict: bool = False,
    names: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    max_chars: int = MAX_CELL_CHARS,
    encoding_errors: str = "strict",
    with_order: bool = False,
) -> DataFrame:
    """Scan delimited text as text columns, plain or gzip by file suffix.

    ``strict``: comma text whose records must have as many cells as the header.  All columns are
    returned under ``names`` (default: the header), with ``_corrupt`` holding the raw text of each
    record of another width.  Blank lines are an error; in gzip files, which are read once, they are records of
    another width, with empty raw text.  (Spark refuses a query that uses ``_corrupt`` alone, so read
    another column with it or stage the scan.)

    Lenient: blank lines are records of empty cells, ``sep`` is overridden by a detected comma when it is the
    default tab, short records are padded with ``''``, extra cells are ignored and of equal headers the last
    one counts.  ``columns`` selects headers; absent ones read as ``''``.

    ``encoding_errors='strict'`` refuses invalid UTF-8, ``'replace'`` reads U+FFFD for it.
    ``with_order`` adds the source position (file, block, row) of each record.  It orders records
    within one scan; stage the frame before a second use.
    """
    if encoding_errors not in ("strict", "replace"):
        raise InputError("encoding_errors must be 'strict' or 'replace'")
    header_line = read_header_line(spark, path)
    used = sep if strict else choose_delimiter(header_line, sep)[0]
    header = _cells(header_line, used)
    width = len(header) if strict else None
    lines = read_lines(spark, path)

    if cannot_split(spark, path):
        if encoding_errors == "strict":
            message = F.concat(F.col("file"), F.lit(": a line is not valid UTF-8"))
            checked = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.raise_error(message).cast("string"))
            lines = lines.withColumn("value", checked)
        records = read_records(lines, None, used, width=width, max_chars=max_chars, header_line=header_line)
        return _picked(_positioned(records, len(header), strict), header, strict, names, columns, with_order)

    summary = stage(with_starts(summarize(lines, used, header_line)), "ranges")
    totals = summary.agg(
        F.sum(F.when(F.col("start") == 0, F.col("blank0")).otherwise(F.col("blank1"))).alias("blank_records"),
        F.sum("other_header").alias("other"), *[F.sum(c).alias(c) for c in ("open", "odd", "blank", "invalid")],
    ).first()
    if encoding_errors == "strict" and totals["invalid"]:
        raise InputError(f"{totals['invalid']} lines of {path} are not valid UTF-8")
    if totals["other"]:
        raise InputError(f"{totals['other']} files at {path} have another header")
    if strict and totals["blank_records"]:
        raise InputError(f"{totals['blank_records']} records of {path} are blank lines")
    if totals["open"] or totals["odd"] or totals["blank"]:
        records = read_records(lines, summary, used, width=width, max_chars=max_chars)
        return _picked(_positioned(records, len(header), strict), header, strict, names, columns, with_order)
    plain = _plain_scan(spark, path, used, len(header), strict, max_chars)
    return _picked(plain, header, strict, names, columns, with_order)


def _positioned(records: DataFrame, width: int, strict: bool) -> DataFrame:
    """Records as columns by position; the raw text of those of another width."""
    cells = [F.get("cells", F.lit(i)).alias(p) for i, p in enumerate(_positional(width))]
    place = [F.col(c).alias(n) for c, n in zip(("file", "block", "row"), SOURCE_ORDER, strict=True)]
    return records.select(*cells, *([F.col("raw").alias(CORRUPT)] if strict else []), *place)


def _plain_scan(spark: SparkSession, path: str | Sequence[str], sep: str, width: int, strict: bool, max_chars: int) -> DataFrame:
    """Files of which every line is a plain record, by position."""
    positional = _positional(width)
    fields = [T.StructField(p, T.StringType()) for p in positional]
    if strict:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    read = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("charToEscapeQuoteEscaping", '"')  # else a NUL in a quoted cell would vanish
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxCharsPerColumn", max_chars)
        .option("maxColumns", 4 * width + SPARE_COLUMNS)
        .option("columnPruning", False)  # a pruned parse would not see a wrong width or a cell too long
        .csv(path if isinstance(path, str) else list(path))
    )
    whole = F.col(CORRUPT).isNull() if strict else F.lit(True)
    cells = [F.when(whole, F.coalesce(p, F.lit(""))).otherwise(F.col(p)).alias(p) for p in positional]
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    place = [c.alias(n) for c, n in zip(place, SOURCE_ORDER, strict=True)]
    return read.select(*cells, *([CORRUPT] if strict else []), *place)


def _picked(
    rows: DataFrame, header: list[str], strict: bool, names: Sequence[str] | None, columns: Sequence[str] | None, with_order: bool
) -> DataFrame:
    positional = _positional(len(header))
    if strict:
        picked = [F.col(p).alias(n) for p, n in zip(positional, names or header, strict=True)]
        picked.append(F.col(CORRUPT))
    else:
        last = dict(zip(header, positional, strict=True))
        picked = [
            (F.coalesce(F.col(last[n]), F.lit("")) if n in last else F.lit("")).alias(n)
            for n in (columns if columns is not None else last)
        ]
    return rows.select(*picked, *(SOURCE_ORDER if with_order else ()))


def record_numbers(df: DataFrame, name: str = "record_number", first: int = 2) -> DataFrame:
    """Add the dense number of each record, counting the header as 1, files in path order.

    Needs the source position columns of a staged, unfiltered scan.  Rows of a block are
    consecutive, so one small aggregate per block gives every offset; no row is sorted.
    """
    blocks = df.groupBy(SOURCE_FILE, SOURCE_BLOCK).agg(
        F.count("*").alias("_n"), F.min(SOURCE_ROW).alias("_start")
    )
    before = Window.orderBy(SOURCE_FILE, SOURCE_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        SOURCE_FILE,
        SOURCE_BLOCK,
        "_start",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    return (
        df.join(offsets, [SOURCE_FILE, SOURCE_BLOCK])
        .withColumn(name, F.col("_before") + F.col(SOURCE_ROW) - F.col("_start") + first)
        .drop("_before", "_start")
    )
