"""Records of delimited text whose cells may hold line breaks, read in byte ranges by many tasks.

Whether a line stands inside a quoted cell depends on all lines before it, but only through one bit.  So a first
pass says for every byte range how it would end for either state at its start, a running composition over the
ranges of a file gives each its true state, and then each range reads from its first true record border.
A record that goes on over the end of a range is the only thing that moves: its pieces meet by a shuffle.

A record is what Python's csv reader makes of it: text behind a closing quote belongs to the cell, a blank
line is a record without cells, and a carriage return outside quotes ends a record, too.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.functions.text import BOM
from granary.session import stage

_SUMMARY = """
    file string, block bigint, end0 int, end1 int, blank0 bigint, blank1 bigint, lines bigint, open bigint, odd bigint,
    blank bigint, invalid bigint, other_header bigint
"""
_RECORDS = "file string, block bigint, row bigint, cells array<string>, raw string, piece string"
_PIECE_END = re.compile(r"(?<=\r)(?!\n)")


def line_patterns(sep: str) -> tuple[str, str, str]:
    """Patterns of a line that ends a record: begun outside quotes, begun inside, and outside with every closing
    quote at the end of its cell."""
    s = re.escape(sep)
    quoted, bare = r'[^"]*+(?:""[^"]*+)*+"', rf'[^"{s}\r][^{s}\r]*+'
    cell, plain = rf'(?:"{quoted}[^{s}\r]*+|{bare}|)', rf'(?:"{quoted}|{bare}|)'
    more = rf"(?:[{s}\r]{cell})*+\z"
    return rf"^{cell}{more}", rf"^{quoted}[^{s}\r]*+{more}", rf"^{plain}(?:[{s}\r]{plain})*+\z"


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines of text files with the byte range that they lie in; a carriage return is part of its line."""
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _flags(sep: str) -> list[Column]:
    """For a line: open if begun outside quotes, open if begun inside.  Both are plain without a quote."""
    outside, inside, _ = line_patterns(sep)
    line, quoted = F.col("value"), F.col("value").contains('"')
    return [(quoted & ~line.rlike(outside)).alias("open0"), (~quoted | ~line.rlike(inside)).alias("open1")]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Rows of a batch that come from one byte range: the range, first row, end row."""
    names = pc.dictionary_encode(batch.column(0))
    code, block = names.indices.to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
    for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(code)], strict=True) if len(code) else ():
        yield (names.dictionary[int(code[start])].as_py(), int(block[start])), start, stop


def _states(open0: np.ndarray, open1: np.ndarray, first: int) -> np.ndarray:
    """Whether each line, and what follows the last one, begins inside quotes, if the first one does."""
    place = np.arange(len(open0))
    fixed, turns = open0 == open1, np.concatenate([[0], np.cumsum(open0 & ~open1)])
    last = np.maximum.accumulate(np.concatenate([[-1], np.where(fixed, place, -1)]))
    known = np.where(last >= 0, open0[last], first)
    return (known + turns - turns[last + 1]) % 2


def summarize(lines: DataFrame, sep: str, header_line: str) -> DataFrame:
    """One row per byte range: its end state and blank records for either state at its start, and counts of
    lines that are open, oddly quoted, blank, not UTF-8, or a first line other than ``header_line``.

    Only flags reach Python; nothing is shuffled.
    """
    line = F.col("value")
    empty = (line == "") | (line == "\r")
    checks = [
        empty.alias("blank"), (line.contains('"') & ~line.rlike(line_patterns(sep)[2])).alias("odd"), (~F.is_valid_utf8(line)).alias("invalid"),
        (F.rtrim(F.ltrim(line, F.lit(BOM)), F.lit("\r")) != header_line.rstrip("\r")).alias("other"),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, int] | None = None
        ends, counts = np.zeros(2, np.int64), np.zeros(8, np.int64)

        def done() -> pa.RecordBatch:
            values = [held[0], held[1], *ends.tolist(), *counts.tolist()]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 8]
            return pa.RecordBatch.from_arrays([pa.array([v], type=k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            open0, open1, blank, odd, invalid, other = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[2:])
            for of, start, stop in _runs(batch):
                if of != held:
                    if held is not None:
                        yield done()
                    held, ends, counts = of, np.array([0, 1]), np.zeros(8, np.int64)
                    counts[7] = other[start] if of[1] == 0 else 0
                for first in (0, 1):
                    state = _states(open0[start:stop], open1[start:stop], int(ends[first]))
                    counts[first] += int(((state[:-1] == 0) & (blank[start:stop] == 1)).sum())
                    ends[first] = state[-1]
                counts[2] += stop - start
                counts[3:7] += [int(x[start:stop].sum()) for x in (open0, odd, blank, invalid)]
        if held is not None:
            yield done()

    names = [part.split()[0] for part in _SUMMARY.split(",")]
    return lines.select("file", "block", *_flags(sep), *checks).mapInArrow(run, _SUMMARY)


def with_starts(summary: DataFrame) -> DataFrame:
    """Add ``start``: whether a range begins inside quotes, from the ranges before it in its file; and ``goes_on``:
    whether the next one does."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.col("end0") * (1 - F.col("end1"))).over(before), F.lit(0))
    fixed = F.when(F.col("end0") == F.col("end1"), F.struct("end0", "turns", "turn"))
    last = F.last(fixed, ignorenulls=True).over(before)
    counted = summary.withColumn("turns", turns).withColumn("turn", F.col("end0") * (1 - F.col("end1")))
    since = F.col("turns") - F.coalesce(F.col("last.turns") + F.col("last.turn"), F.lit(0))
    started = counted.withColumn("last", last).withColumn("start", ((F.coalesce("last.end0", F.lit(0)) + since) % 2).cast("int"))
    after = F.lead("start", 1, 0).over(Window.partitionBy("file").orderBy("block"))
    return started.withColumn("goes_on", after).drop("turns", "turn", "last")


def _reader(lines: list[str], sep: str) -> tuple[list[str], Iterator[list[str]]]:
    pieces = []
    for line in lines:
        pieces += _PIECE_END.split(line + "\n") if "\r" in line[:-1] else [line + "\n"]
    return pieces, csv.reader(pieces, delimiter=sep)


def _parsed(lines: list[str], sep: str, width: int | None) -> Iterator[tuple[list[str], str | None]]:
    """The records of whole lines, and the raw text of those that have not ``width`` cells."""
    pieces, reader = _reader(lines, sep)
    at = 0
    for cells in reader:
        raw = "".join(pieces[at : reader.line_num]).rstrip("\r\n") if width is not None and len(cells) != width else None
        at = reader.line_num
        yield cells, raw


def _scan(lines: DataFrame, sep: str, crossed: dict[str, dict[int, tuple]], width: int | None, max_chars: int, header_line: str | None) -> DataFrame:
    """Records of each range; pieces of records that cross a border come out as text, ``row`` -1 for those that
    end a record of an earlier range or only go on with it.

    ``crossed``: by file and range, whether it begins inside quotes, and whether the next one does; none for
    ranges of which neither holds.  ``header_line``: what the first line of a file must be, if nothing has checked that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(max_chars)
        held, state, row, pending, goes_on = None, 0, 0, [], 0
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()]

        def rows(values: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*values, strict=True)) if values else [()] * 4
            names = [[held[0]] * len(values), [held[1]] * len(values)]
            arrays = [pa.array(c, type=k) for c, k in zip([*names, *columns], kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["file", "block", "row", "cells", "raw", "piece"])

        def left() -> pa.RecordBatch:
            """What the range ends with: a piece, or the last record of its file, which nothing closes."""
            if goes_on or row < 0:
                return rows([(row, None, None, "\n".join(pending) + "\n")])
            return rows([(row + k, *x, None) for k, x in enumerate(_parsed(pending, sep, width))])

        for batch in batches:
            open0, open1 = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
            for of, start, stop in _runs(batch):
                some = batch.column(4).slice(start, stop - start).to_pylist()
                flags = [open0[start:stop], open1[start:stop]]
                if of != held:
                    if pending:
                        yield left()
                    state, goes_on = crossed.get(of[0], {}).get(of[1], (0, 0))
                    held, row, pending = of, -state, []
                    if of[1] == 0:  # the header
                        if header_line is not None and some[0].lstrip(BOM).rstrip("\r") != header_line.rstrip("\r"):
                            raise ValueError(f"{of[0]} has another header")
                        some, flags = some[1:], [f[1:] for f in flags]
                if not some:
                    continue
                states = _states(*flags, state)
                state = int(states[-1])
                ends = np.flatnonzero(states[1:] == 0)
                if not len(ends):
                    pending += some
                    continue
                made = []
                first = 0
                if row < 0:  # what is left of a record of an earlier range
                    first = int(ends[0]) + 1
                    made.append((-1, None, None, "\n".join([*pending, *some[:first]]) + "\n"))
                    row, pending = 0, []
                last = int(ends[-1]) + 1
                for cells, raw in _parsed(pending + some[first:last], sep, width):
                    made.append((row, cells, raw, None))
                    row += 1
                pending = some[last:]
                yield rows(made)
        if pending:
            yield left()

    valid = F.make_valid_utf8("value").alias("value")
    return lines.select("file", "block", *_flags(sep), valid).mapInArrow(run, _RECORDS)


def _joined(pieces: DataFrame, sep: str, width: int | None, max_chars: int) -> DataFrame:
    """The records that cross borders, at the place where they begin."""
    order = Window.partitionBy("file").orderBy("block", "row")
    begun = F.sum(F.when(F.col("row") >= 0, 1).otherwise(0)).over(order)
    whole = pieces.withColumn("record", begun).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "piece"))).alias("parts")
    )
    place = F.col("parts")[0]
    texts = whole.select("file", place["block"].alias("block"), place["row"].alias("row"), F.array_join("parts.piece", "").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(max_chars)
        for batch in batches:
            found = [next(_parsed(text.removesuffix("\n").split("\n"), sep, width)) for text in batch.column(3).to_pylist()]
            arrays = [pa.array([x[0] for x in found], type=pa.list_(pa.string())), pa.array([x[1] for x in found], type=pa.string())]
            arrays.append(pa.nulls(batch.num_rows, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names=["file", "block", "row", "cells", "raw", "piece"])

    return texts.mapInArrow(run, _RECORDS)


def read_records(
    lines: DataFrame, summary: DataFrame | None, sep: str, *, width: int | None, max_chars: int, header_line: str | None = None
) -> DataFrame:
    """``file``, ``block``, ``row`` (place in its range), ``cells`` and ``raw`` of every record behind the headers.

    ``summary`` (see :func:`with_starts`) is None for files of one range each.  ``raw`` is the text of a record that has
    not ``width`` cells.  An unclosed quote at the end of a file closes there.

    The driver gets two bits per range that has a record across its border.  Only if there are any, the records are
    staged, as their pieces are read apart.
    """
    crossed: dict[str, dict[int, tuple]] = {}
    if summary is not None:
        for file, block, *bits in summary.where("start = 1 OR goes_on = 1").select("file", "block", "start", "goes_on").collect():
            crossed.setdefault(file, {})[block] = tuple(bits)
    records = _scan(lines, sep, crossed, width, max_chars, header_line)
    if crossed:
        records = stage(records, "records")
        pieces = records.where("piece IS NOT NULL").select("file", "block", "row", "piece")
        records = records.where("piece IS NULL").unionByName(_joined(pieces, sep, width, max_chars))
    return records.drop("piece")
