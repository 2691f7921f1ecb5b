"""Whole texts in Arrow batches, and texts cut into blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Text that one step of a vectorised loop holds; shapes memory, not results.
BLOCK_CHARS = 1 << 21


def per_document(
    docs: DataFrame,
    columns: dict[str, str | Column],
    function: Callable[[list[list]], dict[str, object]],
    schema: str,
) -> DataFrame:
    """Rows made from ``columns`` of each document, without a shuffle.

    ``function`` gets the values of all columns but the first for a few documents of together about
    ``BLOCK_CHARS`` (the last column is the text) and returns the columns of ``schema`` that follow the
    first one.  The first column (the id, nulls included) is passed through by position.
    """
    names = list(columns)
    source = docs.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])
    made_fields = T.StructType.fromDDL(schema).fields
    target = T.StructType([source.schema[0], *made_fields])
    outputs = [f.name for f in made_fields]
    types = [f.type for f in to_arrow_schema(T.StructType(made_fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(text_lengths(batch.column(len(names) - 1))):
                part = batch.slice(start, stop - start)
                made = function([part.column(i).to_pylist() for i in range(1, len(names))])
                arrays = [part.column(0)]
                for name, kind in zip(outputs, types, strict=True):
                    values = made[name]
                    arrays.append(values if isinstance(values, pa.Array) else pa.array(values, type=kind))
                yield pa.RecordBatch.from_arrays(arrays, names=[names[0], *outputs])

    return source.mapInArrow(run, target)


def text_lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def slices(lengths: np.ndarray, size: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` characters; a longer text has a range of its own."""
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > size:
            yield start, i
            start, held = i, 0
        held += n
    if len(lengths) > start:
        yield start, len(lengths)


def coded_words(texts: pa.Array, table: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of all texts, one after another: the row and the code of each, and the distinct words by code.

    ``table`` gives every byte what stands for it in a word; what it makes a space parts words.  A null text has
    no words.  The distinct words may include an empty one, which no code means.
    """
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    body = bytes(memoryview(data)[ends[0] : ends[-1]]) if ends[-1] > ends[0] else b""
    cleaned = pa.StringArray.from_buffers(len(texts), pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(body.translate(table)))
    lists = pc.ascii_split_whitespace(cleaned)
    coded = lists.flatten().dictionary_encode()
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if (blank := coded.dictionary.index("").as_py()) >= 0:
        real = np.flatnonzero(codes != blank)
        rows, codes = rows[real], codes[real]
    return rows, codes, coded.dictionary


def united(coded: list[tuple[np.ndarray, pa.Array]]) -> tuple[np.ndarray, pa.Array]:
    """Codes of several arrays of distinct words, one after another, as codes of one such array."""
    arrays = [pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), words) for codes, words in coded]
    if not arrays:
        return np.zeros(0, np.int64), pa.array([], type=pa.string())
    chunks = pa.chunked_array(arrays).unify_dictionaries().chunks
    return np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in chunks]).astype(np.int64), chunks[0].dictionary


def ragged_gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[s:s+n]`` for all ``s, n``."""
    total = int(lengths.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lengths)
    offsets = np.repeat(starts - (ends - lengths), lengths)
    return flat[np.arange(total, dtype=np.int64) + offsets]


def sums(values: np.ndarray, lengths: Iterable[int]) -> np.ndarray:
    """The sum of each of the consecutive groups of ``lengths``; 0 for an empty group."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    lengths = np.asarray(lengths, dtype=np.int64)
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]
