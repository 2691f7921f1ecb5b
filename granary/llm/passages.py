"""Which documents share a content key, and lists of such keys brought back to the texts.

A document is known by its id here, smaller ids come first, and a missing id comes last; rows with one
id count as one document.  Rows are (key, id).  Before they are shuffled, each block of documents settles
what it can: of the documents of a block that share a key only the first needs to meet other blocks, so a
key that a third of all documents hold sends a row per block.  The rest travels as arrays, one for each
block and bucket of keys, is sorted by key, and is decided in one pass that remembers a single row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import slices, text_lengths

#: Stands for a missing id.
LAST = (1 << 63) - 1
BUCKETS_PER_PARTITION = 4


#: From some texts, the number of the text and the unsigned key of each of their keys.
KeysOf = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def order_of(id: str) -> Column:
    return F.coalesce(F.col(id).cast("bigint"), F.lit(LAST))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hash_factors() -> tuple[np.ndarray, np.uint64, np.uint64]:
    """Random value of each byte, an odd factor, and its inverse modulo 2**64."""
    values = np.random.default_rng(50).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    factor = 0x9E3779B97F4A7C15
    return values, np.uint64(factor), np.uint64(pow(factor, -1, 2**64))


_VALUES, _FACTOR, _INVERSE = hash_factors()
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse; kept for the next text, as they depend on nothing else."""
    if len(_POWERS[0]) < size:
        for i, base in enumerate((_FACTOR, _INVERSE)):
            steps = np.full(max(size, 1 << 16), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0][:size], _POWERS[1][:size]


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class Hashes:
    """Hashes of any substrings of some bytes, from the running sums of one polynomial."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * powers[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def windows(self, size: int) -> np.ndarray:
        """The hash of every substring of one length."""
        count = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:-size]) * self.inverse[:count])


def _lists(bucket: np.ndarray, uid: np.ndarray, key: np.ndarray, first: np.ndarray | None) -> pa.RecordBatch:
    """One row per bucket, with the ids and keys of a block, in order of the ids."""
    order = np.lexsort((uid, bucket))
    bucket, uid, key = bucket[order], uid[order], key[order]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    offsets = pa.array(np.append(starts, len(key)).astype(np.int32))
    if first is None:
        firsts = pa.ListArray.from_arrays(pa.array(np.zeros(len(starts) + 1, np.int32)), pa.array([], pa.int64()))
    else:
        firsts = pa.ListArray.from_arrays(offsets, pa.array(first[order]))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (uid, key)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), *lists, firsts], names=["bucket", "uids", "keys", "firsts"])


def settle(uid: np.ndarray, key: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of a block: the first id of each key has yet to meet other blocks; ids that share a key inside
    the block are known to share it, with that first id as holder."""
    order = np.lexsort((uid, key))
    uid, key = uid[order], key[order]
    if not len(key):
        return
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (uid[1:] != uid[:-1])])
    uid, key = uid[once], key[once]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    run = np.cumsum(new) - 1
    holder = uid[np.flatnonzero(new)][run]
    yield _lists((key[new].view(np.uint64) % np.uint64(buckets)).astype(np.int64), uid[new], key[new], None)
    shared = np.bincount(run)[run] > 1
    if shared.any():
        place = (mix(uid[shared].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        yield _lists(place, uid[shared], key[shared], holder[shared])


def first_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, key, first) of all rows whose key two ids hold, from rows (key, uid, first) sorted by key and
    uid; a row with ``first`` is known already.  Only the first row of the last key is remembered."""
    held: tuple[int, int, bool] | None = None  # key, smallest uid, whether that row went out
    for batch in batches:
        key, uid = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        first = batch.column(2)
        known = first.is_valid().to_numpy(zero_copy_only=False)
        if known.any():
            yield _triples(uid[known], key[known], first.drop_null().to_numpy(zero_copy_only=False))
        key, uid = key[~known], uid[~known]
        if not len(key):
            continue
        again = held is not None and held[0] == key[0]
        if again:
            key, uid = np.concatenate([[held[0]], key]), np.concatenate([[held[1]], uid])
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(starts[1:], len(key))
        smallest = uid[starts]
        several = uid[ends - 1] != smallest
        out = np.repeat(several, ends - starts)
        sent = bool(several[-1])
        if again and held[2]:
            out[0] = False
            sent |= len(starts) == 1
        held = (int(key[-1]), int(smallest[-1]), sent)
        yield _triples(uid[out], key[out], np.repeat(smallest, ends - starts)[out])


def _triples(uid: np.ndarray, key: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(key), pa.array(first)], names=["uid", "key", "first"])


def shared_keys(bodies: DataFrame, keys_of: KeysOf) -> DataFrame:
    """``uid``, ``key`` and ``first`` (the smallest id that holds the key, or the smallest of a block of
    documents) of every key that two documents hold; a row may come more than once.

    ``bodies``: ``uid``, the bytes of each text (plain, or as ``packed`` by ``packed_texts``), and whether
    the text takes part; further columns are not looked at.
    """
    count = partitions(bodies)
    read = unpack if bodies.columns[1] == "packed" else bytes
    buckets = count * BUCKETS_PER_PARTITION

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(text_lengths(batch.column(1))):
                part = batch.slice(start, stop - start)
                uids = part.column(0).to_numpy(zero_copy_only=False)
                taken = zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)
                number, keys = keys_of([read(t) if t and use else b"" for t, use in taken])
                yield from settle(uids[number], keys.view(np.int64), buckets)

    spread_out = bodies.mapInArrow(spread, "bucket int, uids array<bigint>, keys array<bigint>, firsts array<bigint>")
    sorted_ = (
        spread_out.repartition(count, "bucket")
        .select(F.inline(F.arrays_zip("uids", "keys", "firsts")).alias("uid", "key", "first"))
        .select("key", "uid", "first").sortWithinPartitions("key", "uid")
    )
    return sorted_.mapInArrow(first_holders, "uid bigint, key bigint, first bigint")


def packed_texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``id``, ``uid`` and ``packed`` (the UTF-8 bytes, compressed; null for a null text) of each row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for start, stop in slices(text_lengths(batch.column(2))):
                part = batch.slice(start, stop - start)
                texts = part.column(2).cast(pa.binary()).to_pylist()
                packed = pa.array([None if t is None else compressor.compress(t) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), packed], names=["id", "uid", "packed"])

    rows = docs.select(F.col(id).alias("id"), order_of(id).alias("uid"), F.col(text).alias("text"))
    return rows.mapInArrow(pack, f"id {rows.schema['id'].dataType.simpleString()}, uid bigint, packed binary")


def unpack(packed: bytes | None) -> bytes:
    return b"" if packed is None else zstandard.ZstdDecompressor().decompress(packed)
