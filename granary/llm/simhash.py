"""Near-duplicate documents by SimHash fingerprints, linked through deletion variants.

A fingerprint has 64 bits.  Two of them that differ in at most two bits agree, in one of their two
halves, in all bits but one at most; so they share one of the keys made from a half by leaving out one
of its 32 bits.  Equal keys meet by an equality shuffle, and every candidate is verified on all bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import per_document
from granary.llm.components import components
from granary.session import stage

SHINGLE = 3
SEED = 42  # of XXH64
HALF = 32
MAX_DIFFERENT = 2
#: Fingerprints under one key that are compared with each other; the members of a larger key look up
#: all fingerprints that differ in at most two bits instead, so work per fingerprint stays bounded.
COMPARED = 2048
#: Bytes of one long text that are hashed at a time; shapes memory, not results.
PIECE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

#: Bit b (from the lowest) of each byte value, as counts of a byte value turn into counts of bits.
_BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :] & 1).astype(np.int64)


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, of a long one piece by piece."""
    start = 0
    while start < len(data):
        cut = _SPACE.search(data, min(start + PIECE_BYTES, len(data)))
        end = cut.start() if cut else len(data)
        yield data[start:end].split()
        start = end


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit SimHash of the ``size``-word shingles of a text; 0 without words.

    ASCII letters count in lower case; words are what stands between ASCII white space.  A text of fewer
    words is one shingle.  A bit is set if it is set in over half of all shingle hashes, repeats included.
    """
    total, ones, words = 0, np.zeros((8, 256), dtype=np.int64), []
    digest = xxhash.xxh64_intdigest

    def add(shingles: Iterator[bytes]) -> int:
        hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
        for k, column in enumerate(hashes.view(np.uint8).reshape(-1, 8).T):
            ones[k] += np.bincount(column, minlength=256)
        return len(hashes)

    for some in _words((text or "").encode().lower()):
        words += some
        if len(words) >= size:
            total += add(map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False)))
            words = words[len(words) - size + 1 :]
    if not total and words:
        total = add(iter([b" ".join(words)]))
    set_ = (ones @ _BITS).ravel() * 2 > total
    return int(np.packbits(set_, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``fp`` (the fingerprint as a signed long) of each row; nothing is shuffled."""

    def run(columns: list[list]) -> dict:
        found = np.array([fingerprint(t) for t in columns[0]], dtype=np.uint64)
        return {"fp": pa.array(found.view(np.int64))}

    return per_document(docs, {id: id, text: text}, run, "fp bigint")


def _keys(fp: str) -> Column:
    """The 64 deletion variants: half, bit left out, and the other 31 bits of the half."""
    keys = []
    for half in (0, 1):
        bits = F.shiftrightunsigned(fp, HALF) if half else F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF))
        for bit in range(HALF):
            low = bits.bitwiseAND(F.lit((1 << bit) - 1).cast("bigint"))
            high = F.shiftleft(F.shiftright(bits, bit + 1), bit)
            keys.append(high.bitwiseOR(low).bitwiseOR(F.lit((half * HALF + bit) << (HALF - 1)).cast("bigint")))
    return F.array(*keys)


def _popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


def _verified(keys: np.ndarray, fps: np.ndarray, new: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key, each pair under one of its common keys only.

    ``new``: the rows before this place have been compared with each other already.
    """
    left, right = [], []
    for step in range(1, len(keys)):
        at = np.arange(max(0, new - step), len(keys) - step)
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        differ = fps[at] ^ fps[at + step]
        low, high = differ & np.uint64(0xFFFFFFFF), differ >> np.uint64(HALF)
        place = (keys[at] >> (HALF - 1)).astype(np.uint64)
        bit = np.uint64(1) << (place & np.uint64(HALF - 1))
        first = (place < HALF) & (((low == 0) & (bit == 1)) | (low == bit))
        first |= (place == HALF) & (_popcount(low) == MAX_DIFFERENT)
        good = first & (_popcount(differ) <= MAX_DIFFERENT)
        left.append(fps[at[good]])
        right.append(fps[at[good] + step])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _link(batches: Iterator[pa.RecordBatch], compared: int = COMPARED) -> Iterator[pa.RecordBatch]:
    """Links of (key, fp) rows sorted by key; members of a key with over ``compared`` rows come out alone.

    Only the rows of the last key are carried from batch to batch, and at most ``compared`` of them.
    """
    keys, fps, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None

    def output(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        a = a.view(np.int64)
        other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a), other], names=["a", "b"])

    for batch in batches:
        new = len(keys)
        keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(keys):
            continue
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        large = sizes > compared
        if hot is not None:
            large |= keys[starts] == hot
        if large.any():
            members = np.repeat(large, sizes)
            yield output(fps[members], None)
            if large[-1]:
                hot = keys[-1]
            new -= int(members[:new].sum())
            keys, fps = keys[~members], fps[~members]
        yield output(*_verified(keys, fps, new))
        rest = keys == keys[-1] if len(keys) and not large[-1] else np.zeros(len(keys), bool)
        keys, fps = keys[rest], fps[rest]


def _near(fp: int) -> list[int]:
    masks = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i, j in combinations(range(64), 2))]
    return [fp ^ m for m in masks]


def links(classes: DataFrame, compared: int = COMPARED) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``fp``) that differ in at most two bits."""
    keyed = classes.select("fp", F.explode(_keys("fp")).alias("key")).select("key", "fp")
    sorted_ = keyed.repartition("key").sortWithinPartitions("key")
    found = stage(sorted_.mapInArrow(lambda b: _link(b, compared), "a bigint, b bigint"), "simhash-links")
    pairs = found.where("b IS NOT NULL")
    masks = [m - (1 << 64) if m >> 63 else m for m in _near(0)[1:]]
    hot = found.where("b IS NULL").select("a").distinct()
    around = hot.select("a", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("mask"))
    around = around.select("a", F.col("a").bitwiseXOR(F.col("mask")).alias("b"))
    met = around.join(classes.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")
    return pairs.unionByName(met) if not hot.isEmpty() else pairs


def groups(fps: DataFrame) -> DataFrame:
    """``fp`` and ``root`` (the smallest fingerprint of its component) of each distinct ``fp``."""
    classes = stage(fps.select("fp").distinct(), "simhash-classes")
    found = components(links(classes)).withColumnRenamed("node", "fp")
    return classes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row.

    Fingerprints that differ in at most two bits are linked; a component is what links connect, and its
    id is the smallest document id in it.  Texts without words (null and empty ones) have fingerprint 0,
    which is linked like any other.  A row without an id has the component of its fingerprint, and a
    component has no id if none of its rows has one.  Repeated rows come out as often as they go in;
    other columns are not read.

    Equal fingerprints are one class from the first aggregation on, so thousands of copies cost as much
    as one text; all that is shuffled is fingerprints, never text.
    """
    fps = stage(fingerprints(docs, id, text), "simhash-fingerprints")
    rooted = stage(groups(fps), "simhash-groups")
    first = fps.groupBy("fp").agg(F.min(id).alias("first")).join(rooted, "fp")
    named = first.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(rooted.join(named, "root").select("fp", "component_id"), "fp").select(
        id, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``near_duplicates``, with all columns of ``docs``.

    It is the one with the smallest id (rows without an id come last), then the smallest hash of its
    text; of rows that agree in both any one.  Components meet in an aggregation with partial minima; of
    the texts, only those that stay are joined back.
    """
    held = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs[id].alias("id"), docs[text].alias("text"),
        F.xxhash64(docs[text]).alias("hash"),
    )
    rows = held.select(F.struct("id", "hash").alias("row"), "text")
    fps = stage(fingerprints(rows, "row").select("row.id", "row.hash", "fp"), "simhash-fingerprints")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "hash")
    best = fps.groupBy("fp").agg(F.min(order).alias("best")).join(groups(fps), "fp")
    chosen = best.groupBy("root").agg(F.min("best").alias("best")).select(
        F.col("best.id").alias("kept_id"), F.col("best.hash").alias("kept_hash")
    )
    kept = held.join(
        stage(chosen, "simhash-kept"),
        F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi",
    )
    return kept.dropDuplicates(["id", "hash"]).select("doc.*")
