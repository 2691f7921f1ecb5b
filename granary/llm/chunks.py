"""Substring deduplication by content-defined chunks.

A gear hash of the last 32 bytes decides where a chunk ends, so chunks of equal passages are equal
wherever they stand: an insertion changes the chunks at its place and no others.  Chunks are compared by
digest.  A run of chunks that an earlier document holds is removed once it is long enough that chance, a
common phrase or an accidental equality of digests can't be the reason.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import per_document
from granary.llm.passages import Hashes, order_of, packed_texts, partitions, shared_keys, unpack

#: Mean length of a chunk in bytes, and the length after which one ends anyway.
MEAN_CHUNK, MAX_CHUNK = 16, 256
#: Bytes that consecutive repeated chunks must cover to be removed.
MIN_RUN = 130
#: Bytes of a text that the vectorised loops hold at a time; shapes memory, not results.
BLOCK_BYTES = 1 << 20
_GEAR = np.random.default_rng(32).integers(0, 2**32, size=256, dtype=np.uint32)


def cuts(data: np.ndarray) -> np.ndarray:
    """The ends of the chunks of some bytes; a chunk never ends inside a character.

    The gear hash ``h = 2 h + gear[byte]`` modulo 2**32 depends on 32 bytes; it is built by doubling: the
    hash of 2 n bytes is that of the last n and, shifted by n, that of the n before.
    """
    size = len(data)
    if not size:
        return np.zeros(0, dtype=np.int64)
    found = []
    for begin in range(0, size, BLOCK_BYTES):
        context = max(begin - 31, 0)
        gear = _GEAR[data[context : begin + BLOCK_BYTES]]
        for step in (1, 2, 4, 8, 16):
            shifted = gear[:-step] << np.uint32(step)
            gear = gear.copy()
            gear[step:] += shifted
        found.append(np.flatnonzero(gear[begin - context :] < np.uint32(2**32 // MEAN_CHUNK)) + begin + 1)
    found = np.concatenate(found)
    inside = np.append((data & 0xC0) == 0x80, False)  # a character goes on at this place
    starts = np.flatnonzero(~inside)
    found = starts[np.searchsorted(starts, found)]
    found = np.unique(np.append(found, size))
    lengths = np.diff(found, prepend=0)
    if lengths.max() > MAX_CHUNK:
        extra = [
            np.arange(end - n + MAX_CHUNK, end, MAX_CHUNK)
            for end, n in zip(found[lengths > MAX_CHUNK], lengths[lengths > MAX_CHUNK], strict=True)
        ]
        extra = starts[np.searchsorted(starts, np.concatenate(extra))]
        found = np.unique(np.concatenate([found, extra]))
    return found


def chunk_digests(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends and 64-bit digests of the chunks of a text."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends = cuts(data)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    digests = np.zeros(len(ends), dtype=np.uint64)
    for at in np.split(np.arange(len(ends)), np.searchsorted(ends, np.arange(BLOCK_BYTES, len(data), BLOCK_BYTES))):
        if len(at):
            first = starts[at[0]]
            digests[at] = Hashes(data[first : ends[at[-1]]]).of(starts[at] - first, ends[at] - first)
    return ends, digests


def _digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = [chunk_digests(t)[1] for t in texts]
    return np.repeat(np.arange(len(texts)), [len(f) for f in found]), np.concatenate([np.zeros(0, np.uint64), *found])


def repeated_runs(ends: np.ndarray, first: np.ndarray, uid: int) -> list[dict]:
    """Byte ranges of runs of chunks whose ``first`` holder comes before ``uid``, with those holders."""
    runs, start = [], None
    for i in np.flatnonzero(np.diff(np.concatenate([[0], first < uid, [0]]).astype(np.int8))).tolist():
        if start is None:
            start = i
            continue
        begin, end = int(ends[start - 1]) if start else 0, int(ends[i - 1])
        if end - begin >= MIN_RUN:
            runs.append({"start": begin, "end": end, "sources": np.unique(first[start:i]).tolist()})
        start = None
    return runs


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("sources", pa.list_(pa.int64()))]))


def dedupe(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_bytes``, ``n_chunks``, ``n_shared`` (bytes of chunks that another document holds too),
    ``runs`` (byte ranges removed, and earlier documents that hold their chunks) and ``kept`` (the text
    without them) of each row.

    The first holder of a passage keeps it.  Rows with one id count as one document and do not remove from
    each other; a row without an id comes after all others.  A null text is empty; an empty text has no
    chunks.  Every row gives one row; other columns are not read.
    """
    lists = (
        shared_keys(
            docs.select(order_of(id).alias("uid"), F.col(text).cast("binary").alias("body"), F.lit(True).alias("use")), _digests
        )
        .groupBy("uid").agg(F.collect_list(F.struct("key", "first")).alias("shared"))  # at most a document's chunks
    )
    joined = packed_texts(docs, id, text).repartition(partitions(docs), "uid").join(lists, "uid", "left")

    def run(columns: list[list]) -> dict:
        out = {"n_bytes": [], "n_chunks": [], "n_shared": [], "runs": [], "kept": []}
        for uid, shared, packed in zip(*columns, strict=True):
            body = unpack(packed)
            ends, digests = chunk_digests(body)
            first = np.full(len(ends), uid, dtype=np.int64)
            known = np.zeros(len(ends), dtype=bool)
            if shared:
                pairs = sorted((s["key"], s["first"]) for s in shared)
                keys, at = np.unique(np.array([k for k, _ in pairs], dtype=np.int64), return_index=True)
                holders = np.array([f for _, f in pairs], dtype=np.int64)[at]  # the smallest of each key
                place = np.minimum(np.searchsorted(keys, digests.view(np.int64)), len(keys) - 1)
                known = keys[place] == digests.view(np.int64)
                first[known] = holders[place[known]]
            runs = repeated_runs(ends, first, uid)
            kept, start = [], 0
            for r in runs:
                kept.append(body[start : r["start"]])
                start = r["end"]
            out["n_bytes"].append(len(body))
            out["n_chunks"].append(len(ends))
            out["n_shared"].append(int(np.diff(ends, prepend=0)[known].sum()))
            out["runs"].append(runs)
            out["kept"].append((b"".join(kept) + body[start:]).decode())
        return out | {"runs": pa.array(out["runs"], type=RUNS)}

    return per_document(
        joined, {id: "id", "uid": "uid", "shared": "shared", "packed": "packed"}, run,
        "n_bytes bigint, n_chunks bigint, n_shared bigint, "
        "runs array<struct<start:bigint,end:bigint,sources:array<bigint>>>, kept string",
    )


def summary(deduped: DataFrame) -> DataFrame:
    """Counts, the earlier documents that removed passages repeat, and a digest of the kept text."""
    removed = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    sources = F.array_sort(F.array_distinct(F.flatten(F.transform("runs", lambda r: r["sources"]))))
    return deduped.select(
        "doc_id", "n_bytes", "n_chunks", "n_shared", removed.alias("n_removed"),
        F.size("runs").cast("bigint").alias("n_runs"), sources.alias("source_ids"), F.sha2("kept", 256).alias("kept_sha256"),
    )
