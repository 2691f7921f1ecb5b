"""Benchmark decontamination: word windows of benchmark items, held as hash sets that every task has,
are looked up at every word of the documents, and every hit is verified word by word."""

from __future__ import annotations

import re
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.batches import per_document

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Words of a window.
WINDOW = 13
#: Benchmark text that one broadcast index is made from; a larger benchmark has several indexes.
INDEX_BYTES = 16 << 20
#: Words of one long text that are handled at a time; shapes memory, not results.
WORDS_AT_A_TIME = 200_000


def _words(text: bytes):
    """Lists of words of bounded size."""
    if len(text) <= 4 * WORDS_AT_A_TIME:
        yield WORD.findall(text.lower())
        return
    found = WORD.finditer(text.lower())
    while some := [m.group() for m in islice(found, WORDS_AT_A_TIME)]:
        yield some


class Index:
    """The windows of some items: word numbers, and for each window length a sorted array of hashes."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.item_ids = [i for i, _ in items]
        by_length: dict[int, list] = {}
        for item, (_, text) in enumerate(items):
            words = [w for some in _words((text or "").encode()) for w in some]
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                by_length.setdefault(size, []).append((ids[at : at + size], item))
        self.tables = [self._table(size, rows) for size, rows in sorted(by_length.items())]

    @staticmethod
    def _table(size: int, rows: list) -> tuple:
        """Window length, factors of the hash, sorted hashes, their word numbers, and the items of each."""
        windows, back = np.unique(np.array([w for w, _ in rows], dtype=np.uint64), axis=0, return_inverse=True)
        seed = 1
        while True:  # until no two windows share a hash
            factors = np.random.default_rng(seed).integers(1, 2**63, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            hashes = (windows * factors).sum(axis=1, dtype=np.uint64)
            if len(np.unique(hashes)) == len(hashes):
                break
            seed += 1
        order = np.argsort(hashes)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        pairs = np.unique(np.stack([place[back.ravel()], np.array([i for _, i in rows])], axis=1), axis=0)
        first = np.searchsorted(pairs[:, 0], np.arange(len(order) + 1))
        return size, factors, hashes[order], windows[order], pairs[:, 1], first

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Which words lie in a window that occurs, and (start, item) of each window found.

        ``numbers``: word numbers of texts with a 0 between them; 0 stands for any word that no item has.
        """
        hit = np.zeros(len(numbers) + 1, dtype=np.int64)
        found: list[tuple[int, int]] = []
        unknown = np.concatenate([[0], np.cumsum(numbers == 0)])
        for size, factors, hashes, windows, items, first in self.tables:
            if len(numbers) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            value = np.zeros(len(at), dtype=np.uint64)
            for k in range(size):
                value += numbers[at + k].astype(np.uint64) * factors[k]
            place = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            likely = hashes[place] == value
            at, place = at[likely], place[likely]
            same = (numbers[at[:, None] + np.arange(size)] == windows[place]).all(axis=1)
            at, place = at[same], place[same]
            np.add.at(hit, at, 1)
            np.add.at(hit, at + size, -1)
            for start, window in zip(at.tolist(), place.tolist(), strict=True):
                found += [(start, int(i)) for i in items[first[window] : first[window + 1]]]
        return np.cumsum(hit[:-1]) > 0, found

    def scan(self, texts: list[bytes]) -> tuple[list[int], list[np.ndarray], list[set[str]]]:
        """Number of words, numbers of the hit words, and ids of the items found, for each text."""
        get = self.numbers.get
        arrays, sizes = [], []
        for text in texts:
            parts = [np.fromiter(map(get, w, repeat(0)), dtype=np.int32, count=len(w)) for w in _words(text)]
            sizes.append(sum(map(len, parts)))
            arrays += [*parts, np.zeros(1, dtype=np.int32)]
        starts = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64) + 1)])
        hit, found = self.hits(np.concatenate(arrays) if arrays else np.zeros(0, np.int32))
        items: list[set[str]] = [set() for _ in texts]
        for at, item in found:
            if self.item_ids[item] is not None:
                items[int(np.searchsorted(starts, at, side="right")) - 1].add(self.item_ids[item])
        where = np.flatnonzero(hit)
        cuts = np.searchsorted(where, starts)
        return sizes, [where[a:b] - s for a, b, s in zip(cuts, cuts[1:], starts, strict=False)], items


def broadcast_indexes(spark: SparkSession, benchmark: DataFrame, id: str, text: str, window: int) -> list:
    """Indexes of the benchmark, each of about ``INDEX_BYTES`` of its text at most (one item at least).

    The size is measured first.  Items go to indexes by a hash, the driver holds one index at a time, and
    a task reads one at a time from its executor's disk, so a benchmark of any size has bounded memory.
    """
    items = benchmark.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // INDEX_BYTES) or 1
    share = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    return [
        spark.sparkContext.broadcast(Index([tuple(r) for r in items.where(share == k).collect()], window))
        for k in range(count)
    ]


def scan(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``id``, ``n_words``, ``spans`` (word ranges inside occurring windows) and ``items`` (sorted ids as
    text) of each document row.

    A window is ``window`` consecutive words of an item; a shorter item is one window, an item without
    words none.  Null texts have no words.  An item without an id has its words hit but is not listed;
    repeated items count once.  A null or repeated document id is passed through; other columns are not
    read.  The documents are read once, whatever the number of indexes, and nothing is shuffled.
    """
    indexes = broadcast_indexes(docs.sparkSession, benchmark, item_id, item_text, window)
    held: list[Index] = []

    def run(columns: list[list]) -> dict:
        texts = [(t or "").encode() for t in columns[0]]
        sizes, words, items = [], [[] for _ in texts], [set() for _ in texts]
        for index in indexes:
            if len(indexes) == 1:
                held[:] = held or [index.value]
            else:
                held[:] = [index.value]
                vars(index).pop("_value", None)  # one index at a time in memory; the next use reads it again
            sizes, where, found = held[0].scan(texts)
            for i, (w, f) in enumerate(zip(where, found, strict=True)):
                words[i].append(w)
                items[i] |= f
        return {
            "n_words": sizes,
            "spans": pa.array([_ranges(np.unique(np.concatenate(w))) for w in words], type=SPANS),
            "items": [sorted(i) for i in items],
        }

    return per_document(
        docs, {id: id, text: text}, run,
        "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>",
    )


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _ranges(numbers: np.ndarray) -> list[dict]:
    """Runs of consecutive numbers, the end exclusive."""
    if not len(numbers):
        return []
    breaks = np.flatnonzero(np.diff(numbers) != 1)
    starts = numbers[np.concatenate([[0], breaks + 1])].tolist()
    ends = (numbers[np.concatenate([breaks, [len(numbers) - 1]])] + 1).tolist()
    return [{"start": a, "end": b} for a, b in zip(starts, ends, strict=True)]


def verdicts(scanned: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts, a digest of the items, and ``contaminated``: at least a twentieth of the words are hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return scanned.select(
        id, "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
