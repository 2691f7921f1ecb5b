"""Compressed vectors: every vector is cut into parts, and each part becomes the number of its nearest entry in
the codebook of that part position, learned by rounds of Lloyd's method.

A block of vectors is searched with two trees per part position, one over the parts in the block, one over
the entries.  Pairs of nodes that are farther apart than another pair of the same node must be are pruned.  A
node of parts that is left with one entry is assigned as a whole, with sums that the tree holds; parts of an
uncertain leaf are compared in whole numbers.  Bounds are whole numbers too, so no rounding can decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Parts in a leaf of the tree over parts.
LEAF = 8
#: Vectors that one tree is grown over; shapes memory, not results.
BLOCK = 4096
#: Components of which squares could leave 64 bits are beyond what a codebook holds.
LARGEST = 1 << 26


class Tree:
    """A balanced tree over points: at every level all nodes hold the same number of places.

    Places beyond the number of points repeat the last point; ``weight`` is 0 there.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        count = len(points)
        self.depth = max(0, int(np.ceil(np.log2(max(count, 1) / leaf))))
        places = leaf << self.depth if self.depth else count
        order = np.minimum(np.arange(places), count - 1)
        weight = np.arange(places) < count
        self.low, self.high = [], []
        for level in range(self.depth + 1):
            nodes = points[order].reshape(1 << level, -1, points.shape[1])
            self.low.append(nodes.min(axis=1))
            self.high.append(nodes.max(axis=1))
            if level < self.depth:
                widest = (self.high[-1] - self.low[-1]).argmax(axis=1)
                along = np.take_along_axis(nodes, widest[:, None, None], axis=2)[:, :, 0]
                within = np.argsort(along, axis=1, kind="stable")
                order = np.take_along_axis(order.reshape(1 << level, -1), within, axis=1).ravel()
                weight = np.take_along_axis(weight.reshape(1 << level, -1), within, axis=1).ravel()
        self.order, self.weight = order, weight
        # Cached sums: of any node by the difference of two running sums.
        self.counts = np.concatenate([[0], np.cumsum(weight)])
        kept = points[order] * weight[:, None]
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(kept, axis=0)])


def _distances(a: Tree, at: np.ndarray, level: int, b: Tree, of: np.ndarray, other: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest squared distance between points of nodes ``at`` of a and ``of`` of b."""
    low_a, high_a, low_b, high_b = a.low[level][at], a.high[level][at], b.low[other][of], b.high[other][of]
    gap = np.maximum(np.maximum(low_a - high_b, low_b - high_a), 0)
    span = np.maximum(high_a - low_b, high_b - low_a)
    return (gap * gap).sum(axis=1), (span * span).sum(axis=1)


def _pruned(parts: Tree, level: int, entries: Tree, depth: int, node: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of nodes that may hold nearest ones; equal distances are kept."""
    least, most = _distances(parts, node, level, entries, entry, depth)
    bound = np.full(1 << level, np.iinfo(np.int64).max)
    np.minimum.at(bound, node, most)
    near = least <= bound[node]
    return node[near], entry[near]


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of the nearest entry of ``book`` for each point (the first of equals), and for each entry
    how many points it has and their sums."""
    parts, entries = Tree(points, LEAF), Tree(book, 1)
    found = np.empty(len(parts.order), dtype=np.int64)
    size, sums = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
    node, entry, level, depth = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while len(node):
        node, entry = _pruned(parts, level, entries, depth, node, entry)
        if depth == entries.depth:
            # Places of the tree over entries that repeat the last entry are the same candidate.
            node, entry = np.divmod(np.unique(node * len(book) + entries.order[entry]), len(book))
            candidates = np.bincount(node, minlength=1 << level)
            sole = candidates[node] == 1
            width = len(parts.order) >> level
            first, last = node[sole] * width, (node[sole] + 1) * width
            found[first[:, None] + np.arange(width)] = entry[sole][:, None]
            np.add.at(size, entry[sole], parts.counts[last] - parts.counts[first])
            np.add.at(sums, entry[sole], parts.sums[last] - parts.sums[first])
            node, entry = node[~sole], entry[~sole]
            if level == parts.depth:
                _compare(points, book, parts, node, entry, found, size, sums)
                break
            back = np.empty(len(entries.order), np.int64)
            back[entries.order[::-1]] = np.arange(len(entries.order))[::-1]
            entry = back[entry]
        if depth < entries.depth:
            node, entry, depth = np.repeat(node, 2), np.stack([2 * entry, 2 * entry + 1], axis=1).ravel(), depth + 1
        if level < parts.depth:
            node, entry, level = np.stack([2 * node, 2 * node + 1], axis=1).ravel(), np.repeat(entry, 2), level + 1
    result = np.empty(len(points), np.int64)
    result[parts.order[parts.weight]] = found[parts.weight]
    return result, size, sums


def _compare(points, book, parts: Tree, node, entry, found, size, sums) -> None:
    """Assign the places of uncertain leaves, each compared with the candidates of its leaf."""
    if not len(node):
        return
    width = len(parts.order) >> parts.depth
    place = node[:, None] * width + np.arange(width)
    apart = points[parts.order[place]] - book[entry][:, None, :]
    squared = (apart * apart).sum(axis=2)
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))  # pairs come sorted by node
    counts = np.diff(np.append(first, len(node)))
    least = np.repeat(np.minimum.reduceat(squared, first, axis=0), counts, axis=0)
    chosen = np.minimum.reduceat(np.where(squared == least, entry[:, None], len(book)), first, axis=0).ravel()
    place, entry = place[first].ravel(), chosen
    found[place] = entry
    real = parts.weight[place]
    np.add.at(size, entry[real], 1)
    np.add.at(sums, entry[real], points[parts.order[place[real]]])


@dataclass
class Codebooks:
    books: np.ndarray  # parts x entries x components

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers of all parts, and the squared distance of each vector."""
        cut = vectors.reshape(len(vectors), len(self.books), -1)
        codes = np.stack([nearest(cut[:, k], book)[0] for k, book in enumerate(self.books)], axis=1)
        apart = cut - self.books[np.arange(len(self.books)), codes]
        return codes, (apart * apart).sum(axis=(1, 2))


def _whole(vector: str) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


def kept(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """``id``, ``label`` and the whole numbers ``v`` of the vectors that have finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    read = vectors.select(vectors[id].alias("id"), vectors[label].alias("label"), vectors[vector].alias("v"))
    return read.where(F.col("v").isNotNull() & ~F.exists("v", bad)).withColumn("fits", F.forall("v", lambda x: F.abs(x) * SCALE < LARGEST)).select(
        "id", "label", F.when(F.col("fits"), _whole("v")).alias("v")
    )


def _matrix(values: pa.Array) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _round(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The entries after one round: whole means of the parts that are nearest to them.

    A task sends one row per part position and entry that has parts, whatever the number of its vectors.
    """
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value.books
        sizes, sums = np.zeros(held.shape[:2], np.int64), np.zeros(held.shape, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                cut = _matrix(batch.column(0).slice(start, BLOCK)).reshape(-1, len(held), held.shape[2])
                for k, book in enumerate(held):
                    _, size, total = nearest(cut[:, k], book)
                    sizes[k] += size
                    sums[k] += total
        at = np.flatnonzero(sizes.ravel())
        arrays = [pa.array(at.astype(np.int32)), pa.array(sizes.ravel()[at]), pa.array(list(sums.reshape(-1, held.shape[2])[at]), type=pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["entry", "n", "sums"])

    spread = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(books.books.shape[2])]
    totals = rows.select("v").mapInArrow(run, "entry int, n bigint, sums array<bigint>").groupBy("entry").agg(F.sum("n").alias("n"), *spread)
    moved = books.books.copy()
    flat = moved.reshape(-1, moved.shape[2])
    for entry, n, *total in totals.collect():  # at most one row per entry
        flat[entry] = np.array(total, dtype=np.int64) // n
    return Codebooks(moved)


def learn(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks that start as the parts of the first vectors by id; None without a vector to start from."""
    usable = rows.where(F.col("v").isNotNull() & F.col("id").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0))
    first = usable.orderBy("id", "v").limit(entries).select("v").collect()
    if not first:
        return None
    first = [r.v for r in first if len(r.v) == len(first[0].v)]
    books = Codebooks(np.ascontiguousarray(np.array(first, dtype=np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)))
    fitting = rows.where(F.size("v") == len(first[0]))
    for _ in range(rounds):
        books = _round(fitting, books)
    return books


def _encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``id``, ``label``, ``code`` (hexadecimal) and ``error``; both null for vectors that have no place."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    width = books.books.shape[0] * books.books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexadecimal = np.array([f"{i:02x}" for i in range(shared.value.books.shape[1])])
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                some = batch.slice(start, BLOCK)
                sizes = [None if n is None else n == width for n in some.column(2).value_lengths().to_pylist()]
                at = np.flatnonzero(np.array([bool(s) for s in sizes]))
                codes, errors = [None] * some.num_rows, [None] * some.num_rows
                if len(at):
                    numbers, apart = shared.value.encode(_matrix(some.column(2).take(pa.array(at))))
                    for row, shown, error in zip(at.tolist(), hexadecimal[numbers], apart.tolist(), strict=True):
                        codes[row], errors[row] = "".join(shown), error
                arrays = [some.column(0), some.column(1), pa.array(codes, type=pa.string()), pa.array(errors, type=pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "code", "error"])

    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")


def compress(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """``id``, ``code``, ``error`` and ``label_error`` (the errors of rows with an equal label, nulls together)
    of each vector, and the codebooks.

    Components become whole numbers ``floor(256 * x)``.  Rows whose vector is null or has a null or non-finite
    component go.  A codebook starts as that part of the ``entries`` first vectors by id (then by components);
    with fewer vectors it has fewer entries.  The nearest entry by squared distance takes a part, the first
    of equals; entries that take none stay as they are.  Repeated rows count as often as they stand there.

    A vector without a place in the codebooks has null code and error and takes no part in learning: one of
    another length than the first, of a length that ``parts`` does not divide, or with a component of
    2^18 or more.  A sum of errors beyond 64 bits is null.  A null id is passed through but starts no entry.  Other columns are not read.  An empty
    table gives no rows and no codebooks.
    """
    rows = stage(kept(vectors, id, vector, label), "codes-vectors")
    books = learn(rows, parts, entries, rounds)
    if books is None:
        coded = rows.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    else:
        coded = stage(_encoded(rows, books), "codes-encoded")
    # One row per label meets the vectors; a label of many vectors is on the large side of the join only.
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left")
    return joined.select(F.col("id").alias(id), "code", "error", "label_error"), books


def summary(compressed: DataFrame, books: Codebooks | None) -> DataFrame:
    """The compressed rows with a digest of all entries: whole numbers by part, entry and place."""
    return compressed.withColumn("codebooks_sha256", F.lit(books.digest() if books else None).cast("string"))
