"""Compressed vectors against plain loops."""

import hashlib

import numpy as np
import pytest
from granary.llm import codes
from granary.llm.codes import Tree, nearest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("id", "v", "code", "error", "of_label")],
])


@pytest.mark.parametrize("seed", range(6))
def test_nearest_entries(seed):
    rnd = np.random.default_rng(seed)
    for _ in range(25):
        n, m, d, r = (int(rnd.integers(1, x)) for x in (500, 65, 6, 300))
        points, book = (rnd.integers(-r, r, (k, d)).astype(np.int64) for k in (n, m))
        if m > 2:
            book[m - 1] = book[0]  # equal entries: the first one counts
        want = ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
        got, size, sums = nearest(points, book)
        assert got.tolist() == want.tolist() and size.tolist() == np.bincount(want, minlength=m).tolist()
        total = np.zeros_like(book)
        np.add.at(total, want, points)
        assert (sums == total).all()


def test_whole_nodes_are_assigned():
    """Far clusters: most parts are assigned with their node, and the bounds of the tree hold them."""
    rnd = np.random.default_rng(2)
    points = np.concatenate([rnd.integers(0, 9, (400, 4)) + 1000 * k for k in range(5)])
    compared = []
    original = codes._compare
    try:
        codes._compare = lambda points, book, parts, node, *rest: (compared.append(len(node)), original(points, book, parts, node, *rest))
        nearest(points, points[::400])
    finally:
        codes._compare = original
    assert sum(compared) * codes.LEAF < len(points)
    tree = Tree(points, 8)
    assert (tree.low[0][0] == points.min(axis=0)).all() and (tree.sums[-1] == points.sum(axis=0)).all() and tree.counts[-1] == len(points)


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    first = [v for _, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: r[:2])[:entries]]
    size = len(first[0]) // parts
    books = [[v[k * size : k * size + size] for v in first] for k in range(parts)]
    cut = lambda v, k: v[k * size : k * size + size]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda v, k: min(range(len(books[k])), key=lambda e: (apart(cut(v, k), books[k][e]), e))
    for _ in range(rounds):
        moved = []
        for k in range(parts):
            held = {}
            for _, v, _ in kept:
                held.setdefault(best(v, k), []).append(cut(v, k))
            moved.append([[sum(x) // len(held[e]) for x in zip(*held[e], strict=True)] if e in held else books[k][e] for e in range(len(books[k]))])
        books = moved
    coded = [(i, "".join(f"{best(v, k):02x}" for k in range(parts)), sum(apart(cut(v, k), books[k][best(v, k)]) for k in range(parts)), label)
             for i, v, label in kept]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    sums = {label: sum(c[2] for c in coded if c[3] == label) for label in {c[3] for c in coded}}
    return sorted(((-1 if i is None else i, c, e, sums[label], digest) for i, c, e, label in coded))


def rows_of(rnd, n, width=32):
    rows = [(i, rnd.normal(0, 0.2, width).astype(float).tolist(), int(rnd.integers(4))) for i in range(n)]
    rows += [(1000, rows[3][1], 1), (1000, rows[3][1], 1), (None, rows[5][1], None), (7, rows[6][1], None)]
    rows += [(1001, None, 1), (1002, [None] + rows[0][1][1:], 2), (1003, [float("nan")] + rows[0][1][1:], 2), (1004, [float("-inf")] + rows[0][1][1:], 2)]
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return lambda rows: spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("n", [40, 300])
def test_codes_against_loops(frame, n):
    rows = rows_of(np.random.default_rng(n), n)
    got = codes.summary(*codes.compress(frame(rows)))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got.collect()) == brute(rows)


def test_vectors_without_a_place(frame):
    rows = rows_of(np.random.default_rng(0), 20)
    odd = [(2000, [0.5] * 31, 1), (2001, [0.5] * 48, 2), (2002, [1e9] * 32, 3), (2003, [], 1)]
    got = {r.vec_id: r for r in codes.compress(frame(rows + odd))[0].collect()}
    assert all(got[i].code is None and got[i].error is None for i in (2000, 2001, 2002, 2003))
    want = {r[0]: r for r in brute(rows)}
    assert all(got[i].code == want[i][1] and got[i].label_error == want[i][3] for i in range(20) if i != 7)


def test_no_vectors(frame):
    none, books = codes.compress(frame([(1, [0.5] * 16, 1)]).limit(0))
    assert books is None and codes.summary(none, books).count() == 0
    coded, books = codes.compress(frame([(None, [0.5] * 16, 1), (1, None, 1)]))
    assert books is None and [tuple(r) for r in coded.collect()] == [(None, None, None, None)]
