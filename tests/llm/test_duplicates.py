"""Near duplicates, repeated chunks and repeated windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from granary.llm import chunks, simhash, windows
from granary.llm.components import components
from granary.llm.passages import LAST, first_holders, settle


def key(value):
    return -1 if value is None else value


# --- components -------------------------------------------------------------------------------


class Sets:
    def __init__(self):
        self.above = {}

    def find(self, x):
        while self.above.setdefault(x, x) != x:
            x = self.above[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.above[b] = a


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rnd = random.Random(8)
    nodes = rnd.sample(range(-10**12, 10**12), 60)
    links = {
        "path": list(zip(nodes, nodes[1:])), "star": [(nodes[0], n) for n in nodes[1:]], "none": [],
        "random": [tuple(rnd.choices(nodes, k=2)) for _ in range(45)],
    }[shape]
    sets = Sets()
    for a, b in links:
        sets.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links + links[:5], "a bigint, b bigint")).collect()}
    assert got == {n: sets.find(n) for n in list(sets.above) if sets.find(n) != n}


# --- fingerprints -----------------------------------------------------------------------------


def brute_fingerprint(text):
    w = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(r[1]) for r in rows]
    sets = Sets()
    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        sets.find(a)
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                sets.join(a, b)
    smallest = {}
    for r, fp in zip(rows, fps):
        if r[0] is not None:
            root = sets.find(fp)
            smallest[root] = min(smallest.get(root, r[0]), r[0])
    return sorted((key(r[0]), f"{fp:016x}", key(smallest.get(sets.find(fp)))) for r, fp in zip(rows, fps))


def near_copies(corpus):
    rnd = random.Random(9)
    long = corpus[20][1].split() * 6
    rows = []
    for i in range(30):
        w = list(long)
        w[rnd.randrange(len(w))] = rnd.choice(["x", "y", "z"])
        rows.append((500 + i, " ".join(w), "en", "a"))
    return rows


def test_near_duplicates(documents, corpus):
    rows = corpus + near_copies(corpus)
    got = simhash.near_duplicates(documents(rows)).collect()
    want = brute_components(rows)
    assert sorted((key(r[0]), r[1], key(r[2])) for r in got) == want
    assert len({w[2] for w in want if w[0] >= 500}) < 30  # some of them are linked
    assert simhash.near_duplicates(documents(rows).limit(0)).count() == 0


def test_one_of_each_group_stays(documents, corpus):
    rows = corpus + near_copies(corpus)
    groups = {(a, b): c for a, b, c in brute_components(rows)}
    kept = simhash.keep_first(documents(rows)).collect()
    assert kept[0].__fields__ == documents(rows).columns
    assert sorted(key(r.doc_id) for r in kept) == sorted(set(groups.values()))


def test_pairs_within_and_beyond_the_compared_number(spark):
    rnd = random.Random(10)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for _ in range(8):
            fps.add(b ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
        fps.add(b ^ (1 << 3) ^ (1 << 40))
        fps.add(b ^ (7 << 9))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    classes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    want = {frozenset((a, b)) for i, a in enumerate(signed) for j, b in enumerate(signed[:i]) if (fps[i] ^ fps[j]).bit_count() <= 2}
    for compared in (2048, 3):
        assert {frozenset(r) for r in simhash.links(classes, compared).collect()} == want


def test_links_do_not_depend_on_batches():
    rnd = random.Random(12)
    rows = sorted((rnd.randrange(6), rnd.randrange(8)) for _ in range(60))
    keys, fps = (np.array(x, dtype=np.int64) for x in zip(*sorted(set(rows)), strict=True))

    def run(size):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(keys[i : i + size]), pa.array(fps[i : i + size])], names=["key", "fp"])
            for i in range(0, len(keys), size)
        ]
        return {(a, b) for out in simhash._link(iter(batches)) for a, b in zip(*out.to_pydict().values(), strict=True)}

    assert run(1) == run(7) == run(1000)


# --- repeated chunks and windows --------------------------------------------------------------


def by_document(rows):
    """Rows in order of documents, those without id last; rows with one id are one document."""
    return sorted(((LAST if r[0] is None else r[0], (r[1] or "").encode()) for r in rows))


def brute_windows(rows):
    smallest = {}
    for uid, body in by_document(rows):
        for i in range(len(body) - 49):
            smallest.setdefault(body[i : i + 50], uid)
    out = []
    for uid, body in by_document(rows):
        covered = np.zeros(len(body) + 1, dtype=bool)
        for i in range(len(body) - 49):
            if smallest[body[i : i + 50]] < uid:
                covered[i : i + 50] = True
        kept = bytes(b for b, c in zip(body, covered) if not c)
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((uid, len(body), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def passages(corpus):
    """Passages of 49, 50, 51 bytes, overlapping ones, one many documents start with after different words."""
    rnd = random.Random(13)
    p = "".join(rnd.choice("abcdefgh ") for _ in range(200))
    word = lambda: "".join(rnd.choice("ijklmnop") for _ in range(rnd.randint(1, 12)))
    rows = [(600 + i, f"{word()}{p[: 49 + i % 3]}{word()}", "en", "a") for i in range(9)]
    rows += [(620 + i, f"{word()} {p[i * 7 : i * 7 + 80]} {word()} {p[100:170]}", "en", "a") for i in range(9)]
    rows += [(640 + i, f"{word()}{p[20:90]}{word()}", "en", "a") for i in range(30)]
    return rows + [(700, p * 3, "en", "a"), (700, p[5:] * 2, "en", "a"), (None, p, "en", "a"), (701, "é" * 60, "en", "a"), (702, "xé" + "é" * 59, "en", "a")]


@pytest.mark.parametrize("compared", [4096, 4])
def test_windows(documents, corpus, compared):
    rows = corpus + passages(corpus)
    got = windows.summary(windows.dedupe(documents(rows), compared=compared)).collect()
    assert sorted((LAST if r[0] is None else r[0], *r[1:]) for r in got) == brute_windows(rows)


def test_windows_of_texts_longer_than_a_block(documents, monkeypatch):
    monkeypatch.setattr(windows, "BLOCK_BYTES", 300)
    rnd = random.Random(14)
    body = "".join(rnd.choice("abcdefghij") for _ in range(2000)).encode()
    found = windows.Anchors([body, body[3:], b"short"])
    covered = np.zeros(3, dtype=int)
    for t, a, b in zip(found.text, found.start, found.end):
        covered[t] += b - a + 1
    assert covered.tolist() == [1951, 1948, 0]


def brute_chunks(rows):
    ends_of, holders = [], {}
    for uid, body in by_document(rows):
        ends, digests = chunks.chunk_digests(body)
        ends_of.append((uid, body, ends, digests.tolist()))
        for d in digests.tolist():
            holders.setdefault(d, uid)
    out = []
    for uid, body, ends, digests in ends_of:
        first = np.array([holders[d] for d in digests], dtype=np.int64)
        kept, start, removed = b"", 0, 0
        for run in chunks.repeated_runs(ends, first, uid):
            kept += body[start : run["start"]]
            removed += run["end"] - run["start"]
            start = run["end"]
        out.append((uid, len(body), len(ends), removed, hashlib.sha256(kept + body[start:]).hexdigest()))
    return sorted(out)


def test_chunks(documents, corpus):
    got = chunks.summary(chunks.dedupe(documents(corpus))).collect()
    assert sorted((LAST if r[0] is None else r[0], r.n_bytes, r.n_chunks, r.n_removed, r.kept_sha256) for r in got) == brute_chunks(corpus)
    by_id = {r.doc_id: r for r in got}
    for i in range(80, 85):
        assert by_id[i].n_removed == by_id[i].n_bytes and max(by_id[i].source_ids) < i
    assert all(by_id[60 + i].n_removed > 130 for i in range(1, 12)) and by_id[60].n_removed == 0
    assert by_id[60].n_shared > 130 and by_id[0].n_removed == 0
    assert chunks.dedupe(documents(corpus).limit(0)).count() == 0
    assert windows.dedupe(documents(corpus).limit(0)).count() == 0


def test_chunks_resist_insertions():
    rnd = random.Random(15)
    body = "".join(rnd.choice("abcdefghij éß") for _ in range(5000)).encode()
    before = set(chunks.chunk_digests(body)[1].tolist())
    after = set(chunks.chunk_digests(body[:1000] + b"inserted" + body[1000:])[1].tolist())
    assert len(before - after) <= 6
    for end in chunks.cuts(np.frombuffer(body, dtype=np.uint8)).tolist():
        body[:end].decode()
    assert max(np.diff(chunks.cuts(np.frombuffer(b"a" * 3000, dtype=np.uint8)), prepend=0)) <= chunks.MAX_CHUNK


def test_long_texts_are_handled_in_pieces(monkeypatch):
    rnd = random.Random(17)
    text = "".join(rnd.choice("abcde fghij éß\n") for _ in range(4000)) + "x" * 700
    whole = simhash.fingerprint(text), *[x.tolist() for x in chunks.chunk_digests(text.encode())]
    assert whole[0] == brute_fingerprint(text)
    for size in (64, 100, 1000):
        monkeypatch.setattr(simhash, "PIECE_BYTES", size)
        monkeypatch.setattr(chunks, "BLOCK_BYTES", size)
        assert (simhash.fingerprint(text), *[x.tolist() for x in chunks.chunk_digests(text.encode())]) == whole
    for odd in ("", " ", "a", "a b", " a b c ", "a\x0bb\x1cc d"):
        assert simhash.fingerprint(odd) == brute_fingerprint(odd)


def test_first_holders_over_blocks_and_batches():
    rnd = random.Random(16)
    rows = [(rnd.randrange(40), rnd.randrange(25)) for _ in range(300)]  # key, uid
    expected = {}
    for k, u in rows:
        expected.setdefault(k, set()).add(u)
    want = {(u, k) for k, us in expected.items() if len(us) > 1 for u in us}
    open_, known = [], []
    for start in range(0, 300, 30):
        k, u = (np.array(x, dtype=np.int64) for x in zip(*rows[start : start + 30], strict=True))
        for batch in settle(u, k, 5):
            for r in batch.to_pylist():
                firsts = r["firsts"] or [None] * len(r["keys"])
                (known if r["firsts"] else open_).extend(zip(r["keys"], r["uids"], firsts, strict=True))
    merged = sorted(open_ + known, key=lambda r: r[:2])
    for size in (1, 3, 1000):
        batches = [
            pa.RecordBatch.from_arrays([pa.array([r[i] for r in merged[s : s + size]], pa.int64()) for i in range(3)], names=["key", "uid", "first"])
            for s in range(0, len(merged), size)
        ]
        got = [t for out in first_holders(iter(batches)) for t in zip(*out.to_pydict().values(), strict=True)]
        assert {(u, k) for u, k, _ in got} == want
        best = {}
        for u, k, f in got:
            best[u, k] = min(best.get((u, k), f), f)
        assert all(f <= u for (u, _), f in best.items())
        assert {(u, k) for (u, k), f in best.items() if f < u} == {(u, k) for u, k in want if u != min(expected[k])}
