"""Divergence of sources and language-model scores, against plain loops."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from granary.llm import divergence, scoring
from granary.llm.batches import coded_words
from test_scans import LOWER, key

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


# --- divergence -------------------------------------------------------------------------------


def brute_audit(rows, top=200):
    groups, docs = {}, {}
    for r in rows:
        lang, source = r[2] or "", r[3] or ""
        found = Counter(TERM.findall((r[1] or "").translate(LOWER)))
        groups.setdefault((lang, source), Counter()).update(found)
        docs.setdefault(lang, Counter()).update(found.keys())
    result = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        counts = {s: {t: c[t] for t in kept} for (x, s), c in groups.items() if x == lang}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}
        parts = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: parts(c) for s, c in counts.items()}, parts(whole)
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in counts if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                result += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(result)


@pytest.mark.parametrize("block_terms", [7, 4096])
def test_audit_against_loops(spark, documents, corpus, block_terms):
    rows = corpus + [(300 + i, f"Zed zed Ünï {'x' * (i % 3 + 1)} {'tie' if i % 2 else 'eit'}", "q", f"s{i % 4}") for i in range(40)]
    rows += [(400, None, "q", "no text"), (401, "rare", "w", "one"), (402, "", "w", "two"), (403, "9 _ 9", None, "")]
    got = divergence.audit(documents(rows), block_terms=block_terms)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(rows)
    assert sorted(tuple(r) for r in divergence.audit(documents(rows), top=3).collect()) == brute_audit(rows, 3)


def test_audit_of_nothing(documents):
    assert divergence.audit(documents([(1, "a", "en", "a")]).limit(0)).count() == 0
    assert divergence.audit(documents([(1, "a", "en", "a")])).count() == 0


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Über alles 99 alles_alles " * 50
    whole = divergence.term_counts(text)
    monkeypatch.setattr(divergence, "PIECE_BYTES", 17)
    assert divergence.term_counts(text) == whole == Counter({"Über".encode(): 50, b"alles": 150})


@pytest.mark.parametrize(("held", "piece"), [(1 << 21, 1 << 22), (50, 1 << 22), (1 << 21, 17)])
def test_counts_of_terms_coded_by_block(spark, documents, corpus, monkeypatch, held, piece):
    monkeypatch.setattr(divergence, "HELD_ENTRIES", held)
    monkeypatch.setattr(divergence, "PIECE_BYTES", piece)
    n, n_docs = Counter(), Counter()
    for _, text, lang, source in corpus:
        found = Counter(TERM.findall((text or "").translate(LOWER)))
        of = (lang or "", source or "")
        n.update({(*of, t): k for t, k in found.items()}), n_docs.update((*of, t) for t in found)
        n[*of, None] = n_docs[*of, None] = 0
    got = {(r.lang, r.source, r.term): (r.n, r.docs) for r in divergence.counts(documents(corpus)).collect()}
    assert got == {k: (n[k], n_docs[k]) for k in n}


def test_coded_words():
    texts = ["", None, " A  b\ta ", "Ünï 9\x00x", "  ", "b"]
    whole = pa.array(["cut off", *texts])
    for some, wanted in ((whole.slice(1), texts), (whole.slice(1, 2), texts[:2]), (whole.slice(7), []), (pa.array(texts[2:], pa.large_string()), texts[2:])):
        rows, codes, words = coded_words(some, bytes(range(256)).lower())
        found = [words[c].as_py() for c in codes.tolist()]
        assert list(zip(rows.tolist(), found, strict=True)) == [(i, w) for i, t in enumerate(wanted) for w in (t or "").translate(LOWER).split()]


def test_parts_of_huge_counts():
    n = np.array([0, 5, 10**12, 10**15])
    assert divergence.parts(n, 10**15, 10**6).tolist() == [1 + 10**9 * (x + 1) // (10**15 + 10**6) for x in n.tolist()]


@pytest.mark.parametrize("seed", range(5))
def test_gallop_and_merge(seed):
    rnd = np.random.default_rng(seed)
    for _ in range(60):
        a, b = (np.unique(rnd.integers(0, rnd.integers(1, 400), rnd.integers(0, 90))) for _ in range(2))
        place = {x: i for i, x in enumerate(b.tolist())}
        assert divergence.gallop(a, b).tolist() == [place.get(x, -1) for x in a.tolist()]
        n = [rnd.integers(1, 50, len(x)) for x in (a, b)]
        sides = [dict(zip(x.tolist(), y.tolist(), strict=True)) for x, y in zip((a, b), n, strict=True)]
        totals = [sum(s.values()) + 9 for s in sides]
        p = [[1 + 10**9 * (s.get(t, 0) + 1) // (total + 500) for t in range(400)] for s, total in zip(sides, totals, strict=True)]
        want = [sum((x - y) ** 2 // y for x, y in zip(*z, strict=True)) for z in (p, p[::-1])]
        assert list(divergence.merge((a, n[0]), (b, n[1]), tuple(totals), 500, 400)) == want


# --- scores -----------------------------------------------------------------------------------


def tokens(text):
    return [*bytes(text or "", "utf-8").lower().split(), None]


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute_scores(rows):
    counts = Counter(t for r in rows if not out(r[0]) for t in tokens(r[1]))
    total, kinds = sum(counts.values()), len(counts)
    result = []
    for r in rows:
        found = tokens(r[1])
        base = math.fsum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in found)
        result.append((key(r[0]), len(found), sum(counts[t] > 0 for t in found), base))
    return sorted(result), total


def scored(docs):
    model = scoring.learn(docs, ~scoring.held_out("doc_id"))
    return model, sorted((key(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in scoring.score(docs, model).collect())


@pytest.mark.parametrize("frequent", [1 << 16, 20])
def test_base_scores_against_loops(spark, documents, corpus, monkeypatch, frequent):
    monkeypatch.setattr(scoring, "FREQUENT", frequent)
    monkeypatch.setattr(scoring, "HELD_ENTRIES", 50)
    rows = corpus + [(500 + i, "unseen only here " * i, "en", "a") for i in range(12)]
    model, got = scored(documents(rows))
    want, total = brute_scores(rows)
    assert model.tokens == total
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)
    assert all(g[4] < 0 for g in got)


def brute_model(rows):
    """The model with the exact counts' levels in place of the filter."""
    def level(n):
        return scoring._TYPICAL[np.searchsorted(scoring._LEAST, n, side="right")]

    uni, pairs = Counter(), Counter()
    for r in rows:
        if not out(r[0]):
            t = tokens(r[1])
            uni.update(t), pairs.update(zip(["start", *t], t, strict=False))
    ends, total, kinds = uni[None], sum(uni.values()), len(uni)
    found = []
    for r in rows:
        t, log = tokens(r[1]), 0.0
        for before, now in zip(["start", *t], t, strict=False):
            p = (level(uni[now]) + 1) / (total + kinds + 1)
            history = level(ends if before == "start" else uni[before])
            p = (min(level(pairs[before, now]), history) + scoring.PRIOR * p) / (history + scoring.PRIOR)
            log += math.log10(p)
        found.append((key(r[0]), log))
    return sorted(found)


def test_model_scores_are_those_of_the_levels(spark, documents, corpus, monkeypatch):
    """With many bits an entry no probe is wrong, and the scores are those of the exact levels."""
    want = brute_model(corpus)
    monkeypatch.setattr(scoring, "BITS_PER_ENTRY", 400)
    _, got = scored(documents(corpus))
    assert np.allclose([x for _, x in sorted((g[0], g[4]) for g in got)], [w[1] for w in want], rtol=1e-9)
    monkeypatch.setattr(scoring, "BITS_PER_ENTRY", 40_000)
    monkeypatch.setattr(scoring, "SHARE", 2)  # many shares, of which a task holds one at a time
    model, shared = scored(documents(corpus))
    assert len(model.shares) > 3
    assert np.allclose([x for _, x in sorted((g[0], g[4]) for g in shared)], [w[1] for w in want], rtol=1e-9)


def test_levels_met_lately_are_not_asked_again(monkeypatch):
    monkeypatch.setattr(scoring, "MET_BITS", 4)
    asked = []
    met = scoring.Met(lambda h: asked.append(len(h)) or (h % np.uint64(31)).astype(np.int64))
    rnd = np.random.default_rng(3)
    for h in (np.zeros(0, np.uint64), *(rnd.choice(rnd.integers(0, 1 << 63, 40, dtype=np.uint64) << np.uint64(1), 200) for _ in range(5))):
        assert (met(h) == h % np.uint64(31)).all()
    last = np.array([7, 7 << 60, 15 << 60, 0], dtype=np.uint64)
    asked.clear()
    met(last[1:]), met(last[1:])
    assert sum(asked) <= 3 and (met(last) == last % np.uint64(31)).all()


@pytest.mark.parametrize("piece", [1 << 20, 17])
def test_words_and_grams_coded_by_block(spark, documents, corpus, monkeypatch, piece):
    monkeypatch.setattr(scoring, "PIECE_BYTES", piece)
    texts = pa.array([r[1] for r in corpus])
    found = [(i, some[c].as_py().encode()) for rows, codes, some in scoring._coded(texts) for i, c in zip(rows.tolist(), codes.tolist(), strict=True)]
    assert found == [(i, w) for i, r in enumerate(corpus) for w in tokens(r[1])[:-1]]
    flat, sizes = scoring.framed([(np.array([0, 0, 2]), np.array([5, 6, 7]))], 4, np.array([0, 1]))
    assert flat.tolist() == [0, 5, 6, 1, 0, 1, 0, 7, 1, 0, 1] and sizes.tolist() == [4, 2, 3, 2]
    rows = documents(corpus).selectExpr("true AS learns", "text")
    got = sorted(r.n for r in scoring._gram_counts(rows, 3).collect())
    framed = [["start", *tokens(r[1])] for r in corpus]
    want = Counter(tuple(t[i : i + k]) for t in framed for k in (2, 3) for i in range(len(t) - k + 1))
    assert got == sorted(n for n in want.values() if n >= 2)


def test_filter_loses_nothing_and_errs_rarely():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 1 << 63, 45_000, dtype=np.uint64)
    n = rnd.integers(2, 5000, len(h))
    want = np.searchsorted(scoring._LEAST, n, side="right")
    bits = np.zeros((1, scoring.SUB_BITS // 8), np.uint8)
    for level in range(1, want.max() + 1):
        for place in scoring._places(h[want >= level], level):
            np.bitwise_or.at(bits[0], place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
    found = scoring.Filter(0, bits, 1).levels(h)
    assert (found >= want).all() and (found > want).mean() < 0.02


def test_real_prose_is_likelier_than_shuffled(spark, documents):
    """On held-out texts the model beats the unigram base where word order matters."""
    rnd = np.random.default_rng(5)
    follows = rnd.integers(0, 200, (200, 3))
    def prose():
        at, words = int(rnd.integers(200)), []
        for _ in range(120):
            words.append(f"w{at}")
            at = int(rnd.choice(follows[at]))
        return " ".join(words)
    docs = documents([(i, prose(), "en", "a") for i in range(300)])
    _, got = scored(docs)
    held = [g for g in got if out(g[0])]
    assert sum(g[4] for g in held) > sum(g[3] for g in held) + 20 * len(held)


def test_scores_of_nothing(documents):
    none = documents([(1, "a", "en", "a")]).limit(0)
    model, got = scored(none)
    assert got == [] and model.tokens == 0
    held = next(i for i in range(100) if out(i))
    _, got = scored(documents([(held, "never learned", "en", "a")]))
    assert got == [(held, 3, 0, 0.0, 0.0)]
