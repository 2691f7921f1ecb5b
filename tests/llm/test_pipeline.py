import hashlib
import os

import corpus_pipeline as pipeline
import duckdb
import public_tokenizers
import pytest
from granary.llm import decontaminate
from granary.llm.merges import vocabulary
from granary.session import stage
from test_duplicates import brute_components
from test_quality import brute_verdicts
from test_scans import brute_spans, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_contaminated(rows, items):
    windows = {tuple(w[i : i + min(13, len(w))]) for w in map(words, items) for i in range(max(len(w) - 12, 1)) if w}
    sizes = {len(w) for w in windows}
    bad = set()
    for r in rows:
        w, hit = words(r[1]), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        if hit and 20 * len(hit) >= len(w):
            bad.add(r[0])
    return bad


def test_stages_against_brute_force(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    items = [r[0] for r in duckdb.sql(f"SELECT text FROM '{sf_dir}/benchmark.parquet'").fetchall()]
    results = {}
    for name, function in pipeline.STAGES:
        docs = stage(function(spark, docs, sf_dir), f"test-{name}")
        results[name] = docs
    kept = {w[0] for w in brute_verdicts(rows) if w[3]}
    rows = [r for r in rows if r[0] in kept]
    assert sorted(r.doc_id for r in results["quality"].collect()) == sorted(r[0] for r in rows)
    first = {c for _, _, c in brute_components(rows)}
    rows = [r for r in rows if r[0] in first]
    assert sorted(r.doc_id for r in results["near_duplicates"].collect()) == sorted(first)
    bad = brute_contaminated(rows, items)
    rows = [r for r in rows if r[0] not in bad]
    got = {r.doc_id: r for r in results["decontamination"].collect()}
    assert sorted(got) == sorted(r[0] for r in rows) and all(tuple(got[r[0]]) == r for r in rows)
    masked = {r.doc_id: r for r in results["personal_data"].collect()}
    assert sorted(masked) == sorted(got)
    for r in rows:
        assert (masked[r[0]].text == r[1]) <= (not brute_spans(r[1]))
        assert masked[r[0]].n_chars == len(masked[r[0]].text) and not brute_spans(masked[r[0]].text)
    for name, _ in pipeline.STAGES[:-1]:
        assert results[name].columns == COLUMNS
    library = vocabulary(public_tokenizers.path(pipeline.VOCABULARY)).library
    for r in results["tokens"].collect():
        assert r.ids == library.encode(masked[r.doc_id].text, add_special_tokens=False).ids
    assert pipeline.run(spark, sf_dir).count() == len(rows)


def test_odd_rows_pass_all_stages(spark, documents, corpus):
    sf_dir = "/root/testdata/sf0.001"
    docs = documents(corpus)
    for make in (lambda d: d, lambda d: d.limit(0)):
        frame = make(docs)
        for name, function in pipeline.STAGES:
            frame = stage(function(spark, frame, sf_dir), f"odd-{name}")
            if name != "tokens":
                assert frame.columns == docs.columns
        ids = [r.doc_id for r in frame.collect()]
        assert len(ids) == len(set(ids))
    # The stages keep whole rows, so what the quality rules pass is unchanged.
    kept = {r.doc_id: r.asDict() for r in pipeline.keep_quality(spark, docs, sf_dir).collect()}
    source = {r.doc_id: r.asDict() for r in docs.collect()}
    assert kept and all(row == source[i] for i, row in kept.items())
