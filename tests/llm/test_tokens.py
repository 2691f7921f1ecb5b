import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from granary.llm import bpe
from granary.llm.merges import COMMON_END, Vocabulary, merge_long, merge_rounds, vocabulary
from granary.llm.token_counts import Counter, token_counts

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = "aab c'  \n\t1é́Σİ日<|endoftext|>\U0001f600՘ßſK​\x1c\x85\xa0\x00"


def fuzz(count, seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 50))) for _ in range(count)]
    texts += ["", " ", "a<|endoftext|>b<|startoftext|><|endoftext|>", "a" * 3000, "́", "Ḱx Ḱ"]
    return texts + ["".join(rnd.choice(c) for _ in range(rnd.randint(250, 700))) for c in ("ab", "the", "=-", "0é") for _ in range(20)]


def library(path, texts):
    return vocabulary(path).library.encode_batch(texts, add_special_tokens=False)


@pytest.mark.parametrize("remembered", [10, 400_000])
def test_counts_are_the_librarys(remembered):
    texts = fuzz(1500, 1)
    assert Counter(vocabulary(BYTES), remembered).count(texts) == [len(e.ids) for e in library(BYTES, texts)]


@pytest.mark.parametrize("remembered", [10, 300_000])
def test_codec_is_the_librarys(remembered):
    vocab = vocabulary(WORDS)
    rnd = random.Random(3)
    pieces = [t.removesuffix("</w>") for t in vocab.ids]
    texts = fuzz(1500, 2) + ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 8))) for _ in range(1500)]
    encoder = bpe.Encoder(vocab, remembered)
    flat, counts, shown = encoder.encode(texts)
    ends = np.cumsum(counts)
    expected = library(WORDS, texts)
    assert [flat[e - n : e].tolist() for n, e in zip(counts, ends)] == [e.ids for e in expected]
    assert shown == [vocab.library.decode(e.ids, skip_special_tokens=False) for e in expected]
    assert encoder.repaired > 0


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_code_point_is_split_as_by_the_library(path):
    vocab = vocabulary(path)
    for start in range(1, 0x110000, 0x4000):
        points = [c for c in range(start, start + 0x4000) if c < 0x110000 and not 0xD800 <= c < 0xE000]
        texts = [f"x{chr(c)}y1{chr(c)} z" for c in points if c < COMMON_END or c % 7 == 0]
        mine = [[p for block in vocab.pieces(t) for p in block] for t in texts]
        shown = [vocab.library.pre_tokenizer.pre_tokenize_str(vocab.library.normalizer.normalize_str(t) if vocab.library.normalizer else t) for t in texts]
        assert mine == [[bytes(map(vocab.byte_of.__getitem__, s)).decode() for s, _ in x] for x in shown]
    assert not regex.match(r"\s", "\x1c")


def test_long_and_short_merging_agree():
    vocab = vocabulary(BYTES)
    rnd = random.Random(5)
    for letters in ("a", "ab", "the ", "etaoin"):
        text = "".join(rnd.choice(letters) for _ in range(200))
        symbols, lengths = vocab.symbols([text])
        assert merge_long(vocab, symbols).tolist() == merge_rounds(vocab, symbols, lengths)[0].tolist()


def test_a_long_piece_is_merged_in_time():
    rnd = random.Random(6)
    text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    assert Counter(vocabulary(BYTES)).count([text]) == [len(library(BYTES, [text])[0].ids)]


def test_unsupported_settings_are_refused(tmp_path):
    import json

    with open(WORDS, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["byte_fallback"] = True
    (tmp_path / "v.json").write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="byte_fallback"):
        Vocabulary(str(tmp_path / "v.json"))


def test_queries_on_odd_rows(spark, documents, corpus):
    docs = documents(corpus)
    counted = token_counts(docs, BYTES, 1024)
    assert counted.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    texts = [r[1] or "" for r in corpus]
    expected = sorted(
        ((-1 if r[0] is None else r[0]), len(t.encode()), len(e.ids), len(e.ids) > 1024)
        for r, t, e in zip(corpus, texts, library(BYTES, texts))
    )
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in counted.collect()) == expected
    digests = bpe.digests(bpe.encode(docs, WORDS)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    vocab = vocabulary(WORDS)
    expected = sorted(
        (-1 if r[0] is None else r[0], len(e.ids), sha(" ".join(map(str, e.ids))), sha(vocab.library.decode(e.ids, skip_special_tokens=False)))
        for r, e in zip(corpus, library(WORDS, texts))
    )
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in digests) == expected


def test_empty_tables(documents):
    docs = documents([(1, "x")]).limit(0)
    assert token_counts(docs, BYTES, 1024).count() == 0
    assert bpe.encode(docs, WORDS).count() == 0
