"""Language identification by error-correcting output codes.

Every language has a codeword of several bits.  For each bit a binary classifier on hashed byte n-grams
says on which side a text lies; loss-weighted decoding picks the codeword that fits the margins best, so
a few wrong bits are corrected, and a narrow lead over the second best marks a text as ambiguous.

The classifiers are log-odds of n-gram frequencies, summed over all learning texts by one distributed
aggregation: what it shuffles follows the number of partitions, and the model the number of languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import per_document, slices, text_lengths

#: Hashed features: the first part holds pairs of bytes, the rest triples.
PAIR_FEATURES, FEATURES = 4096, 16384
#: More distinct languages are refused, as the model would not be of bounded size.
MAX_LANGUAGES = 512
#: Up to so many languages every way of parting them is a bit of the code.
EXHAUSTIVE = 6
SMOOTHING = 0.5
#: Steepness of the logistic loss; margins are scaled so that typical texts have about +1 or -1.
STEEPNESS = 3.0
#: A text is ambiguous if its score is below.
AMBIGUOUS_BELOW = 0.75
UNKNOWN = "und"
#: Letters, and the number-like characters (fractions, circled digits) that ``isalpha`` tells from them.
LIKE_LETTER = re.compile(r"[^\W\d_]")


def features(text: str) -> np.ndarray:
    """Feature numbers of the byte pairs and triples of a text (A-Z in lower case, a space around it)."""
    data = np.frombuffer(b" %s " % text.encode().lower(), dtype=np.uint8).astype(np.uint32)
    pairs = data[:-1] << np.uint32(8) | data[1:]
    triples = pairs[:-1] << np.uint32(8) | data[2:]
    factor = np.uint32(2654435761)
    high = (pairs * factor) >> np.uint32(20)  # 12 bits
    low = ((triples * factor) >> np.uint32(16)) * np.uint32(FEATURES - PAIR_FEATURES) >> np.uint32(16)
    return np.concatenate([high, low + np.uint32(PAIR_FEATURES)])


def has_letters(text: str | None) -> bool:
    return bool(text) and any(found.group().isalpha() for found in LIKE_LETTER.finditer(text))


def code(languages: int) -> np.ndarray:
    """Codewords of +1 and -1, one row per language; no two columns part the languages alike."""
    if languages <= EXHAUSTIVE:
        parts = [p for p in range(1, 2 ** max(languages - 1, 1)) if p < 2 ** (languages - 1) or languages == 1]
        return np.array([[1 if p >> row & 1 else -1 for p in parts] for row in range(languages)])
    bits = 15 + 8 * int(np.ceil(np.log2(languages)))
    best, distance = None, -1
    for seed in range(20):
        words = np.where(np.random.default_rng(seed).random((languages, bits)) < 0.5, 1, -1)
        apart = (bits - words @ words.T) // 2
        lowest = int(apart[~np.eye(languages, dtype=bool)].min())
        if lowest > distance and np.all(np.abs(words.sum(axis=0)) < languages):
            best, distance = words, lowest
    return best


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray  # codewords
    weights: np.ndarray  # features x bits
    trust: np.ndarray  # weight of each bit in the decoding

    def decode(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each row of margins, and its share among all codewords."""
        loss = np.logaddexp(0, -STEEPNESS * margins[:, None, :] * self.words[None]) @ self.trust
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        best = loss.argmin(axis=1)
        return [self.languages[i] for i in best], 1 / share.sum(axis=1)


def build(counts: dict[str, np.ndarray]) -> Model:
    """The model from the n-gram counts of each language; a language weighs the same however large."""
    languages = sorted(counts)
    freq = np.stack([(counts[x] + SMOOTHING) / (counts[x] + SMOOTHING).sum() for x in languages])
    words = code(len(languages))
    if len(languages) == 1:
        return Model(languages, words, np.zeros((FEATURES, words.shape[1]), np.float32), np.ones(words.shape[1]))
    side = lambda sign: np.stack([freq[words[:, b] == sign].mean(axis=0) for b in range(words.shape[1])], axis=1)
    weights = np.log(side(1)) - np.log(side(-1))
    typical = freq @ weights  # margin of an average text, by language and bit
    middle = np.stack([
        (typical[words[:, b] == 1, b].min() + typical[words[:, b] == -1, b].max()) / 2 for b in range(words.shape[1])
    ])
    gap = (typical - middle) * words
    scale = np.maximum(gap.mean(axis=0), 1e-9)
    trust = np.maximum(gap.min(axis=0) / scale, 0.05)
    return Model(languages, words, ((weights - middle) / scale).astype(np.float32), trust / trust.mean())


def held_out(id: str, fold: int = 1, folds: int = 3) -> Column:
    """Whether a row is kept out of learning; a row without an id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string")), F.lit(folds)) == fold, F.lit(False))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """The model of all rows of ``docs`` that have a language and a text with letters; None without any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for start, stop in slices(text_lengths(batch.column(1))):
                part = batch.slice(start, stop - start)
                for language, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if has_letters(body):
                        found = np.bincount(features(body), minlength=FEATURES)
                        sums[language] = sums[language] + found if language in sums else found
        for language, values in sums.items():
            some = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(some)), pa.array(some.astype(np.int32)), pa.array(values[some])],
                names=["lang", "feature", "n"],
            )

    source = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    totals = (
        source.mapInArrow(count, "lang string, feature int, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list(F.struct("feature", "n")).alias("counts"))  # FEATURES entries at most
    )
    rows = totals.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} distinct languages")
    counts = {}
    for language, pairs in rows:
        counts[language] = np.zeros(FEATURES)
        counts[language][[p[0] for p in pairs]] = [p[1] for p in pairs]
    return build(counts) if counts else None


def predict(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` of each row, from the text alone.

    A null text, or one without letters, is ``und`` with score 0 and not ambiguous; so is every text when
    nothing could be learned.  Equal losses go to the first language by name.  A null or repeated id is
    passed through; other columns are not read.  Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(columns: list[list]) -> dict:
        model, texts = shared.value, columns[0]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if model and has_letters(t)]
        if known:
            margins = np.empty((len(known), model.weights.shape[1]))
            for row, i in enumerate(known):
                found = features(texts[i])
                margins[row] = np.bincount(found, minlength=FEATURES).astype(np.float32) @ model.weights / len(found)
            for i, name, score in zip(known, *model.decode(margins), strict=True):
                names[i], scores[i] = name, score
        flags = [n != UNKNOWN and s < AMBIGUOUS_BELOW for n, s in zip(names, scores.tolist(), strict=True)]
        return {"lang_pred": names, "score": scores, "ambiguous": flags}

    return per_document(docs, {id: id, text: text}, run, "lang_pred string, score double, ambiguous boolean")
