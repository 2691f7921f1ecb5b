"""Token counts of whole texts under a byte-level BPE vocabulary, by merging in synchronous rounds."""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import per_document, sums
from granary.llm.merges import Vocabulary, merge_rounds, vocabulary

#: Distinct pieces whose counts a worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000


class Counter:
    """Counts of the tokens of texts; pieces that were met before are not merged again."""

    def __init__(self, vocab: Vocabulary, remembered: int = REMEMBERED):
        self.vocab, self.remembered, self.known = vocab, remembered, {}

    def sizes(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece; those not met before are merged in one ragged array."""
        if len(self.known) > self.remembered:
            self.known.clear()
        found = np.fromiter(map(self.known.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        missing = np.flatnonzero(found < 0).tolist()
        new = list({pieces[i] for i in missing})
        if new:
            merged = merge_rounds(self.vocab, *self.vocab.symbols(new))[1]
            self.known.update(zip(new, merged.tolist(), strict=True))
            found[missing] = [self.known[pieces[i]] for i in missing]
        return found

    def count(self, texts: list[str]) -> list[int]:
        blocks: list[list[str]] = []
        owners: list[int] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        held = 0

        def flush() -> None:
            nonlocal held
            sizes = self.sizes([p for block in blocks for p in block])
            np.add.at(counts, np.array(owners, dtype=np.int64), sums(sizes, [len(b) for b in blocks]))
            blocks.clear()
            owners.clear()
            held = 0

        for i, text in enumerate(texts):
            parts = self.vocab.parts(text)
            counts[i] += len(parts) // 2
            for part in parts[::2]:
                for block in self.vocab.pieces(part) if part else ():
                    blocks.append(block)
                    owners.append(i)
                    held += len(block)
                    if held > self.remembered:
                        flush()
        flush()
        return counts.tolist()


def token_counts(docs: DataFrame, path: str, limit: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each row.

    Counts are those of the tokenizers library for the file at ``path`` without added special tokens;
    special strings inside a text count as one token.  A null or empty text has 0 bytes and 0 tokens; a
    null or repeated id is passed through, so every row gives one row; other columns are not read.
    Each row is counted on its own: nothing is shuffled, and a lost task is simply run again.
    """
    counters: list[Counter] = []

    def run(columns: list[list]) -> dict:
        if not counters:
            counters.append(Counter(vocabulary(path)))
        texts = [t or "" for t in columns[0]]
        return {"n_tokens": counters[0].count(texts), "n_bytes": [len(t.encode()) for t in texts]}

    counted = per_document(docs, {id: id, text: text}, run, "n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
