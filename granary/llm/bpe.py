"""Encoding and decoding of whole texts with a byte-level BPE vocabulary: speculate, verify, repair.

Longest vocabulary matches from the left propose the tokens of a word.  A sequence of tokens is the
encoding of its word exactly when no two neighbours would have merged across their border, and whether
two tokens would is a fact of the vocabulary alone; all neighbours of many words are tested at once.
Only words with a failing border are merged.
"""

from __future__ import annotations

from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import per_document, ragged_gather, sums
from granary.llm.merges import NO_MERGE, KeyTable, Vocabulary, merge_rounds, vocabulary

#: Distinct words whose tokens a worker remembers; beyond it the memory starts anew.
REMEMBERED = 300_000


def crossing_rank(vocab: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of the earliest merge over the border of each pair of tokens; ``NO_MERGE`` where none happens.

    Walks back in time from the whole tokens: the part next to the border that was made last is split,
    so the two parts at hand always existed side by side, until the first of them was merged further
    (``left_ends``, ``right_ends``).  A merge of the two crosses the border if it ranks before both ends;
    at the same rank the place further left comes first.
    """
    result = np.full(len(left), NO_MERGE)
    at = np.arange(len(left))
    a, b = left.copy(), right.copy()
    left_ends = np.full(len(a), NO_MERGE)
    right_ends = np.full(len(a), NO_MERGE)
    while len(at):
        rank = vocab.pair_rank(a, b)
        crosses = (rank < left_ends) & (rank <= right_ends)
        crosses &= rank < NO_MERGE
        result[at[crosses]] = rank[crosses]  # walking back, the last one found is the earliest
        made_a, made_b = vocab.rank[a], vocab.rank[b]
        split_a = made_a > made_b
        split_b = ~split_a & (made_b >= 0)
        left_ends = np.where(split_a, made_a, left_ends)
        right_ends = np.where(split_b, made_b, right_ends)
        a, b = np.where(split_a, vocab.right[a], a), np.where(split_b, vocab.left[b], b)
        more = split_a | split_b
        at, a, b, left_ends, right_ends = at[more], a[more], b[more], left_ends[more], right_ends[more]
    return result


class Encoder:
    """Token ids of texts; words that were met before are not encoded again."""

    def __init__(self, vocab: Vocabulary, remembered: int = REMEMBERED):
        self.vocab, self.remembered = vocab, remembered
        self._grow_tree()
        #: Tokens that their own text encodes to; words with others are merged exactly.
        made = np.flatnonzero(vocab.rank >= 0)
        self.whole = np.ones(len(vocab.rank), dtype=bool)
        self.whole[made] = crossing_rank(vocab, vocab.left[made], vocab.right[made]) == vocab.rank[made]
        self.repaired = 0
        self._forget()

    def _grow_tree(self) -> None:
        """The tokens as a tree of bytes: the token that a node stands for inside and at the end of a word."""
        vocab, nodes = self.vocab, {(0, -1): 0}
        inner, ending = {}, {}
        for shown, i in vocab.ids.items():
            if i in vocab.special.values():
                continue
            ends = bool(vocab.suffix) and shown.endswith(vocab.suffix)
            node = 0
            for char in shown.removesuffix(vocab.suffix) if ends else shown:
                node = nodes.setdefault((node, vocab.byte_of[char]), len(nodes))
            if ends or not vocab.suffix:
                ending[node] = i
            if not ends:
                inner[node] = i
        del nodes[0, -1]
        keys = np.array([a << 8 | b for a, b in nodes], dtype=np.int64)
        order = np.argsort(keys)
        self.edges, self.edge_node = KeyTable(keys[order]), np.array(list(nodes.values()))[order]
        self.inner, self.ending = np.full(len(nodes) + 1, -1), np.full(len(nodes) + 1, -1)
        self.inner[list(inner)], self.ending[list(ending)] = list(inner.values()), list(ending.values())

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.lengths, self.shown = array("i"), array("i"), []
        for text, i in self.vocab.special.items():
            self._remember([f"\0{text}"], np.array([i]), np.array([1]))

    def _remember(self, words: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        tokens = self.vocab.tokens
        ends = np.cumsum(lengths).tolist()
        listed = flat.tolist()
        for word, end, n in zip(words, ends, lengths.tolist(), strict=True):
            self.index[word] = len(self.index)
            self.shown.append(" ".join([tokens[i] for i in listed[end - n : end]]))
        self.flat.extend(listed)
        self.lengths.extend(lengths.tolist())

    def speculate(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest token at every byte of concatenated words (``ends``: where the word of each byte ends),
        and its length; -1 and 0 where no token starts.  All bytes walk down the tree together."""
        size = len(data)
        token, length = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int64)
        start, node, depth = np.arange(size), np.zeros(size, dtype=np.int64), 0
        while len(start):
            edge = self.edges.find(node << 8 | data[start + depth])
            start, node = start[edge >= 0], self.edge_node[edge[edge >= 0]]
            depth += 1
            last = start + depth == ends[start]
            here = np.where(last, self.ending[node], self.inner[node])
            known = here >= 0
            token[start[known]], length[start[known]] = here[known], depth
            start, node = start[~last], node[~last]
        return token, length

    def learn(self, words: list[str]) -> None:
        """Encode words not met before, all in one ragged array."""
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        data = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        token, step = self.speculate(data, np.repeat(ends, lengths))
        place, owner, failing = ends - lengths, np.arange(len(words)), np.zeros(len(words), dtype=bool)
        tokens, owners = [], []
        while len(place):
            tokens.append(token[place])
            owners.append(owner)
            failing[owner[step[place] == 0]] = True
            place = place + step[place]
            more = (place < ends[owner]) & ~failing[owner]
            place, owner = place[more], owner[more]
        flat, owner = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        flat, owner = flat[order], owner[order]
        failing[owner[~self.whole[flat]]] = True
        inside = np.flatnonzero((owner[1:] == owner[:-1]) & ~failing[owner[1:]])
        pairs, back = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
        clash = (crossing_rank(self.vocab, pairs >> 32, pairs & 0xFFFFFFFF) < NO_MERGE)[back]
        failing[owner[inside[clash]]] = True
        right = ~failing[owner]
        counts = np.bincount(owner[right], minlength=len(words))
        if failing.any():
            wrong = np.flatnonzero(failing)
            merged, counts[wrong] = merge_rounds(self.vocab, *self.vocab.symbols([words[i] for i in wrong]))
            flat = np.concatenate([flat[right], merged])
            owner = np.concatenate([owner[right], np.repeat(wrong, counts[wrong])])
            flat = flat[np.argsort(owner, kind="stable")]
            self.repaired += len(wrong)
        self._remember(words, flat, counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Flat ids, their number and the decoded text of each text."""
        found: list[list[np.ndarray]] = [[] for _ in texts]
        shown: list[list[str]] = [[] for _ in texts]
        words: list[str] = []
        parts: list[tuple[int, int]] = []

        def flush() -> None:
            if len(self.index) > self.remembered:
                self._forget()
            index = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
            missing = np.flatnonzero(index < 0).tolist()
            if missing:
                self.learn(list({words[i]: None for i in missing}))
                index[missing] = [self.index[words[i]] for i in missing]
            lengths = np.frombuffer(self.lengths, dtype=np.int32).astype(np.int64)
            starts = np.cumsum(lengths) - lengths
            flat = ragged_gather(np.frombuffer(self.flat, dtype=np.int32), starts[index], lengths[index])
            sizes = [n for _, n in parts]
            ends = np.cumsum(sums(lengths[index], sizes))
            start = at = 0
            for (i, n), end in zip(parts, ends.tolist(), strict=True):
                found[i].append(flat[start:end])
                shown[i] += map(self.shown.__getitem__, index[at : at + n].tolist())
                start, at = end, at + n
            words.clear()
            parts.clear()

        for i, text in enumerate(texts):
            for k, part in enumerate(self.vocab.parts(text)):
                for block in ([f"\0{part}"],) if k % 2 else self.vocab.pieces(part) if part else ():
                    words.extend(block)
                    parts.append((i, len(block)))
                    if len(words) > self.remembered:
                        flush()
        flush()
        counts = np.array([sum(map(len, f)) for f in found], dtype=np.int64)
        flat = [x for f in found for x in f]
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), counts, [" ".join(s) for s in shown]


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_tokens``, ``ids`` (array of int) and ``decoded`` of each row.

    Ids are those of the tokenizers library for the file at ``path`` without added special tokens
    (special strings inside a text are single tokens); ``decoded`` is what it decodes them to with
    special tokens kept, for a file that names no decoder: the tokens joined by one space.  A null or
    empty text has no ids and an empty ``decoded``; a null or repeated id is passed through, so every row
    gives one row; other columns are not read.  Nothing is shuffled.
    """
    encoders: list[Encoder] = []

    def run(columns: list[list]) -> dict:
        if not encoders:
            encoders.append(Encoder(vocabulary(path)))
        flat, counts, shown = encoders[0].encode([t or "" for t in columns[0]])
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), type=pa.int32())
        return {
            "n_tokens": pa.array(counts),
            "ids": pa.ListArray.from_arrays(offsets, pa.array(flat, type=pa.int32())),
            "decoded": shown,
        }

    return per_document(docs, {id: id, text: text}, run, "n_tokens bigint, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """SHA-256 of the ids, written in decimal with one space between, and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id", "n_tokens", F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
