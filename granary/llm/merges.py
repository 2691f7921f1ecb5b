"""Merge tables of byte-pair vocabularies as numpy arrays, and merging in synchronous rounds."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import regex
from tokenizers import Tokenizer

#: Rank of a pair that no merge joins.
NO_MERGE = np.int64(2**62)
#: Below this code point the pattern engine here and the library's agree on letters, digits, spaces,
#: case and composition (a test compares them for every code point); other texts are normalised and
#: split by the library itself.
COMMON_END = 0x500
#: Symbols from which a sequence is merged on its own.
LONG = 256
#: Pieces of one very long text that are handled at a time.
PIECES = 100_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable in Latin-1,
    otherwise the next free character from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class KeyTable:
    """Positions of known keys, looked up for whole arrays: one slot per key by a multiplied hash, and a
    binary search for the few keys whose slot is shared."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys  # sorted, unique, not negative
        bits = max(8, int(len(keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        home = self._home(keys)
        self.slot = np.full(1 << bits, -1, dtype=np.int32)
        self.slot[home] = np.arange(len(keys))
        self.shared = np.bincount(home, minlength=1 << bits) > 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each wanted key among the keys; -1 where it is not one."""
        if not len(self.keys):
            return np.full(len(wanted), -1, dtype=np.int64)
        home = self._home(wanted)
        at = self.slot[home].astype(np.int64)
        missed = self.keys[at] != wanted  # an empty slot compares with the last key
        again = np.flatnonzero(missed & self.shared[home])
        at[missed] = -1
        if len(again):
            place = np.minimum(np.searchsorted(self.keys, wanted[again]), len(self.keys) - 1)
            at[again] = np.where(self.keys[place] == wanted[again], place, -1)
        return at


class Vocabulary:
    """A byte-level BPE vocabulary file of the tokenizers library.

    Files with settings that are not honoured here are refused when they are read.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix") if model.get(k)]
        odd += [k for k in ("byte_fallback", "ignore_merges", "fuse_unk") if model.get(k)]
        added = [a for a in spec["added_tokens"] if a["content"] not in model["vocab"] or a["special"]]
        odd += [k for a in added for k in ("single_word", "lstrip", "rstrip", "normalized") if a[k]]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"vocabulary settings that are not supported: {odd or model['type']}")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {a["content"]: a["id"] for a in added}
        self.tokens: dict[int, str] = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self._read_merges([m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        if self.suffix and spec["decoder"] is not None:
            raise ValueError("a decoder beside an end mark of words is not supported")
        self.lower = '"Lowercase"' in json.dumps(spec["normalizer"])
        self.composed = '"NFC"' in json.dumps(spec["normalizer"])
        self.pattern = common_pattern(_pattern(spec["pre_tokenizer"]))
        ordered = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, ordered))) if ordered else None
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.alphabet = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(self.alphabet)}
        self.byte_ids = np.array([self.ids[c] for c in self.alphabet], dtype=np.int64)
        self.last_byte_ids = np.array([self.ids[c + self.suffix] for c in self.alphabet], dtype=np.int64)

    def _read_merges(self, merges: list[list[str]]) -> None:
        ids, size = self.ids, max(self.ids.values()) + 1
        left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        made = np.array([ids[a.removesuffix(self.suffix) + b if self.suffix else a + b] for a, b in merges])
        rank = np.arange(len(merges), dtype=np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.table = KeyTable(keys[order])
        self.key_rank, self.key_made = rank[order], made[order].astype(np.int64)
        #: Rank and parts of each token; -1 where no merge makes it.
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        if len(np.unique(made)) != len(made) or len(np.unique(keys)) != len(keys):
            raise ValueError("a token or a pair occurs in more than one merge")
        self.rank[made], self.left[made], self.right[made] = rank, left, right
        if len(made) and np.any(np.maximum(self.rank[left], self.rank[right]) >= rank):
            raise ValueError("a merge comes before a merge that makes one of its parts")

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the sorted merge table; -1 where there is none."""
        return self.table.find(left << 32 | right)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at = self.lookup(left, right)
        return np.where(at >= 0, self.key_rank[at], NO_MERGE)

    def symbols(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the single bytes of non-empty pieces, the last of each with the end mark of words,
        and their numbers."""
        raw = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        flat = self.byte_ids[data]
        ends = np.cumsum(lengths) - 1
        flat[ends] = self.last_byte_ids[data[ends]]
        return flat, lengths

    def parts(self, text: str) -> list[str]:
        """Ordinary text at even places, special tokens between."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return [text]
        return re.split(f"({self.special_pattern.pattern})", text)

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of ordinary text that are merged on their own, in lists of bounded size."""
        plain = unicodedata.normalize("NFC", text) if self.composed and not text.isascii() else text
        # Lower case of single letters: a capital sigma at the end of a word is no exception.
        plain = plain.replace("Σ", "σ").lower() if self.lower else plain
        if _beyond_common(text) or _beyond_common(plain):
            shown = self.library.pre_tokenizer.pre_tokenize_str(
                self.library.normalizer.normalize_str(text) if self.library.normalizer else text
            )
            yield [bytes(map(self.byte_of.__getitem__, s)).decode() for s, _ in shown]
            return
        text = plain
        if len(text) <= PIECES:
            yield self.pattern.findall(text)
            return
        found = self.pattern.finditer(text)
        while some := [m.group() for m in islice(found, PIECES)]:
            yield some


def _pattern(spec: dict) -> str:
    """The splitting pattern of a byte-level pre-tokenizer."""
    steps = spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]
    kinds = [s["type"] for s in steps]
    if kinds == ["ByteLevel"] and steps[0]["use_regex"] and not steps[0]["add_prefix_space"]:
        import public_tokenizers

        return public_tokenizers.PATTERN
    if kinds == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]:
        return steps[0]["pattern"]["Regex"]
    raise ValueError(f"a pre-tokenizer that is not supported: {kinds}")


def _beyond_common(text: str) -> bool:
    return not text.isascii() and np.frombuffer(text.encode("utf-16-le"), dtype="<u2").max() >= COMMON_END


def common_pattern(pattern: str) -> re.Pattern:
    """A splitting pattern for texts below ``COMMON_END``, its classes spelt out as ranges."""
    letters, digits, spaces = (_ranges(p) for p in (r"\p{L}", r"\p{N}", r"\s"))
    for class_, ranges in (
        (r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{digits}]"), (r"[\p{L}]", f"[{letters}]"),
        (r"[\p{N}]", f"[{digits}]"), (r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{digits}]"),
        (r"\S", f"[^{spaces}]"), (r"\s", f"[{spaces}]"),
    ):
        pattern = pattern.replace(class_, ranges)
    return re.compile(pattern)


def _ranges(class_: str) -> str:
    """The code points of a class below ``COMMON_END`` as the inside of a bracket expression."""
    inside = np.array([bool(regex.match(class_, chr(c))) for c in range(COMMON_END)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edges[::2], edges[1::2], strict=True))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One copy per process."""
    return Vocabulary(path)


def _every_second(places: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of runs of places that overlap (``follows`` says that a place continues the run), every second one."""
    run = np.cumsum(~follows) - 1
    first = np.flatnonzero(~follows)
    return places[(np.arange(len(places)) - first[run]) % 2 == 0]


def merge_rounds(vocab: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge ragged sequences of symbols; returns the flat result and its lengths.

    A round looks up all neighbouring pairs, finds the lowest rank of every sequence and merges all
    its places at once (from the left where they overlap).  As every merge ranks after those that make
    its parts, this equals merging one place at a time.  Finished sequences leave the rounds.  A
    sequence of over ``LONG`` symbols has its rounds on its own, and a round touches only its places.
    """
    count = len(lengths)
    owner = np.repeat(np.arange(count), lengths)
    done_symbols, done_owner = [symbols[:0]], [owner[:0]]
    ends = np.cumsum(lengths)
    for i in np.flatnonzero(lengths > LONG):
        merged = merge_long(vocab, symbols[ends[i] - lengths[i] : ends[i]])
        done_symbols.append(merged)
        done_owner.append(np.full(len(merged), i))
    short = np.repeat(lengths <= LONG, lengths)
    symbols, owner = symbols[short], owner[short]
    same = np.flatnonzero(owner[1:] == owner[:-1])
    at = np.full(len(symbols), -1, dtype=np.int64)
    at[same] = vocab.lookup(symbols[same], symbols[same + 1])
    while len(symbols):
        rank = np.where(at >= 0, vocab.key_rank[at], NO_MERGE)
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
        finished = best == NO_MERGE
        if finished.any():
            done_symbols.append(symbols[finished])
            done_owner.append(owner[finished])
            rest = ~finished
            symbols, owner, at, rank, best = symbols[rest], owner[rest], at[rest], rank[rest], best[rest]
            if not len(symbols):
                break
        places = np.flatnonzero(rank == best)
        places = _every_second(places, np.concatenate([[False], np.diff(places) == 1]))
        symbols[places] = vocab.key_made[at[places]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[places + 1] = False
        places -= np.arange(len(places))  # where they are once the merged symbols are gone
        symbols, owner, at = symbols[keep], owner[keep], at[keep]
        near = np.unique(np.concatenate([places, np.maximum(places - 1, 0)]))
        at[near] = -1
        near = near[:-1] if near[-1] == len(symbols) - 1 else near
        near = near[owner[near] == owner[near + 1]]
        at[near] = vocab.lookup(symbols[near], symbols[near + 1])
    flat, owners = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owners, kind="stable")
    return flat[order], np.bincount(owners, minlength=count)


def merge_long(vocab: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """The same rounds over one sequence; places wait in a heap by rank, neighbours are linked."""
    size = len(symbols)
    symbols = np.append(symbols, -1)
    after = np.arange(1, size + 2)
    before = np.arange(-1, size)
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def offer(places: np.ndarray) -> None:
        at = vocab.lookup(symbols[places], symbols[after[places]])
        places, rank = places[at >= 0], vocab.key_rank[at[at >= 0]]
        order = np.argsort(rank, kind="stable")
        places, rank = places[order], rank[order]
        for value, some in zip(*_groups(rank, places), strict=True):
            if value not in waiting:
                waiting[value] = []
                heapq.heappush(heap, value)
            waiting[value].append(some)

    offer(np.arange(size - 1))
    while heap:
        rank = heapq.heappop(heap)
        places = np.unique(np.concatenate(waiting.pop(rank)))
        at = vocab.lookup(symbols[places], symbols[after[places]])
        fresh = (symbols[places] >= 0) & (at >= 0) & (vocab.key_rank[at] == rank)
        places, at = places[fresh], at[fresh]
        if not len(places):
            continue
        made = vocab.key_made[at[0]]
        places = _every_second(places, np.concatenate([[False], after[places[:-1]] == places[1:]]))
        gone = after[places]
        symbols[places], symbols[gone] = made, -1
        after[places] = after[gone]
        before[after[places]] = places
        near = np.concatenate([before[places], places])
        offer(np.unique(near[(near >= 0) & (after[near] < size)]))
    return symbols[:size][symbols[:size] >= 0]


def _groups(sorted_values: np.ndarray, items: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    starts = np.flatnonzero(np.concatenate([[True], np.diff(sorted_values) != 0])) if len(items) else items
    return sorted_values[starts].tolist(), np.split(items, starts[1:]) if len(items) else []
