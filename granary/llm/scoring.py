"""Language-model scores of texts, from a Bloom filter that holds the logarithms of n-gram counts.

Tokens are lower-cased words and one end per text.  N-grams are counted on Spark as 64-bit hashes.  A count
becomes a level (each level stands for counts ``BASE`` times larger), and an n-gram enters the filter once for
each level up to its own; probes for level 1, 2, ... until one misses give the level back.  The filter consists
of sub-filters of a fixed size, whose number follows the corpus, and goes to the tasks in shares of bounded
size.  Beside the model's probability, every text has an exact add-one unigram score.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import coded_words, per_document, slices, text_lengths, united
from granary.session import stage

#: Words of an n-gram at most.
ORDER = 2
#: N-grams of all orders that occur less often are left to the smoothing.
MIN_COUNT = 2
BASE = 1.5
#: Weight of the shorter history's probability, as a number of observations.
PRIOR = 1000.0
SEED = 42
BITS_PER_ENTRY, PROBES = 10, 6
#: Bits of a sub-filter, and sub-filters that are broadcast together.
SUB_BITS, SHARE = 1 << 23, 64
#: Words whose counts every task has; the counts of all others are joined.
FREQUENT, FREQUENT_BYTES = 1 << 16, 64
#: Entries and n-grams that one task sums before it hands them on; shape memory, not results.
HELD_ENTRIES, HELD_GRAMS = 1 << 20, 1 << 22
#: Bytes of a text beyond which it is cut into words piece by piece.
PIECE_BYTES = 1 << 20
#: Places (a power of two) of a task for the levels of n-grams that it met last; shapes memory, not results.
MET_BITS = 20
#: Words that a task looks up once; shapes memory, not results.
REMEMBERED = 300_000
#: ASCII letters in lower case, and a space for every byte that parts words.
_WORD_BYTES = bytes(32 if b in b" \t\n\v\f\r" else b for b in bytes(range(256)).lower())
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_GOLD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Hashes of what stands before the first and behind the last word; no word has a space in it.
START, END = (np.uint64(xxhash.xxh64_intdigest(x, SEED)) for x in (b" start", b" end"))
#: The least count of each level; the last is beyond any count.
_LEAST = np.array([float(MIN_COUNT)])
while _LEAST[-1] < 2**62:
    _LEAST = np.append(_LEAST, max(np.ceil(MIN_COUNT * BASE ** len(_LEAST)), _LEAST[-1] + 1))
#: The count that a level stands for: the middle of its counts; 0 for none.
_TYPICAL = np.concatenate([[0.0], (_LEAST[:-1] + _LEAST[1:] - 1) / 2])


def words(text: str | None) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, of a long one piece by piece."""
    data, start = (text or "").encode().lower(), 0
    while start < len(data):
        cut = _SPACE.search(data, min(start + PIECE_BYTES, len(data)))
        end = cut.start() if cut else len(data)
        yield data[start:end].split()
        start = end


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _MIX1
    x = (x ^ x >> np.uint64(27)) * _MIX2
    return x ^ x >> np.uint64(31)


def _coded(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """The row and the code of every word of some texts, and the distinct words; with a long text, by pieces."""
    if not text_lengths(texts).max(initial=0) > PIECE_BYTES:
        yield coded_words(texts, _WORD_BYTES)
        return
    for row, text in enumerate(texts.to_pylist()):
        for some in words(text):
            coded = pa.array([w.decode() for w in some], type=pa.string()).dictionary_encode()
            yield np.full(len(some), row), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _shown(found: pa.Array) -> list[bytes]:
    return found.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _hashed(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(SEED)), np.uint64, len(found))


def framed(coded: list[tuple[np.ndarray, np.ndarray]], count: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``count`` texts, given by row and value, with the two ``ends`` around each text's; and the sizes."""
    rows = np.concatenate([np.zeros(0, np.int64), *(c[0] for c in coded)])
    sizes = np.bincount(rows, minlength=count) + 2
    starts = np.cumsum(sizes) - sizes
    flat = np.empty(int(sizes.sum()), ends.dtype)
    flat[starts], flat[starts + sizes - 1] = ends
    flat[np.arange(len(rows)) + 2 * rows + 1] = np.concatenate([np.zeros(0, ends.dtype), *(c[1] for c in coded)])
    return flat, sizes


def grams(tokens: np.ndarray, order: int) -> list[np.ndarray]:
    """Of each order, the n-grams that end at each place; the first places of longer ones mean nothing."""
    found = [tokens]
    for k in range(2, order + 1):
        before = np.concatenate([[START], found[-1][:-1]]).astype(np.uint64)
        found.append(_mixed(before + np.uint64(k)) + tokens)
    return found


def held_out(id: str, fold: int = 2, folds: int = 7) -> Column:
    """Whether a row is kept out of learning; a row without an id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string")), F.lit(folds)) == fold, F.lit(False))


# --- counts -----------------------------------------------------------------------------------


def _word_counts(rows: DataFrame) -> DataFrame:
    """``word`` (null: the end), occurrences ``n`` in learning rows and ``others`` in all other rows.

    A task sums what it has read before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []
        ends = [0, 0]

        def flush() -> Iterator[pa.RecordBatch]:
            codes, found = united([(h[0], h[3]) for h in held])
            sums = [np.zeros(len(found), np.int64) for _ in range(2)]
            for k, total in enumerate(sums):
                np.add.at(total, codes, np.concatenate([np.zeros(0, np.int64), *(h[k + 1] for h in held)]))
            met = np.flatnonzero(sums[0] + sums[1])
            columns = [pa.concat_arrays([pa.nulls(1, pa.string()), found.take(pa.array(met))])]
            columns += [pa.array(np.concatenate([[end], total[met]]), type=pa.int64()) for end, total in zip(ends[::-1], sums, strict=True)]
            made = pa.RecordBatch.from_arrays(columns, names=["word", "n", "others"])
            held.clear()
            ends[:] = 0, 0
            for start in range(0, made.num_rows, 1 << 16):
                yield made.slice(start, 1 << 16)

        size = 0
        for batch in batches:
            learns, texts = batch.column(0).to_numpy(zero_copy_only=False).astype(bool), batch.column(1)
            ends[1] += int(learns.sum())
            ends[0] += int((~learns).sum())
            for start, stop in slices(text_lengths(texts)):
                for rows_of, codes, found in _coded(texts.slice(start, stop - start)):
                    every = np.bincount(codes, minlength=len(found))
                    n = np.bincount(codes[learns[start:stop][rows_of]], minlength=len(found))
                    held.append((np.arange(len(found)), n, every - n, found))
                    size += len(found)
                if size >= HELD_ENTRIES:
                    yield from flush()
                    size = 0
        yield from flush()

    found = rows.select("learns", "text").mapInArrow(run, "word string, n bigint, others bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("others").alias("others"))


def _gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """``h`` and ``n`` of the n-grams of two words or more in the learning rows that are frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            held.clear()
            made = pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])
            for start in range(0, made.num_rows, 1 << 16):
                yield made.slice(start, 1 << 16)

        for batch in batches:
            texts = batch.column(0)
            for start, stop in slices(text_lengths(texts)):
                coded = [(rows_of, _hashed(_shown(some))[codes]) for rows_of, codes, some in _coded(texts.slice(start, stop - start))]
                tokens, sizes = framed(coded, stop - start, np.array([START, END]))
                place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                found = [g[place >= k] for k, g in enumerate(grams(tokens, order)) if k]
                held += found
                size += sum(map(len, found))
                if size >= HELD_GRAMS:
                    yield from flush()
                    size = 0
        yield from flush()

    found = rows.where("learns").select("text").mapInArrow(run, "h bigint, n bigint")
    return found.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _unigram_counts(counted: DataFrame) -> DataFrame:
    """``h`` and ``n`` of the words, the end and the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [int(END) if w is None else xxhash.xxh64_intdigest(w, SEED) for w in batch.column(0).to_pylist()]
            n = batch.column(1).to_pylist()
            starts = [x for w, x in zip(batch.column(0).to_pylist(), n, strict=True) if w is None]
            found, n = found + [int(START)] * len(starts), n + starts
            yield pa.RecordBatch.from_arrays([pa.array(np.array(found, np.uint64).view(np.int64)), pa.array(n, type=pa.int64())], names=["h", "n"])

    return counted.where(F.col("n") >= MIN_COUNT).select("word", "n").mapInArrow(run, "h bigint, n bigint")


# --- the filter -------------------------------------------------------------------------------


def _places(h: np.ndarray, level: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bit of each n-gram and level in its sub-filter, probe by probe; what is sent back narrows the n-grams."""
    x = _mixed(h + _GOLD * np.asarray(level, dtype=np.uint64))
    step = x >> np.uint64(32) | np.uint64(1)
    for _ in range(PROBES):
        hit = yield (x & np.uint64(SUB_BITS - 1)).astype(np.int64)
        if hit is not None:
            x, step = x[hit], step[hit]
        x = x + step


def _home(h: np.ndarray, subs: int) -> np.ndarray:
    """The sub-filter of each n-gram: all its levels are in one."""
    return (h >> np.uint64(33)).astype(np.int64) % subs


class Filter:
    """Sub-filters ``first`` to ``first + len(bits)`` of ``subs``, one row of bytes each."""

    def __init__(self, first: int, bits: np.ndarray, subs: int):
        self.first, self.bits, self.subs = first, bits, subs

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each n-gram; 0 for those of other sub-filters or below the least count."""
        level = np.zeros(len(h), dtype=np.int64)
        home = _home(h, self.subs) - self.first
        at = np.flatnonzero((home >= 0) & (home < len(self.bits)))
        start, flat, step = home[at] * self.bits.shape[1], self.bits.ravel(), 0
        while len(at):
            step += 1
            places = _places(h[at], step)
            hit = None
            try:
                while True:
                    place = places.send(hit)
                    hit = np.flatnonzero(flat[start + (place >> 3)] >> (place & 7).astype(np.uint8) & 1)
                    at, start = at[hit], start[hit]
            except StopIteration:
                level[at] = step
        return level


class Met:
    """Levels of n-grams; those met last are remembered, each in the place that its hash names."""

    def __init__(self, levels: Callable[[np.ndarray], np.ndarray]):
        self.levels, self.shift = levels, np.uint64(64 - MET_BITS)
        self.met = ~(np.arange(1 << MET_BITS, dtype=np.uint64) << self.shift)  # none has its place there
        self.level = np.zeros(1 << MET_BITS, dtype=np.int8)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        place = (h >> self.shift).astype(np.int64)
        found = self.level[place].astype(np.int64)
        new = np.flatnonzero(self.met[place] != h)
        found[new] = self.levels(h[new])
        self.met[place[new]], self.level[place[new]] = h[new], found[new]
        return found


def _sub_filters(counted: DataFrame, subs: int) -> DataFrame:
    """``sub`` and its ``bits``; each is made by one task from rows that it reads in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub, bits = None, np.zeros(SUB_BITS // 8, dtype=np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([sub], type=pa.int64()), pa.array([bits.tobytes()], type=pa.binary())], names=["sub", "bits"])

        for batch in batches:
            of, h, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
            for start, stop in zip(cuts, [*cuts[1:], len(of)], strict=True):
                if sub is not None and sub != of[start]:
                    yield done()
                    bits[:] = 0
                sub = int(of[start])
                top = np.searchsorted(_LEAST, n[start:stop], side="right")
                which = np.repeat(h[start:stop].view(np.uint64), top)
                level = np.arange(len(which)) - np.repeat(np.cumsum(top) - top, top) + 1
                for place in _places(which, level):
                    np.bitwise_or.at(bits, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
        if sub is not None:
            yield done()

    home = F.pmod(F.shiftrightunsigned("h", 33), F.lit(subs)).alias("sub")
    dealt = counted.select(home, "h", "n").repartition("sub").sortWithinPartitions("sub")
    return dealt.mapInArrow(run, "sub bigint, bits binary")


def _shares(counted: DataFrame) -> list[Broadcast]:
    """The filter of all counted n-grams in broadcasts of at most ``SHARE`` sub-filters.

    The number of sub-filters is measured: it follows the number of levels to be held.
    """
    level = F.floor(F.log(F.col("n") / MIN_COUNT) / float(np.log(BASE))) + 1
    entries = counted.agg(F.sum(level)).first()[0] or 0
    subs = max(1, -(-int(entries) * BITS_PER_ENTRY // SUB_BITS))
    made = stage(_sub_filters(counted, subs), "scoring-filter")
    shares = []
    for first in range(0, subs, SHARE):
        bits = np.zeros((min(SHARE, subs - first), SUB_BITS // 8), dtype=np.uint8)
        for sub, row in made.where((F.col("sub") >= first) & (F.col("sub") < first + SHARE)).collect():
            bits[sub - first] = np.frombuffer(row, dtype=np.uint8)
        shares.append(counted.sparkSession.sparkContext.broadcast(Filter(first, bits, subs)))
    return shares


# --- scores -----------------------------------------------------------------------------------


@dataclass
class Model:
    """Counts of words (``word``, ``n``) and what tasks need to score texts."""

    counted: DataFrame
    shares: list[Broadcast]
    frequent: Broadcast
    tokens: int
    kinds: int
    ends: int
    order: int


def learn(docs: DataFrame, learns: Column, text: str = "text", order: int = ORDER) -> Model:
    """The model of the rows where ``learns`` holds; the words of other rows are listed without a count.

    An empty table, or one without learning rows, gives a model in which nothing was seen.
    """
    rows = docs.select(F.coalesce(learns, F.lit(False)).alias("learns"), docs[text].alias("text"))
    counted = stage(_word_counts(rows), "scoring-words")
    kinds = F.count(F.when(F.col("n") > 0, 1))
    tokens, kinds, ends = counted.agg(F.sum("n"), kinds, F.sum(F.when(F.col("word").isNull(), F.col("n")))).first()
    every = stage(_gram_counts(rows, order).unionByName(_unigram_counts(counted)), "scoring-grams")
    # By occurrences in all rows, so no word outside is one that many rows share.
    common = counted.where(F.octet_length("word") <= FREQUENT_BYTES).orderBy(F.desc(F.col("n") + F.col("others")), "word").limit(FREQUENT)
    frequent = {w.encode(): n for w, n in common.select("word", "n").collect()}
    return Model(counted, _shares(every), docs.sparkSession.sparkContext.broadcast(frequent), tokens or 0, kinds or 0, ends or 0, order)


class Words:
    """What a task knows of the words that it has met: exact counts of frequent ones, hashes, and levels.

    0 stands for the start of a text, 1 for its end.
    """

    def __init__(self, frequent: dict[bytes, int], ends: int, levels: Callable[[np.ndarray], np.ndarray]):
        self.numbers: dict[bytes, int] = {}
        self.shown: list[bytes] = []
        self.frequent, self.levels_of = frequent, levels
        self.hashes = np.array([START, END], dtype=np.uint64)
        self.counts = np.array([0.0, ends])
        self.levels = levels(self.hashes)

    def number(self, some: list[bytes]) -> np.ndarray:
        """The numbers of distinct words."""
        found = np.fromiter(map(self.numbers.get, some, repeat(0)), np.int64, len(some))
        for i in np.flatnonzero(found == 0).tolist():
            found[i] = self.numbers.setdefault(some[i], len(self.numbers) + 2)
        return found

    def catch_up(self) -> None:
        """Look up the words numbered since the last time."""
        new = list(islice(self.numbers, len(self.shown), None))
        self.shown += new
        hashes = _hashed(new)
        self.hashes = np.concatenate([self.hashes, hashes])
        self.counts = np.concatenate([self.counts, [self.frequent.get(w, np.nan) for w in new]])
        self.levels = np.concatenate([self.levels, self.levels_of(hashes)])


class Block:
    """Some texts as numbers of their words."""

    def __init__(self, texts: list[str | None], known: Words):
        coded = [(rows, known.number(_shown(found))[codes]) for rows, codes, found in _coded(pa.array(texts, type=pa.string()))]
        known.catch_up()
        self.known = known
        self.flat, self.sizes = framed(coded, len(texts), np.array([0, 1]))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of each text's values."""
        return np.add.reduceat(values, self.starts)

    def rest(self) -> pa.Array:
        """The distinct words of each text that are not frequent, and how often each occurs."""
        counts = self.known.counts
        at = np.flatnonzero(np.isnan(counts[self.flat]))
        text = np.searchsorted(self.starts, at, side="right") - 1
        keys, times = np.unique(text * len(counts) + self.flat[at], return_counts=True)
        text, number = np.divmod(keys, len(counts))
        used, back = np.unique(number, return_inverse=True)
        shown = pa.array([self.known.shown[i - 2].decode() for i in used.tolist()], type=pa.string())
        rows = pa.StructArray.from_arrays([shown.take(pa.array(back)), pa.array(times.astype(np.int64))], names=["word", "n"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(self.sizes) + 1)).astype(np.int32)), rows)


def _log_probabilities(block: Block, model: Model, levels: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over each text of log10 probabilities; ``levels`` asks the filter."""
    place = np.arange(len(block.flat)) - np.repeat(block.starts, block.sizes)
    counts = _TYPICAL[block.known.levels][block.flat]
    p = (counts + 1) / (model.tokens + model.kinds + 1)
    for k, gram in enumerate(grams(block.known.hashes[block.flat], model.order)):
        if k:
            history = np.concatenate([[0.0], counts[:-1]])
            # Of a history never seen, no n-gram counts; with it as a part of longer ones, it may.
            inside = np.flatnonzero((place >= k) & (history > 0) if k + 1 == model.order else place >= k)
            counts = np.zeros(len(gram))
            counts[inside] = _TYPICAL[levels(gram[inside])]
            seen = np.minimum(counts, history)
            p = np.where(place >= k, (seen + PRIOR * p) / (history + PRIOR), p)
    return block.sums(np.where(place > 0, np.log10(p), 0.0))  # the start is no token


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of each row.

    ``n_known``: tokens that learning rows have.  ``base_score``: the sum over tokens of log10 of (count + 1) in
    (tokens + kinds + 1), by exact counts.  ``score``: the model's log10 probability.

    Null and empty texts are an end alone.  Repeated rows are scored as often as they stand there; null ids
    are passed through; other columns are not read.  Very long texts are cut into words piece by piece.  An
    empty table gives no rows.

    Frequent words are counted where the text is read.  Of the others, each row sends its distinct ones to
    their counts; those are rare, so no key is hot.
    """
    slim = Model(None, [], None, model.tokens, model.kinds, model.ends, model.order)
    shares, frequent = model.shares, model.frequent
    held: list[Filter] = []
    met: list[Words] = []
    lately: list[Met] = []

    def levels(h: np.ndarray) -> np.ndarray:
        found = np.zeros(len(h), dtype=np.int64)
        for share in shares:
            if len(shares) == 1:
                held[:] = held or [share.value]
            else:
                held[:] = [share.value]
                vars(share).pop("_value", None)  # one share at a time in memory; the next use reads it again
            found = np.maximum(found, held[0].levels(h))
        return found

    def run(columns: list[list]) -> dict:
        lately[:] = lately or [Met(levels)]
        if not met or len(met[0].numbers) > REMEMBERED:
            met[:] = [Words(frequent.value, slim.ends, levels)]
        block = Block(columns[0], met[0])
        counts = np.nan_to_num(met[0].counts)
        logs = np.log10(counts + 1)[block.flat]
        return {
            "n_tokens": block.sizes - 1,
            "n_known": block.sums((counts > 0)[block.flat].astype(np.int64)),
            "logs": block.sums(logs), "rest": block.rest(), "score": _log_probabilities(block, slim, lately[0]),
        }

    scored = per_document(
        docs.select(F.struct(docs[id].alias("id"), F.monotonically_increasing_id().alias("uid")).alias("row"), docs[text].alias("text")),
        {"row": "row", "text": "text"}, run,
        "n_tokens bigint, n_known bigint, logs double, rest array<struct<word:string,n:bigint>>, score double",
    )
    scored = stage(scored.select("row.*", "n_tokens", "n_known", "logs", "rest", "score"), "scoring-scored")
    rest = scored.select("uid", F.explode("rest").alias("x")).select("uid", "x.word", F.col("x.n").alias("times"))
    counted = rest.join(model.counted.where("word IS NOT NULL").select("word", "n"), "word")
    sums = counted.groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("more_known")
    )
    divisor = float(np.log10(model.tokens + model.kinds + 1))
    return scored.drop("rest").join(sums, "uid", "left").select(
        F.col("id").alias(id), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * divisor).alias("base_score"), "score",
    )
