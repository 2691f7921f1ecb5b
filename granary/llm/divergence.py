"""Divergence of the sources of a language, by a sparse merge of term counts for every pair of sources.

Counts of terms are summed on Spark.  The terms of a language that are frequent enough are dealt into blocks
of about ``BLOCK_TERMS``, and numbered inside their block; a source then is one sorted array of (term number,
count) per block.  A task for an unordered pair meets the two arrays of a block, finds the terms that both
have by galloping search, and prices common, one-sided and absent terms in both directions at once.

Probabilities are whole numbers (parts of ``UNIT``, with one added to every count), so sums are exact in
whatever order they are made.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.batches import coded_words, slices, text_lengths, united
from granary.session import stage

#: Documents of its language that a term occurs in at least, to be compared.
MIN_DOCS = 3
UNIT = 1_000_000_000
#: Terms of a block on average: what one array of a pair task holds.
BLOCK_TERMS = 4096
#: Entries that one task gathers before it sums them and hands them on; shapes memory, not results.
HELD_ENTRIES = 1 << 18
#: Bytes of one long text that are counted at a time; shapes memory, not results.
PIECE_BYTES = 1 << 22

#: ASCII letters in lower case and all bytes of other characters; everything else parts terms.
_TERM_BYTES = bytes(b if 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(text: str) -> Counter:
    """How often each term (as bytes) occurs in a text, of a long one piece by piece."""
    data = text.encode().translate(_TERM_BYTES)
    if len(data) <= PIECE_BYTES:
        return Counter(data.split())
    found, start = Counter(), 0
    while start < len(data):
        end = data.find(b" ", start + PIECE_BYTES)
        end = len(data) if end < 0 else end
        found.update(data[start:end].split())
        start = end
    return found


def _block(texts: pa.Array, long: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, code and occurrences of every term of every text, and the distinct terms by code."""
    if not long:
        row, codes, terms = coded_words(texts, _TERM_BYTES)
        keys, n = np.unique(row << 32 | codes, return_counts=True)
        return keys >> 32, keys & 0xFFFFFFFF, n, terms
    found = [term_counts(text) for text in texts.to_pylist()]
    sizes = [len(x) for x in found]
    n = np.fromiter((k for x in found for k in x.values()), np.int64, sum(sizes))
    codes, terms = united([(np.arange(len(x)), pa.array([t.decode() for t in x], type=pa.string())) for x in found])
    return np.repeat(np.arange(len(found)), sizes), codes, n, terms


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct keys in order, and the sums of each one's values."""
    order = np.argsort(keys)
    keys = keys[order]
    cuts = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), dtype=bool), keys[1:] != keys[:-1]]))
    return keys[cuts], [np.add.reduceat(v[order], cuts) if len(cuts) else v[:0] for v in values]


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, occurrences ``n`` and documents ``docs`` with the term.

    Every group of language and source also has a row without a term.  A task sums what it has read before
    anything is shuffled, so a group with a third of all rows sends no more than any other from each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            codes, terms = united([(h[1], h[4]) for h in held])
            of_group, n, n_docs = (np.concatenate([np.zeros(0, np.int64), *(h[k] for h in held)]) for k in (0, 2, 3))
            keys, (n, n_docs) = _summed(of_group << 32 | codes, n, n_docs)
            of_group = np.concatenate([np.arange(len(groups)), keys >> 32])
            names = [pa.array(x, type=pa.string()).take(pa.array(of_group)) for x in zip(*groups, strict=True)] if groups else [pa.array([], type=pa.string())] * 2
            shown = pa.concat_arrays([pa.nulls(len(groups), pa.string()), terms.take(pa.array(keys & 0xFFFFFFFF))])
            sums = [pa.array(np.concatenate([np.zeros(len(groups), np.int64), x])) for x in (n, n_docs)]
            made = pa.RecordBatch.from_arrays([*names, shown, *sums], names=["lang", "source", "term", "n", "docs"])
            groups.clear(), held.clear()
            for start in range(0, made.num_rows, 1 << 16):
                yield made.slice(start, 1 << 16)

        size = 0
        for batch in batches:
            lengths = text_lengths(batch.column(2))
            for start, stop in slices(lengths):
                part = batch.slice(start, stop - start)
                of_row = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                of_row = np.array([groups.setdefault(of, len(groups)) for of in of_row], dtype=np.int64)
                row, codes, n, terms = _block(part.column(2), bool(lengths[start:stop].max() > PIECE_BYTES))
                keys, (n, n_docs) = _summed(of_row[row] << 32 | codes, n, np.ones(len(n), np.int64))
                held.append((keys >> 32, keys & 0xFFFFFFFF, n, n_docs, terms))
                size += len(keys)
                if size >= HELD_ENTRIES:
                    yield from flush()
                    size = 0
        yield from flush()

    read = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    found = read.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _parts(n: str, total: str, kinds: str) -> Column:
    """The probability of a count as a whole number of parts, in decimals wide enough for any count."""
    wide = lambda c, digits: F.expr(c).cast(f"decimal({digits},0)")
    ratio = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * wide(f"{n} + 1", 19), wide(f"{total} + {kinds}", 19))
    return F.lit(1) + ratio


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def parts(n: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """As ``_parts``, by long division in steps that fit 64 bits (totals up to nine quadrillion)."""
    rest, result = n + 1, np.zeros(len(n), dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        result = result * 1000 + rest // (total + kinds)
        rest %= total + kinds
    return result + 1


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Where each number of ``short`` stands in ``long``, or -1; both sorted without repeats.

    All search at once, each from the place that its rank suggests: steps double until the number lies
    between two probes, then the gap is halved.
    """
    if not len(short) or not len(long):
        return np.full(len(short), -1, dtype=np.int64)
    size = len(long)
    low = np.arange(len(short)) * size // len(short)
    high, step = low + 1, 1
    while True:
        early, late = (low > 0) & (long[low] > short), (high < size) & (long[np.minimum(high, size - 1)] <= short)
        if not (early.any() or late.any()):
            break
        low = np.where(early, np.maximum(low - step, 0), np.where(late, high, low))
        high = np.where(late, np.minimum(high + step, size), high)
        step *= 2
    while (gap := high - low).max() > 1:
        middle = low + gap // 2
        right = long[middle] <= short
        low, high = np.where(right, middle, low), np.where(right, high, middle)
    return np.where(long[low] == short, low, -1)


def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], totals: tuple[int, int], kinds: int, here: int) -> tuple[int, int]:
    """What a block of ``here`` terms adds to the divergence of a pair, from a to b and from b to a.

    ``a``, ``b``: sorted term numbers and counts; ``totals``: occurrences of all ``kinds`` terms in each.
    """
    if len(a[0]) > len(b[0]):
        return merge(b, a, totals[::-1], kinds, here)[::-1]
    p, q = (parts(x[1], t, kinds) for x, t in zip((a, b), totals, strict=True))
    p0, q0 = (parts(np.zeros(1, np.int64), t, kinds) for t in totals)
    at = gallop(a[0], b[0])
    both, alone = at >= 0, np.ones(len(b[0]), dtype=bool)
    alone[at[both]] = False
    absent = here - len(p) - int(alone.sum())
    ab = _apart(p[both], q[at[both]]).sum() + _apart(p[~both], q0).sum() + _apart(p0, q[alone]).sum() + absent * _apart(p0, q0)[0]
    ba = _apart(q[at[both]], p[both]).sum() + _apart(q0, p[~both]).sum() + _apart(q[alone], p0).sum() + absent * _apart(q0, p0)[0]
    return int(ab), int(ba)


def _merged(pairs: DataFrame) -> DataFrame:
    """``lang``, ``a``, ``b``, ``ab``, ``ba`` of each block of each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(i) for i in range(3, 7)]
            totals = [batch.column(i).to_pylist() for i in range(7, 11)]
            found = []
            for row, (total_a, total_b, kinds, here) in enumerate(zip(*totals, strict=True)):
                ids_a, n_a, ids_b, n_b = (x[row].values.to_numpy(zero_copy_only=False) for x in lists)
                found.append(merge((ids_a, n_a), (ids_b, n_b), (total_a, total_b), kinds, here))
            sums = [pa.array([x[k] for x in found], type=pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)] + sums, names=["lang", "a", "b", "ab", "ba"])

    columns = ["lang", "a", "b", "ids_a", "n_a", "ids_b", "n_b", "total_a", "total_b", "kinds", "here"]
    return pairs.select(*columns).mapInArrow(run, "lang string, a string, b string, ab bigint, ba bigint")


def audit(
    docs: DataFrame, top: int = 200, min_docs: int = MIN_DOCS, block_terms: int = BLOCK_TERMS,
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of every group of language and source.

    Terms are runs of ASCII letters (in lower case) and of characters beyond ASCII; a language keeps those that
    at least ``min_docs`` of its rows hold.  With p the group's and q another's probability of a term, a term
    adds (p - q)^2 / q, rounded down.  Part ``pair``: each other source of the language, summed over all kept
    terms (0 without any).  Part ``term``: the ``top`` kept terms that the group has and that are more likely
    in it than in its language.  Ranks go by value, the largest first, then by item.

    Null texts, languages and sources count as empty ones; empty texts have no terms, but their group is
    listed.  Repeated rows count as often as they stand there.  Very long texts are counted in pieces.  Other
    columns are not read.  An empty table gives no rows.

    Pairs are the result's own size: sources of a language times sources.  Blocks grow in number with
    the terms of a language, not in size, so a pair task holds two arrays of about ``block_terms``.
    """
    found = stage(counts(docs, text, lang, source), "divergence-counts")
    terms = found.where("term IS NOT NULL")
    kept = stage(
        terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(F.col("docs") >= min_docs),
        "divergence-terms",
    )
    # A number per language: few rows, which Spark broadcasts only if they are small.
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("n_lang").alias("total_lang"))
    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("kinds") / block_terms)).cast("int")
    placed = kept.join(sizes, "lang").withColumn("block", block)
    number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))
    # Dealt out anew: the exchange by language alone would do for the window, and a language can be large.
    placed = stage(placed.repartition("lang", "block").withColumn("number", number), "divergence-numbered")
    held = stage(
        terms.select("lang", "source", "term", "n").join(placed.select("lang", "term", "block", "number", "n_lang"), ["lang", "term"]),
        "divergence-held",
    )
    groups = found.groupBy("lang", "source").agg(F.count("*").alias("rows")).drop("rows")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stage(
        groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("total", "kinds", "total_lang")]
        ),
        "divergence-groups",
    )

    # Every source has a row in every block of its language, be it empty: an absent term has a price, too.
    blocks = placed.groupBy("lang", "block").agg(F.count("*").alias("here"))
    everywhere = groups.select("lang", "source").join(blocks.select("lang", "block"), "lang")
    entries = held.select("lang", "block", "source", F.struct("number", "n").alias("entry"))
    arrays = entries.unionByName(everywhere.withColumn("entry", F.lit(None).cast(entries.schema["entry"].dataType)))
    arrays = arrays.groupBy("lang", "block", "source").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    arrays = stage(
        arrays.select("lang", "block", "source", F.col("entries.number").alias("ids"), F.col("entries.n").alias("n"))
        .join(groups.select("lang", "source", "total", "kinds"), ["lang", "source"]).join(blocks, ["lang", "block"]),
        "divergence-arrays",
    )
    side = lambda s: arrays.select(
        "lang", "block", *[F.col(c).alias(t) for c, t in (("source", s), ("ids", f"ids_{s}"), ("n", f"n_{s}"), ("total", f"total_{s}"))]
    )
    pairs = side("a").join(side("b").join(arrays.select("lang", "block", "kinds", "here").distinct(), ["lang", "block"]), ["lang", "block"])
    sums = _merged(pairs.where("a < b")).groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"))
    # A language without kept terms has no block; its pairs have the value 0.
    names = lambda s: groups.where("kinds = 0").select("lang", F.col("source").alias(s))
    empty = names("a").join(names("b"), "lang").where("a < b").select("lang", "a", "b", *[F.lit(0).cast("bigint").alias(c) for c in ("ab", "ba")])
    both = F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")),
    ))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_rows = sums.unionByName(empty).select("lang", both.alias("x")).select("lang", "x.*").withColumn("rank", F.row_number().over(order))

    priced = held.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _parts("n", "total", "kinds").alias("p"), _parts("n_lang", "total_lang", "kinds").alias("q")
    )
    value = F.expr("(p - q) * (p - q) DIV q").alias("value")
    term_rows = priced.where("p > q").select("lang", "source", "item", value).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    final = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return final(pair_rows, "pair").unionByName(final(term_rows, "term"))
