"""Exact removal of repeated byte windows by a depth-limited radix sort of suffixes.

A suffix matters only through its first ``DEPTH`` bytes, its window; windows that are equal form a group,
and all of a group but those of the smallest document are covered.  Sorting every suffix on all its bytes
would shuffle the corpus many times over, so the sort runs by digits, the most significant first, and a
group that can't hold two documents leaves it after each digit:

1. *The anchor.*  The anchor of a window is its substring of ``GRAM`` bytes with the smallest hash.
   Neighbouring windows mostly share an anchor, and windows that are equal share it always; one row per
   anchor stands for all its windows.  Anchors that only one document has leave.
2. *The neighbourhood.*  The windows of one anchor cover one stretch of text.  Where two documents have
   the same stretch, all its windows are decided at once; an anchor with a single kind of stretch leaves.
3. *The window.*  What is left are stretches that differ but share an anchor, as at the borders of
   repeated passages.  Their windows are compared one by one.

A document whose whole text an earlier document has needs no sorting: all its windows repeat.  Such copies
are found by digests of the texts first and take no part.

Digits are compared by 64-bit hashes of their bytes; as a window is told apart by all its digits
together, two unequal windows would have to agree in two independent hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import per_document, ragged_gather, slices, text_lengths
from granary.llm.passages import Hashes, mix, order_of, packed_texts, partitions, shared_keys, unpack

DEPTH, GRAM = 50, 24
GRAMS = DEPTH - GRAM + 1  # in a window
#: Bytes handled by one pass of the vectorised loops, and the bits that hold a place in them.
BLOCK_BYTES, PLACE_BITS = 1 << 19, 21
#: Stretches under one anchor that one task compares; more are dealt out by window.
COMPARED = 4096
ALL = -1  # every bit set


class Anchors:
    """The anchors of some texts: number of the text, first and last window, hash of the anchor, and hash
    of the stretch (its bytes and where the anchor lies in it)."""

    def __init__(self, texts: list[bytes]):
        parts = list(self._parts(texts))
        columns = zip(*parts, strict=True) if parts else [[np.zeros(0, np.int64)]] * 3 + [[np.zeros(0, np.uint64)]] * 2
        self.text, self.start, self.end, self.gram, self.stretch = (np.concatenate(c) for c in columns)

    @staticmethod
    def _parts(texts: list[bytes]) -> Iterator[tuple]:
        """Texts together up to ``BLOCK_BYTES``; a longer one in pieces that share ``DEPTH - 1`` bytes."""
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for i, body in enumerate(texts):
            for base in range(0, max(len(body) - DEPTH + 1, 0), BLOCK_BYTES):
                piece = body[base : base + BLOCK_BYTES + DEPTH - 1]
                if held and size + len(piece) > BLOCK_BYTES:
                    yield Anchors._block(held)
                    held, size = [], 0
                held.append((i, base, piece))
                size += len(piece)
        if held:
            yield Anchors._block(held)

    @staticmethod
    def _block(pieces: list[tuple[int, int, bytes]]) -> tuple:
        lengths = np.array([len(b) for _, _, b in pieces])
        data = np.frombuffer(b"".join(b for _, _, b in pieces), dtype=np.uint8)
        hashes = Hashes(data)
        grams = hashes.windows(GRAM)
        mask = np.uint64((1 << PLACE_BITS) - 1)
        least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= GRAMS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < GRAMS:
            least = np.minimum(least[: len(least) - (GRAMS - width)], least[GRAMS - width :])
        inside = np.ones(len(data), dtype=bool)  # windows that do not cross into the next piece
        ends = np.cumsum(lengths)
        inside[ragged_gather(np.arange(len(data)), ends - (DEPTH - 1), np.full(len(ends), DEPTH - 1))] = False
        window = np.flatnonzero(inside[: len(least)])
        least = least[window]
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        start, end = window[first], window[np.append(first[1:], len(window)) - 1]
        place = (least[first] & mask).astype(np.int64)
        around = mix(hashes.of(start, end + DEPTH) + mix((place - start).astype(np.uint64) + np.uint64(1)))
        piece = np.searchsorted(ends, start, side="right")
        shift = np.array([b for _, b, _ in pieces]) - (ends - lengths)
        number = np.array([i for i, _, _ in pieces])[piece]
        return number, start + shift[piece], end + shift[piece], grams[place], around


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = Anchors(texts)
    return found.text, found.gram


def _within(text: np.ndarray, key: np.ndarray, lists: list) -> np.ndarray:
    """Which (text number, key) are in the lists of the texts."""
    sizes = [len(x) if x is not None else 0 for x in lists]
    wanted = np.concatenate([np.zeros(0, np.int64), *[np.asarray(x, dtype=np.int64) for x in lists if x is not None]])
    tagged = lambda t, k: mix(k + mix(t.astype(np.uint64) + np.uint64(7)))
    return np.isin(tagged(text, key), tagged(np.repeat(np.arange(len(lists)), sizes), wanted.view(np.uint64)))


# --- second digit -----------------------------------------------------------------------------


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, stretch, uid, known) of the shared anchors of documents.

    Of the documents of a block with one stretch the first has yet to meet other blocks; the others are
    known to repeat it, and travel by document instead of by anchor.
    """
    for batch in batches:
        for begin, stop in slices(text_lengths(batch.column(1))):
            part = batch.slice(begin, stop - begin)
            uids = part.column(0).to_numpy(zero_copy_only=False)
            lists = part.column(2).to_pylist()
            found = Anchors([unpack(t) if x else b"" for t, x in zip(part.column(1).to_pylist(), lists, strict=True)])
            near = _within(found.text, found.gram, lists)
            gram, stretch, uid = found.gram[near], found.stretch[near], uids[found.text[near]]
            order = np.lexsort((uid, stretch, gram))
            gram, stretch, uid = gram[order], stretch[order], uid[order]
            if not len(uid):
                continue
            new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (stretch[1:] != stretch[:-1])])
            other = np.concatenate([[True], new[1:] | (uid[1:] != uid[:-1])])
            holder = uid[np.flatnonzero(new)][np.cumsum(new) - 1]
            known = uid != holder
            route = np.where(known, mix(uid.view(np.uint64)), gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[other]) for x in (route.view(np.int64), stretch.view(np.int64), uid, known)],
                names=["gram", "stretch", "uid", "known"],
            )


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, stretch, open) from rows sorted by gram, stretch and uid: not open where a smaller document has
    the same stretch, open where other stretches have the same anchor.

    Remembered are the smallest document of the last stretch, and whether its anchor has others.
    """
    held: tuple[int, int, int] | None = None
    several = sent = False

    def output(uid: np.ndarray, stretch: np.ndarray, is_open: bool) -> pa.RecordBatch:
        arrays = [pa.array(uid), pa.array(stretch), pa.array(np.full(len(uid), is_open))]
        return pa.RecordBatch.from_arrays(arrays, names=["uid", "stretch", "open"])

    for batch in batches:
        gram, stretch, uid = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        known = batch.column(3).to_numpy(zero_copy_only=False)
        if known.any():
            yield output(uid[known], stretch[known], False)
            gram, stretch, uid = gram[~known], stretch[~known], uid[~known]
        if not len(gram):
            continue
        same_gram = held is not None and held[0] == gram[0]
        if same_gram:
            gram, stretch, uid = (np.concatenate([[h], x]) for h, x in zip(held, (gram, stretch, uid), strict=True))
        new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
        new = new_gram | np.concatenate([[True], stretch[1:] != stretch[:-1]])
        first = np.flatnonzero(new)
        repeats = uid != uid[first][np.cumsum(new) - 1]
        yield output(uid[repeats], stretch[repeats], False)
        group = np.cumsum(new_gram) - 1
        kinds = np.bincount(group[first])
        many = kinds > 1
        if same_gram and several:
            many[0] = True
        open_ = many[group[first]]
        last_open = bool(open_[-1])
        if same_gram and sent:
            open_[0] = False
        yield output(uid[first][open_], stretch[first][open_], True)
        held = (int(gram[-1]), int(stretch[-1]), int(uid[first[-1]]))
        several, sent = bool(many[-1]), last_open


# --- third digit ------------------------------------------------------------------------------


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, uid, stretch, body) of the stretches of documents that are still undecided."""
    for batch in batches:
        for begin, stop in slices(text_lengths(batch.column(1))):
            part = batch.slice(begin, stop - begin)
            uids = part.column(0).to_numpy(zero_copy_only=False)
            lists = part.column(2).to_pylist()
            texts = [unpack(t) if x else b"" for t, x in zip(part.column(1).to_pylist(), lists, strict=True)]
            found = Anchors(texts)
            at = np.flatnonzero(_within(found.text, found.stretch, lists))
            _, once = np.unique(np.stack([found.text[at].astype(np.uint64), found.stretch[at]], axis=1), axis=0, return_index=True)
            at = at[once]
            spans = zip(found.text[at].tolist(), found.start[at].tolist(), found.end[at].tolist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.gram[at].view(np.int64)), pa.array(uids[found.text[at]]),
                    pa.array(found.stretch[at].view(np.int64)),
                    pa.array([texts[i][a : b + DEPTH] for i, a, b in spans], type=pa.binary()),
                ],
                names=["gram", "uid", "stretch", "body"],
            )


def _window_hashes(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every window of some stretches, and the stretch and place that it is from."""
    lengths = np.array([len(b) for b in bodies], dtype=np.int64)
    ends = np.cumsum(lengths)
    counts = lengths - DEPTH + 1
    starts = ragged_gather(np.arange(int(ends[-1])), ends - lengths, counts)
    row = np.repeat(np.arange(len(bodies)), counts)
    hashes = Hashes(np.frombuffer(b"".join(bodies), dtype=np.uint8)).of(starts, starts + DEPTH)
    return hashes, row, starts - (ends - lengths)[row]


def _masks(gram: np.ndarray, uid: np.ndarray, bodies: list[bytes]) -> np.ndarray:
    """For each stretch the windows, as bits, that a stretch of a smaller document with its anchor has."""
    hashes, row, place = _window_hashes(bodies)
    order = np.lexsort((uid[row], gram[row], hashes))
    hashes, row, place = hashes[order], row[order], place[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (gram[row][1:] != gram[row][:-1])])
    smallest = uid[row][np.flatnonzero(new)][np.cumsum(new) - 1]
    repeats = uid[row] > smallest
    masks = np.zeros(len(bodies), dtype=np.int64)
    np.bitwise_or.at(masks, row[repeats], np.int64(1) << place[repeats])
    return masks


def _compare(batches: Iterator[pa.RecordBatch], compared: int = COMPARED) -> Iterator[pa.RecordBatch]:
    """(uid, stretch, mask, gram, body) from (gram, uid, stretch, body) sorted by gram: masks of the
    windows that repeat; the stretches of an anchor with over ``compared`` come out undecided.

    Only the stretches of the last anchor are carried from batch to batch, at most ``compared`` of them.
    """
    gram, uid, stretch = (np.zeros(0, np.int64) for _ in range(3))
    bodies: list[bytes] = []
    large: int | None = None

    def undecided(members: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(members)
        return pa.RecordBatch.from_arrays(
            [pa.array(uid[at]), pa.array(stretch[at]), pa.nulls(len(at), pa.int64()), pa.array(gram[at]),
             pa.array([bodies[i] for i in at.tolist()], type=pa.binary())],
            names=["uid", "stretch", "mask", "gram", "body"],
        )

    def decided(rows: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(rows)
        masks = _masks(gram[at], uid[at], [bodies[i] for i in at.tolist()]) if len(at) else np.zeros(0, np.int64)
        at, masks = at[masks != 0], masks[masks != 0]
        return pa.RecordBatch.from_arrays(
            [pa.array(uid[at]), pa.array(stretch[at]), pa.array(masks), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary())],
            names=["uid", "stretch", "mask", "gram", "body"],
        )

    for batch in batches:
        gram, uid, stretch = (
            np.concatenate([x, batch.column(i).to_numpy(zero_copy_only=False)]) for i, x in enumerate((gram, uid, stretch))
        )
        bodies += batch.column(3).to_pylist()
        if not len(gram):
            continue
        starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        sizes = np.diff(np.append(starts, len(gram)))
        hot = (sizes > compared) | (gram[starts] == large if large is not None else False)
        members = np.repeat(hot, sizes)
        if members.any():
            yield undecided(members)
        large = int(gram[-1]) if hot[-1] else None
        last = np.repeat(np.arange(len(sizes)) == len(sizes) - 1, sizes) & ~members
        yield decided(~members & ~last)
        at = np.flatnonzero(last)
        gram, uid, stretch, bodies = gram[at], uid[at], stretch[at], [bodies[i] for i in at.tolist()]
    if len(gram):
        yield decided(np.ones(len(gram), dtype=bool))


def _by_window(undecided: DataFrame) -> DataFrame:
    """(uid, stretch, mask) of the stretches of very frequent anchors: their windows are dealt out by
    content, and the smallest document of each is found with partial minima."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            uid, stretch, gram = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            hashes, row, place = _window_hashes(batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (gram[row], hashes.view(np.int64), uid[row], stretch[row], place)],
                names=["gram", "window", "uid", "stretch", "place"],
            )

    rows = undecided.select("uid", "stretch", "gram", "body").mapInArrow(
        explode, "gram bigint, window bigint, uid bigint, stretch bigint, place bigint"
    )
    first = rows.groupBy("gram", "window").agg(F.min("uid").alias("smallest"))
    repeats = rows.join(first, ["gram", "window"]).where("uid > smallest")
    return repeats.groupBy("uid", "stretch").agg(F.expr("bit_or(shiftleft(1L, CAST(place AS INT)))").alias("mask"))


# --- the operator -----------------------------------------------------------------------------


def marked_spans(size: int, starts: np.ndarray, ends: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Maximal runs of bytes covered by the windows ``start + bit`` of all set bits, as (start, end) rows."""
    change = np.zeros(size + 1, dtype=np.int64)
    every = masks == ALL
    np.add.at(change, starts[every], 1)
    np.add.at(change, ends[every] + DEPTH, -1)
    some = np.flatnonzero(~every)
    bits = (masks[some, None] >> np.arange(GRAMS)) & 1
    row, bit = np.nonzero(bits)
    window = starts[some][row] + bit
    np.add.at(change, window, 1)
    np.add.at(change, window + DEPTH, -1)
    covered = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
    return np.flatnonzero(np.diff(covered)).reshape(-1, 2)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def dedupe(docs: DataFrame, id: str = "doc_id", text: str = "text", compared: int = COMPARED) -> DataFrame:
    """``id``, ``n_bytes``, ``spans`` (maximal byte ranges covered by a window of ``DEPTH`` bytes that also
    starts in a document with a smaller id) and ``kept`` (the other bytes) of each row.

    Windows are judged on the input, and may overlap.  Rows with one id count as one document and remove
    nothing from each other; a row without an id comes after all others.  A null text is empty; texts
    shorter than a window are kept whole.  Every row gives one row; other columns are not read.

    The texts are shuffled once, compressed; that exchange serves the second and third digit and the result.
    """
    count = partitions(docs)
    texts = packed_texts(docs, id, text).repartition(count, "uid")
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    firsts = docs.select(order_of(id).alias("uid"), digest.alias("digest")).groupBy("digest").agg(F.min("uid").alias("uid"))
    firsts = firsts.select("uid").distinct()  # all rows of other ids are copies
    firsts = firsts.withColumn("first", F.lit(True))

    def beside(lists: DataFrame) -> DataFrame:
        """All texts with their list: no column or row is left out, so one exchange serves every use."""
        added = [c for c in lists.columns if c != "uid"]
        return texts.join(lists, "uid", "left").select("uid", "packed", *added, "id")

    shared = shared_keys(beside(firsts), _grams)
    shared = shared.groupBy("uid").agg(F.collect_set("key").alias("grams"))  # at most a document's anchors
    stretches = beside(shared).mapInArrow(
        _stretches, "gram bigint, stretch bigint, uid bigint, known boolean"
    )
    decided = (
        stretches.repartition(count, "gram").sortWithinPartitions("gram", "stretch", "uid")
        .mapInArrow(_decide, "uid bigint, stretch bigint, open boolean")
        .repartition(count, "uid")
    )
    lists = decided.groupBy("uid").agg(
        F.collect_set(F.when(F.col("open"), F.col("stretch"))).alias("stretches"),
        F.collect_set(F.when(~F.col("open"), F.col("stretch"))).alias("whole"),
    )
    bodies = beside(lists.select("uid", "stretches").where("size(stretches) > 0")).mapInArrow(
        _bodies, "gram bigint, uid bigint, stretch bigint, body binary"
    )
    compared_ = bodies.repartition(count, "gram").sortWithinPartitions("gram").mapInArrow(
        lambda b: _compare(b, compared), "uid bigint, stretch bigint, mask bigint, gram bigint, body binary"
    )
    masks = compared_.where("mask IS NOT NULL").select("uid", "stretch", "mask").unionByName(
        _by_window(compared_.where("mask IS NULL"))
    )
    masks = masks.groupBy("uid").agg(F.collect_list(F.struct("stretch", "mask")).alias("masks"))
    joined = (
        texts.join(lists.select("uid", "whole"), "uid", "left").join(masks, "uid", "left")
        .join(firsts, "uid", "left")
    )

    def run(columns: list[list]) -> dict:
        firsts, whole, masked, bodies = *columns[:3], [unpack(t) for t in columns[3]]
        found = Anchors([b if w or m else b"" for b, w, m in zip(bodies, whole, masked, strict=True)])
        cut = np.searchsorted(found.text, np.arange(len(bodies) + 1))
        out = {"n_bytes": [len(b) for b in bodies], "spans": [], "kept": []}
        for i, body in enumerate(bodies):
            spans = np.zeros((0, 2), dtype=np.int64)
            if not firsts[i] and len(body) >= DEPTH:
                spans = np.array([[0, len(body)]])
            elif whole[i] or masked[i]:
                known = dict.fromkeys(whole[i] or (), ALL)
                for m in masked[i] or ():
                    known[m["stretch"]] = known.get(m["stretch"], 0) | m["mask"]
                own = slice(cut[i], cut[i + 1])
                masks = np.array([known.get(s, 0) for s in found.stretch[own].view(np.int64).tolist()], dtype=np.int64)
                hit = masks != 0
                spans = marked_spans(len(body), found.start[own][hit], found.end[own][hit], masks[hit])
            edges = [0, *spans.ravel().tolist(), len(body)]
            out["kept"].append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            out["spans"].append([{"start": a, "end": b} for a, b in spans.tolist()])
        return out | {"spans": pa.array(out["spans"], type=SPANS)}

    return per_document(
        joined, {id: "id", "first": "first", "whole": "whole", "masks": "masks", "packed": "packed"}, run,
        "n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
    )


def summary(deduped: DataFrame) -> DataFrame:
    """Counts of removed bytes and spans, and a digest of the kept bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return deduped.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
