"""Removal of repeated passages by a relative Lempel-Ziv parse.

A passage is repeated if `window` words in a row occur again somewhere.  A reference block holds all windows whose smallest k-gram, their
anchor, falls into one part of all hashes; so equal windows are always in one block, and windows that follow each other mostly are too.
It is indexed by its sorted suffixes, and every document is factored greedily against each block that holds windows of it: a factor is
the longest run of windows that the block has in another place, and the next one begins with the first window after it.  A factor of
m windows is window + m - 1 words long, so neighbouring factors share window - 1 words, and each window that reaches over a factor's end
is looked up with the factor after it, or in the block that its own anchor belongs to: no repeated window is lost at a boundary.

Only windows whose anchor occurs twice are entered.  Windows of an anchor that a large share of all windows have are dealt out over all
blocks, by their own hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import checkpoint, ids_and_texts, partitions, slices
from .words import Batch, grams, sliding_min

#: Words in an anchor.
GRAM = 8
#: Records that a task holds before it deals them out.
HELD = 1 << 20
#: An anchor is hot if it has over one in so many of all places of anchors; so there are fewer hot ones than this.
HOT_SHARE = 4096

U64 = np.uint64


class Windows:
    """Windows of a batch of texts that lie within one text: their starts, and the positions and hashes of their anchors."""

    def __init__(self, batch: Batch, window: int):
        gram = min(GRAM, window)
        self.batch = batch
        self.text_of = np.repeat(np.arange(len(batch.first) - 1), np.diff(batch.first))
        if len(batch.hashes) < window:
            self.starts = self.anchors = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, U64)
            return
        self.hashes = grams(batch.hashes, gram)
        at = sliding_min(self.hashes, window - gram + 1)
        starts = np.arange(len(at))
        inside = self.text_of[starts] == self.text_of[starts + window - 1]
        self.starts, self.anchors = starts[inside], at[inside]

    def place(self, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the texts that the words stand in, and the words' places in them."""
        text = self.text_of[at]
        return keys[text], (at - self.batch.first[text]).astype(np.uint32)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """For sorted columns, whether a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _repeated(new: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For rows in runs, whether a row's run has two rows or one that stands for many."""
    run = np.cumsum(new) - 1
    size = np.bincount(run)
    several = np.bincount(run, weights=many) > 0
    return ((size > 1) | several)[run]


def _longest(ids: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a reference, the length of the longest run from it that occurs in another place too, and that place.

    `ids` tells windows apart, `last` is where each one's text ends.  Runs of 1, 2, 4 ... windows are ranked, until suffixes are sorted;
    the longest match of a suffix is with one of its neighbours then.
    """
    n, levels = len(ids), [ids.astype(np.int32)]
    place = np.arange(n)
    most = int((last - place).max(initial=0))
    while 1 << (len(levels) - 1) < most:
        span = 1 << (len(levels) - 1)
        after = np.where(place + span < last, levels[-1][np.minimum(place + span, n - 1)] + 1, 0)
        names, ranks = np.unique(levels[-1].astype(np.int64) * (n + 1) + after, return_inverse=True)
        levels.append(ranks.astype(np.int32))
        if len(names) == n:
            break
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[:-1], order[1:]
    same = np.zeros(max(0, n - 1), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        p, q = a + same, b + same
        fits = (p + (1 << k) <= last[a]) & (q + (1 << k) <= last[b])
        p, q = np.minimum(p, n - 1), np.minimum(q, n - 1)
        same += (fits & (levels[k][p] == levels[k][q])).astype(np.int64) << k
    length, other = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    for here, there in ((a, b), (b, a)):
        more = same > length[here]
        length[here[more]], other[here[more]] = same[more], there[more]
    return length, other


def factors(ids: np.ndarray, key: np.ndarray, at: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, ...]:
    """Greedy factors of the windows that are asked for: key, start and number of windows of each, and key and start of the other place.

    Windows come by key and start.  A run of windows ends where the next one is of another text, or not the next in it.
    """
    n = len(ids)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (at[1:].astype(np.int64) - at[:-1] != 1)
    starts = np.flatnonzero(new)
    last = np.concatenate((starts[1:], [n]))[np.cumsum(new) - 1]
    length, other = _longest(ids, last)
    hit = np.flatnonzero((length > 0) & asked)
    next_hit = np.concatenate((hit, [n]))[np.searchsorted(hit, np.arange(n + 1))].tolist()
    taken, lengths, p = [], length.tolist(), next_hit[0]
    while p < n:
        taken.append(p)
        p = next_hit[p + lengths[p]]
    return key[taken], at[taken], length[taken].astype(np.uint32), key[other[taken]], at[other[taken]]


def parse(h: np.ndarray, check: np.ndarray, key: np.ndarray, at: np.ndarray, asked: np.ndarray):
    """Indexes a reference block and parses against it the windows that are `asked` for.

    Returns the factors: key, start and number of windows of each; and for each window whether it is its kind's first and whether its
    kind is in the block again.
    """
    order = np.lexsort((at, key, check, h))
    new = _runs(h[order], check[order])
    kind, repeated = np.cumsum(new) - 1, _repeated(new, np.zeros(len(order), bool))
    ids, first, hit = np.empty(len(order), np.int64), np.empty(len(order), bool), np.empty(len(order), bool)
    ids[order], first[order], hit[order] = kind, new, repeated
    again = np.flatnonzero(hit)  # the others match nothing
    again = again[np.lexsort((at[again], key[again]))]
    if not len(again):
        return (key[:0], at[:0], at[:0]), first, hit
    ids = np.unique(ids[again], return_inverse=True)[1]
    return factors(ids, key[again], at[again], asked[again])[:3], first, hit


def _by_key(key: np.ndarray, parts: int) -> np.ndarray:
    return (key.view(U64) % U64(parts)).astype(np.int32)


def _enter_anchors(window: int, parts: int):
    """Anchors, dealt out by hash; those that a task has twice are known to be repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush():
            h, key, at = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            new = _runs(h[order])
            twice = np.empty(len(h), bool)
            twice[order] = _repeated(new, np.zeros(len(h), bool))
            yield from blocks.dealt(0, (h[~twice] % U64(parts)).astype(np.int32), h[~twice], key[~twice], at[~twice], parts=parts)
            known = np.unique(h[twice])
            yield from blocks.dealt(1, (known % U64(parts)).astype(np.int32), known, parts=parts)
            yield from blocks.dealt(2, _by_key(key[twice], parts), key[twice], at[twice], parts=parts)

        for rows, texts in slices(batches):
            w = Windows(Batch(texts, "space", False), window)
            at = np.unique(w.anchors)
            held.append((w.hashes[at], *w.place(at, rows.column(2).to_numpy())))
            count += len(at)
            if count > HELD:
                yield from flush()
                held.clear()
                count = 0
        if count:
            yield from flush()

    return run


def _match_anchors(parts: int):
    """Places of repeated anchors, dealt out by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = blocks.gathered(batches, {0: (U64, np.int64, np.uint32), 1: (U64,), 2: (np.int64, np.uint32)})
        h = np.concatenate((found[0][0], found[1][0]))
        if len(h):
            many = np.arange(len(h)) >= len(found[0][0])
            order = np.argsort(h, kind="stable")
            hit = np.empty(len(h), bool)
            hit[order] = _repeated(_runs(h[order]), many[order])
            hit = hit[: len(found[0][0])]
            yield from blocks.dealt(0, _by_key(found[0][1][hit], parts), found[0][1][hit], found[0][2][hit], parts=parts)
        yield from blocks.dealt(0, _by_key(found[2][0], parts), *found[2], parts=parts)

    return run


_ROWS = pa.schema([("key", pa.int64()), ("block", pa.binary())])


def _by_document(*types):
    """Records whose first column is a document's key, as one block for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = blocks.gathered(batches, {0: (np.int64, *types)})[0]
        order = np.argsort(found[0], kind="stable")
        found = [x[order] for x in found]
        if not len(found[0]):
            return
        cuts = np.concatenate((np.flatnonzero(_runs(found[0])), [len(order)])).tolist()
        for i in range(0, len(cuts) - 1, 4096):
            pairs = list(zip(cuts[i : i + 4096], cuts[i + 1 : i + 4097]))
            yield pa.RecordBatch.from_arrays([pa.array([int(found[0][a]) for a, _ in pairs]), pa.array([blocks.pack(*(x[a:b] for x in found[1:])) for a, b in pairs], pa.binary())], schema=_ROWS)

    return run


def _frequent_anchors(window: int):
    """Anchors that have over one in HOT_SHARE of the places that a task holds at a time, with their numbers there, and the number of all (null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            often = n * HOT_SHARE > count
            return pa.RecordBatch.from_arrays([pa.array([None, *h[often].view(np.int64).tolist()], pa.int64()), pa.array([count, *n[often].tolist()], pa.int64())], names=["anchor", "n"])

        for _, texts in slices(batches):
            w = Windows(Batch(texts, "space", False), window)
            held.append(w.hashes[np.unique(w.anchors)])
            count += len(held[-1])
            if count > HELD:
                yield flush()
                held.clear()
                count = 0
        if count:
            yield flush()

    return run


def _hot_anchors(rows: DataFrame, window: int) -> np.ndarray:
    """Fewer than HOT_SHARE hashes of anchors, ascending: those that have over one in HOT_SHARE of all places.  One that has is frequent in some task."""
    counts = checkpoint(rows.select("text").mapInArrow(_frequent_anchors(window), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")))
    total = counts.where("anchor is null").agg(F.sum("n")).first()[0] or 0
    return np.sort(np.array([r[0] for r in counts.where((F.col("n") * HOT_SHARE > total) & F.col("anchor").isNotNull()).select("anchor").collect()], np.int64).view(U64))


def _enter_windows(window: int, parts: int, hot: np.ndarray):
    """From rows (doc_id, text, key, block of anchor places): windows with repeated anchors, dealt out by anchor, and the factors within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush():
            part, h, check, key, at = (np.concatenate(x) for x in zip(*held))
            own, first, hit = parse(h, check, key, at, np.ones(len(h), bool))
            yield from blocks.dealt(2, _by_key(own[0], parts), *own, parts=parts)
            for kind, which in ((0, ~hit), (1, hit & first)):
                yield from blocks.dealt(kind, part[which], h[which], check[which], key[which], at[which], parts=parts)

        for rows, texts in slices(batches):
            batch = Batch(texts, "space", False)
            w = Windows(batch, window)
            if not len(w.starts):
                continue
            marked = np.zeros(len(batch.hashes), bool)
            for i, places in enumerate(rows.column(3).to_pylist()):
                marked[batch.first[i] + np.frombuffer(places, np.uint32)] = True
            take = marked[w.anchors]
            starts, anchors = w.starts[take], w.anchors[take]
            key, at = w.place(starts, rows.column(2).to_numpy())
            found, second, anchor = grams(batch.hashes, window)[starts], grams(batch.second(), window)[starts], w.hashes[anchors]
            to = np.where(np.isin(anchor, hot), found, anchor)
            held.append(((to % U64(parts)).astype(np.int32), found, (second >> U64(32)).astype(np.uint32), key, at))
            count += len(starts)
            if count > HELD:
                yield from flush()
                held.clear()
                count = 0
        if count:
            yield from flush()

    return run


def _match_windows(parts: int):
    """Factors against a reference block, dealt out by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (U64, np.uint32, np.int64, np.uint32)
        found = blocks.gathered(batches, {0: types, 1: types, 2: (np.int64, np.uint32, np.uint32)})
        both = [np.concatenate(x) for x in zip(found[0], found[1])]
        if len(both[0]):
            own, _, _ = parse(*both, np.arange(len(both[0])) < len(found[0][0]))
            yield from blocks.dealt(0, _by_key(own[0], parts), *own, parts=parts)
        yield from blocks.dealt(0, _by_key(found[2][0], parts), *found[2], parts=parts)

    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.int64())), ("text", pa.binary())])


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            batch = Batch(texts, "space", False)
            kept, spans, removed = [], [], []
            for i, places in enumerate(rows.column(3).to_pylist()):
                a, b = int(batch.first[i]), int(batch.first[i + 1])
                if places is None:
                    kept.append(b" ".join(batch.words(a, b)))
                    spans.append([])
                    removed.append(0)
                    continue
                start, length = blocks.unpack(places, len(places) // 8, np.uint32, np.uint32)
                edge = np.zeros(b - a + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + length.astype(np.int64) + window - 1, -1)
                gone = np.cumsum(edge)[:-1] > 0
                stay = (np.flatnonzero(~gone) + a).tolist()
                kept.append(b" ".join([batch.data[s:e] for s, e in zip(batch.starts[stay].tolist(), batch.ends[stay].tolist())]) if stay else b"")
                spans.append(np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))).tolist())
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(batch.first), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, _OUT[3].type), pa.array(kept, pa.binary())], schema=_OUT)

    return run


def without_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, spans, text: one row for each row of `docs`.

    Words are runs of bytes that are not white space, taken as they are.  A word is removed if some `window` consecutive words of its
    document that hold it also start at another place, in this document or any other; all is judged on the input.  spans lists starts
    and ends of the ranges removed, in words, one after the other; text is the words kept, joined by one space, as UTF-8 bytes.  A null
    text has no words; one of fewer words than a window loses none; a repeated row repeats all its windows.  Null and repeated
    ids are allowed; other columns are ignored; an empty table gives an empty result.

    Windows are compared by 96 bits of two independent hashes.  Texts are dealt out once, very long ones whole; anchors, windows and
    factors as blocks of numbers.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    parts = blocks.Parts(partitions(rows, 3.0))
    anchors = blocks.by_part(rows.mapInArrow(_enter_anchors(window, parts), blocks.DDL), parts)
    places = blocks.by_part(anchors.mapInArrow(_match_anchors(parts), blocks.DDL), parts).mapInArrow(_by_document(np.uint32), "key long, block binary")
    hot = _hot_anchors(rows, window)
    entered = rows.join(places, "key").select("doc_id", "text", "key", "block").mapInArrow(_enter_windows(window, parts, hot), blocks.DDL)
    found = blocks.by_part(entered, parts).mapInArrow(_match_windows(parts), blocks.DDL)
    found = blocks.by_part(found, parts).mapInArrow(_by_document(np.uint32, np.uint32), "key long, block binary")
    return rows.join(found, "key", "left").select("doc_id", "text", "key", "block").mapInArrow(_remove(window), "doc_id long, n_words long, n_removed long, spans array<long>, text binary")
