"""Benchmark decontamination by winnowing.

Of every `window - gram + 1` consecutive k-grams of words, the one with the smallest hash is kept as a fingerprint, in documents and in
benchmark items alike.  So a shared run of `window` words has a shared fingerprint, whatever stands around it.  Fingerprints of the
documents are joined with those of the benchmark, each hit is extended to the windows around it, and those are compared word by word,
as bytes: hashes only say where to look.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import importable
from .common import checkpoint, ids_and_texts, slices
from .words import Batch, encoded, grams, lowered, sliding_min

#: Bytes of benchmark text whose index is broadcast at a time; a larger benchmark is taken in blocks of about that size.
BLOCK_BYTES = 4 << 20


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value stands in the ascending table, -1 if it doesn't."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


class Index:
    """Windows of benchmark items: by length, their hashes in order, with the place of each in the items' words, and its items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, gram: int):
        self.window, self.gram = window, min(gram, window)
        self.items = [x for x, _ in items]
        batch = Batch([lowered(x) for _, x in items], "alnum", False)
        self.data, self.word_starts, self.word_ends = batch.data, batch.starts, batch.ends
        prints: list[np.ndarray] = []
        found: dict[int, dict[int, list[tuple[int, set[int]]]]] = {}
        for i in range(len(items)):
            first = int(batch.first[i])
            words = batch.hashes[first : batch.first[i + 1]]
            if not len(words):
                continue
            n = min(window, len(words))
            for at, h in enumerate(grams(words, n).tolist(), first):
                same = found.setdefault(n, {}).setdefault(h, [])
                owners = next((x for place, x in same if self._words(place, n) == self._words(at, n)), None)
                if owners is None:
                    same.append((at, owners := set()))
                owners.add(i)
            if n == window:
                g = grams(words, self.gram)
                prints.append(g[np.unique(sliding_min(g, window - self.gram + 1))])
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        self.by_length = {}
        for n, windows in found.items():
            rows = [(h, place, sorted(owners)) for h in sorted(windows) for place, owners in windows[h]]
            self.by_length[n] = (np.array([r[0] for r in rows], np.uint64), [r[1] for r in rows], [r[2] for r in rows])

    def _words(self, at: int, n: int) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.word_starts[at : at + n].tolist(), self.word_ends[at : at + n].tolist())]

    def _starts(self, batch: Batch, n: int) -> np.ndarray:
        """Where windows of n words may stand in the batch."""
        if n < self.window:
            return np.arange(max(0, len(batch.hashes) - n + 1))
        g = grams(batch.hashes, self.gram)
        width = self.window - self.gram + 1
        at = np.unique(sliding_min(g, width))
        at = at[_find(self.prints, g[at]) >= 0]
        starts = np.unique((at[:, None] - np.arange(width)[None, :]).ravel())
        return starts[(starts >= 0) & (starts <= len(batch.hashes) - n)]

    def hits(self, batch: Batch) -> tuple[np.ndarray, dict[int, set[int]]]:
        """For each word of the batch whether a window covers it, and by text the items that occur."""
        cover = np.zeros(len(batch.hashes) + 1, np.int64)
        items: dict[int, set[int]] = {}
        text_of = np.repeat(np.arange(len(batch.first) - 1), np.diff(batch.first))
        for n, (hashes, places, owners) in self.by_length.items():
            starts = self._starts(batch, n)
            if not len(starts):
                continue
            starts = starts[text_of[starts] == text_of[starts + n - 1]]
            found = _find(hashes, grams(batch.hashes, n)[starts])
            starts, found = starts[found >= 0], found[found >= 0]
            for s, k in zip(starts.tolist(), found.tolist()):
                own = [lowered(x) for x in batch.words(s, s + n)]
                while self._words(places[k], n) != own:
                    k += 1
                    if k == len(hashes) or hashes[k] != hashes[k - 1]:
                        break
                else:
                    cover[s] += 1
                    cover[s + n] -= 1
                    items.setdefault(int(text_of[s]), set()).update(owners[k])
        return np.cumsum(cover[:-1]) > 0, items


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    rows = benchmark.select(F.coalesce(benchmark[id_col].cast("string"), F.lit("")).alias("id"), benchmark[text_col].cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    for i in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == i)
        yield [(x.id, encoded(x.text)) for x in part.collect()]


_STATE = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, items, spans, contaminated: one row for each row of `docs`.

    Words are runs of ASCII digits, letters (A-Z lower-cased) and all characters beyond ASCII.  A window is `window` consecutive words
    of an item; an item of fewer words is one window, one without words has none.  spans lists starts and ends of the word ranges that
    windows cover, one after the other; items the ids of the items with windows in the document, in string order.  Null texts have no
    words.  A null item id counts as an empty one.  Items with one id count once.  Repeated rows are each answered; other columns are
    ignored; an empty benchmark covers nothing, and an empty table gives an empty result.

    The benchmark is the stated query set; its index is broadcast in blocks of about BLOCK_BYTES of text, and the documents are
    neither shuffled nor collected.
    """
    state = ids_and_texts(docs, id_col, text_col, F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items"))
    for i, block in enumerate(_blocks(benchmark, item_id_col, item_text_col)):
        index = docs.sparkSession.sparkContext.broadcast(Index(block, window, gram))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for rows, texts in slices(batches):
                batch = Batch(texts, "alnum", True)
                hit, found = index.value.hits(batch)
                spans, items = rows.column(3).to_pylist(), rows.column(4).to_pylist()
                for k, which in found.items():
                    a, b = batch.first[k], batch.first[k + 1]
                    own = hit[a:b]
                    old = np.zeros(b - a + 1, np.int64)
                    for s, e in zip(spans[k][::2], spans[k][1::2]):
                        old[s] += 1
                        old[e] -= 1
                    own = own | (np.cumsum(old)[:-1] > 0)
                    spans[k] = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8))).tolist()
                    items[k] = sorted({*items[k], *(index.value.items[x] for x in which)})
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.diff(batch.first), pa.int64()), pa.array(spans, _STATE[3].type), pa.array(items, _STATE[4].type)], schema=_STATE)

        state = state.mapInArrow(run, "doc_id long, text string, n_words long, spans array<long>, items array<string>")
        if i % 4 == 3:  # no more than four indexes in a task
            state = checkpoint(state)
    n_hit = F.expr("aggregate(spans, 0L, (s, x) -> x - s)")  # ends minus starts: the sign turns with each step, and the last is an end
    return state.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "spans", (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, in whose text no window of the benchmark occurs; see contamination().

    Rows with null texts, null ids or repeated ids stay, each as often as it stands; an empty benchmark drops nothing.
    """
    importable(docs.sparkSession)
    out = docs
    for i, block in enumerate(_blocks(benchmark, item_id_col, item_text_col)):
        index = docs.sparkSession.sparkContext.broadcast(Index(block, window, gram))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                at = whole.schema.get_field_index(text_col)
                texts = pa.RecordBatch.from_arrays([pa.array(range(whole.num_rows), pa.int64()), whole.column(at).cast(pa.string())], names=["row", "text"])
                drop: list[int] = []
                for rows, raw in slices(iter([texts])):
                    _, found = index.value.hits(Batch(raw, "alnum", True))
                    drop.extend(rows.column(0)[k].as_py() for k in found)
                keep = np.ones(whole.num_rows, bool)
                keep[drop] = False
                yield whole.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
        if i % 4 == 3:  # no more than four indexes in a task
            out = checkpoint(out)
    return out
