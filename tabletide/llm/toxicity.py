"""Toxicity by logistic regression over hashed words and their stems, pairs of neighbouring words and pairs with one word between, fitted
by FTRL-proximal.

Each coordinate has its own learning rate, which falls with the gradients it has seen, and L1 keeps all weights at zero whose evidence
is weak; what is left is small enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, ids_and_texts, slices
from .words import Batch, grams, mix

#: Hashed dimensions.
BITS = 22
#: Labelled rows that a model is fitted on, at most, and how many features these may have together; they are taken by a hash of the id.
TRAINING_ROWS = 16_000
TRAINING_FEATURES = 48_000_000
#: Bytes of the stems that count beside a word; inflected and compound words share them.
STEMS = (5, 6, 7)
EPOCHS = 8
#: FTRL-proximal: learning rate, its offset, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1

U64 = np.uint64


def features(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the batch's texts, with repetitions: the text of each and its dimension."""
    text_of = np.repeat(np.arange(len(batch.first) - 1), np.diff(batch.first))
    found = [(text_of, batch.hashes), *((text_of, batch.stems(k)) for k in STEMS)]
    for gap in (1, 2):
        if len(batch.hashes) > gap:
            same = text_of[:-gap] == text_of[gap:]
            pair = mix(batch.hashes[:-gap] * U64(0x9FB21C651E98DF25) + batch.hashes[gap:] + U64(gap))
            found.append((text_of[:-gap][same], pair[same]))
    return np.concatenate([x for x, _ in found]), (np.concatenate([x for _, x in found]) >> U64(64 - BITS)).astype(np.int64)


class Ftrl:
    """FTRL-proximal with logistic loss on rows of distinct active dimensions."""

    def __init__(self, size: int = 1 << BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.bias = np.zeros(2)  # z and n of the constant, without L1

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def constant(self) -> float:
        return -self.bias[0] * self.alpha / (self.beta + self.bias[1] ** 0.5)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        c = self.constant()
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + c, -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        self.bias += (g - ((self.bias[1] + g * g) ** 0.5 - self.bias[1] ** 0.5) / self.alpha * c, g * g)


class Model:
    """Weights that are not zero, by dimension, and the constant."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, constant: float):
        self.at, self.weights, self.constant = at, weights, constant

    def scores(self, texts: list[bytes]) -> np.ndarray:
        table = self.__dict__.get("table")
        if table is None:
            table = self.table = np.zeros(1 << BITS, np.float32)
            table[self.at] = self.weights
        text, at = features(Batch(texts, "alnum", True))
        weighed = table[at] != 0
        pairs = np.unique(text[weighed] << BITS | at[weighed])  # a feature counts once in a text
        total = np.bincount(pairs >> BITS, weights=table[pairs & ((1 << BITS) - 1)], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total + self.constant, -35, 35)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "table"}


_ROW = pa.schema([("doc_id", pa.int64()), ("label", pa.float64()), ("at", pa.binary())])
_WEIGHTS = pa.schema([("at", pa.binary()), ("weight", pa.binary()), ("constant", pa.float64())])


def _dimensions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in slices(batches):
        text, at = features(Batch(texts, "alnum", True))
        pairs = np.unique(text << BITS | at)
        own = np.split((pairs & ((1 << BITS) - 1)).astype(np.uint32), np.searchsorted(pairs >> BITS, np.arange(1, len(texts))))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array([x.tobytes() for x in own], pa.binary())], schema=_ROW)


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for label, at in (x for batch in batches for x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
        held += len(at) // 4
        if held > TRAINING_FEATURES and rows:
            break  # the first row that doesn't fit ends the sample, so that it stays one by hash whatever the lengths
        rows.append((np.frombuffer(at, np.uint32), label))
    if not rows:
        return
    model = Ftrl()
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)).tolist():
            model.learn(*rows[i])
    w = model.weights()
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array([at.astype(np.uint32).tobytes()], pa.binary()), pa.array([w[at].astype(np.float32).tobytes()], pa.binary()), pa.array([model.constant()])], schema=_WEIGHTS)


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", usable: Column | None = None, limit: int = TRAINING_ROWS) -> Model:
    """A model of labels 0 and 1, learned from `limit` labelled rows at most, with TRAINING_FEATURES features together at most.

    The sample is the rows with the smallest hashes of their ids, up to these bounds, and their whole texts.
    Rows of `labels` with a null id or label, or outside `usable`, teach nothing; if an id has several labels the largest counts.  The
    sample's ids are broadcast, its features go to one task, and only weights that are not zero, of 2**BITS at most, reach the driver.
    """
    known = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("double").alias("label")).where("doc_id is not null and label is not null")
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    count = known.count()
    order = F.xxhash64("doc_id", F.lit("sample"))
    if count > limit:
        known = known.where(F.pmod(order, F.lit(1_000_000)) < min(1_000_000, 1_000_000 * limit * 1.05 / count))
    known = checkpoint(known.orderBy(order).limit(limit))
    rows = ids_and_texts(docs, id_col, text_col).join(F.broadcast(known), "doc_id").select("doc_id", "text", "label")
    taken = rows.mapInArrow(_dimensions, "doc_id long, label double, at binary").repartition(1).sortWithinPartitions(order, "at")
    found = taken.mapInArrow(_fitted, "at binary, weight binary, constant double").collect()
    if not found:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0)
    return Model(np.frombuffer(found[0]["at"], np.uint32).astype(np.int64), np.frombuffer(found[0]["weight"], np.float32), found[0]["constant"])


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted: one row for each row of `docs`, from whole texts.

    score is the model's probability of label 1, predicted is 1 if it is at least `threshold`.  Texts that are null or have no words get
    the score of the constant alone.  A model that learned nothing gives 0.5.  A text gets the same score wherever and however often
    it stands; other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            score = shared.value.scores(texts)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], schema=schema)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")
