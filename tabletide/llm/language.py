"""Language identification with error-correcting output codes.

Each language has a codeword of bits.  For each bit a binary classifier over hashed byte n-grams predicts from the text which value the
bit has.  The language whose codeword has the least total logistic loss under these predictions is the answer; if another language's
loss is nearly as small, the answer is flagged as ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import importable
from .common import checkpoint, ids_and_texts, slices

#: Hashed n-gram dimensions.
DIMENSIONS = 1 << 14
#: Documents that a model is fitted on, at most, over all languages together; sampled evenly by language.
TRAINING_DOCS = 2000
#: Texts of a language that are looked at beyond twice as many as its sample has.
SPARE = 200
#: Difference in mean loss a bit below which two languages count as equally near.
AMBIGUOUS = 0.02
ITERATIONS = 150
#: Losses, of texts by languages by bits, that are held at a time.
LOSSES = 1 << 23
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
#: Bytes with ASCII letters lower-cased and other ASCII bytes as one space.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 97 <= x <= 122 else 32 for x in range(256))
_PIECE = 1 << 20


def features(text: bytes) -> np.ndarray:
    """Square roots of counts of hashed byte n-grams of lengths 2 to 4, at length 1 as a vector."""
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, max(1, len(text)), _PIECE):
        x = np.frombuffer(b" " + text[at : at + _PIECE].translate(_FOLD) + b" ", np.uint8).astype(np.uint32)
        value = x
        for n in (2, 3, 4):
            value = (value[:-1] << np.uint32(8)) | x[n - 1 :]
            hashed = (value ^ np.uint32(n * 0x01000193)) * np.uint32(0x9E3779B1)
            counts += np.bincount(hashed >> np.uint32(18), minlength=DIMENSIONS)
    out = np.sqrt(counts, dtype=np.float32)
    return out / max(float(np.sqrt(counts.sum())), 1.0)


def codewords(n: int) -> np.ndarray:
    """A codeword of -1 and 1 for each of n classes: every split in two for few classes, else rows of a Hadamard matrix."""
    if n == 0:
        return np.zeros((0, 0), np.float32)
    if n <= 5:
        masks = range(1, 1 << max(0, n - 1))
        return np.array([[1 if m >> i & 1 else -1 for m in masks] for i in range(n)], np.float32).reshape(n, -1)
    size = 1 << math.ceil(math.log2(n + 1))
    m = np.ones((1, 1), np.float32)
    while len(m) < size:
        m = np.block([[m, m], [m, -m]])
    code = m[1 : n + 1, :]
    return code[:, np.abs(code.sum(0)) < n]


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights, bias
        self.code = codewords(len(languages))

    def predict(self, texts: list[bytes]) -> list[tuple[str, float, bool]]:
        """Language, score and whether it is ambiguous, of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0, False)] * len(texts)
        known = [_LETTER.search(x.decode("utf-8", "replace")) is not None for x in texts]
        out: list[tuple[str, float, bool]] = []
        step = max(1, min(256, LOSSES // max(1, self.code.size)))
        for a in range(0, len(texts), step):
            rows = np.stack([features(x) for x in texts[a : a + step]])
            margins = np.clip(rows @ self.weights + self.bias, -30, 30)
            loss = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]).sum(2)
            best = loss.argmin(1)
            part = np.exp(loss.min(1)[:, None] - loss)
            score = part.max(1) / part.sum(1)
            near = np.sort(loss, 1)
            bits = max(1, self.code.shape[1])
            gap = (near[:, 1] - near[:, 0]) / bits if len(self.languages) > 1 else np.ones(len(rows))
            for i, (k, s, g) in enumerate(zip(best.tolist(), score.tolist(), gap.tolist())):
                out.append((self.languages[k], min(1.0, max(0.0, s)), g < AMBIGUOUS) if known[a + i] else (UNKNOWN, 0.0, False))
        return out


#: A training text: its label and hash, and the places and values of its features.
_SPARSE = pa.schema([("label", pa.string()), ("hash", pa.int64()), ("at", pa.binary()), ("value", pa.binary())])
_WEIGHTS = pa.schema([("weights", pa.binary()), ("bias", pa.binary())])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of rows (label, text, hash), the first of a task's rows of each label and hash."""
    seen: set[tuple[str, int]] = set()
    for rows, texts in slices(batches):
        new = []
        for i, key in enumerate(zip(rows.column(0).to_pylist(), rows.column(2).to_pylist())):
            if key not in seen:
                seen.add(key)
                new.append(i)
        vectors = [features(texts[i]) for i in new]
        at = [np.flatnonzero(v).astype(np.uint16) for v in vectors]
        which = pa.array(new, pa.int64())
        yield pa.RecordBatch.from_arrays([rows.column(0).take(which), rows.column(2).take(which), pa.array([x.tobytes() for x in at], pa.binary()), pa.array([v[x].tobytes() for v, x in zip(vectors, at)], pa.binary())], schema=_SPARSE)


def _fitted(languages: list[str], each: int):
    """Weights and constants, from the rows of _sparse() in the order of their hashes; of each label the first `each` count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, taken = {x: i for i, x in enumerate(languages)}, []
        count = np.zeros(len(languages), np.int64)
        for batch in batches:
            for label, _, at, value in zip(*(c.to_pylist() for c in batch.columns)):
                if count[number[label]] < each:
                    count[number[label]] += 1
                    taken.append((number[label], at, value))
        if not taken:
            return
        x = np.zeros((len(taken), DIMENSIONS), np.float32)
        for i, (_, at, value) in enumerate(taken):
            x[i, np.frombuffer(at, np.uint16)] = np.frombuffer(value, np.float32)
        code = codewords(len(languages))
        y = code[[k for k, _, _ in taken]]
        # weights are sums of the texts' features, so descent is on what each text adds to them, from the products of texts
        products = x @ x.T
        added, bias = np.zeros(y.shape, np.float32), np.zeros(code.shape[1], np.float32)
        speed = np.zeros_like(added)
        for _ in range(ITERATIONS if code.shape[1] else 0):  # gradient descent with momentum on the regularised logistic loss
            slope = -y / (1 + np.exp(np.clip(y * (products @ added + bias), -30, 30)))
            speed = 0.9 * speed - 8.0 * (slope / len(taken) + 1e-5 * added)
            added += speed
            bias -= 1.0 * slope.mean(0)
        weights = x.T @ added
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias.tobytes()], pa.binary())], schema=_WEIGHTS)

    return run


def fit(labelled: DataFrame, text_col: str, label_col: str, limit: int = TRAINING_DOCS) -> Model:
    """A model of the languages in `label_col`, from a sample of `limit` texts, or 4 of each language if that is more.

    Each language has the same number of texts in the sample, or all if it has fewer: those with the smallest hashes.  A text counts
    once in a language, however many rows have it.  Every label is learned, so the model grows with the number of labels.  Null labels
    and texts teach nothing.  One task learns from hashed n-gram counts of the sample, which its size bounds; only labels and weights reach the driver.

    Which hashes may be among the smallest follows from how many different texts a language has, about; so no task sees all of a language.
    """
    importable(labelled.sparkSession)
    rows = labelled.select(labelled[label_col].cast("string").alias("label"), labelled[text_col].cast("string").alias("text")).where("label is not null and text is not null")
    rows = rows.withColumn("hash", F.xxhash64("text", F.lit("sample")))
    counts = checkpoint(rows.groupBy("label").agg(F.approx_count_distinct("hash", 0.05).alias("n")))
    found = sorted(x["label"] for x in counts.select("label").collect())
    if not found:
        return Model([], np.zeros((DIMENSIONS, 0), np.float32), np.zeros(0, np.float32))
    each = max(4, limit // len(found))
    # twice as many hashes as are wanted, and some more, are expected below the bound; the estimate of n errs by a few hundredths
    share = F.lit(2.0 * each + SPARE) / F.col("n")
    bound = F.when(share < 0.99, ((share - 0.5) * 2.0**64).cast("long")).otherwise((1 << 63) - 1)
    bounds = counts.select("label", bound.alias("bound"))
    sample = rows.join(F.broadcast(bounds), "label").where("hash <= bound").select("label", "text", "hash")
    # a task's repetitions of a text go before the shuffle, the others after it
    sample = sample.mapInArrow(_sparse, "label string, hash long, at binary, value binary").dropDuplicates(["label", "hash"])
    learned = sample.repartition(1).sortWithinPartitions("hash", "label").mapInArrow(_fitted(found, each), "weights binary, bias binary").first()
    bits = codewords(len(found)).shape[1]
    return Model(found, np.frombuffer(learned["weights"], np.float32).reshape(DIMENSIONS, bits), np.frombuffer(learned["bias"], np.float32))


def identify(docs: DataFrame, model: Model, *more: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous: one row for each row of `docs`, from whole texts.

    lang_pred is a language of the model, or `und` with score 0 if the text is null or has no letter, or the model knows no language.
    score is the answer's share of exp(-loss) over all languages.  ambiguous is true if another language's mean loss a bit is within
    AMBIGUOUS; of languages with equal losses the first in string order is the answer.  A text gets the same answer wherever and however often it stands; other columns are ignored; an empty table gives an
    empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            answers = list(zip(*shared.value.predict(texts)))
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(a, f.type) for a, f in zip(answers, list(schema)[1:]))], schema=schema)

    return ids_and_texts(docs, id_col, text_col, *more).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def known_language(docs: DataFrame, model: Model, text_col: str = "text", languages: Collection[str] | None = None) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose language identify() tells: not `und`, not ambiguous, and one of `languages` if given.

    Null texts and those without letters go.  Rows with null or repeated ids, and repeated rows, are each judged by their text; a column
    has no meaning but for `text_col`; an empty table gives an empty result.
    """
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wanted = None if languages is None else frozenset(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = pa.RecordBatch.from_arrays([whole.column(whole.schema.get_field_index(text_col)).cast(pa.string())], names=["text"])
            answers = [x for _, raw in slices(iter([texts])) for x in shared.value.predict(raw)]
            keep = [found != UNKNOWN and not ambiguous and (wanted is None or found in wanted) for found, _, ambiguous in answers]
            yield whole.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
