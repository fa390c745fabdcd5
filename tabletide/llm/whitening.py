"""Principal components of embeddings by block subspace iteration, and the embeddings whitened by them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable

#: Entries are multiplied by SCALE, rounded down and moved by SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Columns of the block for each component asked for; the more, the fewer passes over the data.
OVERSAMPLING = 4
#: When a pass leaves more than this part of the largest residual, the block gets twice as many columns, up to as many as vectors have entries.
SLOW = 0.5
#: A component is certified when its residual is below this part of its distance to the other eigenvalues, or below FLOOR of the largest.
CERTIFIED, FLOOR = 1e-10, 1e-14
#: Components with less than this part of the largest eigenvalue count as having no variance.
NO_VARIANCE = 1e-13
#: Passes after which an iteration that doesn't certify its components gives up.
PASSES = 500
#: Rows multiplied at a time, and partial results that the driver adds up at a time.
ROWS, PARTS = 4096, 64


class NotCertified(Exception):
    """The passes allowed weren't enough for the residuals to certify all components."""


@dataclass(frozen=True)
class Components:
    """Of n vectors with the sums `sums`: unit eigenvectors of their covariance as columns, eigenvalues falling, trace, and passes taken."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    residuals: np.ndarray


def usable(rows: DataFrame, vector_col: str = "embedding", *more) -> DataFrame:
    """The rows whose vector is there, of one length, with no null and no entry that isn't finite, as column `vector` of doubles.

    The length is the one that most vectors without such entries have, the longer one of two that are as frequent; an empty vector is
    of no length.
    """
    vector = rows[vector_col].cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = rows.select(*more, vector.alias("vector")).where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~odd)
    lengths = found.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    return found.where(F.size("vector") == (lengths[0]["length"] if lengths else 0))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """A batch's vectors as whole numbers."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    scaled = np.floor(values * SCALE)
    if len(scaled) and np.abs(scaled).max() > 2.0**52:
        raise ValueError("an entry is too large to be a whole number of 64 bits")
    return scaled.astype(np.int64) + SHIFT


def _added(vectors: DataFrame, of_rows: Callable[[np.ndarray], np.ndarray], kind: str, many: bool) -> np.ndarray | None:
    """The sum over all rows of `of_rows`, which maps a block of them to an array of one shape.  None if there are no rows.

    Each task returns one array; where these are many, other tasks add them up first, so the driver gets PARTS of them at most.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                found = of_rows(_matrix(batch.column(0).slice(at, ROWS)))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"shape": [list(total.shape)], "data": [np.ascontiguousarray(total).tobytes()]}, pa.schema([("shape", pa.list_(pa.int32())), ("data", pa.binary())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shape = None, None
        for batch in batches:
            for shape, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(data, kind)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"shape": [shape], "data": [total.tobytes()]}, batch.schema)

    parts = vectors.select("vector").mapInArrow(each, "shape array<int>, data binary")
    if many:
        parts = parts.repartition(PARTS).mapInArrow(add, "shape array<int>, data binary")
    total = None
    for row in sorted(map(tuple, parts.collect())):
        found = np.frombuffer(row[1], kind).reshape(row[0])
        total = found if total is None else total + found
    return total


def components(vectors: DataFrame, k: int, oversampling: int = OVERSAMPLING, passes: int = PASSES) -> Components | None:
    """The k components of largest variance (all that have some, if these are fewer) of `vectors` as `usable` gives them; None if there are none.

    Each pass multiplies the centred rows by a block of orthonormal columns, and the transposed rows by that, which is the covariance
    times the block; the covariance itself is never made.  Rayleigh-Ritz takes the best vectors that the block holds, whose residuals
    say how far each is from an eigenvector; QR makes the next block.  A flat spectrum converges slowly, so the block then grows.  What
    the driver holds is as large as the block.
    """
    many = vectors.rdd.getNumPartitions() > PARTS
    total = _added(vectors, lambda x: np.concatenate(([len(x)], x.sum(0))), "<i8", many)
    if total is None:
        return None
    n, sums = int(total[0]), total[1:]
    mean, width, random = sums / n, len(sums), np.random.default_rng(0)
    size, worst = min(width, max(1, k * oversampling)), np.inf
    block = np.linalg.qr(random.standard_normal((width, size)))[0]
    for done in range(1, passes + 1):
        # the last column is the sum of squares, for the trace
        image = _added(vectors, lambda x, q=block: np.column_stack(((c := x - mean).T @ (c @ q), (c**2).sum(0))), "<f8", many) / n
        image, trace = image[:, :-1], float(image[:, -1].sum())
        if not trace > 0:
            return Components(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0, done, np.zeros(0))
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, image = block @ turn, image @ turn
        count = min(k, int((values > NO_VARIANCE * values[0]).sum()))
        residuals = np.linalg.norm(image - ritz * values, axis=0)[:count]
        apart = np.abs(values[:count, None] - values[None, :])
        apart[np.arange(count), np.arange(count)] = np.inf
        gap = np.minimum(apart.min(1), values[0])
        if (residuals <= np.maximum(CERTIFIED * gap, FLOOR * values[0])).all():
            break
        before, worst = worst, residuals.max() / values[0]
        if size == width and worst < 1e-12 and worst > before / 2:
            break  # the block holds all directions, and nothing but rounding is left
        grown = min(width, 2 * size) if worst > SLOW * before else size
        block = np.linalg.qr(np.column_stack((image, random.standard_normal((width, grown - size)) * values[0])))[0]
        size = grown
    else:
        raise NotCertified(f"after {passes} passes the largest residual is {worst:.1e} of the largest eigenvalue")
    return Components(n, sums, ritz[:, :count], values[:count], trace, done, residuals)


def identity_error(vectors: DataFrame, found: Components) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, by one more pass."""
    mean, turn = found.sums / found.n, found.vectors / np.sqrt(found.values)

    def of_rows(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ turn
        return np.concatenate((w.T @ w, w.sum(0)[None]))

    total = _added(vectors, of_rows, "<f8", vectors.rdd.getNumPartitions() > PARTS) / found.n
    return float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(len(found.values))).max())


_SCHEMA = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int] | np.ndarray:
    """Of each row the sum of squares of n times it minus the sums; exact."""
    apart = n * x - sums
    if float(np.abs(apart).max(initial=0)) ** 2 * max(1, x.shape[1]) < 2.0**62:
        return (apart**2).sum(1)
    found = [sum(v * v for v in row) for row in apart.tolist()]
    if max(found) >= 1 << 63:
        raise OverflowError("a deviation does not fit in 64 bits")
    return found


def whiten(rows: DataFrame, k: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable row of `rows` and each component.

    Entries become whole numbers, floor(1024 * entry) + 100000; components are those of all usable rows.  Rows without a usable vector
    (see `usable`) give nothing; null and repeated ids are kept as they are, and equal vectors whiten alike.  Components without
    variance are left out, so a table of equal vectors, and an empty one, give no rows.  Of equal eigenvalues the vectors are any
    orthonormal ones of their space, the same for all rows.  A deviation beyond 64 bits, or an entry beyond 2**52 after scaling, is an
    error.  Other columns are ignored.
    """
    importable(rows.sparkSession)
    ids = rows[id_col].cast("long").alias("vec_id")
    vectors = usable(rows, vector_col, ids)
    found = components(vectors, k)
    if found is None or not len(found.values):
        return rows.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    n, sums, mean, turn = found.n, found.sums, found.sums / found.n, found.vectors / np.sqrt(found.values)
    if max(map(abs, sums.tolist())) >= 1 << 62:
        raise OverflowError("sums do not fit in 64 bits")
    explained, error, count = found.values / found.trace, identity_error(vectors, found), len(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x, m = _matrix(part.column(1)), part.num_rows
                each = np.repeat(np.arange(m), count)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)), pa.array(np.full(m * count, n)), pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(each)),
                     pa.array(((x - mean) @ turn).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * count, error))],
                    schema=_SCHEMA,
                )

    return vectors.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
