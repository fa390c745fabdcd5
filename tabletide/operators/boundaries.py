"""Where chunks of a stream end, found in parallel: a scan over functions of how full a chunk is.

A chunk ends with the row that takes it beyond its limit, so each chunk's beginning follows from the one before it.  What a run of rows
does depends on one number only, the bytes that the chunk they come into holds already: below some fullness all rows still fit in it,
above it one of the rows ends it.  So a run is a step function, Run, from the fullness at its beginning to the fullness at its end and
the number of chunks that ended; two neighbouring runs compose to one.  Within a run, each row points to the row after the chunk that
would begin with it, by binary search on the running sum of bytes, and following pointers by doubling gives the ends of all chains.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, importable

#: Runs that are composed by one task; more of them are composed in levels.
FAN_IN = 256
_I8 = np.dtype("<i8")


@dataclass(frozen=True)
class Run:
    """Rows with `total` bytes.  A chunk with more than low[k] bytes, and at most low[k + 1], comes out of them with after[k] bytes, and ended[k] chunks end; one with at most low[0] takes in all."""

    total: int
    low: np.ndarray
    after: np.ndarray
    ended: np.ndarray

    def __call__(self, full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fullness after the run, and how many chunks ended in it."""
        at = np.searchsorted(self.low, full, "left") - 1
        if not len(self.low):
            return full + self.total, np.zeros(len(full), _I8)
        fits = at < 0
        return np.where(fits, full + self.total, self.after[at]), np.where(fits, 0, self.ended[at])

    def to_bytes(self) -> bytes:
        return b"".join(np.ascontiguousarray(x, _I8).tobytes() for x in (np.array([self.total]), self.low, self.after, self.ended))

    @classmethod
    def from_bytes(cls, data: bytes) -> Run:
        x = np.frombuffer(data, _I8)
        low, after, ended = x[1:].reshape(3, -1)
        return cls(int(x[0]), low, after, ended)


def _steps(total: int, low: np.ndarray, after: np.ndarray, ended: np.ndarray, header: int) -> Run:
    """A run without steps that no chunk, which holds its header at least, can reach, nor steps that change nothing."""
    first = max(0, int(np.searchsorted(low, header, "left")) - 1)
    low, after, ended = low[first:], after[first:], ended[first:]
    if len(low):
        new = np.concatenate(([True], (after[1:] != after[:-1]) | (ended[1:] != ended[:-1])))
        low, after, ended = low[new], after[new], ended[new]
    return Run(total, low, after, ended)


def run_of(sizes: np.ndarray, limit: int, header: int) -> Run:
    """What rows of these sizes do."""
    sums = np.concatenate(([0], np.cumsum(sizes, dtype=_I8)))
    n, total = len(sizes), int(sums[-1])
    # of a chunk that begins with row i: the row after it, or n + 1 if it does not end here
    to = np.maximum(np.searchsorted(sums[1:], limit - header + sums[:-1], "right"), np.arange(n)) + 1
    to = np.concatenate((to, [n + 1, n + 1]))
    # the last row that a chain reaches, and in how many steps: pointers are doubled until none leads on
    step, many = np.where(to <= n, to, np.arange(n + 2)), (to <= n).astype(_I8)
    while True:
        further = step[step]
        if (further == step).all():
            break
        many = many + many[step]
        step = further
    after, ended = header + total - sums[np.minimum(step, n)], many
    # a chunk that comes in with more than limit - sums[j + 1] bytes ends with row j, unless an earlier one ends it
    ends = np.arange(min(n, int(np.searchsorted(sums[1:], limit - header, "right")) + 1))[::-1]
    return _steps(total, limit - sums[ends + 1], after[ends + 1], ended[ends + 1] + 1, header)


def composed(first: Run, then: Run, header: int) -> Run:
    """What two runs do one after the other."""
    low = then.low - first.total
    keep = low < first.low[0] if len(first.low) else np.ones(len(low), bool)
    after, ended = then(first.after)
    return _steps(
        first.total + then.total, np.concatenate((low[keep], first.low)), np.concatenate((then.after[keep], after)), np.concatenate((then.ended[keep], first.ended + ended)), header
    )


_RUNS, _RUNS_DDL = pa.schema([("at", pa.int64()), ("run", pa.binary())]), "at long, run binary"


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _runs(sizes: DataFrame, limit: int, header: int) -> DataFrame:
    """A row for each partition that has rows: its number and its run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b.column(0).to_numpy() for b in batches]
        if found:
            yield pa.RecordBatch.from_pydict({"at": [_partition()], "run": [run_of(np.concatenate(found), limit, header).to_bytes()]}, _RUNS)

    return sizes.mapInArrow(run, _RUNS_DDL)


def _in_order(table: pa.Table) -> tuple[list[int], list[Run]]:
    rows = sorted(zip(table.column("at").to_pylist(), table.column("run").to_pylist()))
    return [at for at, _ in rows], [Run.from_bytes(x) for _, x in rows]


def _beginnings(runs: Sequence[Run], full: int, number: int) -> list[tuple[int, int]]:
    """Fullness and chunk number where each run begins."""
    out = []
    for run in runs:
        out.append((full, number))
        after, ended = run(np.array([full]))
        full, number = int(after[0]), number + int(ended[0])
    return out


_PLACES = pa.schema([("at", pa.int64()), ("full", pa.int64()), ("number", pa.int64())])


def _placing(begin: dict[int, tuple[int, int]], fan_in: int) -> Callable[[pa.Table], pa.Table]:
    def place(table: pa.Table) -> pa.Table:
        at, runs = _in_order(table)
        found = _beginnings(runs, *begin[at[0] // fan_in])
        return pa.table({"at": at, "full": [x for x, _ in found], "number": [x for _, x in found]}, _PLACES)

    return place


def beginnings(sizes: DataFrame, partitions: int, limit: int, header: int, fan_in: int = FAN_IN) -> dict[int, tuple[int, int]]:
    """For each partition of `sizes`, of one column of bytes, that has rows: how full the chunk is that its rows come into, and its number, from 1.

    Runs of up to `fan_in` neighbours are composed by a task each, level by level, until one task has them all; then each level's runs
    learn where they begin.  The result is two numbers for each partition.
    """
    importable(sizes.sparkSession)
    levels, width = [checkpointed(_runs(sizes, limit, header))], partitions

    def compose(table: pa.Table) -> pa.Table:
        at, runs = _in_order(table)
        whole = runs[0]
        for run in runs[1:]:
            whole = composed(whole, run, header)
        return pa.table({"at": [at[0] // fan_in], "run": [whole.to_bytes()]}, _RUNS)

    while width > fan_in:
        levels.append(checkpointed(levels[-1].groupBy(F.floor(F.col("at") / fan_in)).applyInArrow(compose, _RUNS_DDL)))
        width = -(-width // fan_in)
    known = {0: (header, 1)}
    for level in reversed(levels):
        placed = level.groupBy(F.floor(F.col("at") / fan_in)).applyInArrow(_placing(known, fan_in), "at long, full long, number long")
        known = {r["at"]: (r["full"], r["number"]) for r in placed.collect()}
    return known


def numbers(sizes: np.ndarray, full: int, number: int, limit: int, header: int) -> tuple[np.ndarray, int, int]:
    """The chunk of each of these rows, which come into chunk `number` that is so full; fullness and chunk after them."""
    sums, out, at = np.cumsum(sizes, dtype=_I8), np.empty(len(sizes), _I8), 0
    while at < len(sizes):
        before = int(sums[at - 1]) if at else 0
        end = max(at, int(np.searchsorted(sums, limit - full + before, "right")))
        out[at : end + 1] = number
        if end >= len(sizes):
            return out, full + int(sums[-1]) - before, number
        at, full, number = end + 1, header, number + 1
    return out, full, number


def numbered(rows: DataFrame, size_col: str, begin: dict[int, tuple[int, int]], limit: int, header: int, name: str) -> DataFrame:
    """`rows`, whose partitions are those that `begin` is for, with their chunks' numbers in place of the column of bytes."""
    at = rows.columns.index(size_col)
    where = rows.sparkSession.sparkContext.broadcast(begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, number = where.value.get(_partition(), (header, 1))
        for batch in batches:
            found, full, number = numbers(batch.column(at).to_numpy(), full, number, limit, header)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *batch.columns[at + 1 :], pa.array(found.astype(np.int32))], names=[*[n for n in batch.schema.names if n != size_col], name])

    return rows.mapInArrow(run, rows.drop(size_col).withColumn(name, F.lit(None).cast("int")).schema)
