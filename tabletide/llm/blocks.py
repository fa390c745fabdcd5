"""Rows dealt out as blocks of arrays.

Millions of small records with a hash for a key cost more as table rows than as arrays.  A task gathers records in arrays, deals them
out by key, and writes for each part one row with a block of them; after the shuffle a task joins a part's blocks.

Of a million parts a task's records would make a million small blocks.  So many parts are dealt in two levels: first in ranges of parts,
about as many as the square root of their number; then a task for each range gathers a good many records at a time and deals these to
the range's own parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pack, unpack  # noqa: F401

#: `widths` are the bytes of each column of a block.
SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("widths", pa.binary()), ("block", pa.binary())])
DDL = "part int, kind int, n long, widths binary, block binary"
#: Parts that are dealt in one level, and bytes that a task of the second one gathers before it deals them.
DIRECT, GATHERED = 4096, 64 << 20


class Parts(int):
    """A number of parts, and how many of them make a range of the first level; ranges of one part are dealt in one level."""

    step: int

    def __new__(cls, count: int, step: int | None = None):
        out = super().__new__(cls, count)
        out.step = step or getattr(count, "step", 0) or (1 if count <= DIRECT else math.isqrt(count - 1) + 1)
        return out

    def __reduce__(self):
        return Parts, (int(self), self.step)


def _rows(kind: int, of: np.ndarray, arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row for each value of `of`, with its records."""
    order = np.argsort(of, kind="stable")
    of, arrays = of[order], [x[order] for x in arrays]
    widths = bytes(x.dtype.itemsize for x in arrays)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(of)) + 1, [len(of)])).tolist()
    for i in range(0, len(cuts) - 1, 512):
        rows = [(int(of[a]), kind, b - a, widths, pack(*(x[a:b] for x in arrays))) for a, b in zip(cuts[i : i + 512], cuts[i + 1 : i + 513])]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)


def dealt(kind: int, part: np.ndarray, *arrays: np.ndarray, parts: int = 1) -> Iterator[pa.RecordBatch]:
    """Blocks of the records, a row for each part that has some, or for each range of parts, in which each record keeps its part."""
    if not len(part):
        return
    step = getattr(parts, "step", 1)
    yield from _rows(kind, part, list(arrays)) if step == 1 else _rows(kind, part // step, [part.astype(np.int32), *arrays])


def _dealt_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The second level: a range's blocks, some at a time, by part."""
    held: dict[tuple[int, bytes], list[list[np.ndarray]]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (kind, _), found in held.items():
            part, *arrays = (np.concatenate(x) for x in zip(*found))
            yield from _rows(kind, part, arrays)
        held.clear()

    for batch in batches:
        for kind, n, widths, block in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4))):
            # what the columns hold is of no account here
            held.setdefault((kind, widths), []).append(unpack(block, n, np.int32, *(f"V{w}" for w in widths[1:])))
            size += len(block)
            if size > GATHERED:
                yield from out()
                size = 0
    yield from out()


def gathered(batches: Iterator[pa.RecordBatch], types: dict[int, tuple]) -> dict[int, list[np.ndarray]]:
    """A task's records of each kind, with these types of columns."""
    found: dict[int, list[list[np.ndarray]]] = {k: [] for k in types}
    for batch in batches:
        for kind, n, block in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(4).to_pylist()):
            found[kind].append(unpack(block, n, *types[kind]))
    return {k: [np.concatenate(x) for x in zip(*found[k])] if found[k] else [np.zeros(0, t) for t in types[k]] for k in types}


def by_part(blocks: DataFrame, parts: int) -> DataFrame:
    """The blocks in `parts` partitions, each part's in its own."""
    step = getattr(parts, "step", 1)
    if step > 1:
        blocks = blocks.repartitionById(-(-int(parts) // step), F.col("part")).mapInArrow(_dealt_again, DDL)
    return blocks.repartitionById(int(parts), F.col("part"))
