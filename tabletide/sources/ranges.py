"""CSV files whose cells hold line breaks, read by many tasks.

Spark cuts a file in ranges and gives each task the lines that begin in its own; what it cannot know is whether a line begins a record
or goes on in a quoted cell.  At the beginning of a line there are just these two states, so each line is a function of two states, of
which an expression tells both results; a range's lines compose to one such function, and the ranges' functions, in order, tell in which
state each range begins.  A second pass puts lines together to records.  What a range has of a record that begins before it, or ends
after it, is put together by one more step, which sees those parts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import importable

#: One cell and the comma after it: quoted, with whatever follows the closing quote, or not.  Possessive, so no line is tried twice.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+,|[^",][^,]*+,|,)*+'
#: A quoted cell that no quote closes on this line.
_OPEN = r'"[^"]*+(?:""[^"]*+)*+\z'
#: What a line leaves open, if it begins a record, and if it goes on in a quoted cell.
OPENS = f"^{_CELL}{_OPEN}"
STAYS_OPEN = rf'^[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,{_CELL}{_OPEN})'

#: A row of the second pass is a whole record, or the part of one that stands at a range's beginning or end.
RECORD, HEAD, TAIL = 0, 1, 2
_PARTS = pa.schema([("part", pa.int32()), ("record", pa.binary()), ("row", pa.int64()), ("path", pa.string()), ("start", pa.int64())])
_DDL = "part int, record binary, row long, path string, start long"


def _lines(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    """Lines, with the two results each, and the file and first byte of the range they were read from."""
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    line, quoted = F.col("value"), F.contains("value", F.lit('"'))

    def after(state: bool, expression: str) -> Column:
        return F.when(quoted, line.rlike(f"(?s){expression}")).otherwise(F.lit(state))

    return reader.text(path).select(
        line.cast("binary").alias("line"), after(False, OPENS).alias("opens"), after(True, STAYS_OPEN).alias("stays"),
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
    )


def states(opens: np.ndarray, stays: np.ndarray, begin: bool) -> np.ndarray:
    """Whether each line begins in a quoted cell, and one more for after the last.

    A line that leaves the same state whatever it begins in decides what follows; other lines keep the state or change it.
    """
    fixed, swaps = opens == stays, np.concatenate(([0], np.cumsum(opens & ~stays)))
    last = np.maximum.accumulate(np.concatenate(([0], np.where(fixed, np.arange(1, len(opens) + 1), 0))))
    since = np.where(last > 0, np.concatenate(([begin], opens))[last], begin)
    return since ^ ((swaps - swaps[last]) % 2 == 1)


def _ranges(lines: DataFrame) -> DataFrame:
    """path, start, first, opens, stays: a row for each range that has lines; how many they are, and their function of two states."""
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("n", pa.int64()), ("opens", pa.bool_()), ("stays", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            for (path, start), rows in _by_range(batch, 2):
                opens, stays = (rows.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                n, a, b = found.get((path, start), (0, False, True))
                found[path, start] = [n + len(opens), bool(states(opens, stays, a)[-1]), bool(states(opens, stays, b)[-1])]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*((*k, *v) for k, v in found.items())), schema)], schema=schema)

    return lines.select("opens", "stays", "path", "start").mapInArrow(run, "path string, start long, n long, opens boolean, stays boolean")


def _by_range(batch: pa.RecordBatch, at: int) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The runs of rows of a batch that come from one range each; its path and start are the columns from `at` on."""
    if not batch.num_rows:
        return
    path, start = batch.column(at).dictionary_encode(), batch.column(at + 1).to_numpy()
    which = path.indices.to_numpy()
    cuts = [0, *(np.flatnonzero((np.diff(start) != 0) | (np.diff(which) != 0)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield (path.dictionary[int(which[a])].as_py(), int(start[a])), batch.slice(a, b - a)


def _begun(ranges: DataFrame) -> DataFrame:
    """path, start, quoted, row: whether a range begins in a quoted cell, and how many lines the file has before it."""
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # as with lines: the last range with one result for both states, and how often the state has changed since
    fixed = F.col("opens") == F.col("stays")
    out = ranges.withColumn("at", F.row_number().over(order)).withColumn("swaps", F.sum((F.col("opens") & ~F.col("stays")).cast("int")).over(order))
    last = F.last(F.when(fixed, F.struct("opens", "swaps")), ignorenulls=True).over(before)
    swapped = F.coalesce(F.last("swaps").over(before), F.lit(0))
    quoted = (F.coalesce(last["opens"], F.lit(False)).cast("int") + swapped - F.coalesce(last["swaps"], F.lit(0))) % 2 == 1
    return out.select("path", "start", quoted.alias("quoted"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row"))


def _joined(lines: pa.BinaryArray, firsts: np.ndarray) -> pa.BinaryArray:
    """Records from consecutive lines, of which `firsts` begin one; the lines of a record with the line breaks between them."""
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inner = np.ones(len(lines), bool)
    inner[firsts] = False
    breaks = np.flatnonzero(inner)
    data = np.insert(data, offsets[breaks], 10)
    moved = offsets + np.concatenate(([0], np.cumsum(inner)))
    # a record's last byte is before the line break that its successor doesn't have
    return pa.Array.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer(np.append(moved[firsts], len(data)).astype(np.int32)), pa.py_buffer(data)])


def _records(lines: DataFrame, whole: bool) -> DataFrame:
    """Whole records, or parts of records, with the number of their first line in the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of the range that is being read: its key, the lines of the record that is open, whether these began before it, its first line, lines so far
        key, held, head, first, row, quoted = None, [], False, 0, 0, False

        def out(part: int, records: pa.Array, rows: np.ndarray) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), records, pa.array(rows, pa.int64()), pa.array([key[0]] * n, pa.string()), pa.array(np.full(n, key[1]))], schema=_PARTS)

        def close() -> Iterator[pa.RecordBatch]:
            part = HEAD if head else TAIL if quoted else RECORD
            if held and whole == (part == RECORD):
                yield out(part, pa.array([b"\n".join(held)], pa.binary()), np.array([first]))

        for batch in batches:
            for found, rows in _by_range(batch, 3):
                if found != key:
                    yield from close()
                    key, held, row = found, [], int(rows.column(6)[0].as_py())
                    quoted = head = bool(rows.column(5)[0].as_py())
                    first = row
                line = rows.column(0)
                state = states(rows.column(1).to_numpy(zero_copy_only=False), rows.column(2).to_numpy(zero_copy_only=False), quoted)
                firsts = np.flatnonzero(~state[:-1])
                if len(firsts):
                    held += line.slice(0, int(firsts[0])).to_pylist()
                    if held or head:  # what was open ends before the first record of these lines
                        quoted = False
                        yield from close()
                        held, head = [], False
                    last = int(firsts[-1])
                    if whole and last > int(firsts[0]):
                        yield out(RECORD, _joined(line.slice(int(firsts[0]), last - int(firsts[0])), firsts[:-1] - firsts[0]), row + firsts[:-1])
                    held, first = line.slice(last).to_pylist(), row + last
                else:
                    held += line.to_pylist()
                row += len(line)
                quoted = bool(state[-1])
        yield from close()

    return lines.mapInArrow(run, _DDL)


def records(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """record, row, path: the records of the CSV files at a path as they stand in them, without the line break at their end.

    `row` is the number of the record's first line in its file, from 0.  Rows for ranges are broadcast, one for each; a range is as
    large as spark.sql.files.maxPartitionBytes.  A file that ends in an open quote has its rest as a last record.  Records that lie in
    one range come in the file's order, those of several ranges after them.
    """
    importable(spark)
    lines = _lines(spark, path, pattern)
    begun = _begun(_ranges(lines))
    placed = lines.join(F.broadcast(begun), ["path", "start"]).select("line", "opens", "stays", "path", "start", "quoted", "row")
    # a record's parts follow one another: the end of a range, then beginnings of ranges, until another end
    order = Window.partitionBy("path").orderBy("start", "part")
    straddling = _records(placed, False).withColumn("of", F.sum(F.when(F.col("part") == TAIL, 1).otherwise(0)).over(order))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("start", "part", "record"))), lambda x: x["record"].cast("string"))
    again = straddling.groupBy("path", "of").agg(F.array_join(pieces, "\n").cast("binary").alias("record"), F.min("row").alias("row"))
    return _records(placed, True).select("record", "row", "path").unionByName(again.select("record", "row", "path"))


def _parsed(spark: SparkSession, path: str, names: list[str], pattern: str | None, options: dict | None) -> DataFrame:
    """cells, row, path: the records that aren't empty, headers too."""
    kind = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    text = F.regexp_replace(F.col("record").cast("string"), r"\r\z", "")
    found = records(spark, path, pattern).where(~F.col("record").isin(b"", b"\r"))
    return found.select(F.from_csv(text, kind, (options or {}) | {"multiLine": "true", "mode": "FAILFAST"}).alias("cells"), "row", "path")


def cells(spark: SparkSession, path: str, names: list[str], pattern: str | None = None, options: dict | None = None) -> DataFrame:
    """The cells of the files' records, as texts under `names`, and their file as `__path`.  Each file's first record has to be the names."""
    rows = _parsed(spark, path, names, pattern, options)
    found = F.array(*[F.coalesce(F.col("cells")[n], F.lit("")) for n in names])
    wanted = F.array(*[F.lit(n) for n in names])
    wrong = F.concat(F.lit("the columns of "), F.col("path"), F.lit(" are "), F.array_join(found, ", "), F.lit(", but the schema has "), F.array_join(wanted, ", "))
    rows = rows.where(F.when(F.col("row") == 0, F.assert_true(found == wanted, wrong).isNotNull()).otherwise(F.lit(True)))
    return rows.select(*[F.col("cells")[n].alias(n) for n in names], F.col("path").alias("__path"))


def located(spark: SparkSession, path: str, names: list[str], name: str, cell: str, pattern: str | None = None, options: dict | None = None) -> tuple[str, int, int] | None:
    """Where a cell stands first in a column: file, line, and record, both from 1, the header's record not counted; None if nowhere."""
    rows = _parsed(spark, path, names, pattern, options).where("row > 0")
    first = rows.where(F.coalesce(F.col("cells")[name], F.lit("")) == cell).agg(F.min(F.struct("path", "row")).alias("first")).first()["first"]
    if first is None:
        return None
    return first["path"], first["row"] + 1, rows.where((F.col("path") == first["path"]) & (F.col("row") <= first["row"])).count()
