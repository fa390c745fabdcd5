"""Best-fit packing into bins of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import importable
from .common import ids_and_texts
from .tokens import counter_of, pieces

#: Pieces that are packed together; larger groups waste less in their last bins and take longer.
GROUP = 4096
#: What a bin costs besides its length.
BIN_COST = 64


def open_size(length: int, rest: int, sizes: Sequence[int], bin_cost: float) -> int:
    """The bin size to open for a piece: of those that hold it, the one whose cost for each unit it can be expected to be filled with is least.

    What is still to be packed can fill a bin, up to its size; a bin of size c costs c + bin_cost, or what it would be downsized to.
    """
    best = None
    for size in sizes:
        if size < length:
            continue
        fill = max(1, min(size, length + rest))
        final = next(c for c in sizes if c >= fill)
        cost = ((final + bin_cost) / fill, final, size)
        if best is None or cost < best:
            best = cost
    assert best is not None
    return best[2]


def pack(lengths: Sequence[int], sizes: Sequence[int], bin_cost: float = BIN_COST) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Packs pieces, none longer than the largest size: for each piece its bin and offset, and for each bin its size and fill.

    The permitted sizes are tried jointly: for each largest size that may be opened the pieces are packed with all sizes up to it, and
    the packing whose bins cost least, size and bin_cost each, is taken.
    """
    sizes = sorted(sizes)
    tried = [_pack(lengths, sizes[: k + 1], bin_cost) for k, c in enumerate(sizes) if not lengths or c >= max(lengths)]
    return min(tried, key=lambda x: sum(c + bin_cost for c, _ in x[1]))


def _pack(lengths: Sequence[int], sizes: Sequence[int], bin_cost: float) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Best fit: pieces go from long to short into the open bin that they leave the least room in; if none holds one, the bin size of
    least cost is opened.  In the end each bin gets the smallest permitted size that holds its contents.
    """
    room: list[tuple[int, int]] = []  # of open bins, ascending
    fill: list[int] = []
    place: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    rest = sum(lengths)
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        n = lengths[i]
        rest -= n
        at = bisect_left(room, (n, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = open_size(n, rest, sizes, bin_cost), len(fill)
            fill.append(0)
        place[i] = (b, fill[b])
        fill[b] += n
        if left - n > 0:
            insort(room, (left - n, b))
    return place, [(next(c for c in sizes if c >= f), f) for f in fill]


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("bin_id", pa.int64()), ("bin_offset", pa.int64()), ("bin_size", pa.int64()), ("bin_fill", pa.int64())])
_DDL = "doc_id long, piece long, start long, length long, bin_id long, bin_offset long, bin_size long, bin_fill long"


def _packed(sizes: Sequence[int], bin_cost: float, schema: pa.Schema = _SCHEMA):
    """From rows (group, doc_id, piece, start, length, ...), those of a group together: each with its bin; further columns stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def out():
            place, bins = pack([r[3] for r in rows], sizes, bin_cost)
            given = list(zip(*rows))
            columns = [*given[:4], [(now << 24) + b for b, _ in place], [o for _, o in place], [bins[b][0] for b, _ in place], [bins[b][1] for b, _ in place], *given[4:]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for group, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if group != now:
                    if rows:
                        yield out()
                    now, rows = group, []
                rows.append(row)
        if rows:
            yield out()

    return run


def best_fit(docs: DataFrame, length: Column, sizes: Sequence[int], bin_cost: float = BIN_COST, id_col: str = "doc_id", group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, bin_id, bin_offset, bin_size, bin_fill: one row for each piece of each row of `docs`.

    A row longer than the largest permitted size is cut in pieces of that size and a rest; `piece` counts them, `start` is where one
    begins in the row.  A piece has bin_offset to bin_offset + length of its bin; no two pieces of a bin overlap, and bin_size is the
    smallest permitted size that holds them all.  Rows with a null length or one of 0 have one piece of length 0, which takes no room.
    Pieces of equal length go by id, then by piece.  Null ids and repeated rows are packed as any other.  Other columns are ignored; an
    empty table gives an empty result.  In what unit lengths are is the caller's choice; with characters no character is cut.

    Pieces are packed in groups of about `group`, dealt out by a hash of id, piece and copy; only numbers are
    shuffled, and a task holds one group at a time.
    """
    importable(docs.sparkSession)
    if not sizes or min(sizes) < 1:
        raise ValueError("the permitted sizes have to be positive")
    most = max(sizes)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("whole"))
    # equal rows are counted and told apart by number, so that they spread evenly, and in the same way if a task is run again
    rows = rows.groupBy("doc_id", "whole").agg(F.count("*").alias("rows")).select("doc_id", "whole", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"))
    pieces = rows.select("doc_id", "copy", "whole", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("whole") - 1) / most)))).alias("piece"))
    start = F.col("piece") * most
    count = rows.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("whole") / most)))).first()[0] or 0
    at = F.pmod(F.xxhash64("doc_id", "piece", "copy"), F.lit(int(count) // group + 1))
    dealt = pieces.select(at.alias("group"), "doc_id", "piece", start.alias("start"), F.least(F.lit(most), F.col("whole") - start).alias("length"))
    return dealt.repartition("group").sortWithinPartitions("group", F.desc("length"), "doc_id", "piece").mapInArrow(_packed(sorted(sizes), bin_cost), _DDL)


_TEXTS = pa.schema([*_SCHEMA, ("text", pa.string())])
_PIECES = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("text", pa.string())])


def _cut(tokenizer: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(tokenizer)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                rows = [(*r, k, *p) for *r, text in zip(*(c.to_pylist() for c in batch.slice(a, 256).columns)) for k, p in enumerate(pieces(counter, text, most))]
                doc_id, copy, piece, start, text, length = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((doc_id, copy, piece, start, length, text), _PIECES)], schema=_PIECES)

    return run


def best_fit_texts(docs: DataFrame, tokenizer: str, sizes: Sequence[int], bin_cost: float = BIN_COST, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, bin_id, bin_offset, bin_size, bin_fill, text: one row for each piece of each row of `docs`, with its text.

    As best_fit(), but lengths and sizes are tokens of a tokenizers .json file, and a text of more tokens than the largest size is cut
    where that changes no token, in pieces of at most that size; start is in characters.  A row's pieces together are its text; null
    counts as empty, with one piece of length 0.
    """
    if not sizes or min(sizes) < 1:
        raise ValueError("the permitted sizes have to be positive")
    most = max(sizes)
    rows = ids_and_texts(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # about four bytes a token, only to choose the number of groups
    count = rows.agg(F.coalesce(F.sum(1 + F.octet_length("text") / (4 * most)), F.lit(0.0))).first()[0]
    rows = rows.groupBy("doc_id", "text").agg(F.count("*").alias("rows")).select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"), "text")
    cut = rows.mapInArrow(_cut(tokenizer, most), "doc_id long, copy long, piece long, start long, length long, text string")
    at = F.pmod(F.xxhash64("doc_id", "copy", "piece", "text"), F.lit(int(count) // group + 1))
    dealt = cut.select(at.alias("group"), "doc_id", "piece", "start", "length", "text").repartition("group").sortWithinPartitions("group", F.desc("length"), "doc_id", "piece", "text")
    return dealt.mapInArrow(_packed(sorted(sizes), bin_cost, _TEXTS), _DDL + ", text string")
