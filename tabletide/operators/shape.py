"""The shape of streams of rows: their names, their number and their sizes."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import TideError
from ..session import checkpointed
from . import boundaries


def stream_name(base: str, path: str) -> str:
    """The name of a file's stream: its path under a directory, or its own name if it is the base, up to the first dot."""
    if path == base:
        relative = path.rsplit("/", 1)[-1]
    else:
        folder = base if base.endswith("/") else base + "/"
        if not path.startswith(folder):
            raise TideError(f"{path} is not in {base}")
        relative = path[len(folder) :]
    return relative.split(".", 1)[0]


def with_stream(df: DataFrame, base: str, is_folder: bool, name: str = "__stream", file: str = "_metadata.file_path") -> DataFrame:
    """A file scan with stream_name() of each row's input file, which is in the column `file`."""
    path = F.url_decode(F.regexp_replace(F.col(file), r"\+", "%2B"))
    path = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*(?=/))?", "")
    top = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*(?=/))?", "", base).rstrip("/")
    relative = F.substring(path, F.lit(len(top) + 2), F.length(path)) if is_folder else F.element_at(F.split(path, "/"), -1)
    return df.withColumn(name, F.substring_index(relative, ".", 1))


def concatenate(*streams: DataFrame) -> DataFrame:
    """All rows of streams with equal headers, in turn."""
    first = streams[0]
    for s in streams[1:]:
        if s.columns != first.columns:
            raise TideError(f"streams with different headers: {first.columns} and {s.columns}")
        first = first.union(s)
    return first


def cell_bytes(cells: Sequence[Column]) -> Column:
    """The bytes that a row of these texts takes as CSV, with its separators, its line break and the quotes that cells need."""
    total = F.lit(len(cells))
    for cell in cells:
        quotes = F.octet_length(cell) - F.octet_length(F.replace(cell, F.lit('"')))
        total = total + F.coalesce(F.octet_length(cell) + F.when(cell.rlike('[",\r\n]'), 2 + quotes).otherwise(0), F.lit(0))
    return total.cast("long")


def row_bytes(df: DataFrame) -> Column:
    """cell_bytes() of all columns."""
    return cell_bytes([F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


#: Fixed value: bytes that a writer of chunks holds back at most before it counts them.
BUFFER = 8 << 10


def rechunk(df: DataFrame, size: int, name: str = "__chunk") -> DataFrame:
    """`df`, which has texts only, with the number of the chunk that each row goes to, from 1 without gaps.

    A chunk begins with a header and ends with the row that takes it beyond `size` bytes; these are counted in whole buffers, so a size
    of more than BUFFER counts as the next multiple of it.  Rows keep their order.  Chunks are found without one task that reads all
    rows, see boundaries; partitions add up their rows' bytes in one pass, and number their rows in another.  Rows that come from a
    shuffle, whose order another run may change, are written to the shared folder first.
    """
    if size < 1:
        raise TideError("a stream's size has to be positive")
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        df = checkpointed(df)
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerow(df.columns)
    header, buffer = len(text.getvalue().encode()), min(BUFFER, size)
    limit = -(-size // buffer) * buffer
    held = df.withColumn("__bytes", row_bytes(df))
    begin = boundaries.beginnings(held.select("__bytes"), df.rdd.getNumPartitions(), limit, header)
    return boundaries.numbered(held, "__bytes", begin, limit, header, name)


def bounded(df: DataFrame, streams: int) -> DataFrame:
    """At most so many partitions, and so tasks, at a time."""
    return df.coalesce(streams)
