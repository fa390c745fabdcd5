"""CSV and JSON Lines files: scans, and sinks of one file, of a folder, or of standard output."""

from __future__ import annotations

import ast
import re
import sys
import uuid
from fnmatch import fnmatch
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TideError
from ..functions import decode, encode
from ..operators import shape
from ..operators.rows import check_header, decoded, encoded
from ..schema import TEXT, Column, Schema, Table
from . import ranges
from .arguments import IfExists
from .storage import Files

#: Formats by extension.
FORMATS = {"csv": "csv", "jsonl": "jsonl"}
#: How CSV is written: doubled quotes, empty cells for null and for empty text, white space as it is.
CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "encoding": "UTF-8"}

#: How it is read.
CELLS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

#: The folders that a write by stream makes; names that begin with _ are hidden.
BY = "tide-stream"


def extension(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[1].lower() if "." in name else ""


def format_of(ext: str, given: str | None) -> str:
    """The format that was asked for, or that goes with the extension; CSV if there is none."""
    found = given or FORMATS.get(ext, ext or "csv")
    if found not in FORMATS.values():
        raise TideError(f"cannot read or write the format {found!r}; there are csv and jsonl")
    return found


def common_extension(paths: Iterable[str]) -> str:
    found = {extension(p) for p in paths}
    if not found:
        raise TideError("there is no file to read")
    if len(found) > 1:
        raise TideError(f"the files have several extensions: {', '.join(sorted(found))}")
    return found.pop()


def text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_cells(spark: SparkSession, path: str, schema: Schema, kind: str, one_line: bool = False, pattern: str | None = None, ranged: bool = False) -> DataFrame:
    """Interchange cells, all text, of the files at a path, with __stream.

    CSV headers have to be the schema's names in order, in each file.  With `one_line` no cell holds a line break, and files are split as
    they are; otherwise files larger than a task's share are read in ranges, see ranges, and smaller ones each by one task, unless
    `ranged` asks for ranges: Spark's reader of whole files takes line ends of two bytes for ones of one byte, in cells too.
    """
    there = Files(spark, path)
    is_folder = there.is_folder()
    reader = spark.read.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if kind == "csv":
        names = [c.name for c in schema.table.columns]
        options = CELLS
        share = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        if not one_line and (ranged or any(n > share for p, n in there.listed() if pattern is None or fnmatch(p.rsplit("/", 1)[-1], pattern))):
            df = ranges.cells(spark, path, names, pattern, _texts(options))
            return shape.with_stream(df, path, is_folder, file="__path").drop("__path")
        # enforceSchema off: each file's own reader compares its header with the names, so there is no pass for that
        df = reader.options(**options, multiLine=not one_line, mode="FAILFAST", header=True, enforceSchema=False).schema(text_schema(names)).csv(path)
        return shape.with_stream(df, path, is_folder)
    lines = reader.text(path).withColumnRenamed("value", "__line")
    lines = shape.with_stream(lines, path, is_folder).where(F.length(F.trim("__line")) > 0)
    return lines.select(*decode.from_json_text(schema, F.col("__line")), "__stream")


def _texts(options: dict) -> dict[str, str]:
    return {k: str(v).lower() for k, v in options.items()}


#: The errors that name a column and a cell.
_READ, _NULL = re.compile(r"column ('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"): cannot read \"(.*?)\" as ", re.S), re.compile(r"unexpected NULL value in column ('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")")


def with_place(spark: SparkSession, path: str, schema: Schema, error: Exception) -> Exception:
    """An error about a cell of CSV files, with the cell's file, line and record; any other error as it is.

    Only now are the records counted, in ranges, by as many tasks as read them; a copy that goes well doesn't number its rows.
    """
    text = str(error)
    found = _READ.search(text) or _NULL.search(text)
    name = found and ast.literal_eval(found[1])
    names = [c.name for c in schema.table.columns]
    if found is None or name not in names:
        return error
    place = ranges.located(spark, path, names, name, found[2] if found.re is _READ else "", options=_texts(CELLS))
    if place is None:
        return error
    what = text[found.start() :].split("\n", 1)[0] if found.re is _NULL else f"{found[0]}{text[found.end() :].split(' SQLSTATE', 1)[0].split(chr(10), 1)[0]}"
    return TideError(f"{place[0]}, line {place[1]}, record {place[2]}: {what}")


def header(spark: SparkSession, path: str, pattern: str | None = None) -> list[str] | None:
    """The header of the first CSV file at a path that isn't empty: its first record, as text."""
    found = _top(spark, path, pattern)
    return found and found[0]


def _top(spark: SparkSession, path: str, pattern: str | None) -> tuple[list[str], bool] | None:
    """A header, and whether its line ends in two bytes."""
    import csv
    import io

    file = next((p for p, n in Files(spark, path).listed() if n and (pattern is None or fnmatch(p.rsplit("/", 1)[-1], pattern))), None)
    if file is None:
        return None
    lines, n = spark.read.option("lineSep", "\n").text(file), 64
    while True:
        top = [r[0] for r in lines.limit(n).collect()]
        found = io.StringIO("\n".join(top))
        names = next(csv.reader(found))
        if len(top) < n or found.tell() < len(found.getvalue()) - 1:  # the record ends before what was read does
            return names, top[0].endswith("\r")
        n *= 4


def header_schema(spark: SparkSession, path: str) -> Schema:
    """All columns of a CSV file as texts that may be null."""
    if Files(spark, path).is_folder():
        raise TideError(f"cannot tell the schema of the folder {path}")
    if format_of(extension(path), None) != "csv":
        raise TideError(f"only CSV files tell their columns, which {path} is not")
    found = header(spark, path)
    if not found:
        raise TideError(f"{path} has no header")
    return Schema(Table(path.rsplit("/", 1)[-1].split(".", 1)[0], tuple(Column(n, TEXT) for n in found)))


def scan(spark: SparkSession, path: str, schema: Schema, kind: str | None = None, one_line: bool = False, pattern: str | None = None) -> DataFrame:
    """Typed rows of the files at a path, of those whose names match the pattern, with __stream."""
    files = Files(spark, path)
    if not files.exists():
        raise TideError(f"{path} does not exist")
    kind = format_of(common_extension(p for p, _ in files.listed() if pattern is None or fnmatch(p.rsplit("/", 1)[-1], pattern)), kind)
    found = _top(spark, path, pattern) if kind == "csv" else None
    if found:
        check_header(found[0], schema)  # the other files' headers are compared as they are read
    cells = read_cells(spark, path, schema, kind, one_line, pattern, ranged=bool(found) and found[1])
    typed = decoded(cells, schema)
    fields = [decode.column(schema, c, F.col(f"`{c.name.replace('`', '``')}`")).cast(f.dataType).alias(c.name, metadata=f.metadata) for c, f in zip(schema.table.columns, typed.schema.fields)]
    return cells.select(*fields, "__stream")


def _cells_to_write(df: DataFrame, schema: Schema, kind: str) -> DataFrame:
    data = df.drop("__stream", "__chunk")
    more = [F.col(c) for c in ("__stream", "__chunk") if c in df.columns]
    check_header(data.columns, schema)
    if kind == "csv":
        return df.select(*encode.columns(schema), *more)
    return df.select(encode.json_line(schema).alias("value"), *more)


def _save(df: DataFrame, kind: str, path: str, by: str | None = None) -> None:
    writer = df.write.mode("errorifexists")
    if by:
        writer = writer.partitionBy(by)
    writer.options(**CSV).csv(path) if kind == "csv" else writer.text(path)


def write_file(df: DataFrame, schema: Schema, path: str, kind: str, if_exists: IfExists) -> list[str]:
    """One file with all rows: a single task writes it, as one file has one writer."""
    target = Files(df.sparkSession, path)
    if target.exists() and if_exists.mode == "error":
        raise TideError(f"{path} exists")
    staging = f"{path}.{uuid.uuid4().hex[:10]}"
    _save(_cells_to_write(df, schema, kind).drop("__stream", "__chunk").coalesce(1), kind, staging)
    parts = sorted(p for p, _ in Files(df.sparkSession, staging).listed())
    if not parts:  # no rows: the header alone
        import csv
        import io

        text = io.StringIO()
        csv.writer(text, lineterminator="\n").writerow([c.name for c in schema.table.columns])
        Files(df.sparkSession, staging + "/part-0").write(text.getvalue() if kind == "csv" else "", True)
        parts = [staging + "/part-0"]
    target.replace([(parts[0], path)])
    Files(df.sparkSession, staging).delete()
    return [path]


def write_folder(df: DataFrame, schema: Schema, path: str, kind: str, if_exists: IfExists, stream: str, stream_size: int | None = None) -> list[str]:
    """A folder of files named after their streams, or after chunks of about `stream_size` bytes.

    Rows without streams of their own make one named `stream`; if several tasks write a stream, its files are numbered.
    """
    spark = df.sparkSession
    target = Files(spark, path)
    folder = path.rstrip("/")
    if target.exists() and if_exists.mode == "error" and next(target.listed(), None):
        raise TideError(f"{path} exists")
    if target.exists() and if_exists.mode not in ("error", "overwrite"):
        raise TideError(f"files cannot be written with --if-exists={if_exists}")
    staging = f"{folder}.{uuid.uuid4().hex[:10]}"
    cells = _cells_to_write(df, schema, kind)
    if stream_size:
        data = cells.drop("__stream", "__chunk")
        cells = shape.rechunk(data, stream_size, "__chunk").withColumn(BY, F.format_string("chunk_%04d", F.col("__chunk"))).drop("__chunk")
        _save(cells.repartition(BY), kind, staging, BY)
    elif "__stream" in cells.columns:
        # each task writes what it read, so a large stream has several writers, and several numbered files
        _save(cells.withColumnRenamed("__stream", BY), kind, staging, BY)
    else:
        _save(cells, kind, staging)
    parts = sorted(p for p, _ in Files(spark, staging).listed())
    names: dict[str, list[str]] = {}
    for p in parts:
        inner = p.rsplit(BY + "=", 1)
        names.setdefault(_unescaped(inner[1].rsplit("/", 1)[0]) if len(inner) > 1 else stream, []).append(p)
    moves = []
    for name, own in names.items():
        if any(part in ("..", "") for part in name.split("/")):
            raise TideError(f"a stream cannot have the name {name!r}")
        for i, p in enumerate(own):
            place = f"{folder}/{name}{f'_{i + 1:04d}' if len(own) > 1 else ''}.{kind}"
            moves.append((p, place))
    target.replace(moves)
    Files(spark, staging).delete()
    return [place for _, place in moves]


def _unescaped(name: str) -> str:
    from urllib.parse import unquote

    return "" if name == "__HIVE_DEFAULT_PARTITION__" else unquote(name)


def print_rows(df: DataFrame, schema: Schema, kind: str, out=None) -> None:
    """All rows to standard output, a partition at a time."""
    import csv

    out = out or sys.stdout
    cells = _cells_to_write(df, schema, kind).drop("__stream", "__chunk")
    if kind == "csv":
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(cells.columns)
        for row in cells.toLocalIterator():
            writer.writerow(["" if x is None else x for x in row])
    else:
        for row in cells.toLocalIterator():
            out.write(row[0] + "\n")


__all__ = ["decoded", "encoded", "format_of", "header_schema", "print_rows", "scan", "write_file", "write_folder"]
