"""The three things to do with locators: copy data, count rows, convert schemas."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import TideError
from ..functions import encode
from ..operators.shape import bounded, cell_bytes
from ..schema import Schema
from ..sources import files, locators
from ..sources.storage import Files
from ..sources.arguments import DestinationArguments, IfExists, SourceArguments, parse


def prepare(spark: SparkSession) -> None:
    """Settings that interchange needs: timestamps at UTC, names told apart by case, errors for what cannot be."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.caseSensitive", "true")
    spark.conf.set("spark.sql.ansi.enabled", "true")


@contextmanager
def prepared(spark: SparkSession) -> Iterator[None]:
    """prepare() for a while: the session's own settings come back."""
    names = ("spark.sql.session.timeZone", "spark.sql.caseSensitive", "spark.sql.ansi.enabled")
    before = {n: spark.conf.get(n) for n in names}
    prepare(spark)
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def _schema(spark: SparkSession, source: locators.Locator, given: str | None, a: SourceArguments, unstable: bool) -> Schema:
    at = locators.parse(given, unstable) if given else source
    found = at.schema(spark, SourceArguments() if given else a)
    if found is None:
        raise TideError(f"don't know how to read a schema from {at}")
    return found


def stage(spark: SparkSession, temporary: Iterable[str]) -> None:
    """Tells the connectors where they may stage data."""
    for place in temporary:
        scheme = place.split(":", 1)[0]
        if scheme == "gs":
            spark.conf.set("temporaryGcsBucket", place[len("gs://") :].split("/", 1)[0])
        elif scheme != "s3":  # see staged
            raise TideError(f"{place} is no place in an object store")


#: Streams that are counted one by one; so few are counted exactly by a sketch that has room for more of them.
STREAMS, ROOM = 10_000, 65_536


def _counters(df: DataFrame, schema: Schema) -> list[Column]:
    """What is counted as rows go by, without another pass: rows, their bytes as interchange text, and rows of each stream."""
    out = [F.count(F.lit(1)).alias("rows"), F.sum(cell_bytes(encode.columns(schema))).alias("bytes")]
    return [*out, F.expr(f"approx_top_k(`__stream`, {STREAMS}, {ROOM})").alias("by_stream")] if "__stream" in df.columns else out


def copy(
    spark: SparkSession, source: str, destination: str, *, if_exists: str = "error", schema: str | None = None, where: str | None = None, from_format: str | None = None, to_format: str | None = None,
    from_args: Iterable[str] = (), to_args: Iterable[str] = (), stream_size: int | None = None, max_streams: int | None = None, temporary: Iterable[str] = (), unstable: bool = True, metrics: dict | None = None,
) -> list[str]:
    """Copies a table, and returns the locators of what was written.

    `metrics`, if given, gets the number of rows, of bytes and of outputs, by schemes, and the rows of each source stream; rows are
    counted as they go by, bytes as they are in files, or, where none are written, as interchange text.

    Two servers that can do it between them copy without Spark: see remote.  `temporary` names folders for data on its way: with
    s3://bucket/tmp/ Redshift and Trino load and unload files there, see staged, and gs://bucket/tmp/ is for BigQuery's connector.
    """
    a, b = locators.parse(source, unstable), locators.parse(destination, unstable)
    read = SourceArguments(where, from_format, parse(from_args))
    write = DestinationArguments(IfExists.parse(if_exists), to_format, parse(to_args))
    with prepared(spark):
        return _copied(spark, a, b, schema, read, write, stream_size, max_streams, list(temporary), unstable, metrics)


def _copied(
    spark: SparkSession, a: locators.Locator, b: locators.Locator, schema: str | None, read: SourceArguments, write: DestinationArguments, stream_size: int | None, max_streams: int | None, temporary: list[str], unstable: bool,
    metrics: dict | None,
) -> list[str]:
    if not a.features.read:
        raise TideError(f"cannot copy from {a}")
    if not b.features.write:
        raise TideError(f"cannot copy to {b}")
    a.features.check_source(a.scheme, read)
    b.features.check_destination(b.scheme, write)
    table = _schema(spark, a, schema, read, unstable)
    from . import staged
    from .remote import transfer

    if (written := transfer(spark, a, b, table, read, write)) is not None:
        if metrics is not None:
            metrics |= {"from": a.scheme, "to": b.scheme, "streams": len(written)}
        return written
    stage(spark, temporary)
    if (by := staged.plan(a, b, table, read, write, temporary)) is not None:
        written = staged.run(spark, by, a, b, table, read, write, stream_size, max_streams)
        if metrics is not None:
            metrics |= {"from": a.scheme, "to": b.scheme, "streams": len(written)}
        return written
    df = a.read(spark, table, read)
    if max_streams:
        df = bounded(df, max_streams)
    seen = Observation()
    try:
        written = b.write(df if metrics is None else df.observe(seen, *_counters(df, table)), table, write, stream_size)
    except Exception as e:
        if not isinstance(a, locators.FileLocator) or a.path == "-" or files.format_of(files.extension(a.path.rstrip("/")), read.format) != "csv":
            raise
        if (placed := files.with_place(spark, a.path, table, e)) is e:
            raise
        raise placed from e
    if metrics is not None:
        found = seen.get
        metrics |= {"from": a.scheme, "to": b.scheme, "rows": found["rows"], "bytes": found["bytes"] or 0, "streams": len(written)}
        if len(found.get("by_stream") or ()) in range(1, STREAMS):
            metrics["by_stream"] = {x["item"]: x["count"] for x in found["by_stream"]}
        if isinstance(b, locators.FileLocator) and b.path != "-":
            metrics["bytes"] = sum(n for w in written for _, n in Files(spark, locators.parse(w).path).listed())
    return written


def count(spark: SparkSession, source: str, *, schema: str | None = None, where: str | None = None, from_format: str | None = None, from_args: Iterable[str] = (), unstable: bool = True) -> int:
    """The number of rows, of those for which `where` is true."""
    a = locators.parse(source, unstable)
    read = SourceArguments(where, from_format, parse(from_args))
    if not a.features.count:
        raise TideError(f"cannot count {a}")
    a.features.check_source(a.scheme, read)
    with prepared(spark):
        return a.count(spark, _schema(spark, a, schema, read, unstable), read)


def convert_schema(spark: SparkSession, source: str, destination: str, *, if_exists: str = "error", unstable: bool = True) -> None:
    """Writes one locator's schema in another's dialect."""
    a, b = locators.parse(source, unstable), locators.parse(destination, unstable)
    if not a.features.schema:
        raise TideError(f"cannot read a schema from {a}")
    if not b.features.write_schema:
        raise TideError(f"cannot write a schema to {b}")
    policy = IfExists.parse(if_exists)
    if policy.mode not in b.features.write_schema:
        raise TideError(f"{b.scheme} does not support --if-exists={policy}")
    b.write_schema(spark, _schema(spark, a, None, SourceArguments(), unstable), policy)
