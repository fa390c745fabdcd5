"""Copies to and from warehouses by way of a store: many tasks write or read files, and the server loads or unloads them.

A copy is planned as hops.  Rows from anywhere go to files in a temporary folder, which the warehouse loads; a warehouse unloads to such
a folder, which Spark scans with as many tasks as it has ranges, or another warehouse loads.  The folder goes when the copy ends, well
or not.  Warehouses that have no temporary folder, or no credentials for it, take part by JDBC as before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..config import find_temporary
from ..dialects import redshift
from ..errors import TideError
from ..operators.shape import bounded
from ..schema import Schema
from ..sources.arguments import DestinationArguments, IfExists, SourceArguments
from ..sources.locators import Locator, RedshiftLocator, S3Locator, TrinoLocator
from ..sources.storage import Files
from .remote import transfer


@dataclass(frozen=True)
class Plan:
    """A copy by way of `folder`: whether the source unloads to it, and whether the destination loads from it."""

    folder: S3Locator
    unload: bool
    load: bool


def plan(source: Locator, target: Locator, schema: Schema, a: SourceArguments, b: DestinationArguments, temporary: Iterable[str]) -> Plan | None:
    """How to copy by way of a folder in S3 among `temporary`; None if neither end can."""
    try:
        place = find_temporary("s3://", list(temporary))
    except TideError:
        return None
    unload = isinstance(source, TrinoLocator) or isinstance(source, RedshiftLocator) and bool(a.arguments.get("credentials"))
    load = isinstance(target, TrinoLocator) or isinstance(target, RedshiftLocator) and bool(b.arguments.get("credentials")) and _loadable(schema)
    return Plan(S3Locator(f"{place.rstrip('/')}/{uuid.uuid4().hex}/"), unload, load) if unload or load else None


def _loadable(schema: Schema) -> bool:
    try:
        redshift.check_loadable(schema)
    except TideError:
        return False
    return True


def run(spark: SparkSession, by: Plan, source: Locator, target: Locator, schema: Schema, a: SourceArguments, b: DestinationArguments, stream_size: int | None = None, max_streams: int | None = None) -> list[str]:
    """Makes the hops in turn; the locators that were written."""
    plain = SourceArguments(format="csv")
    try:
        if by.unload:
            transfer(spark, source, by.folder, schema, a, DestinationArguments(IfExists("append")))
            df = None if by.load else by.folder.read(spark, schema, plain)
        else:
            df = source.read(spark, schema, a)
        if df is not None and max_streams:
            df = bounded(df, max_streams)
        if not by.load:
            return target.write(df, schema, b, stream_size)
        if df is not None:
            by.folder.write(df.drop("__stream"), schema, DestinationArguments(IfExists("overwrite"), "csv"))
        return transfer(spark, by.folder, target, schema, plain, b) or []
    finally:
        Files(spark, by.folder.path).delete()
