"""Transfers that two servers do between them: no row goes through Spark.

Redshift loads from S3 and unloads to it; Trino reads and writes CSV in S3 through a table over the folder, which goes again.  Each
function gives the statements to run; transfer() runs them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession

from ..dialects import redshift, trino
from ..dialects.postgres import quote_table
from ..errors import TideError
from ..schema import Schema
from ..sources.arguments import DestinationArguments, IfExists, SourceArguments
from ..sources.locators import Locator, RedshiftLocator, S3Locator, TrinoLocator
from ..sources.storage import Files
from . import storage


def _url(folder: S3Locator) -> str:
    """The folder as servers name it."""
    if not folder.text.endswith("/"):
        raise TideError(f"{folder} has to end in / for a server to read or write it")
    return folder.text


def _credentials(arguments: Mapping) -> Mapping[str, str]:
    found = arguments.get("credentials")
    if not isinstance(found, Mapping) or not found:
        raise TideError("Redshift needs credentials for S3: give an argument such as credentials.iam_role=...")
    return found


def redshift_to_s3(schema: Schema, table: str, folder: S3Locator, a: SourceArguments) -> list[str]:
    return [redshift.unload_statement(schema, table, a.where, _url(folder), _credentials(a.arguments))]


def s3_to_redshift(schema: Schema, folder: S3Locator, table: str, a: DestinationArguments, tag: str) -> list[str]:
    redshift.check_loadable(schema)
    mode, load = a.if_exists.mode, lambda t: redshift.copy_statement(t, _url(folder), _credentials(a.arguments))
    made = redshift.render(schema, table).rstrip().rstrip(";")
    calm = made.replace("CREATE TABLE", "CREATE TABLE IF NOT EXISTS", 1)
    if mode == "upsert":
        staged = f"{table.rsplit('.', 1)[-1]}_{tag}"
        temporary = redshift.render(schema, staged).rstrip().rstrip(";").replace("CREATE TABLE", "CREATE TEMPORARY TABLE", 1)
        return [calm, temporary, load(staged), *redshift.upsert_statements(schema, staged, table, list(a.if_exists.keys))]
    first = {"error": [made], "append": [calm], "overwrite": [f"DROP TABLE IF EXISTS {quote_table(table)}", made]}[mode]
    return [*first, load(table)]


def trino_to_s3(schema: Schema, table: str, folder: S3Locator, a: SourceArguments, profile: str, tag: str) -> list[str]:
    plain = trino.create_table(schema, table)
    wrapper = storage.csv_wrapper(plain, _url(folder), tag)
    cells = ", ".join(trino.export_expression(t, storage.loaded_sql(profile, t, trino.quote(n))) for n, t, *_ in plain.columns)
    where = f" WHERE ({a.where})" if a.where else ""
    return [str(wrapper), f"INSERT INTO {trino.quote_table(wrapper.name)} SELECT {cells} FROM {trino.quote_table(table)}{where}", f"DROP TABLE {trino.quote_table(wrapper.name)}"]


def s3_to_trino(schema: Schema, folder: S3Locator, table: str, if_exists: IfExists, profile: str, tag: str) -> list[str]:
    mode = if_exists.mode
    plain = trino.create_table(schema, table, or_replace=mode == "overwrite", if_not_exists=mode in ("append", "upsert"))
    wrapper = storage.csv_wrapper(plain, _url(folder), tag)
    first, made = storage.storage_table(profile, plain, merge=mode == "upsert")
    names = ", ".join(trino.quote(n) for n, *_ in plain.columns)
    values = ", ".join(storage.stored_sql(profile, t, trino.import_expression(t, trino.quote(n))) for n, t, *_ in plain.columns)
    insert = lambda t: f"INSERT INTO {trino.quote_table(t)} ({names}) SELECT {values} FROM {trino.quote_table(wrapper.name)}"
    last = [f"DROP TABLE {trino.quote_table(wrapper.name)}"]
    if mode != "upsert":
        return [*first, str(made), str(wrapper), insert(table), *last]
    staged = f"{table}_{tag}_new"
    _, beside = storage.storage_table(profile, trino.create_table(schema, staged))
    merged = trino.merge_statement(schema, staged, table, list(if_exists.keys), key_loader(schema, profile))
    return [str(made), str(wrapper), str(beside), insert(staged), merged, f"DROP TABLE {trino.quote_table(staged)}", *last]


def key_loader(schema: Schema, profile: str) -> Callable[[str, str], str]:
    return lambda name, x: storage.loaded_sql(profile, trino.from_portable(schema, schema.table.column(name).data_type), x)


def transfer(spark: SparkSession, source: Locator, target: Locator, schema: Schema, a: SourceArguments, b: DestinationArguments) -> list[str] | None:
    """The locators that were written, or None if these two cannot do it between them.

    A folder that is overwritten gets what is new in a folder of its own below it, and what was there goes once that is whole; if the
    server fails, the new folder goes.
    """
    tag = uuid.uuid4().hex[:10]
    place = target
    if isinstance(target, S3Locator) and b.if_exists.mode == "overwrite":
        place = S3Locator(f"{_url(target)}{tag}/")
    match source, place:
        case RedshiftLocator(), S3Locator():
            server, statements = source, redshift_to_s3(schema, source.table_name(), place, a)
        case TrinoLocator(), S3Locator():
            server, statements = source, trino_to_s3(schema, source.table_name(), place, a, source.profile(a.arguments), tag)
        case S3Locator(), RedshiftLocator() if not a.where and a.format in (None, "csv"):
            server, statements = target, s3_to_redshift(schema, source, target.table_name(), b, tag)
        case S3Locator(), TrinoLocator() if not a.where and a.format in (None, "csv"):
            server, statements = target, s3_to_trino(schema, source, target.table_name(), b.if_exists, target.profile(b.arguments), tag)
        case _:
            return None
    if place is target:
        server.execute(spark, statements)
        return [target.text]
    old = [p for p, _ in Files(spark, target.path).listed()] if Files(spark, target.path).exists() else []
    try:
        server.execute(spark, statements)
    except BaseException:
        Files(spark, place.path).delete()
        raise
    for file in old:
        Files(spark, file).delete()
    return [target.text]
