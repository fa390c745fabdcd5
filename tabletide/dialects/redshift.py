"""Redshift: PostgreSQL without nested types, and the statements that load, unload and upsert."""

from __future__ import annotations

from collections.abc import Mapping

from .. import schema as S
from ..errors import TideError
from ..schema import DataType, Schema
from . import postgres
from .postgres import quote, quote_table, quote_text


def type_name(schema: Schema, t: DataType) -> str:
    if isinstance(t, (S.Array, S.Named)):
        raise TideError(f"Redshift cannot have the type {S.type_to_json(t)}")
    return "varchar(max)" if t == S.TEXT else postgres.type_name(schema, t)


def check_loadable(schema: Schema) -> None:
    """CSV cannot be loaded into columns of every type."""
    for c in schema.table.columns:
        if isinstance(c.data_type, (S.Array, S.GeoJson, S.Named, S.OneOf, S.Struct)) or c.data_type in (S.DECIMAL, S.JSON, S.UUID):
            raise TideError(f"Redshift cannot load the column {c.name!r} of type {S.type_to_json(c.data_type)}")


def render(schema: Schema, table: str | None = None) -> str:
    columns = [f"    {quote(c.name)} {type_name(schema, c.data_type)}{'' if c.is_nullable else ' NOT NULL'}" for c in schema.table.columns]
    return f"CREATE TABLE {quote_table(table or schema.table.name)} (\n" + ",\n".join(columns) + "\n);\n"


def _credentials(values: Mapping[str, str]) -> str:
    return "".join(f"\n{k} {quote_text(v)}" for k, v in values.items())


def unload_statement(schema: Schema, table: str, where: str | None, url: str, credentials: Mapping[str, str]) -> str:
    inner = postgres.export_select(schema, table, where)
    return f"UNLOAD ({quote_text(inner)}) TO {quote_text(url)}{_credentials(credentials)}\nHEADER FORMAT CSV"


def copy_statement(table: str, url: str, credentials: Mapping[str, str]) -> str:
    return f"COPY {quote_table(table)} FROM {quote_text(url)}{_credentials(credentials)}\nFORMAT CSV IGNOREHEADER 1 DATEFORMAT 'auto' TIMEFORMAT 'auto'"


def upsert_statements(schema: Schema, source: str, target: str, keys: list[str]) -> list[str]:
    """To be run in one transaction: update what is there, take it out of the source, insert the rest."""
    for k in keys:
        if schema.table.column(k).is_nullable:
            raise TideError(f"the upsert key {k!r} has to be NOT NULL")
    t, s = quote_table(target), quote_table(source)
    names = [c.name for c in schema.table.columns]
    rest = [n for n in names if n not in keys]
    match = " AND ".join(f"{t}.{quote(k)} = {s}.{quote(k)}" for k in keys)
    update = [f"UPDATE {t} SET {', '.join(f'{quote(n)} = {s}.{quote(n)}' for n in rest)} FROM {s} WHERE {match}"] if rest else []
    columns = ", ".join(map(quote, names))
    return [*update, f"DELETE FROM {s} USING {t} WHERE {match}", f"INSERT INTO {t} ({columns}) SELECT {columns} FROM {s}", f"DROP TABLE {s}"]
