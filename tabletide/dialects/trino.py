"""Trino tables: types, CREATE TABLE statements, and which portable type stands for which."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from .. import schema as S
from ..errors import Span, ParseError, TideError
from ..schema import Column, DataType, Schema, Table
from .scanner import Scanner

_SKIP = r"\s|--[^\n]*(?:\n|\Z)|/\*.*?\*/"


@dataclass(frozen=True)
class Type:
    """A type by name, with numbers in brackets, an element, or fields; a field's name may be None."""

    name: str
    sizes: tuple[int, ...] = ()
    element: Type | None = None
    fields: tuple[tuple[str | None, Type], ...] = ()

    def __str__(self) -> str:
        match self.name:
            case "array":
                return f"ARRAY({self.element})"
            case "row":
                return "ROW(" + ", ".join(f"{quote(n)} {t}" if n is not None else str(t) for n, t in self.fields) + ")"
            case "timestamp with time zone" | "time with time zone":
                return f"{self.name.split()[0].upper()}{self._sizes()} WITH TIME ZONE"
            case "sphericalgeography":
                return "SphericalGeography"
        return self.name.upper() + self._sizes()

    def _sizes(self) -> str:
        return f"({', '.join(map(str, self.sizes))})" if self.sizes else ""


#: Types that are known, and not supported.
REFUSED = ("char", "time with time zone", "interval day to second", "interval year to month", "map")
#: The types without parameters.
PLAIN = ("boolean", "tinyint", "smallint", "int", "bigint", "real", "double", "varbinary", "json", "date", "uuid", "sphericalgeography")
#: Fixed value: the digits of a second's fraction, where none are given.
PRECISION = 3


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def identifier(name: str) -> str:
    """Names are lower case in ASCII letters, and not empty."""
    if not name:
        raise TideError("a Trino name cannot be empty")
    return re.sub("[A-Z]", lambda m: m[0].lower(), name)


def quote_table(name: str) -> str:
    return ".".join(quote(identifier(x)) for x in name.split("."))


def _size(s: Scanner, default: int | None = None) -> tuple[int, ...]:
    if s.take_mark("("):
        n = s.number()
        s.mark(")")
        return (n,)
    return () if default is None else (default,)


def scan_type(s: Scanner) -> Type:
    at = s.now
    refuse = lambda name: ParseError(s.source, s.name, f"the Trino type {name.upper()} is not supported", Span(at.start, at.end, "not supported"))
    if s.take_words("array"):
        s.mark("(")
        element = scan_type(s)
        s.mark(")")
        return Type("array", element=element)
    if s.take_words("row"):
        s.mark("(")
        return Type("row", fields=tuple(s.listed(lambda: _field(s))))
    if s.take_words("decimal"):
        s.mark("(")
        precision = s.number()
        scale = s.number() if s.take_mark(",") else 0
        s.mark(")")
        return Type("decimal", (precision, scale))
    if s.take_words("varchar"):
        return Type("varchar", _size(s))
    for name in ("timestamp", "time"):
        if s.take_words(name):
            sizes = _size(s, PRECISION)
            if s.take_words("with", "time", "zone"):
                name += " with time zone"
            if name in REFUSED:
                raise refuse(name)
            return Type(name, sizes)
    for name in REFUSED:
        if s.is_word(*name.split()):
            raise refuse(name)
    if s.take_words("integer"):
        return Type("int")
    if s.now.kind == "word" and s.now.text.lower() in PLAIN:
        return Type(s.next().text.lower())
    raise s.fail("a Trino type")


def _field(s: Scanner) -> tuple[str | None, Type]:
    following = s.tokens[s.at + 1]
    # a name stands before its type; a type alone is followed by a bracket, a comma or more words of its own
    if s.now.kind == "quoted" or s.now.kind == "word" and following.kind == "word" and following.text.lower() not in ("with", "day", "year"):
        return identifier(s.identifier()), scan_type(s)
    return None, scan_type(s)


def parse_type(source: str) -> Type:
    s = Scanner(source, "Trino type", _SKIP)
    out = scan_type(s)
    if s.now.kind != "end":
        raise s.fail("the end")
    return out


def to_portable(t: Type) -> DataType:
    match t.name:
        case "boolean":
            return S.BOOL
        case "tinyint" | "smallint":
            return S.INT16
        case "int":
            return S.INT32
        case "bigint":
            return S.INT64
        case "real":
            return S.FLOAT32
        case "double":
            return S.FLOAT64
        case "decimal":
            return S.DECIMAL
        case "varchar":
            return S.TEXT
        case "json":
            return S.JSON
        case "date":
            return S.DATE
        case "timestamp":
            return S.TIMESTAMP
        case "timestamp with time zone":
            return S.TIMESTAMPTZ
        case "uuid":
            return S.UUID
        case "sphericalgeography":
            return S.GeoJson(S.WGS84)
        case "array":
            return S.Array(to_portable(t.element))  # type: ignore[arg-type]
        case "row":
            return S.Struct(tuple(S.StructField(n if n is not None else f"_f{i}", to_portable(x)) for i, (n, x) in enumerate(t.fields, 1)))
    raise TideError(f"the portable schema has no type for {t}")


def from_portable(schema: Schema, t: DataType) -> Type:
    t = schema.resolve(t)
    match t:
        case S.Array(element):
            return Type("array", element=from_portable(schema, element))
        case S.Struct(fields):
            return Type("row", fields=tuple((identifier(f.name), from_portable(schema, f.data_type)) for f in fields))
        case S.GeoJson(srid):
            return Type("sphericalgeography" if srid == S.WGS84 else "json")
        case S.OneOf():
            return Type("varchar")
    plain = {S.BOOL: "boolean", S.INT16: "smallint", S.INT32: "int", S.INT64: "bigint", S.FLOAT32: "real", S.FLOAT64: "double", S.JSON: "json", S.DATE: "date", S.UUID: "uuid", S.TEXT: "varchar"}
    if t in plain:
        return Type(plain[t])
    if t == S.DECIMAL:
        return Type("decimal", (38, 9))
    return Type("timestamp" if t == S.TIMESTAMP else "timestamp with time zone", (PRECISION,))


def _options(s: Scanner) -> dict[str, object]:
    """The values in WITH (...)."""

    def option() -> tuple[str, object]:
        name = s.identifier()
        s.mark("=")
        if s.now.kind == "string":
            return name, s.string()
        if s.take_words("true"):
            return name, True
        if s.take_words("false"):
            return name, False
        if s.take_words("array"):
            s.mark("[")
            return name, s.listed(s.string, "]") if not s.take_mark("]") else []
        return name, int(s.next().text)

    s.mark("(")
    return dict(s.listed(option))


@dataclass(frozen=True)
class CreateTable:
    name: str
    columns: tuple[tuple[str, Type, bool, str | None], ...]
    or_replace: bool = False
    options: tuple[tuple[str, object], ...] = ()
    if_not_exists: bool = False

    def __str__(self) -> str:
        head = f"CREATE {'OR REPLACE ' if self.or_replace else ''}TABLE {'IF NOT EXISTS ' if self.if_not_exists else ''}{quote_table(self.name)} (\n"
        columns = [f"  {quote(n)} {t}{'' if nullable else ' NOT NULL'}{f' COMMENT {_literal(c)}' if c is not None else ''}" for n, t, nullable, c in self.columns]
        tail = f" WITH (\n{', '.join(f'  {quote(k)} = {_literal(v)}' for k, v in self.options)}\n)" if self.options else ""
        return head + ",\n".join(columns) + "\n)" + tail + "\n"


def _literal(v: object) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (list, tuple)):
        return f"ARRAY[{', '.join(map(_literal, v))}]"
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def parse_create(source: str, name: str = "Trino schema") -> CreateTable:
    s = Scanner(source, name, _SKIP)
    s.words("create")
    replace = s.take_words("or", "replace")
    s.words("table")
    calm = s.take_words("if", "not", "exists")
    parts = [identifier(s.identifier())]
    while len(parts) < 3 and s.take_mark("."):
        parts.append(identifier(s.identifier()))

    def column() -> tuple[str, Type, bool, str | None]:
        n, t = identifier(s.identifier()), scan_type(s)
        nullable = not s.take_words("not", "null")
        return n, t, nullable, s.string() if s.take_words("comment") else None

    s.mark("(")
    columns = tuple(s.listed(column))
    options = _options(s) if s.take_words("with") else {}
    s.take_mark(";")
    if s.now.kind != "end":
        raise s.fail("the end")
    return CreateTable(".".join(parts), columns, replace, tuple(options.items()), calm)


def parse(source: str, name: str = "Trino schema") -> Schema:
    c = parse_create(source, name)
    return Schema(Table(c.name, tuple(Column(n, to_portable(t), nullable, comment) for n, t, nullable, comment in c.columns)))


def create_table(schema: Schema, table: str | None = None, **how) -> CreateTable:
    columns = tuple((identifier(c.name), from_portable(schema, c.data_type), c.is_nullable, c.comment) for c in schema.table.columns)
    names = [c[0] for c in columns]
    if len({*names}) < len(names):
        raise TideError(f"Trino cannot tell the columns {', '.join(names)} apart")
    return CreateTable(table or schema.table.name, columns, **how)


def render(schema: Schema, table: str | None = None) -> str:
    return str(create_table(schema, (table or schema.table.name).replace(".", "_")))


def merge_statement(schema: Schema, source: str, target: str, keys: list[str], loaded: Callable[[str, str], str] = lambda name, x: x) -> str:
    """MERGE on equal keys; without other columns, rows that match stay as they are.

    Keys are compared as `loaded` gives them, by column and expression: as values, not as a storage keeps them.
    """
    if not keys:
        raise TideError("an upsert needs a key")
    names = [identifier(c.name) for c in schema.table.columns]
    for k in keys:
        schema.table.column(k)
    rest = [n for n in names if n not in {identifier(k) for k in keys}]
    on = " AND ".join(f"{loaded(k, f'dest.{quote(identifier(k))}')} = {loaded(k, f'src.{quote(identifier(k))}')}" for k in keys)
    update = "WHEN MATCHED THEN UPDATE SET " + ", ".join(f"{quote(n)} = src.{quote(n)}" for n in rest) + " " if rest else ""
    return f"MERGE INTO {quote_table(target)} AS dest USING {quote_table(source)} AS src ON {on} {update}WHEN NOT MATCHED THEN INSERT ({', '.join(map(quote, names))}) VALUES ({', '.join(f'src.{quote(n)}' for n in names)})"


def catalog_query(table: str) -> str:
    """The columns of a table in a live catalog."""
    *schema, name = table.split(".")
    where = f" AND table_schema = {_literal(identifier(schema[-1]))}" if schema else ""
    return f"SELECT column_name, data_type, is_nullable, column_comment FROM information_schema.columns WHERE table_name = {_literal(identifier(name))}{where} ORDER BY ordinal_position"


def from_catalog(table: str, rows) -> Schema:
    columns = tuple(Column(n, to_portable(parse_type(t)), nullable == "YES", comment) for n, t, nullable, comment in rows)
    if not columns:
        raise TideError(f"there is no table {table!r}")
    return Schema(Table(table, columns))


def export_expression(t: Type, x: str) -> str:
    """SQL that gives a value in interchange text."""
    match t.name:
        case "varchar":
            return x
        case "boolean":
            return f"CASE WHEN {x} THEN 't' WHEN NOT {x} THEN 'f' END"
        case "timestamp":
            return f"RTRIM(RTRIM(DATE_FORMAT({x}, '%Y-%m-%dT%H:%i:%s.%f'), '0'), '.')"
        case "timestamp with time zone":
            return f"RTRIM(RTRIM(DATE_FORMAT({x} AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%i:%s.%f'), '0'), '.') || 'Z'"
        case "json":
            return f"JSON_FORMAT({x})"
        case "array" | "row":
            return f"JSON_FORMAT(CAST({x} AS JSON))"
        case "sphericalgeography":
            return f"to_geojson_geometry({x})"
    return f"CAST({x} AS VARCHAR)"


def import_expression(t: Type, x: str) -> str:
    """SQL that gives the value of interchange text; an empty cell is null."""
    text = f"NULLIF({x}, '')"
    match t.name:
        case "varchar":
            return text
        case "boolean":
            return f"CASE WHEN LOWER({x}) IN ('1', 'y', 'yes', 'on', 't', 'true') THEN TRUE WHEN LOWER({x}) IN ('0', 'n', 'no', 'off', 'f', 'false') THEN FALSE ELSE CAST({text} AS BOOLEAN) END"
        case "timestamp":
            return f"CAST(REPLACE({text}, 'T', ' ') AS {t})"
        case "timestamp with time zone":
            return f"CAST(from_iso8601_timestamp_nanos({text}) AS {t})"
        case "json":
            return f"JSON_PARSE({text})"
        case "array" | "row":
            return f"CAST(JSON_PARSE({text}) AS {t})"
        case "sphericalgeography":
            return f"from_geojson_geometry({text})"
    return f"CAST({text} AS {t})"
