"""PostgreSQL tables: reading and writing of CREATE statements, and which portable type stands for which type."""

from __future__ import annotations

import re

from ..errors import ParseError, Span, TideError
from ..schema import BOOL, DATE, DECIMAL, FLOAT32, FLOAT64, INT16, INT32, INT64, JSON, TEXT, TIMESTAMP, TIMESTAMPTZ, UUID, Array, Column, DataType, GeoJson, Named, OneOf, Schema, Struct, Table
from .scanner import Scanner

_SKIP = r"\s|--[^\n]*(?:\n|\Z)"

#: How scalar types are written.
NAMES = {
    BOOL: "boolean", DATE: "date", DECIMAL: "numeric", FLOAT32: "real", FLOAT64: "double precision", INT16: "smallint", INT32: "int", INT64: "bigint", JSON: "jsonb", TEXT: "text",
    TIMESTAMP: "timestamp without time zone", TIMESTAMPTZ: "timestamp with time zone", UUID: "uuid",
}
#: Further words for scalar types.
WORDS = {
    "boolean": BOOL, "date": DATE, "numeric": DECIMAL, "real": FLOAT32, "smallint": INT16, "int": INT32, "integer": INT32, "bigint": INT64, "json": JSON, "jsonb": JSON, "text": TEXT,
    "citext": TEXT, "uuid": UUID,
}


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def quote_table(name: str) -> str:
    return ".".join(map(quote, name.split(".", 1)))


def quote_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _name(s: Scanner) -> str:
    first = s.identifier()
    return f"{first}.{s.identifier()}" if s.take_mark(".") else first


def _scalar(s: Scanner) -> DataType:
    if s.take_words("public") and s.mark(".") and not s.is_word("geometry"):
        raise s.fail("geometry")
    if s.take_words("geometry"):
        s.mark("(")
        s.words("geometry")
        s.mark(",")
        srid = s.number()
        s.mark(")")
        return GeoJson(srid)
    if s.take_words("double", "precision"):
        return FLOAT64
    if s.take_words("character"):
        if s.take_mark("("):
            s.number()
            s.mark(")")
        return TEXT
    if s.take_words("timestamp"):
        if s.take_words("with", "time", "zone"):
            return TIMESTAMPTZ
        s.take_words("without", "time", "zone")
        return TIMESTAMP
    if s.now.kind == "word" and s.now.text.lower() in WORDS:
        return WORDS[s.next().text.lower()]
    return Named(_name(s))


def _column(s: Scanner) -> Column:
    name = s.identifier()
    t = _scalar(s)
    while s.take_mark("["):
        s.mark("]")
        t = Array(t)
    nullable = not s.take_words("not", "null")
    s.take_words("primary", "key")
    return Column(name, t, nullable)


def parse(source: str, name: str = "PostgreSQL schema") -> Schema:
    """One CREATE TABLE, and CREATE TYPE ... AS ENUM for the types it names; a word for no known type is a name."""
    s = Scanner(source, name, _SKIP)
    named: dict[str, DataType] = {}
    tables: list[Table] = []
    starts = []
    while s.now.kind != "end":
        starts.append(s.now)
        s.words("create")
        if s.take_words("type"):
            at = s.now
            type_name = _name(s)
            if type_name in named:
                raise ParseError(source, name, f"the type {type_name} is defined twice", Span(at.start, at.end, "again here"))
            s.words("as", "enum")
            s.mark("(")
            named[type_name] = OneOf(tuple(s.listed(s.string)))
        else:
            s.take_words("unlogged")
            s.words("table")
            table_name = _name(s)
            s.mark("(")
            tables.append(Table(table_name, tuple(s.listed(lambda: _column(s)))))
        if not s.take_mark(";") and s.now.kind != "end":
            raise s.fail("';'")
    if len(tables) != 1:
        raise TideError(f"{name}: expected one CREATE TABLE, found {len(tables)}")
    return Schema(tables[0], named)


def type_name(schema: Schema, t: DataType) -> str:
    match t:
        case Array(element):
            return type_name(schema, element) + "[]"
        case GeoJson(srid):
            return f"public.geometry(Geometry, {srid})"
        case Struct():
            return "jsonb"
        case Named(name):
            target = schema.resolve(t)
            if not isinstance(target, OneOf):
                raise TideError(f"PostgreSQL can only have named types with fixed values, which {name!r} is not")
            return quote_table(name)
        case OneOf():
            raise TideError("PostgreSQL cannot have a one_of type without a name")
    return NAMES[t]


def _used(schema: Schema) -> list[str]:
    found: dict[str, None] = {}

    def visit(t: DataType) -> None:
        if isinstance(t, Array):
            visit(t.element)
        elif isinstance(t, Named):
            found[t.name] = None

    for c in schema.table.columns:
        visit(c.data_type)
    return list(found)


def table_name_for(name: str) -> str:
    """A table name for a statement in a file: the last part that can be a name."""
    found = re.findall(r"[_A-Za-z][_A-Za-z0-9]*", name)
    return found[-1] if found else "data"


def render(schema: Schema, table: str | None = None) -> str:
    """CREATE TYPE for the named types in use, then CREATE TABLE."""
    out = []
    for name in _used(schema):
        type_name(schema, Named(name))
        values = ", ".join(map(quote_text, schema.resolve(Named(name)).values))  # type: ignore[union-attr]
        out.append(f"CREATE TYPE {quote_table(name)} AS ENUM ({values});\n\n")
    out.append(f"CREATE TABLE {quote_table(table or schema.table.name)} (\n")
    columns = [f"    {quote(c.name)} {type_name(schema, c.data_type)}{'' if c.is_nullable else ' NOT NULL'}" for c in schema.table.columns]
    return "".join(out) + ",\n".join(columns) + "\n);\n"


def export_select(schema: Schema, table: str, where: str | None = None, *more: str) -> str:
    """The SELECT that reads a table in interchange form, and `more` expressions, for a server to run."""
    if not schema.table.columns:
        raise TideError("cannot read a table without columns")

    def stamp(x: str, zone: bool) -> str:
        value = f"{x} AT TIME ZONE 'UTC'" if zone else x
        text = f"""RTRIM(RTRIM(TO_CHAR({value}, 'YYYY-MM-DD"T"HH24:MI:SS.US'), '0'), '.')"""
        return f"{text} || 'Z'" if zone else text

    def expression(c: Column) -> str:
        x, t = quote(c.name), schema.resolve(c.data_type)
        if isinstance(t, Array):
            inner = schema.resolve(t.element)
            if isinstance(inner, Array):
                if any(schema.resolve(e) in (INT64, TIMESTAMP, TIMESTAMPTZ) for e in (inner.element,)):
                    raise TideError(f"cannot export the nested array {c.name!r}")
                return f"TO_JSON({x})"
            element = {INT64: "e::text", TIMESTAMP: stamp("e", False), TIMESTAMPTZ: stamp("e", True)}.get(inner)
            return f"TO_JSON({x})" if element is None else f"CASE WHEN {x} IS NULL THEN NULL ELSE TO_JSON(ARRAY(SELECT {element} FROM UNNEST({x}) WITH ORDINALITY AS u(e, k) ORDER BY k)) END"
        if isinstance(t, GeoJson):
            return f"ST_AsGeoJSON({x})"
        if t in (TIMESTAMP, TIMESTAMPTZ):
            return f"{stamp(x, t == TIMESTAMPTZ)}"
        return x

    selected = [e if (e := expression(c)) == quote(c.name) else f"{e} AS {quote(c.name)}" for c in schema.table.columns]
    return f"SELECT {', '.join([*selected, *more])} FROM {quote_table(table)}" + (f" WHERE ({where})" if where else "")


def count_select(table: str, where: str | None = None) -> str:
    return f"SELECT COUNT(*) AS {quote('count')} FROM {quote_table(table)}" + (f" WHERE ({where})" if where else "")


def upsert_statement(schema: Schema, source: str, target: str, keys: list[str]) -> str:
    """INSERT that updates the rows whose keys are there already; with no other columns they stay as they are."""
    for k in keys:
        if schema.table.column(k).is_nullable:
            raise TideError(f"the upsert key {k!r} has to be NOT NULL")
    names = [c.name for c in schema.table.columns]
    rest = [n for n in names if n not in keys]
    columns = ", ".join(map(quote, names))
    action = "DO UPDATE SET " + ", ".join(f"{quote(n)} = EXCLUDED.{quote(n)}" for n in rest) if rest else "DO NOTHING"
    return f"INSERT INTO {quote_table(target)} ({columns}) SELECT {columns} FROM {quote_table(source)} ON CONFLICT ({', '.join(map(quote, keys))}) {action}"


def catalog_query(table: str) -> str:
    """The columns of a table in a live catalog: name, type, element type, whether null may be, and SRID or enumeration values."""
    schema, _, name = table.rpartition(".")
    return (
        "SELECT c.column_name, c.data_type, c.udt_schema, c.udt_name, c.is_nullable, g.srid, "
        "(SELECT STRING_AGG(e.enumlabel, E'\\n' ORDER BY e.enumsortorder) FROM pg_enum e JOIN pg_type t ON t.oid = e.enumtypid JOIN pg_namespace n ON n.oid = t.typnamespace "
        "WHERE t.typname = c.udt_name AND n.nspname = c.udt_schema) AS labels "
        "FROM information_schema.columns c LEFT JOIN public.geometry_columns g ON g.f_table_schema = c.table_schema AND g.f_table_name = c.table_name AND g.f_geometry_column = c.column_name "
        f"WHERE c.table_schema = {quote_text(schema or 'public')} AND c.table_name = {quote_text(name)} ORDER BY c.ordinal_position"
    )


#: Type names of the catalog.
CATALOG = {
    "boolean": BOOL, "character": TEXT, "character varying": TEXT, "citext": TEXT, "text": TEXT, "date": DATE, "numeric": DECIMAL, "real": FLOAT32, "double precision": FLOAT64, "smallint": INT16, "integer": INT32,
    "bigint": INT64, "json": JSON, "jsonb": JSON, "timestamp without time zone": TIMESTAMP, "timestamp with time zone": TIMESTAMPTZ, "uuid": UUID,
    "bool": BOOL, "bpchar": TEXT, "varchar": TEXT, "float4": FLOAT32, "float8": FLOAT64, "int2": INT16, "int4": INT32, "int8": INT64, "timestamp": TIMESTAMP, "timestamptz": TIMESTAMPTZ,
}


def from_catalog(table: str, rows) -> Schema:
    """The schema that catalog_query()'s rows describe."""
    columns, named = [], {}
    for name, data_type, udt_schema, udt_name, nullable, srid, labels in rows:
        if data_type == "ARRAY":
            element = udt_name.lstrip("_")
            if element not in CATALOG:
                raise TideError(f"column {name!r} has elements of the unknown type {element!r}")
            t: DataType = Array(CATALOG[element])
        elif udt_name == "geometry":
            t = GeoJson(int(srid or 0))
        elif labels is not None:
            key = udt_name if udt_schema in ("public", None) else f"{udt_schema}.{udt_name}"
            named[key] = OneOf(tuple(labels.split("\n")))
            t = Named(key)
        elif (found := CATALOG.get(data_type) or CATALOG.get(udt_name)) is not None:
            t = found
        else:
            raise TideError(f"column {name!r} has the unknown type {data_type!r}")
        columns.append(Column(name, t, nullable == "YES"))
    if not columns:
        raise TideError(f"there is no table {table!r}")
    return Schema(Table(table, tuple(columns)), named)
