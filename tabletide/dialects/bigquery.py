"""BigQuery table schemas as JSON: columns with types and modes."""

from __future__ import annotations

import json
import re

from ..errors import TideError
from ..schema import BOOL, DATE, DECIMAL, FLOAT32, FLOAT64, INT16, INT32, INT64, JSON, TEXT, TIMESTAMP, TIMESTAMPTZ, UUID, Array, Column, DataType, GeoJson, Named, OneOf, Schema, Struct, StructField, Table
from ..schema import WGS84
from .scanner import Scanner

#: How scalar types are written; JSON, UUID and text are strings.
NAMES = {BOOL: "BOOL", DATE: "DATE", DECIMAL: "NUMERIC", FLOAT32: "FLOAT64", FLOAT64: "FLOAT64", INT16: "INT64", INT32: "INT64", INT64: "INT64", JSON: "STRING", TEXT: "STRING", TIMESTAMP: "DATETIME", TIMESTAMPTZ: "TIMESTAMP", UUID: "STRING"}
#: Which portable types the names stand for, older names included.
PORTABLE: dict[str, DataType] = {
    "BOOL": BOOL, "BOOLEAN": BOOL, "DATE": DATE, "DATETIME": TIMESTAMP, "FLOAT": FLOAT64, "FLOAT64": FLOAT64, "GEOGRAPHY": GeoJson(WGS84), "INT64": INT64, "INTEGER": INT64, "NUMERIC": DECIMAL,
    "STRING": TEXT, "TIMESTAMP": TIMESTAMPTZ,
}


def check_names(names: list[str]) -> None:
    """Column names are ASCII words, and differ in more than case."""
    seen: dict[str, str] = {}
    for n in names:
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", n):
            raise TideError(f"BigQuery cannot have a column {n!r}")
        if n.lower() in seen:
            raise TideError(f"BigQuery cannot tell the columns {seen[n.lower()]!r} and {n!r} apart")
        seen[n.lower()] = n


def type_name(schema: Schema, t: DataType, for_csv: bool = False) -> str:
    """The type of a column; with `for_csv` that of a column that CSV is loaded into, where nested values are text."""
    t = schema.resolve(t)
    match t:
        case Array(element):
            inner = schema.resolve(element)
            if for_csv:
                return "STRING"
            if inner == JSON:
                raise TideError("BigQuery cannot have an array of json")
            name = type_name(schema, inner)
            return f"ARRAY<STRUCT<{name}>>" if isinstance(inner, Array) else f"ARRAY<{name}>"
        case Struct(fields):
            return "STRING" if for_csv else f"STRUCT<{','.join(f'{f.name} {type_name(schema, f.data_type)}' for f in fields)}>"
        case GeoJson(srid):
            return "GEOGRAPHY" if srid == WGS84 and not for_csv else "STRING"
        case OneOf():
            return "STRING"
    return NAMES[t]


def _column(schema: Schema, name: str, t: DataType, nullable: bool, comment: str | None) -> dict:
    t = schema.resolve(t)
    mode = "NULLABLE" if nullable else "REQUIRED"
    if isinstance(t, Array):
        mode, whole, t = "REPEATED", t, schema.resolve(t.element)
        if t == JSON:
            raise TideError(f"BigQuery cannot have an array of json, which {name!r} is")
        if isinstance(t, Array):  # arrays don't nest; a struct stands between
            inner = _column(schema, "nested", whole.element, True, None)
            return {"name": name, "type": "RECORD", "mode": mode, "fields": [inner]}
    out: dict = {"name": name}
    if comment is not None:
        out["description"] = comment
    if isinstance(t, Struct):
        check_names([f.name for f in t.fields])
        return out | {"type": "RECORD", "mode": mode, "fields": [_column(schema, f.name, f.data_type, f.is_nullable, None) for f in t.fields]}
    return out | {"type": type_name(schema, t), "mode": mode}


def render(schema: Schema) -> str:
    check_names([c.name for c in schema.table.columns])
    return json.dumps([_column(schema, c.name, c.data_type, c.is_nullable, c.comment) for c in schema.table.columns], indent=2) + "\n"


def parse_type(source: str) -> DataType:
    """A type as it is written in SQL, nested ones included."""
    s = Scanner(source, "BigQuery type", r"\s")

    def data_type() -> DataType:
        if s.take_words("array"):
            s.mark("<")
            [inner] = s.listed(data_type, ">")
            return Array(inner)
        if s.take_words("struct"):
            s.mark("<")
            fields = s.listed(member, ">")
            if len(fields) == 1 and fields[0].name == "" and isinstance(fields[0].data_type, Array):
                return fields[0].data_type
            return Struct(tuple(fields))
        at = s.now
        name = s.identifier().upper()
        if name not in PORTABLE:
            raise s.fail("a type with a portable one", at)
        return PORTABLE[name]

    def member() -> StructField:
        following = s.tokens[s.at + 1]
        named = following.kind in ("word", "quoted") and s.now.kind == "word"
        return StructField(s.identifier() if named else "", data_type())

    out = data_type()
    if s.now.kind != "end":
        raise s.fail("the end")
    return out


def _portable(c: dict) -> tuple[DataType, bool]:
    mode = (c.get("mode") or "NULLABLE").upper()
    if mode not in ("NULLABLE", "REQUIRED", "REPEATED"):
        raise TideError(f"column {c.get('name')!r} has the unknown mode {mode!r}")
    kind = c["type"].upper()
    if kind in ("RECORD", "STRUCT"):
        parts = tuple(StructField(f["name"], t, n) for f in c.get("fields") or [] for t, n in [_portable(f)])
        t: DataType = Struct(parts)
    elif kind in ("BYTES", "TIME"):
        raise TideError(f"the portable schema has no type for {kind}, which column {c['name']!r} has")
    else:
        t = parse_type(c["type"])
    return (Array(t), True) if mode == "REPEATED" else (t, mode == "NULLABLE")


def parse(source: str, table: str = "unnamed") -> Schema:
    value = json.loads(source)
    if not isinstance(value, list):
        raise TideError("a BigQuery schema is a list of columns")
    columns = []
    for c in value:
        t, nullable = _portable(c)
        columns.append(Column(c["name"], t, nullable, c.get("description")))
    check_names([c.name for c in columns])
    return Schema(Table(table, tuple(columns)))


def quote_table(name: str) -> str:
    """`project.dataset.table`, of a name with a colon after the project."""
    return f"`{name.replace(':', '.', 1)}`"


def merge_statement(schema: Schema, source: str, target: str, keys: list[str]) -> str:
    """MERGE on equal keys, which cannot be null; without other columns, rows that match stay as they are."""
    if not keys:
        raise TideError("an upsert needs a key")
    for k in keys:
        if schema.table.column(k).is_nullable:
            raise TideError(f"the upsert key {k!r} has to be REQUIRED")
    names = [c.name for c in schema.table.columns]
    check_names(names)
    on = " AND ".join(f"old.`{k}` = new.`{k}`" for k in keys)
    rest = ", ".join(f"`{n}` = new.`{n}`" for n in names if n not in keys)
    matched = f" WHEN MATCHED THEN UPDATE SET {rest}" if rest else ""
    columns, values = ", ".join(f"`{n}`" for n in names), ", ".join(f"new.`{n}`" for n in names)
    return f"MERGE INTO {quote_table(target)} AS old USING {quote_table(source)} AS new ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({values})"
