"""The portable schema: one table, its columns, and named types; to and from JSON and Spark types.

A data type is a value of one of the small classes below.  Facts that Spark's types don't hold (uuid, json, geometries, enumerations,
names) are kept in a field's metadata under "portable".
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from .errors import TideError

#: The names of the types without parameters.
SCALARS = ("bool", "date", "decimal", "float32", "float64", "int16", "int32", "int64", "json", "text", "timestamp_without_time_zone", "timestamp_with_time_zone", "uuid")
WGS84 = 4326


@dataclass(frozen=True)
class Scalar:
    name: str

    def __post_init__(self) -> None:
        if self.name not in SCALARS:
            raise TideError(f"there is no data type {self.name!r}")


@dataclass(frozen=True)
class GeoJson:
    srid: int = WGS84


@dataclass(frozen=True)
class Named:
    name: str


@dataclass(frozen=True)
class OneOf:
    values: tuple[str, ...]


@dataclass(frozen=True)
class StructField:
    name: str
    data_type: DataType
    is_nullable: bool = True


@dataclass(frozen=True)
class Struct:
    fields: tuple[StructField, ...]


@dataclass(frozen=True)
class Array:
    element: DataType


DataType = Scalar | GeoJson | Named | OneOf | Struct | Array

BOOL, DATE, DECIMAL, FLOAT32, FLOAT64, INT16, INT32, INT64, JSON, TEXT, TIMESTAMP, TIMESTAMPTZ, UUID = map(Scalar, SCALARS)


@dataclass(frozen=True)
class Column:
    name: str
    data_type: DataType
    is_nullable: bool = True
    comment: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise TideError(f"table {self.name!r} has no column {name!r}; it has {', '.join(repr(c.name) for c in self.columns)}")


@dataclass(frozen=True)
class Schema:
    table: Table
    named: Mapping[str, DataType] = field(default_factory=dict)

    def __post_init__(self) -> None:
        seen: set[str] = set()
        for c in self.table.columns:
            if c.name in seen:
                raise TideError(f"table {self.table.name!r} has two columns {c.name!r}")
            seen.add(c.name)
            self._check(c.data_type, ())
        for name, data_type in self.named.items():
            self._check(data_type, (name,))

    def _check(self, t: DataType, path: tuple[str, ...]) -> None:
        """Names have to be defined and must not lead back to themselves; the same name may be used twice side by side."""
        match t:
            case Named(name):
                if name not in self.named:
                    raise TideError(f"the data type {name!r} is not defined")
                if name in path:
                    raise TideError(f"the data type {name!r} is defined by itself")
                self._check(self.named[name], (*path, name))
            case Array(element):
                self._check(element, path)
            case Struct(fields):
                names = [f.name for f in fields]
                if "" in names or len({*names}) < len(names):
                    raise TideError(f"the fields of a struct need different names, not {names}")
                for f in fields:
                    self._check(f.data_type, path)

    def resolve(self, t: DataType) -> DataType:
        """The type that a name stands for, at the top."""
        while isinstance(t, Named):
            t = self.named[t.name]
        return t

    def is_json_cell(self, t: DataType) -> bool:
        """Whether a value stands in a cell as JSON."""
        t = self.resolve(t)
        return isinstance(t, (GeoJson, Struct, Array)) or t == JSON

    def select(self, names: list[str]) -> Schema:
        return replace(self, table=replace(self.table, columns=tuple(self.table.column(n) for n in names)))


# JSON


def type_to_json(t: DataType) -> object:
    match t:
        case Scalar(name):
            return name
        case GeoJson(srid):
            return {"geo_json": srid}
        case Named(name):
            return {"named": name}
        case OneOf(values):
            return {"one_of": list(values)}
        case Array(element):
            return {"array": type_to_json(element)}
        case Struct(fields):
            return {"struct": [{"name": f.name, "is_nullable": f.is_nullable, "data_type": type_to_json(f.data_type)} for f in fields]}
    raise TypeError(t)


def _keys(value: object, needed: set[str], allowed: set[str], what: str) -> dict:
    if not isinstance(value, dict):
        raise TideError(f"{what} has to be an object, not {value!r}")
    if missing := needed - value.keys():
        raise TideError(f"{what} lacks {', '.join(sorted(missing))}")
    if unknown := value.keys() - needed - allowed:
        raise TideError(f"{what} has unknown keys: {', '.join(sorted(unknown))}")
    return value


def type_from_json(value: object) -> DataType:
    if isinstance(value, str):
        return Scalar(value)
    if isinstance(value, dict) and len(value) == 1:
        [(kind, inner)] = value.items()
        if kind == "geo_json" and isinstance(inner, int):
            return GeoJson(inner)
        if kind == "named" and isinstance(inner, str):
            return Named(inner)
        if kind == "one_of" and isinstance(inner, list) and all(isinstance(x, str) for x in inner):
            return OneOf(tuple(inner))
        if kind == "array":
            return Array(type_from_json(inner))
        if kind == "struct" and isinstance(inner, list):
            parts = [_keys(f, {"name", "is_nullable", "data_type"}, set(), "a struct's field") for f in inner]
            return Struct(tuple(StructField(f["name"], type_from_json(f["data_type"]), f["is_nullable"]) for f in parts))
    raise TideError(f"not a data type: {json.dumps(value)}")


def _table_from_json(value: object) -> Table:
    t = _keys(value, {"name", "columns"}, set(), "a table")
    columns = [_keys(c, {"name", "is_nullable", "data_type"}, {"comment"}, "a column") for c in t["columns"]]
    return Table(t["name"], tuple(Column(c["name"], type_from_json(c["data_type"]), c["is_nullable"], c.get("comment")) for c in columns))


def schema_from_json(text: str) -> Schema:
    """The current form, with named types and exactly one table, or the old one, which is a bare table."""
    value = json.loads(text)
    if isinstance(value, dict) and "columns" in value:
        return Schema(_table_from_json(value))
    whole = _keys(value, {"named_data_types", "tables"}, set(), "a schema")
    if len(whole["tables"]) != 1:
        raise TideError(f"a schema has one table, not {len(whole['tables'])}")
    named: dict[str, DataType] = {}
    for n in whole["named_data_types"]:
        _keys(n, {"name", "data_type"}, set(), "a named data type")
        if n["name"] in named:
            raise TideError(f"the data type {n['name']!r} is defined twice")
        named[n["name"]] = type_from_json(n["data_type"])
    return Schema(_table_from_json(whole["tables"][0]), named)


def schema_to_json(schema: Schema) -> str:
    columns = []
    for c in schema.table.columns:
        columns.append({"name": c.name, "is_nullable": c.is_nullable, "data_type": type_to_json(c.data_type)} | ({"comment": c.comment} if c.comment is not None else {}))
    named = [{"name": n, "data_type": type_to_json(t)} for n, t in schema.named.items()]
    return json.dumps({"named_data_types": named, "tables": [{"name": schema.table.name, "columns": columns}]}, indent=2) + "\n"


# Spark

_SPARK: dict[DataType, T.DataType] = {
    BOOL: T.BooleanType(), DATE: T.DateType(), DECIMAL: T.DecimalType(38, 9), FLOAT32: T.FloatType(), FLOAT64: T.DoubleType(), INT16: T.ShortType(), INT32: T.IntegerType(), INT64: T.LongType(),
    JSON: T.StringType(), TEXT: T.StringType(), TIMESTAMP: T.TimestampNTZType(), TIMESTAMPTZ: T.TimestampType(), UUID: T.StringType(),
}


def to_spark(schema: Schema, t: DataType) -> T.DataType:
    t = schema.resolve(t)
    match t:
        case Array(element):
            return T.ArrayType(to_spark(schema, element), True)
        case Struct(fields):
            return T.StructType([T.StructField(f.name, to_spark(schema, f.data_type), f.is_nullable) for f in fields])
        case GeoJson() | OneOf():
            return T.StringType()
    return _SPARK[t]


def spark_schema(schema: Schema) -> T.StructType:
    out = []
    for c in schema.table.columns:
        metadata: dict[str, object] = {"portable": json.dumps(type_to_json(c.data_type))}
        if c.comment is not None:
            metadata["comment"] = c.comment
        out.append(T.StructField(c.name, to_spark(schema, c.data_type), c.is_nullable, metadata))
    return T.StructType(out)


def _from_spark_type(t: T.DataType) -> DataType:
    for portable, spark in _SPARK.items():
        if portable not in (JSON, UUID) and spark == t:
            return portable
    match t:
        case T.ByteType():
            return INT16
        case T.DecimalType():
            return DECIMAL
        case T.CharType() | T.VarcharType():
            return TEXT
        case T.ArrayType():
            return Array(_from_spark_type(t.elementType))
        case T.StructType():
            return Struct(tuple(StructField(f.name, _from_spark_type(f.dataType), f.nullable) for f in t.fields))
        case T.VariantType():
            return JSON
    raise TideError(f"the portable schema has no type for {t.simpleString()}")


def from_spark(name: str, struct: T.StructType, named: Mapping[str, DataType] | None = None) -> Schema:
    """The schema of a DataFrame's columns; metadata that earlier schemas left is used."""
    columns = []
    for f in struct.fields:
        known = f.metadata.get("portable")
        t = type_from_json(json.loads(known)) if known else _from_spark_type(f.dataType)
        if isinstance(t, Named) and t.name not in (named or {}):
            t = _from_spark_type(f.dataType)
        columns.append(Column(f.name, t, f.nullable, f.metadata.get("comment")))
    return Schema(Table(name, tuple(columns)), named or {})


def walk(t: DataType) -> Iterator[DataType]:
    yield t
    match t:
        case Array(element):
            yield from walk(element)
        case Struct(fields):
            for f in fields:
                yield from walk(f.data_type)
