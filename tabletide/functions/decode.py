"""From interchange text to typed columns, strictly.

Each builder takes a string column and returns a typed one.  A cell that isn't written as its type demands raises an error that names
column and cell; Spark's own casts would let many through.  All of it is built-in expressions, so it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from ..schema import DataType, Schema
from .bound import bound
from .geo import is_geometry

#: What stands for true and false, in any case.
TRUE, FALSE = ("1", "y", "yes", "on", "t", "true"), ("0", "n", "no", "off", "f", "false")
#: How cells are written.
DATE = r"^[+-]?\d{4,6}-\d{1,2}-\d{1,2}$"
INTEGER = r"^[+-]?\d+$"
DECIMAL = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"
FLOAT = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
STAMP = r"^(\d{4,6}-\d{1,2}-\d{1,2})[ T](\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,9})?)"
ZONE = r"(Z|z|[+-]\d{2}(?::?\d{2})?)$"
UUID = r"^(?i:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|\{[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\}|[0-9a-f]{32}|urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12})$"


def fail(name: str, what: str, cell: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"column {name!r}: cannot read "), F.coalesce(F.concat(F.lit('"'), cell, F.lit('"')), F.lit("null")), F.lit(f" as {what}")))


def _guarded(cell: Column, good: Column, value: Column, name: str, what: str) -> Column:
    """The value where the cell is good; an error where it isn't; null where the cell is null."""
    return F.when(cell.isNull(), F.lit(None)).when(F.coalesce(good, F.lit(False)), value).otherwise(fail(name, what, cell))


def _parsed(cell: Column, pattern: str, value: Column, name: str, what: str) -> Column:
    return _guarded(cell, cell.rlike(pattern) & value.isNotNull(), value, name, what)


def _stamp(cell: Column) -> Column:
    return F.concat(F.regexp_extract(cell, STAMP, 1), F.lit(" "), F.regexp_extract(cell, STAMP, 2))


def scalar(schema: Schema, t: DataType, cell: Column, name: str) -> Column:
    """The value of a cell that is not empty, or not to be taken as null."""
    t = schema.resolve(t)
    if isinstance(t, S.OneOf):
        return _guarded(cell, cell.isin(*t.values), cell, name, f"one of {', '.join(t.values)}")
    if isinstance(t, S.GeoJson):
        return bound(cell, lambda x: _guarded(x, is_geometry(x), x, name, "GeoJSON geometry"))
    if t == S.TEXT:
        return cell
    if t == S.BOOL:
        low = F.lower(cell)
        return _guarded(cell, low.isin(*TRUE, *FALSE), low.isin(*TRUE), name, "bool")
    if t == S.DATE:
        return _parsed(cell, DATE, cell.try_cast("date"), name, "date")
    if t in (S.INT16, S.INT32, S.INT64):
        kind = {S.INT16: "smallint", S.INT32: "int", S.INT64: "bigint"}[t]
        return _parsed(cell, INTEGER, cell.try_cast(kind), name, t.name)
    if t == S.DECIMAL:
        # digits that the type cannot hold would be rounded away
        fits = F.length(F.regexp_replace(F.regexp_extract(cell, r"\.(\d*)$", 1), "0+$", "")) <= 9
        value = cell.try_cast("decimal(38,9)")
        return _guarded(cell, cell.rlike(DECIMAL) & fits & value.isNotNull(), value, name, "decimal")
    if t in (S.FLOAT32, S.FLOAT64):
        return _parsed(cell, FLOAT, cell.try_cast("float" if t == S.FLOAT32 else "double"), name, t.name)
    if t == S.TIMESTAMP:
        return _parsed(cell, STAMP + "$", _stamp(cell).try_cast("timestamp_ntz"), name, "timestamp")
    if t == S.TIMESTAMPTZ:
        zone = F.regexp_extract(cell, ZONE, 1)
        zone = F.when(F.lower(zone) == "z", F.lit("+00:00")).when(F.length(zone) == 3, F.concat(zone, F.lit(":00"))).when(F.length(zone) == 5, F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2))).otherwise(zone)
        return _parsed(cell, STAMP + ZONE, F.concat(_stamp(cell), zone).try_cast("timestamp"), name, "timestamp with time zone")
    if t == S.UUID:
        digits = F.regexp_replace(F.regexp_replace(F.lower(cell), "^urn:uuid:", ""), "[{}-]", "")
        value = F.regexp_replace(digits, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
        return _guarded(cell, cell.rlike(UUID) & digits.rlike("^[0-9a-f]{32}$"), value, name, "uuid")
    if t == S.JSON:
        return _guarded(cell, is_json(cell), cell, name, "json")
    raise AssertionError(t)


def is_json(cell: Column) -> Column:
    return F.coalesce(F.try_parse_json(cell).isNotNull(), F.lit(False))


#: Types whose values are JSON numbers, or strings where a number might be rounded.
NUMBERS = (S.INT16, S.INT32, S.INT64, S.DECIMAL, S.FLOAT32, S.FLOAT64)


def _field(value: Column, name: str) -> Column:
    """A key's value in a JSON object; null if there is none."""
    return F.try_variant_get(value, "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']", "variant")


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _member(schema: Schema, f: S.StructField, name: str):
    """What reads a struct's field from its JSON."""
    spot = f"{name}.{f.name}"

    def read(part: Column) -> Column:
        whole = _from_json(schema, f.data_type, part, spot)
        return whole if f.is_nullable else F.when(_kind(part) == "VOID", fail(spot, "a value that is not null", F.to_json(part))).otherwise(whole)

    return read


def _from_json(schema: Schema, t: DataType, value: Column, name: str) -> Column:
    """The value of a part of JSON, whose kind has to be the type's: true or false for bool, a string for text and what is written as
    text, a number or a string of one for numbers.  A JSON null is null.
    """
    t, kind = schema.resolve(t), _kind(value)
    text, plain = F.to_json(value), F.try_variant_get(value, "$", "string")
    is_text = kind == "STRING"
    if isinstance(t, S.Array):
        good, what = kind.startswith("ARRAY"), "a JSON array"
        found = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: _from_json(schema, t.element, x, f"{name}[]"))
    elif isinstance(t, S.Struct):
        good, what, fields = kind.startswith("OBJECT"), "a JSON object", []
        for f in t.fields:
            fields.append(bound(_field(value, f.name), _member(schema, f, name)).alias(f.name))
        found = F.struct(*fields)
    elif t == S.BOOL:
        good, what, found = kind == "BOOLEAN", "JSON true or false", F.try_variant_get(value, "$", "boolean")
    elif t in NUMBERS:
        is_number = kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
        good, what, found = is_text | is_number, "a JSON number", scalar(schema, t, F.when(is_text, plain).otherwise(text), name)
    elif t == S.JSON:
        good, what, found = F.lit(True), "json", text
    elif isinstance(t, S.GeoJson):
        good, what, found = is_text | kind.startswith("OBJECT"), "GeoJSON geometry", scalar(schema, t, F.when(is_text, plain).otherwise(text), name)
    else:
        good, what, found = is_text, "a JSON string", scalar(schema, t, plain, name)
    return F.when(kind == "VOID", F.lit(None)).when(good, found).otherwise(fail(name, what, text))


def cell(schema: Schema, t: DataType, text: Column, name: str) -> Column:
    """The value of a cell, nested or not."""
    t = schema.resolve(t)
    if not isinstance(t, (S.Array, S.Struct)):
        return scalar(schema, t, text, name)
    opening, what = ("ARRAY", "a JSON array") if isinstance(t, S.Array) else ("OBJECT", "a JSON object")

    def whole(x: Column) -> Column:
        value = x["value"]
        return F.when(x["text"].isNull(), F.lit(None)).when(_kind(value).startswith(opening), _from_json(schema, t, value, name)).otherwise(fail(name, what, x["text"]))

    # of a text that is no JSON nothing is left to look at but the text
    return bound(F.struct(text.alias("text"), F.try_parse_json(text).alias("value")), whole)


def column(schema: Schema, c: S.Column, text: Column) -> Column:
    """A column's values: an empty cell is null where the column may be null, and is itself decoded where it may not."""
    if c.is_nullable:
        # Spark's reader gives null for an empty cell
        text = F.when(F.length(text) > 0, text)
    else:
        text = F.coalesce(text, F.lit(""))
    return cell(schema, c.data_type, text, c.name)


def from_json_text(schema: Schema, line: Column) -> list[Column]:
    """Interchange cells of a JSON Lines row: values by column name; missing keys are null, further keys are not looked at."""
    value = F.try_parse_json(line)
    whole = F.when(F.schema_of_variant(value).startswith("OBJECT"), value).otherwise(F.raise_error(F.concat(F.lit("expected a JSON object, found "), F.coalesce(line, F.lit("null")))))
    out = []
    for c in schema.table.columns:
        field = _field(whole, c.name)
        kind = _kind(field)
        text = F.to_json(field)
        if schema.is_json_cell(c.data_type):
            cell_text = F.when(kind == "VOID", F.lit("")).otherwise(text)
        else:
            plain = F.try_variant_get(field, "$", "string")
            nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
            cell_text = F.when(kind == "VOID", F.lit("")).when(kind == "BOOLEAN", F.when(text == "true", "t").otherwise("f")).when(nested, fail(c.name, S.type_to_json(c.data_type), text)).when(kind == "STRING", plain).otherwise(text)
        if not c.is_nullable:
            cell_text = F.when(cell_text == "", F.raise_error(F.lit(f"unexpected NULL value in column {c.name!r}"))).otherwise(cell_text)
        out.append(cell_text.alias(c.name))
    return out
