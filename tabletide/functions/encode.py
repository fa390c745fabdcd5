"""From typed columns to interchange text, and to JSON values for JSON Lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from ..schema import DataType, Schema

#: Fixed value: integers beyond this are strings in JSON, since readers with floating-point numbers would change them.
SAFE_INTEGER = (1 << 53) - 1


def timestamp(value: Column) -> Column:
    """ISO 8601 without trailing zeros in the fraction."""
    return F.regexp_replace(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.?0+$", "")


def timestamp_utc(value: Column) -> Column:
    """As timestamp(), at UTC, with a Z; in any session time zone."""
    return F.concat(timestamp(F.to_utc_timestamp(value, F.current_timezone())), F.lit("Z"))


def number(value: Column) -> Column:
    """A float in the shortest text that is read as the same value, in JSON's form; infinities and no-numbers are an error."""
    finite = ~(F.isnan(value) | (F.abs(value) == float("inf")))
    # Spark writes 1.0E37 and 100.0, which are JSON numbers as well
    text = F.regexp_replace(F.regexp_replace(value.cast("string"), r"\.0(?=$|E)", ""), "E", "e")
    return F.when(value.isNull(), F.lit(None)).when(finite, text).otherwise(F.raise_error(F.concat(F.lit("JSON has no number "), value.cast("string"))))


def quoted(text: Column) -> Column:
    """A JSON string."""
    whole = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(whole, F.lit(2), F.length(whole) - 2))


def json_value(schema: Schema, t: DataType, value: Column, arrays_as_strings: bool = True) -> Column:
    """A value inside JSON; null as the word null.

    Integers that other readers may round are strings.  With `arrays_as_strings`, all int64 values are, as inside arrays.
    """
    t = schema.resolve(t)
    null = F.lit("null")
    if isinstance(t, S.Array):
        inner = F.transform(value, lambda x: json_value(schema, t.element, x, arrays_as_strings))
        return F.coalesce(F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]")), null)
    if isinstance(t, S.Struct):
        parts: list[Column] = []
        for i, f in enumerate(t.fields):
            label = quoted(F.lit(f.name))
            parts += [F.lit(",") if i else F.lit("{"), label, F.lit(":"), json_value(schema, f.data_type, value[f.name], arrays_as_strings)]
        whole = F.concat(*parts, F.lit("}")) if parts else F.lit("{}")
        return F.when(value.isNull(), null).otherwise(whole)
    if t == S.JSON or isinstance(t, S.GeoJson):
        return F.coalesce(value, null)
    if t == S.BOOL:
        return F.coalesce(value.cast("string"), null)
    if t in (S.INT16, S.INT32):
        return F.coalesce(value.cast("string"), null)
    if t == S.INT64:
        text = value.cast("string")
        unsafe = F.lit(True) if arrays_as_strings else F.abs(value.cast("decimal(20,0)")) > SAFE_INTEGER
        return F.coalesce(F.when(unsafe, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text), null)
    if t in (S.FLOAT32, S.FLOAT64):
        return F.coalesce(number(value), null)
    return F.coalesce(quoted(scalar(schema, t, value)), null)


def scalar(schema: Schema, t: DataType, value: Column) -> Column:
    t = schema.resolve(t)
    if t == S.BOOL:
        return F.when(value, "t").when(~value, "f")
    if t == S.TIMESTAMP:
        return timestamp(value)
    if t == S.TIMESTAMPTZ:
        return timestamp_utc(value)
    if t == S.DECIMAL:
        return F.regexp_replace(F.regexp_replace(value.cast("decimal(38,9)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    if t in (S.FLOAT32, S.FLOAT64):
        return F.regexp_replace(F.regexp_replace(value.cast("string"), r"\.0(?=$|E)", ""), "E", "e")
    return value.cast("string")


def cell(schema: Schema, t: DataType, value: Column) -> Column:
    """Interchange text; null for null."""
    t = schema.resolve(t)
    if isinstance(t, (S.Array, S.Struct)):
        return F.when(value.isNotNull(), json_value(schema, t, value))
    return scalar(schema, t, value)


def columns(schema: Schema) -> list[Column]:
    """All columns in interchange form, in the schema's order."""
    return [cell(schema, c.data_type, F.col(f"`{c.name.replace('`', '``')}`")).alias(c.name) for c in schema.table.columns]


def json_line(schema: Schema) -> Column:
    """A row as a JSON object, every column in it, for JSON Lines."""
    parts: list[Column] = []
    for i, c in enumerate(schema.table.columns):
        value = F.col(f"`{c.name.replace('`', '``')}`")
        t = schema.resolve(c.data_type)
        if isinstance(t, (S.Array, S.Struct)) or t == S.JSON or isinstance(t, S.GeoJson):
            text = json_value(schema, t, value)
        else:
            text = json_value(schema, t, value, arrays_as_strings=False)
        parts += [F.lit(",") if i else F.lit("{"), quoted(F.lit(c.name)), F.lit(":"), text]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")
