"""Values as SQL literals, for statements that other servers run."""

from __future__ import annotations

import datetime as dt
import json
import math
from decimal import Decimal
from uuid import UUID

from .. import schema as S
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dialects.trino import Type
from ..errors import TideError
from ..schema import DataType, Schema


def bigquery_text(text: str) -> str:
    out = []
    for ch in text:
        if ch in '"\\':
            out.append("\\" + ch)
        elif "!" <= ch <= "~" or ch == " ":
            out.append(ch)
        else:
            out.append(f"\\U{ord(ch):08x}")
    return '"' + "".join(out) + '"'


def bigquery(schema: Schema, t: DataType, value: object) -> str:
    """A BigQuery literal of a portable type's value, as Python has it; json and geometries as text."""
    t = schema.resolve(t)
    if value is None:
        return "NULL"
    if isinstance(t, S.Array):
        inner = schema.resolve(t.element)
        items = [bigquery(schema, inner, x) for x in value]  # type: ignore[attr-defined]
        return "ARRAY[" + ",".join(f"STRUCT({x})" if isinstance(inner, S.Array) else x for x in items) + "]"
    if isinstance(t, S.Struct):
        return "STRUCT(" + ",".join(f"{bigquery(schema, f.data_type, value[f.name])} AS {f.name}" for f in t.fields) + ")"  # type: ignore[index]
    if isinstance(t, S.GeoJson):
        return f"ST_GEOGFROMGEOJSON({bigquery_text(str(value))})" if t.srid == S.WGS84 else bigquery_text(str(value))
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, bytes):
        return 'b"' + "".join(f"\\x{b:02x}" for b in value) + '"'
    if isinstance(value, int):
        return str(value)
    if isinstance(value, Decimal):
        return f"NUMERIC {bigquery_text(format(value, 'f'))}"
    if isinstance(value, float):
        if not math.isfinite(value):
            return f"CAST({bigquery_text(str(value))} AS FLOAT64)"
        mantissa, _, exponent = repr(value).partition("e")
        return f"{mantissa}e{int(exponent or 0)}"
    if isinstance(value, dt.datetime):
        kind = "TIMESTAMP" if t == S.TIMESTAMPTZ else "DATETIME"
        text = value.astimezone(dt.UTC).replace(tzinfo=None).isoformat() + "Z" if value.tzinfo else value.isoformat()
        return f"{kind} {bigquery_text(text)}"
    if isinstance(value, dt.date):
        return f"DATE {bigquery_text(value.isoformat())}"
    return bigquery_text(str(value))


def _needs_cast(t: Type, value: object) -> bool:
    """Whether a literal's type would not be seen: empty arrays, rows with names, and what holds those."""
    if value is None:
        return False
    if t.name == "array":
        return not value or any(_needs_cast(t.element, x) for x in value)  # type: ignore[arg-type, union-attr, attr-defined]
    if t.name == "row":
        return any(n is not None for n, _ in t.fields) or any(_needs_cast(x, v) for (_, x), v in zip(t.fields, value))  # type: ignore[call-overload]
    return False


def _trino_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def trino(t: Type, value: object, top: bool = True) -> str:
    """A Trino literal; a cast stands around it only where its type would not be seen otherwise."""
    if value is None:
        return f"CAST(NULL AS {t})"
    if t.name in ("array", "row"):
        if t.name == "array":
            text = f"ARRAY[{', '.join(trino(t.element, x, False) for x in value)}]"  # type: ignore[arg-type, attr-defined]
        else:
            text = f"ROW({', '.join(trino(x, v, False) for (_, x), v in zip(t.fields, value))})"  # type: ignore[call-overload]
        return f"CAST({text} AS {t})" if top and _needs_cast(t, value) else text
    match t.name:
        case "boolean":
            return "TRUE" if value else "FALSE"
        case "tinyint" | "smallint" | "int" | "bigint":
            return f"{t.name.upper()} {_trino_text(str(value))}" if t.name != "int" else str(value)
        case "real" | "double":
            text = {"inf": "Infinity", "-inf": "-Infinity", "nan": "NaN"}.get(repr(value), repr(value))
            return f"{t.name.upper()} {_trino_text(text)}"
        case "decimal":
            return f"DECIMAL {_trino_text(format(value, 'f'))}"
        case "varchar":
            return _trino_text(str(value))
        case "varbinary":
            return f"X'{bytes(value).hex()}'"  # type: ignore[call-overload]
        case "json":
            return f"JSON {_trino_text(value if isinstance(value, str) else json.dumps(value))}"
        case "date":
            return f"DATE {_trino_text(str(value))}"
        case "time":
            return f"TIME {_trino_text(_fraction(str(value), t.sizes[0]))}"
        case "timestamp":
            return f"TIMESTAMP {_trino_text(_fraction(value.strftime('%Y-%m-%d %H:%M:%S.%f'), t.sizes[0]))}"  # type: ignore[attr-defined]
        case "timestamp with time zone":
            utc = value.astimezone(dt.UTC)  # type: ignore[attr-defined]
            return f"TIMESTAMP {_trino_text(_fraction(utc.strftime('%Y-%m-%d %H:%M:%S.%f'), t.sizes[0]) + ' +00:00')}"
        case "uuid":
            return f"UUID {_trino_text(str(UUID(str(value))))}"
        case "sphericalgeography":
            return f"from_geojson_geometry({_trino_text(str(value))})"
    raise TideError(f"no literal of {t}")


def _fraction(text: str, digits: int) -> str:
    """A time with so many digits after the point, cut, not rounded."""
    whole, _, rest = text.partition(".")
    return f"{whole}.{rest[:digits].ljust(digits, '0')}" if digits else whole


# The same for columns: whole tables are written as literals by expressions, without the driver.


def _bigquery_text_column(c: Column) -> Column:
    point = lambda ch: F.concat(F.lit("\\U"), F.lpad(F.lower(F.hex(F.ascii(ch).cast("long"))), 8, "0"))
    plain = lambda ch: (ch >= " ") & (ch <= "~") & (F.octet_length(ch) == 1)
    each = F.transform(F.regexp_extract_all(c, F.lit("(?s)(.)"), 1), lambda ch: F.when(ch.isin('"', "\\"), F.concat(F.lit("\\"), ch)).when(plain(ch), ch).otherwise(point(ch)))
    return F.concat(F.lit('"'), F.array_join(each, ""), F.lit('"'))


def bigquery_column(t: DataType, c: Column) -> Column:
    """BigQuery literals of a column of texts, whole numbers, booleans, dates or times, or of arrays of these."""
    if isinstance(t, S.Array):
        if isinstance(t.element, S.Array):
            raise TideError(f"no literals of columns of {S.type_to_json(t)}")
        found = F.concat(F.lit("ARRAY["), F.array_join(F.transform(c, lambda x: bigquery_column(t.element, x)), ","), F.lit("]"))
    elif t in (S.TEXT, S.UUID, S.JSON):
        found = _bigquery_text_column(c)
    elif t in (S.INT16, S.INT32, S.INT64):
        found = c.cast("string")
    elif t == S.BOOL:
        found = F.when(c, "TRUE").otherwise("FALSE")
    elif t == S.DATE:
        found = F.concat(F.lit('DATE "'), c.cast("string"), F.lit('"'))
    elif t in (S.TIMESTAMP, S.TIMESTAMPTZ):
        from .encode import timestamp, timestamp_utc

        zoned = t == S.TIMESTAMPTZ
        found = F.concat(F.lit("TIMESTAMP " if zoned else "DATETIME "), _bigquery_text_column((timestamp_utc if zoned else timestamp)(c)))
    else:
        raise TideError(f"no literals of columns of {S.type_to_json(t)}")
    return F.when(c.isNull(), "NULL").otherwise(found)


def trino_column(t: Type, c: Column, top: bool = True) -> Column:
    """Trino literals of a column of texts, whole numbers, booleans, dates or uuids, or of arrays of these."""
    quoted = lambda x: F.concat(F.lit("'"), F.replace(x.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    match t.name:
        case "array":
            found = F.concat(F.lit("ARRAY["), F.array_join(F.transform(c, lambda x: trino_column(t.element, x, False)), ", "), F.lit("]"))  # type: ignore[arg-type]
            if top:  # an empty one doesn't show its type
                found = F.when(F.size(c) > 0, found).otherwise(F.lit(f"CAST(ARRAY[] AS {t})"))
        case "boolean":
            found = F.when(c, "TRUE").otherwise("FALSE")
        case "int":
            found = c.cast("string")
        case "tinyint" | "smallint" | "bigint" | "date" | "uuid":
            found = F.concat(F.lit(f"{t.name.upper()} "), quoted(c))
        case "varchar":
            found = quoted(c)
        case _:
            raise TideError(f"no literals of columns of {t}")
    return F.when(c.isNull(), f"CAST(NULL AS {t})").otherwise(found)
