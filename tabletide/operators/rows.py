"""Row operators: filter, projection, alignment, header checks, counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..errors import TideError
from ..functions import decode, encode
from ..schema import DataType, Schema


def named(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def where(df: DataFrame, condition: str | None) -> DataFrame:
    """Rows for which a condition, as text in Spark SQL, is true."""
    return df.where(F.expr(f"({condition})")) if condition else df


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """These columns, in this order; a name that isn't there is an error that lists those that are."""
    if not names:
        raise TideError("a table needs a column")
    there = df.columns
    for n in names:
        if there.count(n) != 1:
            raise TideError(f"{'no column' if n not in there else 'several columns'} {n!r}; there are {', '.join(map(repr, there))}")
    # by position, so that names that differ in case only are told apart whatever the session's setting
    fields = {f.name: i for i, f in enumerate(df.schema.fields)}
    renamed = df.toDF(*[f"c{i}" for i in range(len(there))])
    return renamed.select([F.col(f"c{fields[n]}").alias(n, metadata=df.schema.fields[fields[n]].metadata) for n in names])


def rename_header(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names for all columns, as many as there are."""
    if len(names) != len(df.columns):
        raise TideError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def check_header(found: Sequence[str], schema: Schema) -> None:
    """Names have to be the schema's, at the same places."""
    wanted = [c.name for c in schema.table.columns]
    if list(found) != wanted:
        raise TideError(f"the columns are {list(found)}, but the schema has {wanted}")


def align_schema(destination: Schema, source: Schema) -> Schema:
    """The destination's columns, with its types, in the source's order."""
    return destination.select([c.name for c in source.table.columns])


def align_type(have: Schema, t: DataType, want: Schema, u: DataType, what: str) -> DataType:
    """The type with which a column that is t there takes values that are u: text takes uuid, json, geometry and fixed values as they are written."""
    t, u = have.resolve(t), want.resolve(u)
    if t == u:
        return t
    if t == S.TEXT and (u in (S.UUID, S.JSON) or isinstance(u, (S.GeoJson, S.OneOf))):
        return u
    if isinstance(t, S.Array) and isinstance(u, S.Array):
        return S.Array(align_type(have, t.element, want, u.element, what))
    if isinstance(t, S.Struct) and isinstance(u, S.Struct) and [f.name for f in t.fields] == [f.name for f in u.fields]:
        return S.Struct(tuple(S.StructField(a.name, align_type(have, a.data_type, want, b.data_type, f"{what}.{a.name}"), a.is_nullable) for a, b in zip(t.fields, u.fields)))
    raise TideError(f"{what} is {S.type_to_json(t)} and cannot take {S.type_to_json(u)}")


def not_null(schema: Schema, df: DataFrame) -> DataFrame:
    """Errors on a null where the schema has none; Spark's file formats don't check."""
    out = []
    for c in schema.table.columns:
        value = named(c.name)
        if not c.is_nullable:
            value = F.when(value.isNull(), F.raise_error(F.lit(f"unexpected NULL value in column {c.name!r}"))).otherwise(value)
        out.append(value.alias(c.name))
    return df.select(out)


def decoded(df: DataFrame, schema: Schema) -> DataFrame:
    """Typed columns from interchange cells."""
    fields = S.spark_schema(schema).fields
    return df.select([decode.column(schema, c, named(c.name)).cast(f.dataType).alias(c.name, metadata=f.metadata) for c, f in zip(schema.table.columns, fields)])


def encoded(df: DataFrame, schema: Schema) -> DataFrame:
    """Interchange cells from typed columns."""
    return df.select(encode.columns(schema))


def counted(df: DataFrame, condition: str | None = None) -> DataFrame:
    """One row with the number of rows; only the condition's columns are read."""
    return where(df, condition).agg(F.count("*").alias("count"))


def close_enough(a: object, b: object) -> bool:
    """Whether two values are equal up to what back ends lose: 2 units in the last place of floats, 2 ms of times, 2e-8 degrees of points."""
    import datetime as dt
    import math

    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 2 * max(math.ulp(a), math.ulp(b))
    if isinstance(a, dt.datetime) and isinstance(b, dt.datetime):
        return abs(a - b) <= dt.timedelta(milliseconds=2)
    if isinstance(a, dt.time) and isinstance(b, dt.time):
        day = dt.date(2000, 1, 1)
        return abs(dt.datetime.combine(day, a) - dt.datetime.combine(day, b)) <= dt.timedelta(milliseconds=2)
    if isinstance(a, dict) and isinstance(b, dict) and a.get("type") == b.get("type") == "Point":
        return all(abs(x - y) <= 2e-8 for x, y in zip(a["coordinates"], b["coordinates"], strict=True))
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(map(close_enough, a, b))
    return a == b
