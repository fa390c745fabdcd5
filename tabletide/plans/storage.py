"""Types that a storage doesn't have, stored as others: for each profile the type to store, and expressions to store and to load.

The types are Trino's.  In memory a column has the Spark type that comes nearest: json, uuid, geometries (GeoJSON) and times are text.
Expressions are built once; parts that need no change are left as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dialects import trino
from ..dialects.trino import Type
from ..errors import TideError
from ..functions.geo import geometry_to_wkt, wkt_to_geometry

#: What each storage can do.
CAPABILITIES = {
    "hive": {"not_null": False, "or_replace": False, "merge": True},
    "iceberg": {"not_null": True, "or_replace": True, "merge": True},
    "memory": {"not_null": False, "or_replace": False, "merge": False},
}
#: Options of a table that is to be merged into.
MERGE_OPTIONS = {"hive": {"format": "ORC", "transactional": True}, "iceberg": {}}

Expression = Callable[[Column], Column]


@dataclass(frozen=True)
class Transform:
    """How values of a type are stored.  None for an expression that changes nothing."""

    stored: Type
    store: Expression | None = None
    load: Expression | None = None

    @property
    def is_identity(self) -> bool:
        return self.store is None


def truncated(precision: int) -> Expression:
    """A timestamp without the digits of its fraction beyond `precision`, of six."""
    if precision >= 6:
        return lambda c: c
    step = 10 ** (6 - precision)
    return lambda c: F.timestamp_add("MICROSECOND", -(F.unix_micros(c.cast("timestamp")) % step + step) % step, c)


def _utc(c: Column) -> Column:
    return F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")


def _from_utc(c: Column) -> Column:
    return F.from_utc_timestamp(c.cast("timestamp"), F.current_timezone())


def transform(profile: str, t: Type) -> Transform:
    if profile not in CAPABILITIES:
        raise TideError(f"there is no storage profile {profile!r}; there are {', '.join(CAPABILITIES)}")
    same = Transform(t)
    match (profile, t.name):
        case (_, "array"):
            inner = transform(profile, t.element)  # type: ignore[arg-type]
            if inner.is_identity:
                return same
            return Transform(Type("array", element=inner.stored), lambda c: F.transform(c, inner.store), lambda c: F.transform(c, inner.load))  # type: ignore[arg-type]
        case (_, "row"):
            return _row(profile, t)
        case ("iceberg", "tinyint" | "smallint"):
            return Transform(Type("int"), lambda c: c.cast("int"), lambda c: c.cast("smallint" if t.name == "smallint" else "tinyint"))
        case ("iceberg", "time") if t.sizes != (6,):
            return Transform(Type("time", (6,)), lambda c: F.rpad(F.when(c.contains("."), c).otherwise(F.concat(c, F.lit("."))), 15, "0"), lambda c: F.substring(c, 1, 8 + (t.sizes[0] + 1 if t.sizes[0] else 0)))
        case ("iceberg", "timestamp" | "timestamp with time zone") if t.sizes != (6,):
            return Transform(Type(t.name, (6,)), lambda c: c, truncated(t.sizes[0]))
        case ("hive", "time"):
            return Transform(Type("varchar"), lambda c: c, lambda c: c)
        case ("hive", "timestamp") if t.sizes != (3,):
            return Transform(Type("timestamp", (3,)), truncated(3), lambda c: c)
        case ("hive", "timestamp with time zone"):
            return Transform(Type("timestamp", (3,)), lambda c: truncated(3)(_utc(c)), _from_utc)
        case ("hive" | "iceberg", "json") | ("hive", "uuid"):
            return Transform(Type("varchar"), lambda c: c, lambda c: c)
        case ("hive" | "iceberg", "sphericalgeography"):
            return Transform(Type("varchar"), geometry_to_wkt, wkt_to_geometry)
    return same


def _row(profile: str, t: Type) -> Transform:
    """A row is built anew, null staying null, if a field changes or, outside memory, has no name."""
    inner = [transform(profile, x) for _, x in t.fields]
    names = [n if n is not None else f"_f{i}" for i, (n, _) in enumerate(t.fields, 1)]
    given = profile != "memory" and any(n is None for n, _ in t.fields)
    stored = [n if n is not None or profile == "memory" else f"f__{i}" for i, (n, _) in enumerate(t.fields, 1)]
    if all(x.is_identity for x in inner) and not given:
        return Transform(t)

    def rebuilt(c: Column, take: list[str], give: list[str], change: list[Expression | None]) -> Column:
        fields = [(f(c[a]) if f else c[a]).alias(b) for a, b, f in zip(take, give, change)]
        return F.when(c.isNotNull(), F.struct(*fields))

    kept = [n if n is not None else m for n, m in zip(stored, names)]
    return Transform(
        Type("row", fields=tuple(zip(stored, (x.stored for x in inner)))),
        lambda c: rebuilt(c, names, kept, [x.store for x in inner]),
        lambda c: rebuilt(c, kept, names, [x.load for x in inner]),
    )


def _sql(profile: str, t: Type, text: str, storing: bool, depth: int = 0) -> str:
    """A Trino expression that stores or loads the value of an expression."""
    if transform(profile, t).is_identity:
        return text
    stored = transform(profile, t).stored
    if t.name == "array":
        x = f"x{depth}"
        return f"TRANSFORM({text}, {x} -> {_sql(profile, t.element, x, storing, depth + 1)})"  # type: ignore[arg-type]
    if t.name == "row":
        fields = [_sql(profile, x, f"{text}[{i}]", storing, depth) for i, (_, x) in enumerate(t.fields, 1)]
        return f"IF({text} IS NULL, NULL, CAST(ROW({', '.join(fields)}) AS {stored if storing else t}))"
    match t.name:
        case "json":
            return f"JSON_FORMAT({text})" if storing else f"JSON_PARSE({text})"
        case "sphericalgeography":
            return f"ST_AsText(to_geometry({text}))" if storing else f"to_spherical_geography(ST_GeometryFromText({text}))"
        case "timestamp with time zone" if stored.name == "timestamp":
            return f"CAST({text} AT TIME ZONE 'UTC' AS {stored})" if storing else f"with_timezone({text}, 'UTC')"
    return f"CAST({text} AS {stored if storing else t})"


def affixes(profile: str, t: Type, storing: bool) -> tuple[str, str]:
    """What to write before and after an expression to store or load it; a row's expression stands several times, so a lambda binds it."""
    if transform(profile, t).is_identity:
        return "", ""
    if t.name == "row":
        return "ELEMENT_AT(TRANSFORM(ARRAY[", f"], r -> {_sql(profile, t, 'r', storing)}), 1)"
    before, _, after = _sql(profile, t, "\0", storing).partition("\0")
    return before, after


def loaded_sql(profile: str, t: Type, text: str) -> str:
    """A Trino expression for the value that a stored expression stands for."""
    before, after = affixes(profile, t, False)
    return before + text + after


def stored_sql(profile: str, t: Type, text: str) -> str:
    before, after = affixes(profile, t, True)
    return before + text + after


def store(profile: str, t: Type, c: Column) -> Column:
    found = transform(profile, t).store
    return found(c) if found else c


def load(profile: str, t: Type, c: Column) -> Column:
    found = transform(profile, t).load
    return found(c) if found else c


def storage_table(profile: str, table: trino.CreateTable, merge: bool = False) -> tuple[list[str], trino.CreateTable]:
    """Statements to run first, and the table as the storage can have it."""
    can = CAPABILITIES[profile]
    if merge and not can["merge"]:
        raise TideError(f"{profile} tables cannot be merged into")
    columns = tuple((n, transform(profile, t).stored, nullable or not can["not_null"], comment) for n, t, nullable, comment in table.columns)
    options = dict(table.options) | (MERGE_OPTIONS[profile] if merge else {})
    first = [f"DROP TABLE IF EXISTS {trino.quote_table(table.name)}"] if table.or_replace and not can["or_replace"] else []
    return first, trino.CreateTable(table.name, columns, table.or_replace and can["or_replace"], tuple(options.items()), table.if_not_exists)


def csv_wrapper(table: trino.CreateTable, location: str, tag: str) -> trino.CreateTable:
    """An all-text table over CSV files in a folder."""
    options = {"format": "csv", "external_location": location, "skip_header_line_count": 1}
    return trino.CreateTable(f"{table.name}_{tag}", tuple((n, Type("varchar"), True, None) for n, *_ in table.columns), options=tuple(options.items()))
