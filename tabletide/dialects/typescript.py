"""A subset of TypeScript's interfaces and type aliases, as schemas."""

from __future__ import annotations

from dataclasses import dataclass

from .. import schema as S
from ..errors import ParseError, Span, TideError
from ..schema import Column, DataType, Schema, Table
from .scanner import Scanner, Token

_SKIP = r"\s|//[^\n]*(?:\n|\Z)|/\*.*?\*/"

#: What the built-in names stand for.
BUILT_IN = {"any": S.JSON, "boolean": S.BOOL, "Date": S.TIMESTAMPTZ, "number": S.FLOAT64, "string": S.TEXT}
#: Aliases of these names have types of their own, whatever they are defined as.
MAGIC = {"decimal": S.DECIMAL, "int16": S.INT16, "int32": S.INT32, "int64": S.INT64}


@dataclass(frozen=True)
class Named:
    name: str
    at: Token


@dataclass(frozen=True)
class ArrayOf:
    element: object


@dataclass(frozen=True)
class Union:
    """A union of types and string constants."""

    options: tuple[object, ...]
    at: Token


@dataclass(frozen=True)
class Interface:
    fields: tuple[tuple[str, object, bool], ...]


class Source:
    """The definitions in a file, by name."""

    def __init__(self, source: str, name: str = "TypeScript"):
        self.s = s = Scanner(source, name, _SKIP, escapes=True)
        self.definitions: dict[str, tuple[Token, object]] = {}
        while s.now.kind != "end":
            if s.take_mark(";"):
                continue
            s.take_words("export")
            if s.take_words("interface"):
                at, title = s.now, s.identifier()
                value: object = self._interface()
            elif s.take_words("type"):
                at, title = s.now, s.identifier()
                s.mark("=")
                value = self._type()
                s.mark(";")
            else:
                raise s.fail("an interface or a type")
            if title in self.definitions or title in BUILT_IN:
                earlier = [Span(o.start, o.end, "first here") for o, _ in [self.definitions[title]]] if title in self.definitions else []
                raise ParseError(source, name, f"{title} is defined twice", Span(at.start, at.end, "again here"), earlier)
            self.definitions[title] = (at, value)

    def _interface(self) -> Interface:
        s, fields, seen = self.s, [], {}
        s.mark("{")
        while not s.take_mark("}"):
            at = s.now
            name = s.identifier() if s.now.kind != "string" else s.string()
            if name in seen:
                raise ParseError(s.source, s.name, f"the field {name} is defined twice", Span(at.start, at.end, "again here"), [Span(seen[name].start, seen[name].end, "first here")])
            seen[name] = at
            optional = s.take_mark("?")
            s.mark(":")
            fields.append((name, self._type(), optional))
            if not (s.take_mark(",") or s.take_mark(";")) and not s.is_mark("}"):
                raise s.fail("',' or ';'")
        return Interface(tuple(fields))

    def _type(self) -> object:
        s, at = self.s, self.s.now
        s.take_mark("|")
        options = [self._one()]
        while s.take_mark("|"):
            options.append(self._one())
        return options[0] if len(options) == 1 else Union(tuple(options), at)

    def _one(self) -> object:
        s = self.s
        if s.is_mark("{"):
            out: object = self._interface()
        elif s.take_mark("("):
            out = self._type()
            s.mark(")")
        elif s.now.kind in ("string", "quoted"):
            out = s.next().text[1:-1]
        else:
            at = s.now
            out = Named(s.identifier(), at)
        while s.take_mark("["):
            s.mark("]")
            out = ArrayOf(out)
        return out

    def _fail(self, at: Token, message: str) -> ParseError:
        return ParseError(self.s.source, self.s.name, message, Span(at.start, at.end, "here"))

    def data_type(self, value: object, path: tuple[str, ...] = ()) -> tuple[DataType, bool]:
        """The portable type, and whether null is one of the values."""
        match value:
            case ArrayOf(element):
                inner, _ = self.data_type(element, path)
                return S.Array(inner), False
            case Interface(fields):
                return S.Struct(tuple(S.StructField(n, *self._field(t, optional, path)) for n, t, optional in fields)), False
            case str():
                return S.OneOf((value,)), False
            case Union(options, at):
                rest = [o for o in options if not (isinstance(o, Named) and o.name in ("null", "undefined"))]
                nullable = len(rest) < len(options)
                if rest and all(isinstance(o, str) for o in rest):
                    return S.OneOf(tuple(rest)), nullable  # type: ignore[arg-type]
                if len(rest) != 1:
                    raise self._fail(at, "a union can only be of one type and null, or of strings")
                inner, also = self.data_type(rest[0], path)
                return inner, nullable or also
            case Named(name, at):
                if name in ("null", "undefined"):
                    raise self._fail(at, f"{name} is no type by itself")
                if name in BUILT_IN:
                    return BUILT_IN[name], False
                if name not in self.definitions:
                    raise self._fail(at, f"{name} is not defined")
                if name in path:
                    raise self._fail(at, f"{name} is defined by itself")
                if name in MAGIC and not isinstance(self.definitions[name][1], Interface):
                    return MAGIC[name], False
                return self.data_type(self.definitions[name][1], (*path, name))
        raise TypeError(value)

    def _field(self, t: object, optional: bool, path: tuple[str, ...]) -> tuple[DataType, bool]:
        data_type, nullable = self.data_type(t, path)
        return data_type, nullable or optional


def parse(source: str, interface: str, name: str = "TypeScript") -> Schema:
    """The table that an interface describes; everything it uses is written out in its columns."""
    found = Source(source, name)
    if interface not in found.definitions:
        raise TideError(f"{name} does not define {interface}")
    value = found.definitions[interface][1]
    if not isinstance(value, Interface):
        raise TideError(f"{interface} in {name} has to be an interface")
    struct, _ = found.data_type(value, (interface,))
    assert isinstance(struct, S.Struct)
    return Schema(Table(interface, tuple(Column(f.name, f.data_type, f.is_nullable) for f in struct.fields)))
