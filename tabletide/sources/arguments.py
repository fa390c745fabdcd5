"""Arguments of drivers: `a=b`, `a.b=c`, `a[b]=c`, `a[]=x`, and which kinds of arguments a driver takes."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from ..errors import ParseError, Span, TideError
from ..operators.merge import parse_keys

_NAME = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")
_PART = re.compile(r"\.([A-Za-z_][A-Za-z_0-9]*)|\[([A-Za-z_][A-Za-z_0-9]*)\]")


def _path(argument: str) -> tuple[list[str | None], list[Span], str]:
    """The parts of an argument's name, None for a list's end, where they are, and the value."""
    fail = lambda at, what: ParseError(argument, "driver argument", f"expected {what}", Span(at, at + 1, f"expected {what}"))
    m = _NAME.match(argument)
    if m is None:
        raise fail(0, "a name")
    path: list[str | None] = [m[0]]
    spans = [Span(m.start(), m.end(), "conflict here")]
    at = m.end()
    while m := _PART.match(argument, at):
        path.append(m[1] or m[2])
        spans.append(Span(m.start(), m.end(), "conflict here"))
        at = m.end()
    if argument.startswith("[]", at):
        path.append(None)
        spans.append(Span(at, at + 2, "conflict here"))
        at += 2
    if not argument.startswith("=", at):
        raise fail(at, "'='")
    return path, spans, argument[at + 1 :]


def parse(arguments: Iterable[str]) -> dict:
    """A nested object of all arguments; a value that is set twice, or as two kinds of thing, is an error."""
    out: dict = {}
    for argument in arguments:
        path, spans, value = _path(argument)
        place: dict | list = out
        for part, following, span in zip(path, [*path[1:], ""], spans):
            last = span is spans[-1]
            conflict = ParseError(argument, "driver argument", "this does not go with earlier arguments", span)
            if part is None:
                if not isinstance(place, list):
                    raise conflict
                place.append(value)
                break
            if not isinstance(place, dict) or last and part in place:
                raise conflict
            if last:
                place[part] = value
            else:
                place = place.setdefault(part, [] if following is None else {})
    return out


@dataclass(frozen=True)
class IfExists:
    """What to do if the destination exists: error, append, overwrite, or upsert on keys."""

    mode: str = "error"
    keys: tuple[str, ...] = ()

    @classmethod
    def parse(cls, text: str) -> IfExists:
        if text in ("error", "append", "overwrite"):
            return cls(text)
        if text.startswith("upsert-on:"):
            return cls("upsert", tuple(parse_keys(text[len("upsert-on:") :])))
        raise TideError(f"--if-exists can be error, append, overwrite or upsert-on:KEY,..., not {text!r}")

    def __str__(self) -> str:
        return f"upsert-on:{','.join(self.keys)}" if self.mode == "upsert" else self.mode

    @property
    def write_disposition(self) -> str:
        """BigQuery's word for it."""
        found = {"error": "WRITE_EMPTY", "append": "WRITE_APPEND", "overwrite": "WRITE_TRUNCATE"}.get(self.mode)
        if found is None:
            raise TideError("a load job cannot upsert")
        return found


@dataclass(frozen=True)
class SourceArguments:
    where: str | None = None
    format: str | None = None
    arguments: dict = field(default_factory=dict)


@dataclass(frozen=True)
class DestinationArguments:
    if_exists: IfExists = IfExists()
    format: str | None = None
    arguments: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Features:
    """What a driver can do."""

    schema: bool = False
    write_schema: frozenset[str] = frozenset()
    count: bool = False
    read: bool = False
    write: bool = False
    source: frozenset[str] = frozenset()
    destination: frozenset[str] = frozenset()
    if_exists: frozenset[str] = frozenset()
    unstable: bool = False

    def check_source(self, scheme: str, a: SourceArguments) -> None:
        for name, given in (("--where", a.where), ("--from-format", a.format), ("--from-arg", a.arguments)):
            if given and name not in self.source:
                raise TideError(f"{scheme} does not take {name}")

    def check_destination(self, scheme: str, a: DestinationArguments) -> None:
        for name, given in (("--to-format", a.format), ("--to-arg", a.arguments)):
            if given and name not in self.destination:
                raise TideError(f"{scheme} does not take {name}")
        if a.if_exists.mode not in self.if_exists:
            raise TideError(f"{scheme} does not support --if-exists={a.if_exists}")

    def describe(self) -> str:
        lines = []
        modes = lambda names: " ".join(f"--if-exists={m}" if m != "upsert" else "--if-exists=upsert-on:COL" for m in ("error", "append", "overwrite", "upsert") if m in names)
        takes = lambda names: " ".join(sorted(names))
        if self.schema:
            lines.append("- conv FROM")
        if self.write_schema:
            lines += ["- conv TO:", f"  {modes(self.write_schema)}"]
        if self.count:
            lines += ["- count", *([f"  {takes(self.source)}"] if self.source else [])]
        if self.read:
            lines += ["- cp FROM:", *([f"  {takes(self.source)}"] if self.source else [])]
        if self.write:
            lines += ["- cp TO:", *([f"  {takes(self.destination)}"] if self.destination else []), *([f"  {modes(self.if_exists)}"] if self.if_exists else [])]
        return "\n".join(lines) + "\n"
