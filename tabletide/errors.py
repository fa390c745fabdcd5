"""Errors that say where."""

from __future__ import annotations

from dataclasses import dataclass, field


class TideError(Exception):
    """Anything a user can put right."""


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    label: str


@dataclass
class ParseError(TideError):
    """An error in a source text, with the place it is at and places that have to do with it."""

    source: str
    name: str
    message: str
    primary: Span
    secondary: list[Span] = field(default_factory=list)

    def __str__(self) -> str:
        out = [f"{self.name}: {self.message}"]
        for span in (self.primary, *self.secondary):
            start = min(span.start, len(self.source))
            line = self.source.count("\n", 0, start) + 1
            begin = self.source.rfind("\n", 0, start) + 1
            end = self.source.find("\n", start)
            text = self.source[begin : len(self.source) if end < 0 else end]
            width = max(1, min(span.end, begin + len(text)) - start)
            out.append(f"  line {line}, column {start - begin + 1}: {span.label}\n    {text}\n    {' ' * (start - begin)}{'^' * width}")
        return "\n".join(out)
