"""Tokens of the small languages that schemas are written in."""

from __future__ import annotations

import re
from dataclasses import dataclass

from ..errors import ParseError, Span


@dataclass(frozen=True)
class Token:
    kind: str  # word, quoted, string, number, mark or end
    text: str
    start: int
    end: int


class Scanner:
    """A cursor over the tokens of a text.  `skip` is what stands between tokens."""

    def __init__(self, source: str, name: str, skip: str, escapes: bool = False):
        self.source, self.name = source, name
        inner = r"(?:[^'\\]|\\.)*" if escapes else r"(?:[^']|'')*"
        double = r"(?:[^\"\\]|\\.)*" if escapes else r"(?:[^\"]|\"\")*"
        rule = re.compile(rf"(?:{skip})*(?:(?P<word>[A-Za-z_$][A-Za-z_0-9$]*)|(?P<quoted>\"{double}\")|(?P<string>'{inner}')|(?P<number>-?\d+(?:\.\d+)?)|(?P<mark>[^\sA-Za-z0-9_\"'])|(?P<end>\Z))", re.S)
        self.tokens, at = [], 0
        while not self.tokens or self.tokens[-1].kind != "end":
            m = rule.match(source, at)
            if m is None:
                raise ParseError(source, name, "cannot read this", Span(at, at + 1, "here"))
            kind = m.lastgroup or "end"
            self.tokens.append(Token(kind, m[kind], m.start(kind), m.end(kind)))
            at = m.end()
        self.at = 0

    @property
    def now(self) -> Token:
        return self.tokens[self.at]

    def fail(self, expected: str, token: Token | None = None) -> ParseError:
        t = token or self.now
        return ParseError(self.source, self.name, f"expected {expected}", Span(t.start, max(t.end, t.start + 1), f"expected {expected}"))

    def next(self) -> Token:
        t = self.now
        self.at += t.kind != "end"
        return t

    def is_mark(self, text: str) -> bool:
        return self.now.kind == "mark" and self.now.text == text

    def take_mark(self, text: str) -> bool:
        if self.is_mark(text):
            self.at += 1
            return True
        return False

    def mark(self, text: str) -> Token:
        if not self.is_mark(text):
            raise self.fail(f"{text!r}")
        return self.next()

    def is_word(self, *words: str) -> bool:
        """Whether the next tokens are these words, in any case."""
        found = self.tokens[self.at : self.at + len(words)]
        return len(found) == len(words) and all(t.kind == "word" and t.text.lower() == w for t, w in zip(found, words))

    def take_words(self, *words: str) -> bool:
        if self.is_word(*words):
            self.at += len(words)
            return True
        return False

    def words(self, *words: str) -> None:
        for w in words:
            if not self.take_words(w):
                raise self.fail(w.upper())

    def string(self) -> str:
        if self.now.kind != "string":
            raise self.fail("a string in single quotes")
        return self.next().text[1:-1].replace("''", "'")

    def number(self) -> int:
        if self.now.kind != "number" or not self.now.text.isdigit():
            raise self.fail("a number")
        return int(self.next().text)

    def identifier(self) -> str:
        if self.now.kind == "word":
            return self.next().text
        if self.now.kind == "quoted" and len(self.now.text) > 2:
            return self.next().text[1:-1].replace('""', '"')
        raise self.fail("a name")

    def listed(self, item, close: str = ")"):
        """Items with commas between them, up to and with the closing mark."""
        out = [item()]
        while self.take_mark(","):
            out.append(item())
        self.mark(close)
        return out
