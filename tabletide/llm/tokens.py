"""Token counts, by encoding batches and keeping lengths only."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import ids_and_texts, slices, table

#: The pre-tokens of byte-level BPE vocabularies of this kind: fixed values, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class is the same in every Unicode version and regular-expression library.
PLAIN = r"[\x09-\x0D\x20-\x7E\xA1-\u024F]*"
#: Pre-tokens whose lengths a worker remembers; beyond it the memory is begun anew.
REMEMBERED = 400_000
#: Characters of a text that are encoded at a time.
PART = 1 << 16

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
_SAFE = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def parts(text: str, size: int = PART) -> Iterator[str]:
    """`text` cut before single spaces between letters: a pre-token begins there, and no special token holds a space, so the parts' tokens are the text's."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Counter:
    """Lengths in tokens of whole texts, as `tokenizers` gives them without added tokens.

    A byte-level BPE never merges across pre-tokens, so a text's length is the sum of its pre-tokens', and the library encodes each
    distinct pre-token once.  Texts with other characters than plain ones go through the library whole, part by part.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            about = json.load(f)
        splitter = about.get("pre_tokenizer") or {}
        self.by_pieces = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space") and not about.get("normalizer")
        added = about.get("added_tokens") or []
        self.by_pieces = self.by_pieces and not any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added)
        self.cut_safely = self.by_pieces and not any(" " in x["content"] for x in added)
        self.special = regex.compile("|".join(regex.escape(x["content"]) for x in added)) if added else None
        self.pieces, self.plain = regex.compile(PATTERN), regex.compile(PLAIN)
        self.known: dict[str, int] = {}

    def encoded(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def count(self, texts: list[str]) -> list[int]:
        out, whole, found = [0] * len(texts), [], []
        for i, text in enumerate(texts):
            for part in parts(text) if self.cut_safely else (text,):
                if not self.by_pieces or self.plain.fullmatch(part) is None or self.special is not None and self.special.search(part):
                    whole.append((i, part))
                else:
                    found.append((i, self.pieces.findall(part)))
        new = list(set().union(*(p for _, p in found)).difference(self.known)) if found else []
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(set().union(*(p for _, p in found)))
        for a in range(0, len(new), 4096):
            self.known.update(zip(new[a : a + 4096], self.encoded(new[a : a + 4096])))
        for i, p in found:
            out[i] += sum(map(self.known.__getitem__, p))
        for (i, _), n in zip(whole, self.encoded([x for _, x in whole])):
            out[i] += n
        return out


#: Characters of the parts that a text is put together from when it is cut.
SMALL_PART = 256


def pieces(counter: Counter, text: str, most: int) -> list[tuple[int, str, int]]:
    """`text` cut in consecutive pieces of at most `most` tokens each: start in characters, piece, and tokens.

    Cuts come at safe boundaries, where the pieces' tokens are the text's; only a part without one that is too long by itself is cut
    between any two characters.  A single character may have more tokens than `most`.
    """
    if (n := counter.count([text])[0]) <= most:
        return [(0, text, n)]
    small = list(parts(text, SMALL_PART)) if counter.cut_safely else [text]
    stack, out, at = list(zip(small, counter.count(small)))[::-1], [], 0
    held, size = "", 0
    while stack:
        part, n = stack.pop()
        if n > most and len(part) > 1:
            half = [part[: len(part) // 2], part[len(part) // 2 :]]
            stack.extend(list(zip(half, counter.count(half)))[::-1])
            continue
        whole = size + n if counter.cut_safely and n <= most and _SAFE.match(held[-1:] + part[:2], 1) else (counter.count([held + part])[0] if held else n)
        if held and whole > most:
            out.append((at, held, size))
            at, held, whole = at + len(held), "", n
        held, size = held + part, whole
    return [*out, (at, held, size)]


_counters: dict[str, Counter] = {}


def counter_of(tokenizer: str) -> Counter:
    """This process's counter for a tokenizer's file."""
    counter = _counters.get(tokenizer)
    if counter is None:
        counter = _counters[tokenizer] = Counter(tokenizer)
    return counter


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit): one row for each row of `docs`, over whole texts.

    `tokenizer` is the path of a tokenizers .json file, which each executor must be able to open.  Null counts as empty, with 0
    tokens.  The strings of special tokens inside texts count as that library counts them by default.  Repeated rows are counted
    each; other columns are ignored; an empty table gives an empty result.  Only lengths leave the workers, and texts are taken in
    batches of about a megabyte, long ones in parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(tokenizer)
        for batch, raw in slices(batches):
            n = counter.count([x.decode("utf-8", "replace") for x in raw])
            yield table(_SCHEMA, batch.column(0), list(map(len, raw)), n, list(map(int.__gt__, n, repeat(limit))))

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
