"""Byte-level BPE by a lazily determinised transducer, and streaming decoding back to text.

A sequence of tokens is what merging by rank makes of its bytes exactly if merging makes each two neighbours of themselves again.  So
each prefix of a text has one last token, which follows from the last tokens of the prefixes that a token may begin at.  A state of the
transducer holds, for each place where a token may still have begun, the bytes since and the last token before; a state's output is the
last token of the prefix that leads to it.  Tokens up to where the ways back from all places meet are certain, which is never
more than a few tokens' lengths back, and are emitted.  States and transitions are made when a byte first asks for them.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids_and_texts, slices, table

#: Splits a text into what is encoded separately: fixed values, as published with the vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Transitions, and pieces with their tokens, that a worker keeps; beyond these it begins anew.
TRANSITIONS, REMEMBERED = 700_000, 600_000
#: Longer pieces aren't remembered, and those beyond LONG_PIECE give their tokens as they are read, in bytes; texts of more characters are split as they are read.
SHORT_PIECE, LONG_PIECE, LONG_TEXT = 64, 1 << 12, 1 << 20
#: Pieces of a long text that are encoded at a time, and tokens that are decoded at a time.
RUN = 1 << 16

#: Stands for the token before the first one.
BEGIN = -1
#: Characters below it are letters, numbers and spaces alike in all versions of Unicode that libraries have.
LATIN = 0x250


def ranks_of(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a .tiktoken file; a token's id is its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, f)))}


def newer_characters(letters: str = r"\p{L}", numbers: str = r"\p{N}") -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Ranges of characters that `regex` takes for letters, or for numbers, and tiktoken's older Unicode tables do not."""
    import tiktoken

    characters = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = []
    for kind in (letters, numbers):
        single = tiktoken.Encoding("bytes", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        known = set(bytes(single.encode_ordinary(characters)).decode())
        codes = np.array(sorted(ord(c) for c in regex.findall(kind, characters) if c not in known), np.int64)
        cuts = np.flatnonzero(np.diff(codes) != 1) + 1
        out.append([(int(x[0]), int(x[-1])) for x in np.split(codes, cuts) if len(x)])
    return out[0], out[1]


def _class(ranges: list[tuple[int, int]]) -> str:
    return f"[{''.join(f'\\U{a:08x}-\\U{b:08x}' for a, b in ranges)}]"


def splitter(newer: tuple[list[tuple[int, int]], list[tuple[int, int]]] = ([], [])):
    """PATTERN, with letters and numbers but for those of `newer`."""

    def without(kind: str, ranges: list[tuple[int, int]]) -> str:
        return f"[{kind}--[{''.join(f'\\U{a:08x}-\\U{b:08x}' for a, b in ranges)}]]" if ranges else kind

    letters, numbers = without(r"\p{L}", newer[0]), without(r"\p{N}", newer[1])
    other = rf"[^\s{letters}{numbers}]" if not any(newer) else rf"[^\s||{letters}||{numbers}]"
    found = PATTERN.replace(r"[^\s\p{L}\p{N}]", "OTHER").replace(r"\p{L}", letters).replace(r"\p{N}", numbers).replace("OTHER", other)
    return regex.compile(found, regex.V1 if any(newer) else 0)


def _latin_splitter():
    """The same for texts whose characters are all below LATIN, which Python's own module splits in half the time."""
    letters, numbers = (regex.findall(kind, "".join(map(chr, range(LATIN)))) for kind in (r"\p{L}", r"\p{N}"))
    spaces = regex.findall(r"\s", "".join(map(chr, range(LATIN))))
    space, letter, number = ("".join(map(re.escape, x)) for x in (spaces, letters, numbers))
    return re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]").replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]").replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]"))


class Transducer:
    """Encodes pieces, a byte at a time."""

    def __init__(self, ranks: dict[bytes, int], transitions: int = TRANSITIONS):
        self.ranks, self.most = ranks, transitions
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.begun = {x: x for token in ranks for n in range(1, len(token)) for x in (token[:n],)}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.fit: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[bytes, float]]] = {}
        self._anew()

    def _anew(self) -> None:
        start = ((b"", BEGIN),)
        # of each state the last token, with which all transitions to it have to do
        self.ids, self.states, self.last, self.moves, self.places = {start: 0}, [start], [BEGIN], {}, {}

    def merged(self, data: bytes, most: int = 1) -> list[bytes]:
        """What merging makes of a short run of bytes: each time the pair of the lowest rank, the first of equals, until none or `most` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > most:
            pairs = [(self.ranks[x], i) for i, x in enumerate(map(bytes.__add__, parts, parts[1:])) if x in self.ranks]
            if not pairs:
                break
            at = min(pairs)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, rank: int, side: int) -> list[tuple[bytes, float]]:
        """The parts that stand, one after another, at a token's first (0) or last (-1) byte while it is made, and the rank at which each is merged.

        The last is the token itself, which nothing merges.
        """
        found = self.edges.get((rank, side))
        if found is None:
            token = self.tokens[rank]
            found = [(token, float("inf"))]
            if len(token) > 1:
                part = self.merged(token, 2)[side]
                below = self._edge(self.ranks[part], side)
                found = [*below[:-1], (part, rank), *found]
            self.edges[rank, side] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side.

        They don't if two parts that meet between them have a token together that is made before either part is merged within its own
        token; of equal ranks the first place is merged first.
        """
        found = self.fit.get(left << 32 | right)
        if found is None:
            ranks, heads, found = self.ranks, self._edge(right, 0), True
            for tail, merged in self._edge(left, -1):
                for head, then in heads:
                    rank = ranks.get(tail + head)
                    if rank is not None and rank < merged and rank <= then:
                        found = False
                        break
            self.fit[left << 32 | right] = found
        return found

    def _move(self, state: int, byte: int) -> int:
        """The next state."""
        grown = [(begun + bytes([byte]), last) for begun, last in self.states[state]]
        for token, last in grown:  # the longest first
            rank = self.ranks.get(token)
            if rank is not None and (last == BEGIN or self.fits(last, rank)):
                break
        else:
            raise ValueError("the ranks hold no token for some byte, or tokens that merging doesn't make")
        same = self.places.setdefault  # places are few beside states
        key = tuple([same((whole, last), (whole, last)) for begun, last in grown if (whole := self.begun.get(begun)) is not None] + [same((b"", rank), (b"", rank))])
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.states)
            self.states.append(key)
            self.last.append(rank)
        self.moves[state << 8 | byte] = to
        return to

    def _back(self, states: list[int], to: int) -> list[int]:
        """The tokens of the first `to` bytes, of which each led to a state."""
        out, last, lengths = [], self.last, self.lengths
        while to:
            token = last[states[to - 1]]
            out.append(token)
            to -= lengths[token]
        out.reverse()
        return out

    def stream(self) -> Stream:
        return Stream(self)

    def encode(self, piece: bytes) -> list[int]:
        """The piece's tokens."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.moves) > self.most:
            self._anew()
        if len(piece) > LONG_PIECE:
            stream = self.stream()
            return [x for at in range(0, len(piece), LONG_PIECE) for x in stream.feed(piece[at : at + LONG_PIECE])] + stream.end()
        state, states, moves = 0, [], self.moves
        for byte in piece:
            state = moves.get(state << 8 | byte) or self._move(state, byte)
            states.append(state)
        return self._back(states, len(states))


class Stream:
    """One piece that arrives in parts: each gives the tokens that are certain with it."""

    def __init__(self, transducer: Transducer):
        self.by, self.state, self.states = transducer, 0, []

    def feed(self, data: bytes) -> list[int]:
        by, state, states = self.by, self.state, self.states
        for byte in data:
            state = by.moves.get(state << 8 | byte) or by._move(state, byte)
            states.append(state)
        self.state = state
        ways = {len(states) - len(begun) for begun, _ in by.states[state]}
        while len(ways) > 1:
            furthest = max(ways)
            ways.remove(furthest)
            ways.add(furthest - by.lengths[by.last[states[furthest - 1]]])
        meet = ways.pop()
        sure = by._back(states, meet)
        del states[:meet]
        return sure

    def end(self) -> list[int]:
        out, self.states, self.state = self.by._back(self.states, len(self.states)), [], 0
        return out


class _Known(dict):
    """Tokens by piece, as 32-bit numbers.  Pieces met lately are kept, and those before them as long as they are met again."""

    def __init__(self, transducer: Transducer, most: int):
        super().__init__()
        self.transducer, self.most, self.older = transducer, most, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            data = piece.encode()
            found = array("i", self.transducer.encode(data)).tobytes()
            if len(data) > SHORT_PIECE:
                return found
        self[piece] = found
        return found

    def rest(self) -> None:
        if len(self) > self.most // 2:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Encodes whole texts, each piece by the transducer."""

    def __init__(self, ranks: dict[bytes, int], newer: tuple = ([], []), remembered: int = REMEMBERED):
        self.transducer, self.latin, self.split_newer = Transducer(ranks), _latin_splitter(), splitter(newer)
        self.beyond = re.compile(f"[{chr(LATIN)}-{chr(0x10FFFF)}]")
        self.known = _Known(self.transducer, remembered)

    def encode(self, text: str) -> np.ndarray:
        split = self.latin if self.beyond.search(text) is None else self.split_newer
        known, found = self.known, []
        if len(text) <= LONG_TEXT:
            found = [b"".join(map(known.__getitem__, split.findall(text)))]
        else:
            pieces = (match[0] for match in split.finditer(text))
            while run := list(islice(pieces, RUN)):
                found.append(b"".join(map(known.__getitem__, run)))
                known.rest()
        known.rest()
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return text_of(ids.tolist(), self.transducer.tokens)


def _utf8_steps() -> list[list[int]]:
    """steps[state][byte]: the next state.  0 is between characters; 1, 2 and 3 want so many bytes more; REJECT means none can follow.

    The states from 4 on are those after a first byte whose second is of a narrower range, as Unicode's table of well-formed
    sequences has it: fixed values.
    """
    narrow = {0xE0: (4, 0xA0, 0xBF, 1), 0xED: (5, 0x80, 0x9F, 1), 0xF0: (6, 0x90, 0xBF, 2), 0xF4: (7, 0x80, 0x8F, 2)}
    steps = [[REJECT] * 256 for _ in range(8)]
    for byte in range(256):
        if byte < 0x80:
            steps[0][byte] = 0
        elif byte in narrow:
            steps[0][byte] = narrow[byte][0]
        elif 0xC2 <= byte <= 0xF3:
            steps[0][byte] = 1 if byte < 0xE0 else 2 if byte < 0xF0 else 3
        elif byte < 0xC0:
            for want in (1, 2, 3):
                steps[want][byte] = want - 1
            for state, low, high, then in narrow.values():
                if low <= byte <= high:
                    steps[state][byte] = then
    return steps


REJECT = 8
STEPS = _utf8_steps()


class Characters:
    """Bytes that arrive in any pieces, as characters: an unfinished one waits, and each longest ill-formed part is one U+FFFD."""

    def __init__(self) -> None:
        self.waiting = b""

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data)
        for at in range(len(data) - 1, max(-1, len(data) - 4), -1):
            if data[at] >= 0xC0 or data[at] < 0x80:  # a first byte; all between it and the end are later ones
                state = 0
                for byte in data[at:]:
                    state = STEPS[state][byte]
                    if state == REJECT:
                        break
                if state not in (0, REJECT):
                    cut = at
                break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        data, self.waiting = self.waiting, b""
        return data.decode("utf-8", "replace")


def text_of(ids: list[int], tokens: dict[int, bytes]) -> str:
    """The text of tokens, decoded run by run."""
    characters, out = Characters(), []
    for at in range(0, len(ids), RUN):
        try:
            out.append(characters.feed(b"".join(map(tokens.__getitem__, ids[at : at + RUN]))))
        except KeyError as e:
            raise ValueError(f"no token has the id {e.args[0]}") from None
    return "".join([*out, characters.end()])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str, newer: tuple) -> Encoder:
    """This process's encoder for a file of ranks."""
    if path not in _encoders:
        _encoders[path] = Encoder(ranks_of(path), newer)
    return _encoders[path]


_IDS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", decoded_col: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids: the tokens of each row's whole text, one row for each row of `docs`.

    `ranks` is the path of a .tiktoken file, which each executor must be able to open; the ids are those that the tiktoken library
    gives with PATTERN and no special tokens.  Null and empty texts have none.  Bytes that are no UTF-8 count as U+FFFD.  Repeated
    rows are encoded each; other columns are ignored; an empty table gives an empty result.  Texts are taken a megabyte at a time; a
    longer one is split as it is read, and time grows with its length alone, also if it is one word.  With `decoded_col` the text that
    the ids decode to comes along, as decode() gives it, without another pass.
    """
    newer = newer_characters()
    schema = _IDS.append(pa.field(decoded_col, pa.string())) if decoded_col else _IDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, newer)
        for batch, raw in slices(batches):
            gc.disable()  # states are many and hold no cycles; looking for some takes a third of the time
            try:
                found = [encoder.encode(x.decode("utf-8", "replace")) for x in raw]
            finally:
                gc.enable()
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            ids = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32), np.concatenate(found))
            yield table(schema, batch.column(0), pa.array(lengths), ids, *([pa.array(list(map(encoder.decode, found)), pa.string())] if decoded_col else []))

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>" + (f", `{decoded_col}` string" if decoded_col else ""))


def decode(encoded: DataFrame, ranks: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """`encoded` with the text of its tokens in `text_col`, in place of `ids_col`; null for null.

    Tokens are decoded in runs, and characters whose bytes lie in two runs are put together; bytes that are no UTF-8 become U+FFFD.
    An id that the ranks don't have, or a null one, is an error that names it.  A column already called `text_col` is replaced, as
    with withColumn; all others stay.
    """
    others = [c for c in encoded.columns if c not in (ids_col, text_col)]
    frame = encoded.select(*[encoded[c] for c in others], encoded[ids_col].cast("array<int>").alias(ids_col))
    schema = frame.drop(ids_col).withColumn(text_col, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in ranks_of(ranks).items()}
        for batch in batches:
            *rest, ids = batch.columns
            offsets, values = np.asarray(ids.offsets), ids.values
            there, at = ids.is_valid().to_pylist(), 0
            while at < batch.num_rows:  # rows with about a million tokens
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 20), "right")) - 1)
                rows = [values.slice(offsets[i], offsets[i + 1] - offsets[i]).to_pylist() if there[i] else None for i in range(at, to)]
                texts = pa.array([None if x is None else text_of(x, tokens) for x in rows], pa.string())
                yield pa.RecordBatch.from_arrays([*[c.slice(at, to - at) for c in rest], texts], names=[*batch.schema.names[:-1], text_col])
                at = to

    return frame.mapInArrow(run, schema)
