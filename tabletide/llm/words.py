"""Words of many texts at once, as 64-bit hashes, with numpy on the UTF-8 bytes.

A text's words are runs of bytes that are not separators.  Every separator used in this package is an ASCII byte, and UTF-8 never
uses ASCII bytes inside a longer character, so the byte runs are exactly the character runs.

A word's length is scrambled first, and then its bytes, eight at a time; of words longer than LONG bytes the hash is a BLAKE2 hash.  No
sum of length and bytes comes in unscrambled, so none can cancel another, and each seed scrambles with multipliers of its own, so words
that collide under one of them don't for that reason collide under the other.  Runs of words are hashed in the same way.  A hash depends
on the bytes and the seed alone, so it is the same in every process, on every machine.
"""

from __future__ import annotations

import hashlib

import numpy as np

U64 = np.uint64
#: Odd numbers that states are multiplied with.
ODD, LENGTH = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
#: Words beyond so many bytes are hashed one by one.
LONG = 256
#: Bytes hashed at a time; the temporary arrays take about 40 bytes for each of them.
PIECE = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, for texts whose A-Z is already lower case.
_NOT_ALNUM = np.zeros(256, bool)
_NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
SEPARATORS = {"space": _SPACE, "alnum": _NOT_ALNUM}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_BYTES = _LOWER.tobytes()
#: The bytes of a little-endian number that belong to a word with so many left.
_LEFT = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


#: Shifts and multipliers of two published 64-bit finalisers, for the seeds 0 and 1.
SCRAMBLERS = (((33, 33, 33), (U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53))), ((30, 27, 31), (U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB))))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A one-to-one scrambling of 64 bits, in place."""
    (first, second, third), (a, b) = SCRAMBLERS[seed]
    x ^= x >> U64(first)
    x *= a
    x ^= x >> U64(second)
    x *= b
    x ^= x >> U64(third)
    return x


def _spans(separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs that are not separators."""
    edge = np.diff(np.concatenate(([True], separator, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, as one number; zeros follow the last."""
    return np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))).data, strides=(1,))


def _hash_piece(data: np.ndarray, separator: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = _spans(separator)
    if not len(starts):
        return np.zeros(0, U64), starts, ends
    length = ends - starts
    eight = _eights(data)
    found = mix((length.astype(U64) + U64(seed + 1)) * LENGTH, seed)
    found = mix((found ^ (eight[starts] & _LEFT[np.minimum(length, 8)])) * ODD, seed)
    more, done = np.flatnonzero(length > 8), 8
    while len(more) and done < LONG:
        left = length[more] - done
        found[more] = mix((found[more] ^ (eight[starts[more] + done] & _LEFT[np.minimum(left, 8)])) * ODD, seed)
        done += 8
        more = more[left > 8]
    for i in more.tolist():
        found[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return found, starts, ends


def hash_words(data: bytes, kind: str, lower: bool, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the words of `data`, and where each begins and ends in it.

    Long inputs are hashed in pieces that end at a separator, so the memory used doesn't follow the length of a text; only a single
    word longer than PIECE makes a longer piece.
    """
    table = SEPARATORS[kind]
    whole = np.frombuffer(data.translate(_LOWER_BYTES) if lower else data, np.uint8)
    if len(whole) <= PIECE:
        return _hash_piece(whole, table[whole], seed)
    parts, at = [], 0
    while at < len(whole):
        to = min(at + PIECE, len(whole))
        if to < len(whole):
            back = np.flatnonzero(table[whole[at:to]])
            if len(back):
                to = at + int(back[-1]) + 1
            else:
                while to < len(whole) and not table[whole[to]]:
                    to += 1
        found, starts, ends = _hash_piece(whole[at:to], table[whole[at:to]], seed)
        parts.append((found, starts + at, ends + at))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def lowered(text: bytes) -> bytes:
    """A-Z lower-cased, all else as it is."""
    return text.translate(_LOWER_BYTES)


def encoded(text: str | bytes | None) -> bytes:
    """UTF-8 bytes; none for null."""
    if text is None:
        return b""
    return text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")


class Batch:
    """The words of several texts: `hashes`, `starts` and `ends` in `data`, and for text i the words first[i] to first[i + 1]."""

    def __init__(self, texts: list[bytes], kind: str, lower: bool):
        self.data = b"\n".join(texts) + b"\n"
        lengths = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        self.kind, self.lower = kind, lower
        self.hashes, self.starts, self.ends = hash_words(self.data, kind, lower)
        self.first = np.searchsorted(self.starts, self.offsets)

    def second(self) -> np.ndarray:
        """Further hashes of the words, which depend on the first ones in nothing."""
        return hash_words(self.data, self.kind, self.lower, 1)[0]

    def stems(self, size: int) -> np.ndarray:
        """Hashes of the first `size` bytes, at most 8, of each word; shorter words are their own stems."""
        data = np.frombuffer(lowered(self.data) if self.lower else self.data, np.uint8)
        return mix((_eights(data)[self.starts] & _LEFT[np.minimum(self.ends - self.starts, size)]) * ODD + U64(size))

    def words(self, a: int, b: int) -> list[bytes]:
        return [self.data[s:e] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n consecutive words, in order; empty if there are fewer words.

    Runs of 2, 4, 8 ... words are hashed from two halves each, and those whose lengths add up to n are put together.
    """
    if n < 1 or len(hashes) < n:
        return np.zeros(0, U64)
    count, run, span, done = len(hashes) - n + 1, hashes, 1, 0
    found = np.full(count, n, U64)
    while True:
        if n & span:
            found = mix(found * ODD + run[done : done + count])
            done += span
        span *= 2
        if span > n:
            return found
        half = span // 2
        run = mix(run[:-half] * LENGTH + run[half:])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The position of the smallest of each `width` consecutive values, the last one of equals; the distinct positions, ascending.

    Doubling: the minimum over 2**j values from two minima over half as many.
    """
    if len(values) == 0:
        return np.zeros(0, np.int64)
    width = min(width, len(values))
    at = np.arange(len(values), dtype=np.int64)
    span = 1
    while span * 2 <= width:
        left, right = at[: len(at) - span], at[span:]
        at = np.where(values[right] <= values[left], right, left)
        span *= 2
    if span < width:
        left, right = at[: len(values) - width + 1], at[width - span : width - span + len(values) - width + 1]
        at = np.where(values[right] <= values[left], right, left)
    return at
