"""Exact duplicates, by Patricia tries.

Texts are dealt out by length and content hash.  A task inserts the full byte strings of its part, each after its length and hash, into
one compressed radix trie, whose terminal nodes hold the smallest identifier and the number of rows.  Beyond what a task may hold,
subtrees are written out and taken away, largest ones first; the part comes sorted by length and hash, so those subtrees are whole.

A trie of the texts themselves runs before the shuffle, so a text that a third of all rows share is shuffled once for each task, not once
for each row; there, what is left of a subtree that was written out is merged after the shuffle.  Tries compare bytes; rows then find
their text's owner by its SHA-256, which the result has anyway.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, ids_and_texts

#: Bytes that a task's trie holds; beyond it subtrees are written out until half of that is left.
HELD_BYTES = 16 << 20
#: About what a node takes besides its label.
NODE_BYTES = 400
#: A group counts as hot, and is joined by a broadcast, if it has over one in so many of all rows; so there are fewer hot groups than this.
HOT_SHARE = 1000

#: White space runs that one space replaces; a single space stays as it is.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


class Trie:
    """A compressed radix trie over bytes.  A node is [label, children by first byte, owner, bytes below]; an owner is [smallest id, rows]."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root: list = [b"", {}, None, 0]

    @property
    def size(self) -> int:
        return self.root[3]

    def add(self, key: bytes, owner: int | None, rows: int) -> bool:
        """Whether the key is new."""
        node, at, path = self.root, 0, [self.root]
        while True:
            if at == len(key):
                break
            child = node[1].get(key[at])
            if child is None:
                child = node[1][key[at]] = [key[at:], {}, None, 0]
                at = len(key)
            elif key.startswith(child[0], at):
                at += len(child[0])
            else:  # the label is cut where the key leaves it
                same = _shared(child[0], key, at)
                lower = [child[0][same:], child[1], child[2], child[3]]
                child[:] = [child[0][:same], {lower[0][0]: lower}, None, child[3]]
                at += same
            path.append(child)
            node = child
        held = node[2]
        if held is None:
            node[2] = [owner, rows]
            for x in path:
                x[3] += len(key) + NODE_BYTES
            return True
        held[0] = owner if held[0] is None else held[0] if owner is None else min(held[0], owner)
        held[1] += rows
        return False

    @staticmethod
    def _below(head: bytes, node: list) -> Iterator[tuple[bytes, int | None, int]]:
        stack = [(head, node)]
        while stack:
            head, node = stack.pop()
            key = head + node[0]
            if node[2] is not None:
                yield key, *node[2]
            stack.extend((key, x) for x in node[1].values())

    def items(self) -> Iterator[tuple[bytes, int | None, int]]:
        return self._below(b"", self.root)

    def spilled(self, limit: int) -> Iterator[tuple[bytes, int | None, int]]:
        """Takes subtrees away until at most `limit` bytes are left: the largest one that isn't most of the trie, or else of its largest child."""
        while self.root[3] > limit:
            path, head = [self.root], b""
            if not self.root[1]:
                yield from self._below(b"", self.root)
                self.root = [b"", {}, None, 0]
                return
            while True:
                child = max(path[-1][1].values(), key=lambda x: x[3])
                if not child[1] or child[3] * 2 <= self.root[3]:
                    break
                head += child[0]
                path.append(child)
            del path[-1][1][child[0][0]]
            for x in path:
                x[3] -= child[3]
            yield from self._below(head, child)


def _shared(label: bytes, key: bytes, at: int) -> int:
    """How many bytes `label` and `key` from `at` have in common, by halving; they differ somewhere."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == key[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


_LOCAL = pa.schema([("length", pa.int64()), ("hash", pa.int64()), ("text", pa.binary()), ("owner", pa.int64()), ("n", pa.int64())])
_OWNERS = pa.schema([("sha", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _rows(rows: list[tuple], schema: pa.Schema, at_a_time: int = 256) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), at_a_time):
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows[i : i + at_a_time]), schema)], schema=schema)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct texts of a task with smallest ids and counts, from rows (doc_id, text, hash)."""
    trie, hashes = Trie(), {}

    def out(items):
        done = []
        for text, owner, n in items:
            done.append((len(text), hashes.pop(text), text, owner, n))
            if len(done) == 256:
                yield from _rows(done, _LOCAL)
                done = []
        yield from _rows(done, _LOCAL)

    for batch in batches:
        for owner, text, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if trie.add(text, owner, 1):
                hashes[text] = key
                if trie.size > HELD_BYTES:
                    yield from out(trie.spilled(HELD_BYTES // 2))
    yield from out(trie.items())


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owners, from rows sorted by length and hash, which are the first sixteen bytes of their place in the trie."""
    trie, now, done = Trie(), None, []

    def out(items, least):
        for key, owner, n in items:
            done.append((hashlib.sha256(key[16:]).hexdigest(), owner, n))
            if len(done) == 4096:
                yield from _rows(done, _OWNERS, 4096)
                done.clear()
        if len(done) >= least:
            yield from _rows(done, _OWNERS, 4096)
            done.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            length, key, text, owner, n = (batch.column(c)[i].as_py() for c in range(5))
            if (length, key) != now:
                now = (length, key)
                if trie.size > HELD_BYTES:
                    yield from out(trie.spilled(HELD_BYTES // 2), 4096)
            trie.add(struct.pack(">qq", length, key) + text, owner, n)
    yield from out(trie.items(), 1)


def digest(text: Column) -> Column:
    """The text_sha256 that exact_duplicates() gives a text."""
    return F.sha2(F.encode(_plain(text), "UTF-8"), 256)


def _plain(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of `docs`, with the owner of its text.

    Two texts are equal if they are the same bytes once each run of white space is one space; null counts as empty.  Of equal texts
    the smallest id is the owner.  Ids that are null never own a text that has another id; a group of null ids only has a null
    keep_id, and all its rows are kept.  A row that is repeated with its id counts each time in group_size and is kept each time.
    Very long texts are compared whole.  An empty table gives an empty result.  Other columns are ignored.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    rows = rows.select("doc_id", _plain(F.col("text")).alias("text"))
    local = rows.select("doc_id", F.encode("text", "UTF-8").alias("text"), F.xxhash64("text").alias("hash")).mapInArrow(_local, "length long, hash long, text binary, owner long, n long")
    owners = checkpoint(local.repartition("length", "hash").sortWithinPartitions("length", "hash").mapInArrow(_merged, "sha string, keep_id long, group_size long"))
    total = owners.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("group_size") * HOT_SHARE > total
    hot = owners.where(is_hot).select("sha", F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size"))
    named = rows.select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
    named = named.join(F.broadcast(hot), F.col("text_sha256") == F.col("sha"), "left").drop("sha")
    # rows of hot groups look for nothing in the second join, and their keys are spread
    key = F.when(F.col("hot_size").isNull(), F.col("text_sha256")).otherwise(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    found = named.withColumn("key", key).join(owners.where(~is_hot), F.col("key") == F.col("sha"), "left")
    keep = F.when(F.col("hot_size").isNull(), F.col("keep_id")).otherwise(F.col("hot_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("hot_size", "group_size").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
