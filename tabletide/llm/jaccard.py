"""Similar documents by the Jaccard similarity of their word n-grams: a size-aware join.

Small sets are light: for every size a partner may have, a set enumerates its subsets of the fixed size that the two must share, and
equal subsets meet.  Large sets are heavy: each is entered in the inverted lists of its rarest n-grams, as many as two similar sets
cannot differ in, and the lists are scanned.  The boundary between light and heavy is the size from which enumerating costs more than
the lists.  How rare an n-gram is comes from counts over all documents; n-grams that occur once need no list.

What meets is only a candidate.  Candidates are gathered in clusters, whole texts are fetched for those alone, and within a cluster sets
are compared until all links that can join two components have been decided.  A large cluster is split in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import checkpoint, ids_and_texts, partitions, slices
from .components import connected, smallest_labels
from .words import Batch, encoded, grams, mix

#: What an entry in an inverted list costs against an enumerated subset: its key is one n-gram, so more sets meet by chance.
LIST_COST = 4
#: n-grams on more sets than this count as equally frequent.
FREQUENT = 64
#: Records that a task holds before it deals them out.
HELD = 1 << 20
#: Sets, and n-grams of theirs, that are compared in one task at a time; a larger cluster is split in blocks of about half as many.
BLOCK_SETS = 256
BLOCK_GRAMS = 2_000_000
#: Sets of a split cluster that all its blocks see.
PIVOTS = 32
#: The blocks that what is left is compared with: at least so many.
LEAST_BLOCKS = 16

U64 = np.uint64


class Rule:
    """Similarity of at least num / den, in whole numbers."""

    def __init__(self, words: int, num: int, den: int):
        if not 0 < num <= den or words < 1:
            raise ValueError("the similarity must be above 0 and at most 1, of one word or more")
        self.words, self.num, self.den = words, num, den
        light = lambda s: sum(math.comb(s, c) for c in self.shared_sizes(s, s + s))
        self.boundary = next(s for s in range(1, 1000) if light(s) > LIST_COST * self.lists(s))

    def similar(self, both: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int):
        return self.den * both >= self.num * (a + b - both)

    def overlap(self, a: int, b: int) -> int:
        """The n-grams that similar sets of these sizes share, at least."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def shared_sizes(self, size: int, below: int) -> set[int]:
        """For sets of this size, sizes of subsets to enumerate, given partners of sizes under `below`."""
        least, most = -(-self.num * size // self.den), self.den * size // self.num
        return {self.overlap(size, b) for b in range(max(1, least), min(most + 1, below)) if self.overlap(size, b) <= min(size, b)}

    def lists(self, size):
        """In how many lists a set is entered: similar sets share one of that many rarest n-grams, whatever the order."""
        return size - -(-self.num * size // self.den) + 1

    def is_heavy(self, size: int) -> bool:
        """Whether a set is entered in lists: it is large, or a large one may be similar."""
        return size * self.den >= self.boundary * self.num

    def subsets(self, found: np.ndarray) -> np.ndarray:
        """The keys of the subsets that a light set enumerates, given its n-grams."""
        size, out = len(found), []
        if size < self.boundary:
            mixed = mix(found ^ U64(0x5851F42D4C957F2D))
            for c in sorted(self.shared_sizes(size, self.boundary)):
                # the sum of a subset's mixed n-grams, from the sum of all less those left out
                left = np.array(list(combinations(range(size), size - c)), np.int64).reshape(math.comb(size, c), size - c)
                sums = mixed.sum(dtype=U64, keepdims=True) - mixed[left].sum(1, dtype=U64)
                out.append(mix(sums + U64(c * 0x9E3779B97F4A7C15 % (1 << 64))))
        return np.concatenate(out) if out else np.zeros(0, U64)


def sets_of(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The distinct n-grams of each text, ascending: of lower-cased words, the whole sequence as one if there are fewer than n."""
    batch, out = Batch(texts, "space", True), []
    for a, b in zip(batch.first[:-1].tolist(), batch.first[1:].tolist()):
        found = grams(batch.hashes[a:b], min(n, b - a))
        out.append(np.unique(found ^ U64(b - a) if b - a < n else found))
    return out


def node_of(found: np.ndarray) -> int:
    """A set's identity: equal sets are one node."""
    value = mix(np.array([mix(found.copy()).sum(dtype=U64) + U64(len(found))], U64))[0]
    return int(value.astype(np.int64))


_FACTS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("digest", pa.int64())])


def _facts(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            own = sets_of(texts, rule.words)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([len(x) for x in own], pa.int64()), pa.array([node_of(x) for x in own], pa.int64()), rows.column(2)], schema=_FACTS)

    return run


def _part(node: np.ndarray, parts: int) -> np.ndarray:
    return (node.view(U64) % U64(parts)).astype(np.int32)


def _count(rule: Rule, parts: int):
    """Each set's n-grams, dealt out to be counted (0), with its size (2), and the keys of its subsets (3).

    An n-gram that FREQUENT of a task's sets have is frequent, however many others have it; it is dealt out once for the task (1), and
    the sets are told at once (4).  So a passage that a third of all documents share makes few rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        count, seen = 0, set()

        def flush():
            heavy = [(n, x) for n, x in held if rule.is_heavy(len(x))]
            light = [(n, k) for n, x in held if len(k := rule.subsets(x))]
            if heavy:
                size = np.array([len(x) for _, x in heavy])
                node, gram = np.repeat(np.array([n for n, _ in heavy], np.int64), size), np.concatenate([x for _, x in heavy])
                part, short = (gram % U64(parts)).astype(np.int32), (gram >> U64(32)).astype(np.uint32)
                name = short.astype(U64) << U64(32) | part.astype(U64)
                order = np.argsort(name, kind="stable")
                new = np.concatenate(([True], name[order][1:] != name[order][:-1]))
                often = np.empty(len(name), bool)
                often[order] = (np.bincount(np.cumsum(new) - 1) >= FREQUENT)[np.cumsum(new) - 1]
                yield from blocks.dealt(0, part[~often], short[~often], node[~often], parts=parts)
                known = np.unique(name[often])
                yield from blocks.dealt(1, (known & U64(0xFFFFFFFF)).astype(np.int32), (known >> U64(32)).astype(np.uint32), parts=parts)
                yield from blocks.dealt(4, _part(node[often], parts), node[often], name[often], parts=parts)
                nodes = np.array([n for n, _ in heavy], np.int64)
                yield from blocks.dealt(2, _part(nodes, parts), nodes, size.astype(np.int64), parts=parts)
            if light:
                node, key = np.repeat(np.array([n for n, _ in light], np.int64), [len(k) for _, k in light]), np.concatenate([k for _, k in light])
                yield from blocks.dealt(3, _part(node, parts), node, key, parts=parts)

        for _, texts in slices(batches):
            for found in sets_of(texts, rule.words):
                node = node_of(found) if len(found) else None
                if node is not None and node not in seen:
                    seen.add(node)
                    held.append((node, found))
                    count += len(found)
            if count > HELD:
                yield from flush()
                held.clear(), seen.clear()
                count = 0
        yield from flush()

    return run


#: Records by kind: n-grams and nodes, frequent n-grams, nodes and sizes, nodes and keys, nodes and frequent n-grams.
_COUNTED = {0: (np.uint32, np.int64), 1: (np.uint32,), 2: (np.int64, np.int64), 3: (np.int64, np.uint64), 4: (np.int64, np.uint64)}
_RANKED = {0: (np.int64, np.uint64, np.uint8), 2: (np.int64, np.int64), 3: (np.int64, np.uint64)}


def _rank(parts: int):
    """Counts a part's n-grams, and tells each set how frequent those are that it doesn't have alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        found = blocks.gathered(iter(batches), _COUNTED)
        own = {p for b in batches for p, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if k in (0, 1)}
        assert len(own) <= 1, "a task has one part"
        short, node = found[0]
        if len(short):
            every = np.concatenate((short, found[1][0]))
            weight = np.concatenate((np.ones(len(short), np.int64), np.full(len(found[1][0]), FREQUENT)))
            names, index = np.unique(every, return_inverse=True)
            total = np.minimum(np.bincount(index, weights=weight), FREQUENT)[index[: len(short)]].astype(np.uint8)
            keep = total > 1
            name = short[keep].astype(U64) << U64(32) | U64(own.pop())
            yield from blocks.dealt(0, _part(node[keep], parts), node[keep], name, total[keep], parts=parts)
        node, name = found[4]
        yield from blocks.dealt(0, _part(node, parts), node, name, np.full(len(node), FREQUENT, np.uint8), parts=parts)
        for kind in (2, 3):
            yield from blocks.dealt(kind, _part(found[kind][0], parts), *found[kind], parts=parts)

    return run


def _enter(rule: Rule, parts: int):
    """Enters sets in the lists of their rarest n-grams, and light sets under their subsets' keys.

    A key that several sets of a task have is dealt out once, and the links that it makes with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = blocks.gathered(batches, _RANKED)
        nodes, first = np.unique(found[2][0], return_index=True)
        size = found[2][1][first]
        node, name, often = found[0]
        order = np.lexsort((mix(name.copy()), often, node))
        node, name = node[order], name[order]
        if len(node):  # equal sets of several tasks are told twice
            same = np.concatenate(([False], (node[1:] == node[:-1]) & (name[1:] == name[:-1])))
            node, name = node[~same], name[~same]
        start = np.searchsorted(node, nodes)
        shared = np.diff(np.concatenate((start, [len(node)])))
        take = np.maximum(0, rule.lists(size) - (size - shared))  # n-grams of its own come before all others
        at = np.arange(len(node)) - np.repeat(start, shared)
        chosen = at < np.repeat(take, shared)
        key = np.concatenate((mix(name[chosen] ^ U64(0xD1B54A32D192ED03)), found[3][1]))
        node = np.concatenate((node[chosen], found[3][0]))
        if not len(key):
            return
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        head = node[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        a, b = node[~new], head[~new]
        if (a != b).any():
            a, b = smallest_labels(a, b)
            yield from blocks.dealt(1, _part(a, parts), a, b, parts=parts)
        yield from blocks.dealt(0, (key[new] % U64(parts)).astype(np.int32), key[new], node[new], parts=parts)

    return run


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scans the lists of a part: a star of links for each set of nodes that its lists connect."""
    found = blocks.gathered(batches, {0: (np.uint64, np.int64), 1: (np.int64, np.int64)})
    key, node = found[0]
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    again = np.flatnonzero(key[1:] == key[:-1]) if len(key) else np.zeros(0, np.int64)
    a, b = np.concatenate((node[again], found[1][0])), np.concatenate((node[again + 1], found[1][1]))
    if len(a):
        a, b = smallest_labels(a, b)
        keep = a != b
        for i in range(0, int(keep.sum()), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(a[keep][i : i + (1 << 16)]), pa.array(b[keep][i : i + (1 << 16)])], names=["a", "b"])


class _Sets:
    """Sets over a dense numbering of their n-grams, for overlaps of one set with many."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        names, dense = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(dense, np.cumsum(self.sizes)[:-1])
        self.mark = np.zeros(len(names), bool)

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([self.sets[i] for i in which.tolist()]), np.concatenate(([0], np.cumsum(self.sizes[which])[:-1]))

    def overlaps(self, one: int, grams_: np.ndarray, starts: np.ndarray) -> np.ndarray:
        self.mark[self.sets[one]] = True
        out = np.add.reduceat(self.mark[grams_], starts, dtype=np.int64)
        self.mark[self.sets[one]] = False
        return out


def _join(rule: Rule, sets: list[np.ndarray]) -> np.ndarray:
    """For each set the index of the first set of its component.  A set is compared with those not yet reached, which are all it can add."""
    label = np.arange(len(sets))
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.zeros(2, np.int64) if rule.similar(both, len(sets[0]), len(sets[1])) else label
    all_sets = _Sets(sets)
    left = np.arange(len(sets))
    while len(left):
        seed, left = left[0], left[1:]
        queue = [seed]
        alive = np.ones(len(left), bool)
        if len(left):
            flat, starts = all_sets.gather(left)
        while queue and len(left):
            one = queue.pop()
            hit = alive & rule.similar(all_sets.overlaps(one, flat, starts), all_sets.sizes[one], all_sets.sizes[left])
            label[left[hit]] = seed
            queue.extend(left[hit].tolist())
            alive &= ~hit
            if alive.sum() * 2 < len(left):
                left, alive = left[alive], np.ones(int(alive.sum()), bool)
                if len(left):
                    flat, starts = all_sets.gather(left)
        left = left[alive] if len(left) else left
    return label


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows, sorted by their first `width` columns, by group."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:width] != now:
                if rows:
                    yield now, rows
                now, rows = row[:width], []
            rows.append(row[width:])
    if rows:
        yield now, rows


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _own_sets(rule: Rule, rows: list[tuple]) -> tuple[list[int], list[np.ndarray]]:
    """The nodes of rows (node, text), each once, with their sets; texts of other nodes with the same id are left out."""
    nodes, sets, seen = [], [], set()
    for a in range(0, len(rows), 200):
        for (node, _), found in zip(rows[a : a + 200], sets_of([encoded(x) for _, x in rows[a : a + 200]], rule.words)):
            if node not in seen and node_of(found) == node:
                seen.add(node)
                nodes.append(node)
                sets.append(found)
    return nodes, sets


def _compare(rule: Rule):
    """Rows (cluster, block, node, text), sorted: the links that join each block's components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for _, rows in _groups(batches, 2):
            nodes, sets = _own_sets(rule, rows)
            label = _join(rule, sets) if sets else np.zeros(0, np.int64)
            out.extend((nodes[i], nodes[k]) for i, k in enumerate(label.tolist()) if i != k)
            if len(out) > 50_000:
                yield _links(out)
                out = []
        yield _links(out)

    return run


def _compare_rest(rule: Rule):
    """Rows (cluster, block, chunk, odd, node, label, text), sorted: links between the odd nodes of a chunk and the others of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 3):
            rest, odd = [x for x in rows if not x[0]], [x for x in rows if x[0]]
            if not rest or not odd:
                continue
            (nodes, sets), (odd_nodes, odd_sets) = (_own_sets(rule, [(x[1], x[3]) for x in part]) for part in (rest, odd))
            label_of = {x[1]: x[2] for x in rows}
            if not nodes or not odd_nodes:
                continue
            all_sets = _Sets(sets + odd_sets)
            labels = np.array([label_of[n] for n in nodes], np.int64)
            out: set[tuple[int, int]] = set()
            flat, starts = all_sets.gather(np.arange(len(nodes)))
            for i, n in enumerate(odd_nodes, len(nodes)):
                mine = label_of[n]
                hit = rule.similar(all_sets.overlaps(i, flat, starts), all_sets.sizes[i], all_sets.sizes[: len(nodes)]) & (labels != mine)
                out.update((mine, y) for y in np.unique(labels[hit]).tolist())
            yield _links(sorted(out))

    return run


def similar_components(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of `docs`.

    A document's set has the distinct runs of `words` words (A-Z lower-cased, cut at white space) of its whole text; with fewer words,
    the whole sequence as one.  Documents link when den * intersection >= num * union.  component_id is the smallest doc_id that
    links reach, its own included.  Null texts and texts without words have empty sets, which link with nothing.  Repeated rows
    have one set and one component; null ids are never a component's smallest, unless it has no other.  Other columns are ignored;
    an empty table gives an empty result.

    n-grams and whole sets are compared as 64-bit hashes.  No link is lost: see Rule.lists and Rule.shared_sizes.
    """
    return _components(docs, Rule(words, num, den), id_col, text_col).select("doc_id", "n_shingles", "component_id")


def digest(text: Column) -> Column:
    """The digest that one_of_each() gives a text."""
    return F.xxhash64(text)


def one_of_each(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest: the id and the text of one document of each component that similar_components() finds.

    It has the component's smallest id.  If several texts have that id, one is taken by the hash of its set, then of the text.  Each
    text without words is a component of its own, with each of its ids.
    """
    found = _components(docs, Rule(words, num, den), id_col, text_col)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("node") == F.col("owner")))
    own = F.when(F.col("n_shingles") == 0, F.col("digest")).alias("own")
    return kept.groupBy("doc_id", "node", own).agg(F.min("digest").alias("digest")).select("doc_id", "digest")


def _components(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, component_id, node, digest, owner: the owner is the node that stands for the component."""
    rows = ids_and_texts(docs, id_col, text_col)
    parts = blocks.Parts(partitions(rows, 4.0))
    digested = rows.withColumn("digest", digest(F.col("text")))
    facts = checkpoint(digested.mapInArrow(_facts(rule), "doc_id long, n_shingles long, node long, digest long"))
    counted = blocks.by_part(rows.mapInArrow(_count(rule, parts), blocks.DDL), parts)
    ranked = blocks.by_part(counted.mapInArrow(_rank(parts), blocks.DDL), parts)
    lists = blocks.by_part(ranked.mapInArrow(_enter(rule, parts), blocks.DDL), parts)
    clusters = connected(lists.mapInArrow(_scan, "a long, b long"))
    clusters = clusters.select("node", F.col("label").alias("cluster"))
    links = _verified(rows, facts, clusters, rule)
    return _named(facts, connected(links))


def _verified(rows: DataFrame, facts: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """Links between nodes that have the same components as all links there are."""
    first = facts.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("size"))
    members = first.join(clusters, "node")
    sizes = members.groupBy("cluster").agg(F.sum("size").alias("grams"), F.count("*").alias("nodes")).where("nodes > 1")
    by_grams = F.ceil(F.col("grams") * 2 / BLOCK_GRAMS)
    is_large = (F.col("grams") > BLOCK_GRAMS) | (F.col("nodes") > BLOCK_SETS)
    split = F.when(is_large, F.greatest(by_grams, F.ceil(F.col("nodes") * 2 / BLOCK_SETS), F.lit(2))).otherwise(1).cast("int")
    members = members.join(sizes, "cluster").select("cluster", "node", "first_id", "size", "nodes", split.alias("split"), F.greatest(by_grams, F.lit(LEAST_BLOCKS)).cast("int").alias("rest_split"))
    members = checkpoint(members.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("split")).cast("int")))
    pivot = F.pmod(F.xxhash64("node", F.lit("pivot")), F.col("nodes")) < PIVOTS
    blocks_of = F.when((F.col("split") > 1) & pivot, F.sequence(F.lit(0), F.col("split") - 1)).otherwise(F.array("block"))
    # the candidates' texts are kept, so that all texts are dealt out once only
    texts = checkpoint(_fetched(rows, members.select("first_id", "cluster", blocks_of.alias("blocks"), "node", (F.col("split") > 1).alias("large"))))
    grouped = texts.select("cluster", F.explode("blocks").alias("block"), "node", "text").repartition("cluster", "block").sortWithinPartitions("cluster", "block")
    links = checkpoint(grouped.mapInArrow(_compare(rule), "a long, b long"))
    block = F.pmod(F.xxhash64("node", F.lit("rest")), F.col("rest_split")).cast("int")
    large = members.where("split > 1").select("cluster", "node", "size", F.col("rest_split").alias("split"), block.alias("block"))
    if not large.limit(1).count():
        return links
    # between blocks: whatever is not in a split cluster's main component is compared with all the cluster's blocks
    labels = connected(links)
    large = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = large.groupBy("cluster", "label").agg(F.sum("size").alias("n"))
    main = counts.groupBy("cluster").agg(F.max_by("label", F.struct("n", "label")).alias("main"), (F.sum("n") - F.max("n")).alias("odd"))
    large = checkpoint(large.join(main.where("odd > 0"), "cluster").withColumn("chunks", F.ceil(F.col("odd") * 2 / BLOCK_GRAMS).cast("int")))
    rest = large.select("cluster", F.array("block").alias("blocks"), F.sequence(F.lit(0), F.col("chunks") - 1).alias("chunk"), F.lit(False).alias("odd"), "node", "label")
    chunk = F.array(F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks")).cast("int"))
    odd = large.where("label <> main").select("cluster", F.sequence(F.lit(0), F.col("split") - 1).alias("blocks"), chunk.alias("chunk"), F.lit(True).alias("odd"), "node", "label")
    texts = texts.where("large").select("node", "text")
    both = rest.union(odd).join(texts, "node").select("cluster", F.explode("blocks").alias("block"), "chunk", "odd", "node", "label", "text")
    both = both.select("cluster", "block", F.explode("chunk").alias("chunk"), "odd", "node", "label", "text")
    pairs = both.repartition("cluster", "block", "chunk").sortWithinPartitions("cluster", "block", "chunk")
    return links.union(pairs.mapInArrow(_compare_rest(rule), "a long, b long"))


def _fetched(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Members with the texts that have their first ids; where several texts have one id, the comparison takes the right one by its node."""
    return rows.join(members, F.col("doc_id").eqNullSafe(F.col("first_id"))).drop("doc_id", "first_id")


def _named(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """Facts with component ids; sets without links are their own components."""
    first = facts.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows"))
    first = first.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = first.groupBy("label").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("least"))
    lowest = lowest.select("label", F.col("least.first_id").alias("component_id"), F.col("least.node").alias("owner"))
    # only nodes that stand for several documents or have links need a join; a node's rows are few or, if one text is very frequent, hot
    total = facts.count()
    named = checkpoint(first.join(lowest, "label").where("rows > 1 or node <> owner").select("node", "component_id", "owner", "rows"))
    hot = named.where(F.col("rows") * 1000 > total).select("node", F.col("component_id").alias("hot_id"), F.col("owner").alias("hot_owner"))  # fewer than 1000 rows
    found = facts.join(F.broadcast(hot), "node", "left")
    key = F.when(F.col("hot_id").isNull() & (F.col("n_shingles") > 0), F.col("node"))
    rest = named.where(F.col("rows") * 1000 <= total).select(F.col("node").alias("key"), "component_id", "owner")
    # rows without a key are dealt out by their ids, and match nothing
    found = found.withColumn("key", F.coalesce(key, F.xxhash64("doc_id"))).withColumn("keyed", key.isNotNull()).join(rest.withColumn("keyed", F.lit(True)), ["key", "keyed"], "left")
    component = F.coalesce("hot_id", "component_id", "doc_id").alias("component_id")
    return found.select("doc_id", "n_shingles", component, "node", "digest", F.coalesce("hot_owner", "owner", "node").alias("owner"))
