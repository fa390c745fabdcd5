"""Connected components, in arrays and in tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

#: Edges for a task.
EDGES = 50_000
#: A graph of no more edges is labelled by one task, in some 100 MB of memory.
ONE_TASK = 1 << 20
#: A node is a hub if over one in so many edges end at it; there are fewer than twice as many hubs.
HUB_SHARE = 1000


def smallest_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges a-b, ascending, and for each the smallest node it is connected with."""
    nodes, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _with_low(edges: DataFrame, low: DataFrame, total: int) -> DataFrame:
    """The edges (a, b) with `low` of a, from rows (a, low, n) with the numbers of edges: hubs' rows are broadcast, so no task gets all edges of one."""
    hub = F.col("n") * HUB_SHARE > total
    found = edges.join(F.broadcast(low.where(hub).select("a", F.col("low").alias("hub_low"))), "a", "left")
    key = F.when(F.col("hub_low").isNull(), F.col("a")).otherwise(F.xxhash64("a", "b"))
    found = found.withColumn("key", key).join(low.where(~hub).select(F.col("a").alias("key"), F.col("low").alias("own_low")), "key", "left")
    return found.select("a", "b", F.coalesce("hub_low", "own_low").alias("low")).where("low is not null")


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, label of all edges of a small graph."""
    found = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not found:
        return
    nodes, labels = smallest_labels(*(np.concatenate(x) for x in zip(*found)))
    for i in range(0, len(nodes), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + (1 << 16)]), pa.array(labels[i : i + (1 << 16)])], names=["node", "label"])


def connected(edges: DataFrame) -> DataFrame:
    """node, label: for each node of the edges (a, b), which are longs, the smallest node it is connected with.

    Large and small stars in turn: every node first links its larger neighbours, then its smaller ones, to the smallest it knows.
    Each round is a partial minimum by node and a join with it, in which hubs' edges stay where they are; so no node's neighbours are
    gathered.  Each round's edges are written to the shared checkpoint folder.  The number of rounds grows with the logarithm of the longest path.  Tasks have about
    EDGES edges, so a small graph doesn't make a file for each of many empty partitions in each exchange.  One of at most ONE_TASK edges
    needs no rounds: a task has them all in arrays.
    """
    edges = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    total = edges.count()
    if total <= ONE_TASK:
        return edges.coalesce(1).mapInArrow(_labelled, "node long, label long")
    tasks = total // EDGES + 1
    edges = edges.coalesce(tasks)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"), F.count("*").alias("n"))
        large = _with_low(both, low, total).where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.union(_with_low(edges, low, total).select("a", F.col("low").alias("b"))).where("a <> b").coalesce(tasks).distinct().coalesce(tasks)
        low = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        small = _with_low(large, low, total).select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = checkpoint(small.select("e.a", "e.b").where("a <> b").coalesce(tasks).distinct().coalesce(tasks))
        if not edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count() and not edges.groupBy("a").count().where("count > 1").limit(1).count():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
