"""Which filters remove which documents, in every order of the filters, as products of an incidence matrix."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import importable

#: The filters, by their letters; bit i of a mask is set if the i-th one fails.
FILTERS = "ABCDE"
MASKS, ORDERS, STEPS = 1 << len(FILTERS), ["".join(p) for p in permutations(FILTERS)], len(FILTERS)


def outcomes() -> dict[str, np.ndarray]:
    """For each outcome a matrix of 0 and 1 (shapley: of counts) with a row for each mask and a column for each order and step.

    kept: no filter of the steps so far fails.  removed: the step's filter fails and none before it.  redundant: it fails and one before
    it too.  unique_fails: it alone fails.  shapley: the number of orders in which the step's filter is the one that removes.
    """
    position = np.array([[FILTERS.index(x) for x in order] for order in ORDERS])
    fails = (np.arange(MASKS)[:, None] >> np.arange(STEPS) & 1).astype(np.int64)
    each = fails[:, position]  # mask, order, step
    gone = np.cumsum(each, axis=2)
    first = each * (gone == 1)
    shares = np.zeros((MASKS, STEPS), np.int64)
    np.add.at(shares.T, position.ravel(), first.reshape(MASKS, -1).T)
    found = {"kept": gone == 0, "removed": first, "redundant": each * (gone > 1), "unique_fails": each * (fails.sum(1) == 1)[:, None, None], "shapley": shares[:, position]}
    return {k: x.astype(np.int64).reshape(MASKS, -1) for k, x in found.items()}


def text_mask(text: Column) -> Column:
    """The bits of the filters that look at one text alone, A to D; `text` isn't null."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 100, 100 * distinct.cast("long") < 80 * n.cast("long"), 100 * capitals.cast("long") > 10 * F.char_length(text).cast("long"), text.rlike("[#$%&*|]")]
    return sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(fails)), F.lit(0)).cast("int")


def histograms(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of a part fail just the mask's filters, and how many of these have each label.

    Rows meet by the SHA-256 of their text and their id.  Equal rows are counted before anything is shuffled, and what is counted of a
    text holds one row for each part and pair of labels, so a group of copies of any size is a few rows in any task.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.sha2(text, 256).alias("digest"), F.coalesce(docs["lang"].cast("string"), F.lit("")).alias("part"), text_mask(text).alias("mask"))
    rows = rows.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.select(labels["doc_id"].cast("long").alias("id"), (labels["quality"] == 1).alias("good"), (labels["toxic"] == 1).alias("toxic"))
    marks = marks.where("id is not null").groupBy("id").agg(*[F.coalesce(F.bool_or(x), F.lit(False)).alias(x) for x in ("good", "toxic")])
    rows = rows.join(marks, "id", "left").select("id", "digest", "part", "mask", "n", *[F.coalesce(x, F.lit(False)).alias(x) for x in ("good", "toxic")])
    # within such a group an id stands once, so the smallest one's count is known; null ids come with none
    same = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"), F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    firsts = same.groupBy("digest").agg(F.min("least.id").alias("first"), F.collect_list(F.struct("part", "mask", "good", "toxic", "least", "n", "no_id")).alias("groups"))
    same = firsts.select("first", F.inline("groups"))
    passes = F.col("no_id") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = F.array(F.struct(F.col("mask").alias("mask"), passes.alias("n")), F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - passes).alias("n")))
    counted = same.select("part", "good", "toxic", F.inline(split))
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_SCHEMA = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in COUNTS)])


def interactions(counts: DataFrame) -> DataFrame:
    """The counts of every order and step from histograms (part, mask, n, good, toxic); masks that a part doesn't have count as none.

    The histograms of all parts of a batch are the rows of one matrix, which is multiplied by the outcomes' matrices.
    """
    importable(counts.sparkSession)
    lists = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("rows"))  # MASKS of them at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = outcomes()
        orders, steps = pa.array(np.repeat(ORDERS, STEPS)), pa.array(np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS)))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = (c.to_pylist() for c in batch.slice(at, 256).columns)
                stacked = np.zeros((3, len(part), MASKS), np.int64)
                for i, found in enumerate(rows):
                    for x in found:
                        stacked[:, i, x["mask"]] += (x["n"], x["good"], x["toxic"])
                of = {k: (stacked[0] @ m).ravel() for k, m in matrices.items()}
                of |= {"good_lost": (stacked[1] @ matrices["removed"]).ravel(), "toxic_lost": (stacked[2] @ matrices["removed"]).ravel()}
                n = len(part)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part, len(orders)), pa.string()), pa.concat_arrays([orders] * n), pa.concat_arrays([steps] * n), *[pa.array(of[c]) for c in COUNTS]], schema=_SCHEMA)

    return lists.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step: what is kept, removed, redundant, unique and lost there.

    A part is a value of lang; null and the empty string are one part, "".  A null text counts as empty: it fails A alone, and E where
    an empty text has a smaller id.  Filter E fails a row whose text a smaller doc_id has, in any part; equal ids don't fail each other,
    and a null id neither fails nor makes fail.  Repeated rows count each.  A document is good (toxic) if any row of `labels` with its
    id says so; null labels, and labels of no document, count for nothing.  An empty table has no parts and gives no rows; texts of any
    length are read whole; other columns, whatever they are called, are ignored.
    """
    importable(docs.sparkSession)
    return interactions(histograms(docs, labels))
