"""Shards by weighted rendezvous hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ids_and_texts

#: Parts of a shard within which slots are counted; so no task sees a whole shard.
PARTS = 256


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose score for the key is the highest: weight / -ln(u), where u in (0, 1) is a hash of key and shard.

    A shard's score depends on that shard alone, so a further shard takes keys only into itself, in proportion to its weight.
    A weight of 0 takes nothing.  Equal scores go to the lower shard.
    """
    open_shards = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not open_shards:
        raise ValueError("no shard has a positive weight")

    def score(i: int, w: float) -> Column:
        # the two halves of u's hash are mixed with the shard separately; 53 bits, never 0 or 1
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(i)), 11).cast("double") + 0.5) / float(1 << 53)
        return F.struct((F.lit(float(w)) / -F.ln(u)).alias("score"), F.lit(-i).alias("shard"))

    return (-F.array_max(F.array(*[score(i, w) for i, w in open_shards]))["shard"]).cast("int")


def shard(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row for each row of `docs`.

    The record's key is its id as 64 bits and decides the shard with the weights alone; null ids share a key of their own.  size is
    the text's UTF-8 bytes plus 8 (null: 8), text_crc32 that of its bytes (null: of none).  Within a shard slots run from 0 without
    gaps, in the order of a hash of the key; repeated rows get slots of their own.  grown_shard is the shard under the weights
    `grown`, null if none are given.  An empty table gives an empty result; other columns are ignored.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    key = F.coalesce(F.xxhash64("doc_id", F.lit("key")), F.lit(0))
    rows = rows.select(
        "doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"),
        rendezvous(key, weights).alias("shard"), (rendezvous(key, grown) if grown is not None else F.lit(None).cast("int")).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts)).cast("int").alias("part"),
    )
    # a row for each shard and part, so len(weights) * parts of them however large the table
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("at", F.row_number().over(inside)).join(F.broadcast(starts), ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "law", "shard", (F.col("start") + F.col("at") - 1).cast("long").alias("slot"), "grown_shard")
    )
