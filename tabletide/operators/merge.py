"""Upsert: new rows replace old ones with equal keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import TideError
from .rows import named, project


def parse_keys(text: str) -> list[str]:
    """The keys in `k1,k2`."""
    keys = text.split(",")
    if not all(keys):
        raise TideError(f"an upsert needs keys with names, not {text!r}")
    return keys


def check_keys(columns: Sequence[str], keys: Sequence[str]) -> None:
    if not keys:
        raise TideError("an upsert needs a key")
    for k in keys:
        if k not in columns:
            raise TideError(f"the upsert key {k!r} is no column; there are {', '.join(map(repr, columns))}")
    if len({*keys}) < len(keys):
        raise TideError(f"an upsert key is named twice in {', '.join(keys)}")


def checked(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`source`, with an error when it is computed if a key is null, or if two rows have it."""
    columns = [named(k) for k in keys]
    spot = F.concat_ws(", ", *[F.concat(F.lit(f"{k} = "), F.coalesce(named(k).cast("string"), F.lit("null"))) for k in keys])
    whole = F.lit(True)
    for c in columns:
        whole = whole & c.isNotNull()
    once = F.count("*").over(Window.partitionBy(*columns)) == 1
    found = source.withColumn("__once", once)
    return found.where(F.assert_true(whole, F.concat(F.lit("an upsert key is null: "), spot)).isNull() & F.assert_true(F.col("__once"), F.concat(F.lit("several rows to upsert have the key "), spot)).isNull()).drop("__once")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of `source`, and those of `target` whose keys it doesn't have; columns are the target's, by name.

    A key that is null, or that two rows of the source have, is an error when the result is computed.  The check for repeated keys and
    the anti join need the same partitioning, so the source is shuffled once for both; Spark broadcasts it by itself if it is small.
    """
    check_keys(target.columns, keys)
    found = checked(project(source, target.columns), keys)
    return target.join(found.select(*map(named, keys)), list(keys), "left_anti").select(*map(named, target.columns)).unionByName(found)
