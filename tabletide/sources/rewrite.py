"""Upserts into a table of files that leave all files alone in which no key is found.

New rows are written first, as files of their own.  Which of the table's files hold one of their keys is asked of the key columns alone:
row groups whose ranges the new keys don't meet aren't read, and the rest by a semi join, which Spark gives a Bloom filter where both
sides are large.  Only those files are read whole, and written without the replaced rows.  Then files change places, by a journal: a run
that fails puts all back, and what a run that died has left half done is put back by the next one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge
from ..operators.rows import named, project
from .storage import Files

#: Hidden folders in the table's own, so that moves are renames; and the journal in one.
WORK, JOURNAL = "_tide-upsert-", "journal"
#: Formats whose files carry ranges of columns.
FORMATS = ("parquet", "orc")
#: Types whose ranges can be compared with a value.
RANGED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


@dataclass(frozen=True)
class Place:
    """A table's files."""

    name: str
    location: str
    format: str
    partitions: tuple[str, ...]


def place_of(spark: SparkSession, name: str) -> Place | None:
    """Where a table's files are, if they can be replaced one by one: Parquet or ORC, not bucketed."""
    about = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])
    if about.get("type") not in ("MANAGED", "EXTERNAL") or about.get("provider", "").lower() not in FORMATS or int(about.get("num_buckets") or 0) > 0 or not about.get("location"):
        return None
    return Place(name, about["location"].rstrip("/"), about["provider"].lower(), tuple(about.get("partition_columns") or ()))


def holding(there: DataFrame, new: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files of a table that hold a key of `new`."""
    ranged = [k for k in keys if isinstance(there.schema[k].dataType, RANGED)]
    bounds = new.agg(F.count("*").alias("n"), *[f(named(k)).alias(f"{w}{i}") for i, k in enumerate(ranged) for w, f in (("low", F.min), ("high", F.max))]).first()
    if not bounds["n"]:
        return []
    near = F.lit(True)
    for i, k in enumerate(ranged):
        near = near & named(k).between(F.lit(bounds[f"low{i}"]), F.lit(bounds[f"high{i}"]))
    found = there.where(near).select(*map(named, keys), F.col("_metadata.file_path").alias("__file")).join(new.select(*map(named, keys)), list(keys), "left_semi")
    return sorted(unquote(r[0]) for r in found.select("__file").distinct().collect())


def recover(spark: SparkSession, place: Place) -> None:
    """Puts back what runs that died have moved, and takes their folders away."""
    for folder in Files(spark, place.location).folders(WORK):
        journal = Files(spark, f"{folder}/{JOURNAL}")
        if journal.exists():
            undo(spark, json.loads(journal.read()))
        Files(spark, folder).delete()


def undo(spark: SparkSession, moves: list[list[str]]) -> None:
    """Takes moves back, the last first, as far as they were made."""
    for source, target in reversed(moves):
        if Files(spark, target).exists() and not Files(spark, source).exists():
            Files(spark, target).rename(target, source)


def upsert(place: Place, data: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Puts `data` into the table in place of rows with equal keys; how many files were replaced, and how many were left alone.

    A key that is null, or that two rows of `data` have, is an error, and so is a failure on the way: both leave the table as it was.
    One writer at a time; a reader that lists the files just while they change places may see some of either.
    """
    spark, there = data.sparkSession, data.sparkSession.table(place.name)
    merge.check_keys(there.columns, keys)
    recover(spark, place)
    work = f"{place.location}/{WORK}{uuid.uuid4().hex[:10]}"
    journal, moves = Files(spark, f"{work}/{JOURNAL}"), []

    def save(df: DataFrame, name: str) -> None:
        writer = df.write.format(place.format)
        (writer.partitionBy(*place.partitions) if place.partitions else writer).save(f"{work}/{name}")

    def load(*paths: str, base: str) -> DataFrame:
        return spark.read.format(place.format).schema(there.schema).option("basePath", base).load(list(paths)).select(*map(named, there.columns))

    try:
        typed = project(data, there.columns).select([named(f.name).cast(f.dataType).alias(f.name) for f in there.schema.fields])
        save(merge.checked(typed, keys), "new")
        new = load(f"{work}/new", base=f"{work}/new")
        touched = holding(there, new, keys)
        if touched:
            save(load(*touched, base=place.location).join(new.select(*map(named, keys)), list(keys), "left_anti").select(*map(named, there.columns)), "rest")
        all_files = sum(1 for _ in Files(spark, place.location).listed())
        moves += [[file, f"{work}/old/{i}"] for i, file in enumerate(touched)]
        for name in ("new", "rest")[: 1 + bool(touched)]:
            top = Files(spark, f"{work}/{name}")
            moves += [[file, f"{place.location}/{file[len(top.qualified()) :].lstrip('/')}"] for file, _ in top.listed()]
        journal.write(json.dumps(moves), False)
        for source, target in moves:
            Files(spark, source).rename(source, target)
        journal.delete()
    except BaseException:
        if journal.exists():
            undo(spark, moves)
        Files(spark, work).delete()
        raise
    Files(spark, work).delete()
    if place.partitions:
        spark.catalog.recoverPartitions(place.name)
    spark.catalog.refreshTable(place.name)
    return len(touched), all_files - len(touched)
