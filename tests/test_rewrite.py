"""Upserts file by file: what is left alone, and what failures leave behind."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tabletide import schema as S
from tabletide.sources import locators, rewrite
from tabletide.sources.arguments import DestinationArguments, IfExists
from tabletide.sources.storage import Files


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def make(spark, name, files=6, partitions=(), format="parquet"):
    df = spark.range(files * 100).select("id", F.concat(F.lit("v"), "id").alias("v"), (F.col("id") % 3).cast("int").alias("p"))
    writer = df.repartitionByRange(files, "id").write.format(format)
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)


def content(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("id", "v", "p").collect())


def names(spark, name):
    return {*spark.table(name).inputFiles()}


def leftovers(spark, name):
    place = rewrite.place_of(spark, name)
    return Files(spark, place.location).folders(rewrite.WORK)


@pytest.mark.parametrize("partitions, format", [((), "parquet"), ((), "orc"), (("p",), "parquet")])
def test_rows_and_files(spark, name, partitions, format):
    make(spark, name, partitions=partitions, format=format)
    before, rows = names(spark, name), {r[0]: r for r in content(spark, name)}
    new = [(105, "x", 0), (106, "y", 1), (9000, "z", 7)]
    touched, alone = rewrite.upsert(rewrite.place_of(spark, name), spark.createDataFrame(new, "id long, v string, p int").select("v", "p", "id"), ["id"])
    rows |= {r[0]: r for r in new}
    assert content(spark, name) == sorted(rows.values())
    after = names(spark, name)
    assert len(before) == touched + alone and len(before & after) == alone and 0 < touched < alone
    assert leftovers(spark, name) == []
    # nothing to put in changes nothing
    assert rewrite.upsert(rewrite.place_of(spark, name), spark.createDataFrame([], "id long, v string, p int"), ["id"])[0] == 0
    assert content(spark, name) == sorted(rows.values())


def test_keys_of_two_columns_and_nulls(spark, name):
    spark.createDataFrame([(1, "a", 0), (1, "b", 0), (None, "c", 0), (2, "it's", 0)], "id long, v string, p int").write.saveAsTable(name)
    rewrite.upsert(rewrite.place_of(spark, name), spark.createDataFrame([(1, "b", 5), (2, "it's", 6), (2, "c", 7)], "id int, v string, p int"), ["id", "v"])
    assert sorted((tuple(r) for r in spark.table(name).collect()), key=str) == sorted([(1, "a", 0), (1, "b", 5), (None, "c", 0), (2, "it's", 6), (2, "c", 7)], key=str)


def test_failures_change_nothing(spark, name, monkeypatch):
    make(spark, name)
    before, rows, place = names(spark, name), content(spark, name), rewrite.place_of(spark, name)
    for bad in ([(1, "a", 0), (1, "b", 0)], [(None, "a", 0)]):
        with pytest.raises(Exception, match="several rows to upsert|key is null"):
            rewrite.upsert(place, spark.createDataFrame(bad, "id long, v string, p int"), ["id"])
        assert names(spark, name) == before and leftovers(spark, name) == []
    # moves that fail, at each of them
    real = Files.rename
    good = spark.createDataFrame([(5, "a", 0), (350, "b", 0)], "id long, v string, p int")
    for k in range(4):
        left = [k]

        def rename(self, source, target):
            if left[0] == 0:
                left[0] = -1
                raise OSError("no room")
            left[0] -= 1
            real(self, source, target)

        monkeypatch.setattr(Files, "rename", rename)
        with pytest.raises(OSError):
            rewrite.upsert(place, good, ["id"])
        monkeypatch.setattr(Files, "rename", real)
        spark.catalog.refreshTable(name)
        assert names(spark, name) == before and content(spark, name) == rows and leftovers(spark, name) == []


def test_a_run_that_died_is_put_back(spark, name):
    make(spark, name)
    place, rows, before = rewrite.place_of(spark, name), content(spark, name), names(spark, name)
    file = next(p for p, _ in Files(spark, place.location).listed())
    work = f"{place.location}/{rewrite.WORK}dead"
    Files(spark, f"{work}/new/part-9").write("not there yet", False)
    moves = [[file, f"{work}/old/0"], [f"{work}/new/part-9", f"{place.location}/part-9"]]
    Files(spark, f"{work}/{rewrite.JOURNAL}").write(json.dumps(moves), False)
    for source, target in moves:
        Files(spark, source).rename(source, target)
    rewrite.recover(spark, place)
    spark.catalog.refreshTable(name)
    assert names(spark, name) == before and content(spark, name) == rows and leftovers(spark, name) == []


def test_files_are_chosen_by_keys(spark, name):
    """The files of the keys that are there; of keys between those of the table, none."""
    make(spark, name)
    there = spark.table(name)
    assert len(rewrite.holding(there, spark.createDataFrame([(105,), (106,)], "id long"), ["id"])) == 1
    assert len(rewrite.holding(there, spark.createDataFrame([(0,), (599,)], "id long"), ["id"])) == 2
    assert rewrite.holding(there, spark.createDataFrame([(-5,), (600,)], "id long"), ["id"]) == []


def test_other_tables(spark, name):
    """Tables whose files can't be replaced one by one are written anew."""
    spark.range(5).selectExpr("id", "cast(id as string) v").write.format("csv").saveAsTable(name)
    assert rewrite.place_of(spark, name) is None
    at, schema = locators.parse(f"table:{name}"), S.from_spark("t", spark.table(name).schema)
    at.write(spark.createDataFrame([(3, "x"), (9, "y")], "id long, v string"), schema, DestinationArguments(IfExists("upsert", ("id",))))
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(0, "0"), (1, "1"), (2, "2"), (3, "x"), (4, "4"), (9, "y")]
    assert not [t for t in os.listdir(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")) if t.startswith(f"{name}_")]
