"""Types and arguments that the given tables don't have."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabletide import schema as S
from tabletide.dialects import trino
from tabletide.dialects.trino import parse_type
from tabletide.errors import TideError
from tabletide.functions import literals
from tabletide.operators import rows
from tabletide.plans import storage
from tabletide.schema import Array, Column, GeoJson, OneOf, Schema, Table
from tabletide.sources import arguments

#: By type: what hive and iceberg store it as, if not as itself.
STORED = {
    "boolean": (None, None), "smallint": (None, "INT"), "bigint": (None, None), "varchar": (None, None), "json": ("VARCHAR", "VARCHAR"), "uuid": ("VARCHAR", None), "time(3)": ("VARCHAR", "TIME(6)"),
    "timestamp(6)": ("TIMESTAMP(3)", None), "timestamp(3) with time zone": ("TIMESTAMP(3)", "TIMESTAMP(6) WITH TIME ZONE"), "array(smallint)": (None, "ARRAY(INT)"),
    'row("a" json, "b" bigint)': ('ROW("a" VARCHAR, "b" BIGINT)', 'ROW("a" VARCHAR, "b" BIGINT)'), "SphericalGeography": ("VARCHAR", "VARCHAR"),
}


@pytest.mark.parametrize("name", STORED)
def test_stored_types(name):
    t = parse_type(name)
    for profile, want in zip(("hive", "iceberg", "memory"), (*STORED[name], None)):
        found = storage.transform(profile, t)
        assert str(found.stored) == (want or str(t)) and found.is_identity == (want is None) == (storage.stored_sql(profile, t, "x") == "x")


def test_tables_as_profiles_have_them():
    schema = Schema(Table("t", (Column("k", S.INT64, False), Column("j", S.JSON))))
    want = {"hive": (1, False, [True, True], ["BIGINT", "VARCHAR"], ["format", "transactional"]), "iceberg": (0, True, [False, True], ["BIGINT", "VARCHAR"], []), "memory": (1, False, [True, True], ["BIGINT", "JSON"], [])}
    for profile, can in storage.CAPABILITIES.items():
        first, made = storage.storage_table(profile, trino.create_table(schema, "t", or_replace=True), merge=can["merge"])
        assert want[profile] == (len(first), made.or_replace, [n for _, _, n, _ in made.columns], [str(t) for _, t, _, _ in made.columns], sorted(k for k, _ in made.options))


def test_aligned_types():
    have = want = Schema(Table("t", (Column("a", S.TEXT),)))
    for t in (S.TEXT, S.UUID, S.JSON, GeoJson(), OneOf(("x",))):
        assert rows.align_type(have, S.TEXT, want, t, "a") == t
    assert rows.align_type(have, Array(S.TEXT), want, Array(S.UUID), "a") == Array(S.UUID)
    for t, u in ((S.TEXT, S.INT64), (S.TEXT, S.BOOL), (S.INT64, S.INT32), (Array(S.TEXT), Array(S.DATE))):
        with pytest.raises(TideError, match="cannot take"):
            rows.align_type(have, t, want, u, "a")


def test_arguments():
    assert arguments.parse(["a=1", "b.c=x", "b[d]=y=z", "e[]=p", "e[]=q", "f.g[]="]) == {"a": "1", "b": {"c": "x", "d": "y=z"}, "e": ["p", "q"], "f": {"g": [""]}}


def test_literals_of_columns_are_those_of_values(spark):
    """Expressions write what the functions of single values write."""
    schema = Schema(Table("t", (Column("a", S.TEXT),)))
    texts = ["", "a'b\"c\\", "é中\U0001f600\n\t~ \x7f", None, "x" * 3]
    df = spark.createDataFrame([(x, i if i != 2 else None, i % 2 == 0, dt.date(2020, 1, i + 1), dt.datetime(2020, 1, 1, 1, 2, 3, 450000)) for i, x in enumerate(texts)], "t string, n long, b boolean, d date, s timestamp_ntz")
    kinds = (("t", S.TEXT, "varchar"), ("n", S.INT64, "bigint"), ("b", S.BOOL, "boolean"), ("d", S.DATE, "date"))
    found = df.select("*", *[f(t, F.col(c)).alias(f"{k}_{c}") for c, p, q in kinds for k, f, t in (("b", literals.bigquery_column, p), ("t", literals.trino_column, parse_type(q)))], literals.bigquery_column(S.TIMESTAMP, F.col("s")).alias("b_s"), literals.trino_column(parse_type("array(varchar)"), F.array("t")).alias("t_a"), literals.bigquery_column(Array(S.TEXT), F.array("t")).alias("b_a"))
    for r in found.collect():
        for c, p, q in kinds:
            assert (r[f"b_{c}"], r[f"t_{c}"]) == (literals.bigquery(schema, p, r[c]), literals.trino(parse_type(q), r[c]))
        assert r["b_a"] == literals.bigquery(schema, Array(S.TEXT), [r["t"]]) and r["t_a"] == literals.trino(parse_type("array(varchar)"), [r["t"]])
        assert r["b_s"].replace(".45", ".450000") == literals.bigquery(schema, S.TIMESTAMP, r["s"])
    empty = spark.sql("select array() as a").select(literals.trino_column(parse_type("array(varchar)"), F.col("a").cast("array<string>")).alias("x")).first()
    assert empty.x == literals.trino(parse_type("array(varchar)"), [])
