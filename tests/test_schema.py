"""Schemas, dialects and their errors; no Spark session needed."""

import json
import random

import pytest

from tabletide import schema as S
from tabletide.dialects import bigquery, postgres, redshift, trino, typescript
from tabletide.errors import ParseError, TideError
from tabletide.schema import Array, Column, GeoJson, Named, OneOf, Schema, Struct, StructField, Table

EVERYTHING = '''
-- everything
CREATE TYPE color AS ENUM ('red', 'it''s');
create unlogged table shop.things (
    id int NOT NULL PRIMARY KEY,
    "Select" text, "a ""b""" character (3), c citext, ok boolean NOT NULL, day date, n numeric, r real, d double precision,
    s smallint, b bigint[], j json, jb jsonb, t timestamp, tz timestamp with time zone, tzs TIMESTAMP WITHOUT TIME ZONE[],
    u uuid, g public.geometry(Geometry, 4326), h public.geometry (Geometry,
      3857), k color
);
'''


def test_postgres_both_ways():
    s = postgres.parse(EVERYTHING)
    assert s.table.name == "shop.things" and s.named == {"color": OneOf(("red", "it's"))}
    assert s.table.column("id") == Column("id", S.INT32, False) and s.table.column("b").data_type == Array(S.INT64)
    assert s.table.column('a "b"').data_type == S.TEXT and s.table.column("k").data_type == Named("color") and s.table.column("h").data_type == GeoJson(3857)
    text = postgres.render(s)
    assert postgres.parse(text) == s
    assert text.startswith("CREATE TYPE \"color\" AS ENUM ('red', 'it''s');\n\nCREATE TABLE \"shop\".\"things\" (\n    \"id\" int NOT NULL,\n") and text.endswith('"k" "color"\n);\n')


@pytest.mark.parametrize(
    "text, what",
    [
        ("CREATE TABLE t (a varchar(3))", "expected ')'"), ("CREATE TABLE t (a wrong)", "'wrong' is not defined"), ("CREATE TABLE t (a int); CREATE TABLE u (a int)", "found 2"), ("", "found 0"),
        ("CREATE TABLE t ()", "a name"), ("CREATE TABLE t (a int,)", "a name"), ("CREATE TYPE c AS ENUM ('x'); CREATE TYPE c AS ENUM ('y'); CREATE TABLE t (a c)", "twice"), ("CREATE TABLE t (a int, a int)", "two columns"),
    ],
)
def test_postgres_errors(text, what):
    with pytest.raises(TideError, match=what.replace("(", r"\(").replace(")", r"\)")):
        postgres.parse(text)


def test_error_shows_the_place():
    with pytest.raises(ParseError) as e:
        postgres.parse("CREATE TABLE t (\n  a int NULL\n)")
    assert "line 2, column 9" in str(e.value) and "^^^^" in str(e.value)


def test_what_postgres_cannot_have():
    with pytest.raises(TideError, match="without a name"):
        postgres.render(Schema(Table("t", (Column("a", OneOf(("x",))),))))
    with pytest.raises(TideError, match="fixed values"):
        postgres.render(Schema(Table("t", (Column("a", Named("n")),)), {"n": S.TEXT}))
    assert [postgres.table_name_for(x) for x in ("a.b", "my-table 1", "123", "x_1")] == ["b", "table", "data", "x_1"]


def test_statements():
    s = Schema(Table("t", (Column("k", S.INT64, False), Column("v", S.TEXT), Column("a", Array(S.INT64)), Column("at", S.TIMESTAMPTZ), Column("g", GeoJson()))))
    sql = postgres.export_select(s, "s.t", "k > 1")
    assert sql.startswith('SELECT "k", "v", CASE WHEN "a" IS NULL') and sql.endswith('FROM "s"."t" WHERE (k > 1)') and "AT TIME ZONE 'UTC'" in sql and "ST_AsGeoJSON" in sql
    assert postgres.count_select("t") == 'SELECT COUNT(*) AS "count" FROM "t"'
    assert "DO UPDATE SET \"v\" = EXCLUDED.\"v\"" in postgres.upsert_statement(s, "src", "t", ["k"])
    keys = s.select(["k"])
    assert postgres.upsert_statement(keys, "src", "t", ["k"]).endswith("DO NOTHING")
    with pytest.raises(TideError, match="NOT NULL"):
        postgres.upsert_statement(s, "src", "t", ["v"])
    assert "WHEN MATCHED" not in trino.merge_statement(keys, "a", "b", ["k"]) and "WHEN MATCHED" in trino.merge_statement(s, "a", "b", ["k"])
    assert [x.split()[0] for x in redshift.upsert_statements(s.select(["k", "v"]), "a", "b", ["k"])] == ["UPDATE", "DELETE", "INSERT", "DROP"]
    assert redshift.unload_statement(s.select(["k"]), "t", None, "s3://x/", {"IAM_ROLE": "r"}).startswith("UNLOAD ('SELECT \"k\"")
    assert "varchar(max)" in redshift.render(s.select(["k", "v"]))
    with pytest.raises(TideError, match="Redshift"):
        redshift.render(s)
    with pytest.raises(TideError, match="cannot load"):
        redshift.check_loadable(s)


def test_json_schema():
    t = Struct((StructField("x", Array(OneOf(("a", "b"))), False), StructField("y", GeoJson(3857))))
    s = Schema(Table("t", (Column("a", Named("n"), False, "a comment"), Column("b", S.DECIMAL))), {"n": t})
    assert S.schema_from_json(S.schema_to_json(s)) == s
    assert S.schema_from_json('{"name": "t", "columns": [{"name": "a", "is_nullable": true, "data_type": "bool"}]}') == Schema(Table("t", (Column("a", S.BOOL),)))
    whole = json.loads(S.schema_to_json(s))
    for change, what in (
        (lambda x: x["tables"].append(x["tables"][0]), "one table"), (lambda x: x.update(more=1), "unknown keys"), (lambda x: x["tables"][0]["columns"][0].update(z=1), "unknown keys"),
        (lambda x: x["named_data_types"].clear(), "not defined"), (lambda x: x["tables"][0]["columns"][1].update(data_type="int8"), "no data type"), (lambda x: x["tables"][0]["columns"][1].pop("is_nullable"), "lacks"),
    ):
        copy = json.loads(json.dumps(whole))
        change(copy)
        with pytest.raises(TideError, match=what):
            S.schema_from_json(json.dumps(copy))


def test_names_may_be_used_twice_but_not_in_a_circle():
    pair = Struct((StructField("a", Named("x")), StructField("b", Named("x"))))
    Schema(Table("t", (Column("c", pair),)), {"x": S.INT16})
    with pytest.raises(TideError, match="by itself"):
        Schema(Table("t", ()), {"x": Array(Named("y")), "y": Named("x")})
    with pytest.raises(TideError, match="different names"):
        Schema(Table("t", (Column("c", Struct((StructField("a", S.TEXT), StructField("a", S.TEXT)))),)))


def test_spark_types_both_ways():
    s = postgres.parse(EVERYTHING)
    assert S.from_spark("shop.things", S.spark_schema(s), s.named) == s


def test_bigquery():
    nested = Array(Array(S.INT16))
    s = Schema(Table("t", (Column("a", nested), Column("b", Struct((StructField("x", S.DATE, False),)), False), Column("c", Array(Struct((StructField("y", S.FLOAT32),)))), Column("d", S.UUID), Column("e", GeoJson(3857)), Column("f", GeoJson()))))
    found = json.loads(bigquery.render(s))
    assert [(c["type"], c["mode"]) for c in found] == [("RECORD", "REPEATED"), ("RECORD", "REQUIRED"), ("RECORD", "REPEATED"), ("STRING", "NULLABLE"), ("STRING", "NULLABLE"), ("GEOGRAPHY", "NULLABLE")]
    assert bigquery.type_name(s, nested) == "ARRAY<STRUCT<ARRAY<INT64>>>" and bigquery.type_name(s, nested, True) == "STRING"
    assert bigquery.parse_type("ARRAY<STRUCT<ARRAY<INT64>>>") == Array(Array(S.INT64))
    assert bigquery.parse_type("struct<a string, b array<date>>") == Struct((StructField("a", S.TEXT), StructField("b", Array(S.DATE))))
    assert bigquery.parse('[{"name": "x", "type": "INTEGER"}]').table.columns == (Column("x", S.INT64),)
    for bad in ('[{"name": "x", "type": "BYTES"}]', '[{"name": "x y", "type": "INT64"}]', '[{"name": "x", "type": "INT64"}, {"name": "X", "type": "INT64"}]', '[{"name": "x", "type": "INT64", "mode": "ODD"}]'):
        with pytest.raises(TideError):
            bigquery.parse(bad)
    with pytest.raises(TideError, match="array of json"):
        bigquery.render(Schema(Table("t", (Column("a", Array(S.JSON)),))))


def random_type(rng, depth=2):
    name = rng.choice([*trino.PLAIN, "decimal", "varchar", "timestamp", "timestamp with time zone", "time", *(["array", "row"] if depth else [])])
    if name == "array":
        return trino.Type(name, element=random_type(rng, depth - 1))
    if name == "row":
        return trino.Type(name, fields=tuple((rng.choice([None, f"f{i}", 'q "x', "with space"]), random_type(rng, depth - 1)) for i in range(rng.randint(1, 3))))
    sizes = {"decimal": (rng.randint(10, 38), rng.randint(0, 9)), "varchar": rng.choice([(), (9,)]), "timestamp": (rng.randint(0, 9),), "timestamp with time zone": (6,), "time": (3,)}.get(name, ())
    return trino.Type(name, sizes)


@pytest.mark.parametrize("seed", range(60))
def test_trino_tables_are_read_as_they_are_written(seed):
    rng = random.Random(seed)
    columns = tuple((f"c{i} x", random_type(rng), rng.random() < 0.5, rng.choice([None, "it's"])) for i in range(rng.randint(1, 5)))
    options = (("format", "ORC"), ("transactional", True), ("n", 3), ("keys", ["a", "b"])) if rng.random() < 0.5 else ()
    made = trino.CreateTable(rng.choice(["t", "s.t", "c.s.t"]), columns, rng.random() < 0.3, options)
    assert trino.parse_create(str(made)) == made


@pytest.mark.parametrize("text", ["CHAR(3)", "TIME WITH TIME ZONE", "INTERVAL DAY TO SECOND", "MAP(VARCHAR, INT)"])
def test_trino_types_that_are_refused(text):
    with pytest.raises(ParseError, match="not supported"):
        trino.parse_type(text)


def test_trino_types():
    assert str(trino.parse_type('row("A" integer, timestamp with time zone)')) == 'ROW("a" INT, TIMESTAMP(3) WITH TIME ZONE)'
    assert trino.to_portable(trino.parse_type("ROW(INT, VARCHAR)")) == Struct((StructField("_f1", S.INT32), StructField("_f2", S.TEXT)))
    with pytest.raises(TideError, match="VARBINARY"):
        trino.to_portable(trino.parse_type("varbinary"))
    with pytest.raises(TideError, match="apart"):
        trino.create_table(Schema(Table("t", (Column("a", S.TEXT), Column("A", S.TEXT)))))


TS = """
// shapes
type int32 = number; type Id = string;
export interface Shape { id: Id, "n": int32; kind: "round" | "square", at?: Date; points: Point[], note: string | null; any: any, inner: { ok: boolean } }
interface Point { x: number, y: number }
interface Loop { next: Loop }
type Odd = string | number;
interface Bad { a: Odd }
"""


def test_typescript():
    s = typescript.parse(TS, "Shape")
    assert {c.name: (c.data_type, c.is_nullable) for c in s.table.columns} == {
        "id": (S.TEXT, False), "n": (S.INT32, False), "kind": (OneOf(("round", "square")), False), "at": (S.TIMESTAMPTZ, True),
        "points": (Array(Struct((StructField("x", S.FLOAT64, False), StructField("y", S.FLOAT64, False)))), False), "note": (S.TEXT, True), "any": (S.JSON, False), "inner": (Struct((StructField("ok", S.BOOL, False),)), False),
    }
    for name, what in (("Loop", "by itself"), ("Bad", "union"), ("Odd", "has to be an interface"), ("None", "does not define")):
        with pytest.raises(TideError, match=what):
            typescript.parse(TS, name)
    with pytest.raises(ParseError) as e:
        typescript.parse("interface A { x: string, x: number }", "A")
    assert str(e.value).count("line 1") == 2


def test_live_catalogs():
    rows = [
        ("id", "integer", "pg_catalog", "int4", "NO", None, None), ("xs", "ARRAY", "pg_catalog", "_int8", "YES", None, None), ("g", "USER-DEFINED", "public", "geometry", "YES", 3857, None),
        ("k", "USER-DEFINED", "shop", "color", "YES", None, "red\nit's"), ("v", "character varying", "pg_catalog", "varchar", "YES", None, None), ("c", "USER-DEFINED", "public", "citext", "YES", None, None),
    ]
    s = postgres.from_catalog("shop.t", rows)
    assert [c.data_type for c in s.table.columns] == [S.INT32, Array(S.INT64), GeoJson(3857), Named("shop.color"), S.TEXT, S.TEXT] and s.named == {"shop.color": OneOf(("red", "it's"))}
    assert "table_schema = 'shop' AND c.table_name = 't'" in postgres.catalog_query("shop.t") and "'public'" in postgres.catalog_query("t")
    for bad in ([], [("x", "money", "pg_catalog", "money", "YES", None, None)], [("x", "ARRAY", "public", "_color", "YES", None, None)]):
        with pytest.raises(TideError):
            postgres.from_catalog("t", bad)
    found = trino.from_catalog("t", [("a", "array(row(x integer))", "NO", None), ("b", "timestamp(6) with time zone", "YES", "note")])
    assert found.table.columns == (Column("a", Array(Struct((StructField("x", S.INT32),))), False), Column("b", S.TIMESTAMPTZ, True, "note"))
    assert trino.catalog_query("s.T").endswith("table_name = 't' AND table_schema = 's' ORDER BY ordinal_position")


def test_storage_expressions_as_text():
    from tabletide.plans.storage import affixes

    t = trino.parse_type
    assert affixes("memory", t("json"), True) == ("", "") and affixes("hive", t("json"), True) == ("JSON_FORMAT(", ")") and affixes("hive", t("json"), False) == ("JSON_PARSE(", ")")
    assert affixes("iceberg", t("array(smallint)"), True) == ("TRANSFORM(", ", x0 -> CAST(x0 AS INT))") and affixes("iceberg", t("array(smallint)"), False)[1] == ", x0 -> CAST(x0 AS SMALLINT))"
    before, after = affixes("iceberg", t("row(a tinyint, b varchar)"), True)
    assert before + "col" + after == 'ELEMENT_AT(TRANSFORM(ARRAY[col], r -> IF(r IS NULL, NULL, CAST(ROW(CAST(r[1] AS INT), r[2]) AS ROW("a" INT, "b" VARCHAR)))), 1)'
