"""Interchange text: strict reading, exact writing, nested values, null and empty cells."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabletide import schema as S
from tabletide.functions import decode, encode, literals
from tabletide.dialects.trino import parse_type
from tabletide.operators import rows
from tabletide.plans import storage
from tabletide.plans.copy import prepare
from tabletide.schema import Array, Column, GeoJson, OneOf, Schema, Struct, StructField, Table

ID = Column("id", S.INT32, False)


def one(t, nullable=True):
    return Schema(Table("t", (Column("v", t, nullable),)))


@pytest.fixture(scope="module")
def sql(spark):
    prepare(spark)
    return spark


def decoded(spark, t, cells, nullable=True):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(decode.column(one(t, nullable), Column("v", t, nullable), F.col("v"))).collect()]


UTC = dt.UTC
STAMP = dt.datetime(1987, 11, 5, 22, 41, 8)
GOOD = [
    (S.BOOL, ["1", "y", "YES", "On", "t", "True"], [True] * 6), (S.BOOL, ["0", "n", "No", "OFF", "f", "false"], [False] * 6), (S.DATE, ["1987-11-05", "2000-02-29"], [dt.date(1987, 11, 5), dt.date(2000, 2, 29)]),
    (S.INT16, ["-32768", "+7", "32767"], [-32768, 7, 32767]), (S.INT64, ["-9223372036854775808", "9223372036854775807"], [-(2**63), 2**63 - 1]), (S.DECIMAL, ["2.72", "-1", "0.700000000"], [Decimal("2.72"), Decimal(-1), Decimal("0.7")]),
    (S.FLOAT64, ["1e+37", "1000.125", "-0"], [1e37, 1000.125, 0.0]), (S.FLOAT32, ["1e-37"], [pytest.approx(1e-37, rel=1e-6)]), (S.TEXT, [" a ", "x"], [" a ", "x"]),
    (S.TIMESTAMP, ["1987-11-05 22:41:08", "1987-11-05 22:41:08.0", "1987-11-05T22:41:08"], [STAMP] * 3), (S.TIMESTAMP, ["1987-11-05T22:41:08.5"], [STAMP.replace(microsecond=500_000)]),
    (S.UUID, ["6fa459ea-ee8a-3ca4-894e-db77e160355e", "6FA459EAEE8A3CA4894EDB77E160355E", "{6fa459ea-ee8a-3ca4-894e-db77e160355e}"], ["6fa459ea-ee8a-3ca4-894e-db77e160355e"] * 3), (S.JSON, ['{"x": 1, "y": [2]}', "3", "null"], ['{"x": 1, "y": [2]}', "3", "null"]),
    (OneOf(("red", "green")), ["red", "green"], ["red", "green"]), (GeoJson(), ['{"type":"Point","coordinates":[13,-7]}', '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'], ['{"type":"Point","coordinates":[13,-7]}', '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}']),
    (Array(S.INT64), ['["-9223372036854775808", 0, null]', "[]"], [[-(2**63), 0, None], []]), (Array(S.TEXT), ['["hello",""]'], [["hello", ""]]), (Array(Array(S.BOOL)), ["[[true,false],[]]"], [[[True, False], []]]),
]


@pytest.mark.parametrize("t, cells, want", GOOD, ids=str)
def test_good_cells(sql, t, cells, want):
    assert decoded(sql, t, cells) == want


def test_time_zones(sql):
    cells = ["1987-11-05 22:41:08+00", "1987-11-05 20:11:08.0-0230", "1987-11-06 00:41:08.0+02:00", "1987-11-06T00:41:08.0+02:00", "1987-11-05T22:41:08Z"]
    df = sql.createDataFrame([(c,) for c in cells], "v string")
    value = decode.column(one(S.TIMESTAMPTZ), Column("v", S.TIMESTAMPTZ), F.col("v"))
    assert {r[0] for r in df.select(encode.cell(one(S.TIMESTAMPTZ), S.TIMESTAMPTZ, value)).collect()} == {"1987-11-05T22:41:08Z"}


BAD = [
    (S.BOOL, ["10", " t", "tt"]), (S.DATE, ["2001", "2001-01-01T10", "2001-02-30", " 2001-01-01", "x"]), (S.INT16, ["32768", " 1", "1.0", "", "0x1"]), (S.INT64, ["9223372036854775808", "1e3"]),
    (S.DECIMAL, ["1e5", "x", "1.0000000001", "9" * 40]), (S.FLOAT64, ["1.5d", " 1", "x"]), (S.TIMESTAMP, ["2001-01-01", "2001-01-01 10", "2001-01-01 10:00:00Z", "2001-01-01 25:00:00"]),
    (S.TIMESTAMPTZ, ["2001-01-01 10:00:00", "2001-01-01 10:00:00 UTC"]), (S.UUID, ["{6fa459ea-ee8a-3ca4-894e-db77e160355e", "6fa459ea-ee8a-3ca4-894e-db77e160355e}", "6fa459ea", "6fa459ea-ee8a-3ca4-894e-db77e160355g"]), (S.JSON, ["{", "{'a': 1}"]), (OneOf(("a",)), ["b", "A"]),
    (GeoJson(), ['{"type":"Feature","geometry":null}', '{"type":"Point","coordinates":[1]}', "x"]), (Array(S.INT32), ["{}", '["x"]', "[1", '[3000000000]', "1"]), (Struct((StructField("a", S.INT32, False),)), ["{}", "[]", '{"a": "x"}']),
]


@pytest.mark.parametrize("t, cell", [(t, c) for t, cells in BAD for c in cells], ids=str)
def test_bad_cells(sql, t, cell):
    with pytest.raises(Exception, match="column 'v"):
        decoded(sql, t, [cell], nullable=False)


KINDS = [
    (Array(S.TEXT), ["[1]", "[true]", '[{"a":1}]', "[[]]"]), (Array(S.BOOL), ['["yes"]', "[1]", '["true"]']), (Array(S.DATE), ["[20010101]"]), (Array(S.INT64), ["[true]", "[1.5]", "[[1]]"]), (Array(S.FLOAT64), ["[false]", '[{}]']),
    (Struct((StructField("a", S.TEXT),)), ['{"a": 5}', '{"a": false}']), (Struct((StructField("a", Array(S.BOOL)),)), ['{"a": [0]}', '{"a": true}']), (Array(OneOf(("1",))), ["[1]"]), (Array(S.UUID), ["[7]"]),
]


@pytest.mark.parametrize("t, cell", [(t, c) for t, cells in KINDS for c in cells], ids=str)
def test_json_of_another_kind(sql, t, cell):
    """Inside JSON only true and false are bool, and only strings are text."""
    with pytest.raises(Exception, match="column 'v"):
        decoded(sql, t, [cell])


def test_numbers_in_json(sql):
    assert decoded(sql, Array(S.INT64), ['["7", 8, null]']) == [[7, 8, None]]
    assert decoded(sql, Array(S.FLOAT64), ["[1, 2.5, 1e3]"]) == [[1.0, 2.5, 1000.0]]
    assert decoded(sql, Array(S.DECIMAL), ['[12345678901234567890.123456789, "0.5"]']) == [[Decimal("12345678901234567890.123456789"), Decimal("0.5")]]


def test_null_and_empty(sql):
    assert decoded(sql, S.TEXT, ["", None, "x"]) == [None, None, "x"]
    assert decoded(sql, S.TEXT, ["", None, "x"], nullable=False) == ["", "", "x"]
    assert decoded(sql, S.INT32, ["", None]) == [None, None]


def test_exact_output(sql):
    """What is read is written in the same way."""
    columns = (ID, *(Column(n, t) for n, t in (("b", S.BOOL), ("d", S.DATE), ("i16", S.INT16), ("i32", S.INT32), ("i64", S.INT64), ("t", S.TEXT), ("ts", S.TIMESTAMP), ("tz", S.TIMESTAMPTZ), ("u", S.UUID), ("Select", S.TEXT), ("e", S.Named("color")))))
    schema = Schema(Table("t", columns), {"color": OneOf(("red", "green"))})
    cells = [
        ("1", "t", "1987-11-05", "-32768", "-2147483648", "-9223372036854775808", "hello", "1987-11-05T22:41:08", "1987-11-05T22:41:08Z", "6fa459ea-ee8a-3ca4-894e-db77e160355e", None, "red"),
        ("2", "f", "2001-01-01", "32767", "2147483647", "9223372036854775807", None, "1987-11-05T22:41:08.5", "1987-11-05T22:41:08.000001Z", None, "x,\"y\"\n", "green"), ("3", *[None] * 11),
    ]
    df = sql.createDataFrame(cells, ", ".join(f"`{c.name}` string" for c in columns))
    assert [tuple(r) for r in rows.encoded(rows.decoded(df, schema), schema).orderBy("id").collect()] == cells


def random_type(rng, depth=2):
    kinds = [S.BOOL, S.DATE, S.DECIMAL, S.FLOAT64, S.INT16, S.INT32, S.INT64, S.TEXT, S.TIMESTAMP, S.UUID, OneOf(("a", "b c"))]
    if depth and rng.random() < 0.5:
        if rng.random() < 0.5:
            return Array(random_type(rng, depth - 1))
        return Struct(tuple(StructField(f"f{i} x", random_type(rng, depth - 1)) for i in range(rng.randint(1, 3))))
    return rng.choice(kinds)


def random_value(rng, t):
    if rng.random() < 0.2:
        return None
    if isinstance(t, Array):
        return [random_value(rng, t.element) for _ in range(rng.randint(0, 3))]
    if isinstance(t, Struct):
        return tuple(random_value(rng, f.data_type) for f in t.fields)
    if isinstance(t, OneOf):
        return rng.choice(t.values)
    return {
        S.BOOL: lambda: rng.random() < 0.5, S.DATE: lambda: dt.date(1900 + rng.randrange(200), 1 + rng.randrange(12), 1 + rng.randrange(28)), S.DECIMAL: lambda: Decimal(rng.randint(-(10**15), 10**15)).scaleb(-9),
        S.FLOAT64: lambda: rng.choice([0.5, 1e37, -1e-37, rng.random() * 1e6, 1e22, 123456789.0]), S.INT16: lambda: rng.randint(-(2**15), 2**15 - 1), S.INT32: lambda: rng.randint(-(2**31), 2**31 - 1), S.INT64: lambda: rng.randint(-(2**63), 2**63 - 1),
        S.TEXT: lambda: rng.choice(["x", "a \"b\"\n\\", "é 中 😀", "null", "[1]"]), S.TIMESTAMP: lambda: dt.datetime(1950 + rng.randrange(100), 3, 4, 5, 6, 7, rng.choice([0, 500_000, 1, 123_456])),
        S.UUID: lambda: "6fa459ea-ee8a-3ca4-894e-db77e160355e",
    }[t]()


@pytest.mark.parametrize("seed", range(8))
def test_values_survive(sql, seed):
    """Encoding and decoding give the value back, and JSON Lines too."""
    rng = random.Random(seed)
    columns = (ID, *(Column(f"c{i}", random_type(rng)) for i in range(4)))
    schema = Schema(Table("t", columns))
    data = [(i, *(random_value(rng, c.data_type) for c in columns[1:])) for i in range(25)]
    df = sql.createDataFrame(data, S.spark_schema(schema))
    want = [tuple(r) for r in df.orderBy("id").collect()]
    back = rows.decoded(rows.encoded(df, schema), schema)
    assert [tuple(r) for r in back.orderBy("id").collect()] == want
    lines = df.select(encode.json_line(schema).alias("line"))
    back = rows.decoded(lines.select(*decode.from_json_text(schema, F.col("line"))), schema)
    assert [tuple(r) for r in back.orderBy("id").collect()] == want


def test_json_lines(sql):
    schema = Schema(Table("t", (Column("n", S.INT64), Column("s", S.TEXT, False), Column("j", S.JSON))))
    cells = lambda line: [tuple(r) for r in sql.createDataFrame([(line,)], "line string").select(*decode.from_json_text(schema, F.col("line"))).collect()]
    assert cells('{"s": "x", "n": "9223372036854775807", "other": 1}') == [("9223372036854775807", "x", "")]
    assert cells('{"s": "x", "n": 5, "j": {"a": [1]}}') == [("5", "x", '{"a":[1]}')]
    for bad, what in (("[1]", "JSON object"), ('{"n": 1}', "unexpected NULL"), ('{"s": ""}', "unexpected NULL"), ('{"s": "x", "n": [1]}', "column 'n'"), ("{", "JSON object")):
        with pytest.raises(Exception, match=what):
            cells(bad)
    line = encode.json_line(schema)
    df = sql.createDataFrame([(2**53, "x", None), (2**53 - 1, "y", "[1]")], "n long, s string, j string")
    assert [r[0] for r in df.select(line).collect()] == ['{"n":"9007199254740992","s":"x","j":null}', '{"n":9007199254740991,"s":"y","j":[1]}']
    with pytest.raises(Exception, match="no number"):
        sql.createDataFrame([(float("nan"),)], "v double").select(encode.json_line(one(S.FLOAT64))).collect()


def test_no_python_in_plans(sql):
    schema = Schema(Table("t", (Column("v", Array(Struct((StructField("a", S.INT64),)))),)))
    df = sql.createDataFrame([("[]",)], "v string")
    plan = rows.encoded(rows.decoded(df, schema), schema)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_storage_profiles(sql):
    types = {"small": "smallint", "at": "timestamp(6)", "j": "json", "u": "uuid", "p": "SphericalGeography", "xs": "array(smallint)", "r": "row(a tinyint, varchar)", "t": "time(3)"}
    stored = {p: {n: str(storage.transform(p, parse_type(t)).stored) for n, t in types.items()} for p in storage.CAPABILITIES}
    assert stored["hive"] == {"small": "SMALLINT", "at": "TIMESTAMP(3)", "j": "VARCHAR", "u": "VARCHAR", "p": "VARCHAR", "xs": "ARRAY(SMALLINT)", "r": 'ROW("a" TINYINT, "f__2" VARCHAR)', "t": "VARCHAR"}
    assert stored["iceberg"] == {"small": "INT", "at": "TIMESTAMP(6)", "j": "VARCHAR", "u": "UUID", "p": "VARCHAR", "xs": "ARRAY(INT)", "r": 'ROW("a" INT, "f__2" VARCHAR)', "t": "TIME(6)"}
    assert all(storage.transform("memory", parse_type(t)).is_identity for t in types.values())
    row = sql.sql("select cast(7 as smallint) small, timestamp_ntz'2001-02-03 04:05:06.789012' at, '{\"type\":\"Point\",\"coordinates\":[1,-2.5]}' p, array(cast(1 as smallint), null) xs, named_struct('a', cast(3 as tinyint), '_f2', 'x') r, '10:11:12.5' t, cast(null as struct<a: tinyint, _f2: string>) nothing")
    for profile in storage.CAPABILITIES:
        for name in ("small", "p", "xs", "r", "t"):
            back = storage.load(profile, parse_type(types[name]), storage.store(profile, parse_type(types[name]), F.col(name)))
            want, got = row.select(name, back.alias("b")).first()
            assert got == want or name == "t" and got.rstrip("0") == want
        assert row.select(storage.load(profile, parse_type(types["r"]), storage.store(profile, parse_type(types["r"]), F.col("nothing")))).first()[0] is None
    assert row.select(storage.store("hive", parse_type("timestamp(6)"), F.col("at"))).first()[0] == dt.datetime(2001, 2, 3, 4, 5, 6, 789000)
    first, made = storage.storage_table("hive", storage.trino.CreateTable("t", (("a", parse_type("json"), False, None),), True), merge=True)
    assert first == ['DROP TABLE IF EXISTS "t"'] and made.columns[0][2] and dict(made.options) == {"format": "ORC", "transactional": True} and not made.or_replace
    assert "skip_header_line_count" in str(storage.csv_wrapper(made, "s3://x/", "abc"))


def test_literals():
    schema = one(S.TEXT)
    for t, value, want in (
        (S.BOOL, True, "TRUE"), (S.TEXT, 'a"é\n', '"a\\"\\U000000e9\\U0000000a"'), (S.INT64, -5, "-5"), (S.FLOAT64, 1000.125, "1000.125e0"), (S.FLOAT64, 1e37, "1e37"), (S.DECIMAL, Decimal("1.50"), 'NUMERIC "1.50"'),
        (S.DATE, dt.date(2001, 2, 3), 'DATE "2001-02-03"'), (S.TIMESTAMP, STAMP, 'DATETIME "1987-11-05T22:41:08"'), (S.TIMESTAMPTZ, STAMP.replace(tzinfo=UTC), 'TIMESTAMP "1987-11-05T22:41:08Z"'),
        (Array(Array(S.INT16)), [[1], []], "ARRAY[STRUCT(ARRAY[1]),STRUCT(ARRAY[])]"), (GeoJson(), "{}", 'ST_GEOGFROMGEOJSON("{}")'), (S.TEXT, None, "NULL"),
    ):
        assert literals.bigquery(schema, t, value) == want
    for t, value, want in (
        ("bigint", 5, "BIGINT '5'"), ("array(int)", [], "CAST(ARRAY[] AS ARRAY(INT))"), ("array(int)", [1, 2], "ARRAY[1, 2]"), ('row("a" int)', [1], 'CAST(ROW(1) AS ROW("a" INT))'), ("varchar", "it's", "'it''s'"),
        ("timestamp(3)", STAMP, "TIMESTAMP '1987-11-05 22:41:08.000'"), ("json", None, "CAST(NULL AS JSON)"), ("varbinary", b"\x01", "X'01'"), ("double", float("inf"), "DOUBLE 'Infinity'"),
    ):
        assert literals.trino(parse_type(t), value) == want


def test_close_enough():
    assert rows.close_enough([1.0, (dt.datetime(2001, 1, 1), "x")], [1.0 + 2e-16, (dt.datetime(2001, 1, 1, 0, 0, 0, 1500), "x")])
    assert not rows.close_enough(1.0, 1.0001) and not rows.close_enough([1], [1, 2]) and rows.close_enough(float("nan"), float("nan"))
    assert rows.close_enough({"type": "Point", "coordinates": [1.0, 2.0]}, {"type": "Point", "coordinates": [1.0, 2.00000001]})
